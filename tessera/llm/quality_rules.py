"""Operator 1: quality rules as a short-circuit cascade.

Every rule is a Boolean column over a few features of the whole text.  On a
bounded sample each rule's cost (seconds to evaluate it) and selectivity (share
it rejects) are measured; the rules then run in order of rejections per cost,
inside one CASE expression that stops at the first rule that rejects.  The
order changes the time and the rule that is named, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, kept_table, no_space, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 2000
BASE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a Column over ``text``, ``words`` and the base features."""
    name: str
    rejects: Callable[[], Column]


def _share(pred) -> Column:
    return F.size(F.filter("words", pred))


RULES = (
    Rule("symbol_ratio", lambda: F.col("n_symbols") * 10 > F.col("n_words")),
    Rule("duplicate_lines", lambda: F.col("n_dup_lines") * 2 > F.col("n_lines")),
    Rule("word_length", lambda: (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 15)),
    Rule("shouting", lambda: _share(lambda w: (w == F.upper(w)) & (F.length(w) > 1) & (w != F.lower(w))) * 2 > F.col("n_words")),
    Rule("no_letters", lambda: _share(lambda w: F.upper(w) == F.lower(w)) * 2 > F.col("n_words")),
    Rule("control_characters", lambda: F.regexp_count("text", F.lit(r"[\x00-\x08\x0E-\x1F\x7F�]")) * 100 > F.length("text")),
)


def features(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, words and the base features of every whole text (null: no word)."""
    df = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                     *[F.col(c).alias(c) for c in keep])
    df = df.withColumn("words", words(F.col("text")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, SPACE, "") != ""))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    # one hash per window of eight words; get() is constant time, slice() copies the whole array
    df = df.withColumn("windows", F.when(F.col("n_words") >= WINDOW, F.slice(F.transform(
        "words", lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WINDOW)])),
        F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("again", F.size("windows") > F.size(F.array_distinct("windows")))
    # only texts with a repeat sort their windows
    df = df.withColumn("sorted", F.when(F.col("again"), F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))

    def same(x, y):
        equal = F.lit(True)
        for k in range(WINDOW):
            equal = equal & (F.get("words", x["i"] + k) == F.get("words", y["i"] + k))
        return F.coalesce((x["h"] == y["h"]) & equal, F.lit(False))

    twice = F.filter("sorted", lambda x, j: same(x, F.get("sorted", j - 1)) | same(x, F.get("sorted", j + 1)))
    df = df.withColumn("places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate("places", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                          lambda a, p: F.struct((p + WINDOW).alias("end"),
                                                (a["n"] + p + WINDOW - F.greatest(a["end"], p)).alias("n")), lambda a: a["n"])
    return df.select(
        "doc_id", "text", "words", *keep, "n_words",
        F.length(no_space(F.col("text"))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def measure(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, rejected share) on at most ``sample_rows`` rows, best rejection per cost first.

    Rows come from the whole table by a hash of the id.  Each rule runs twice;
    the faster run counts, since the first one compiles.
    """
    n = docs.count()
    if not n:
        return [(r, 0.0, 0.0) for r in rules]
    every = max(1, n // sample_rows)
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).limit(sample_rows)
    # materialised before the filter, which would otherwise be pushed below and recompute the features
    sample = kept_table(features(picked).coalesce(1)).where(~base_failed())
    rows, out = max(sample.count(), 1), []
    for r in rules:
        best, hit = None, 0
        for _ in range(2):
            t0 = time.perf_counter()
            hit = sample.agg(F.sum(r.rejects().cast("int"))).first()[0] or 0
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
        out.append((r, best, hit / rows))
    return cascade_order(out)


def cascade_order(measured: list[tuple[Rule, float, float]]) -> list[tuple[Rule, float, float]]:
    """Most rejections per second first; ties: the cheaper rule, then the name."""
    return sorted(measured, key=lambda m: (-m[2] / max(m[1], 1e-6), m[1], m[0].name))


def quality(docs: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS, order: list[Rule] | None = None) -> DataFrame:
    """doc_id, the base features, base_failed, kept and rejected_by of every document.

    A null or empty text has no word, so it fails the base.  ``rejected_by`` is
    ``base``, or the first rule of the cascade that rejects, or null.  Repeated
    rows are judged alike and all returned; other columns are not read.
    """
    order = order or [m[0] for m in measure(docs, rules, sample_rows)]
    df = features(docs)
    why = F.when(base_failed(), F.lit("base"))
    for r in order:
        why = why.when(r.rejects(), F.lit(r.name))
    df = df.withColumn("rejected_by", why)
    return df.select("doc_id", *BASE[:3], "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
                     F.col("rejected_by").isNull().alias("kept"), "rejected_by")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
tok AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
win AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o
         || ' ' || lead(word, 4) OVER o || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o
         || ' ' || lead(word, 7) OVER o AS k
  FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM win WHERE k IS NOT NULL),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice WHERE n > 1)
  GROUP BY doc_id),
f AS (
  SELECT d.doc_id, t, w, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR n_dup_lines * 2 > n_lines
            OR word_chars < n_words * 2 OR word_chars > n_words * 15
            OR len(list_filter(w, lambda x: x = upper(x) AND length(x) > 1 AND x <> lower(x))) * 2 > n_words
            OR len(list_filter(w, lambda x: upper(x) = lower(x))) * 2 > n_words
            OR len(regexp_extract_all(t, '[\x00-\x08\x0E-\x1F\x7F\x{FFFD}]')) * 100 > length(t)) AS kept
FROM b
"""
