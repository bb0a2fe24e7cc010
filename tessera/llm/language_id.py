"""Operator 4: language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent character n-grams (one to
three letters, words padded with a blank) over the learning documents.  A
document's own list is compared with each profile by the out-of-place distance:
the sum over its n-grams of how far each stands from its rank in the profile,
the list's length for one that is absent (Cavnar and Trenkle).
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import broadcast_if_light, kept_table

PROFILE = 400
LEARN_DOCS = 3000  # per language, at most, on average
UNKNOWN = "und"
_BITS = 21  # of a code point: three fit one exact 64-bit code


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of the whole text, ascending, and their counts."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    a = np.where(_letters()[a], a, 32)
    a = np.concatenate([[32], a, [32]])
    a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]
    if len(a) < 3:
        return none, none
    two = (a[:-1] << _BITS) | a[1:]
    three = (two[:-1] << _BITS) | a[2:]
    codes = np.concatenate([a[a != 32], two, three[a[1:-1] != 32]])
    codes.sort()
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes in order; ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def _count(batches):
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for pdf in batches:
        for lang, own in pdf.groupby("lang")["text"]:
            for lo in range(0, len(own), 64):
                found = [grams(t) for t in own.iloc[lo:lo + 64]]
                if lang in total:
                    found.append(total[lang])
                codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                total[lang] = codes, np.bincount(at, np.concatenate([n for _, n in found]), len(codes)).astype(np.int64)
    for lang, (codes, n) in total.items():
        if len(codes):
            yield pd.DataFrame({"lang": lang, "code": codes, "n": n})


def learn(docs: DataFrame, profile: int = PROFILE, learn_docs: int = LEARN_DOCS) -> dict[str, np.ndarray]:
    """Profiles from ``docs`` (doc_id, text, lang); rows without lang or text teach nothing.

    ``learn_docs`` bounds the sample per language: a hash of the id decides, so
    it does not depend on partitions.  Only ``profile`` codes per language
    reach the driver.
    """
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("lang is not null and text is not null")
    share = docs.groupBy("lang").agg((F.lit(float(learn_docs)) / F.count(F.lit(1))).alias("share"))
    # a few languages: no text is moved to meet them
    share = broadcast_if_light(kept_table(share.withColumnRenamed("lang", "share_lang")), F.length("share_lang"))
    picked = (docs.join(share, F.col("lang") == F.col("share_lang"))
              .where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("learn")), F.lit(1_000_000)) < F.col("share") * 1_000_000)
              .select("lang", "text"))
    counts = picked.mapInPandas(_count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = (counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code")))
           .where(F.col("rank") <= profile).select("lang", "rank", "code"))
    out: dict[str, list] = {}
    for r in sorted(top.collect()):
        out.setdefault(r["lang"], []).append(r["code"])
    return {k: np.array(v, np.int64) for k, v in sorted(out.items())}


def _classify(profiles: dict[str, np.ndarray], size: int, keep_text: bool = False):
    langs = list(profiles)
    codes = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
    ranks = np.full((len(langs), len(codes) + 1), size, np.int64)
    for i, own in enumerate(profiles.values()):
        ranks[i, np.searchsorted(codes, own)] = np.arange(len(own))

    def one(text) -> tuple[str, float]:
        own = ranked(*grams(text), size)
        if not len(own) or not langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        at = np.where(codes[at] == own, at, len(codes))
        absent = ranks[:, at] == size
        far = np.where(absent, size, np.abs(ranks[:, at] - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(far))  # ties: the first name
        return langs[best], 1.0 - float(far[best]) / (size * len(own))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # what goes back is as small: it holds whole texts
                part = batch.slice(lo, 256)
                found = [one(t) for t in part.column(part.num_columns - 1).to_pylist()]
                own = part.columns if keep_text else part.columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                    names=[*part.schema.names[:len(own)], "lang_pred", "score"])
        pa.default_memory_pool().release_unused()  # workers live on
    return run


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], profile: int = PROFILE, keep: tuple[str, ...] = (),
            keep_text: bool = False) -> DataFrame:
    """doc_id, the columns ``keep``, text if asked for, lang_pred, score of every row from its whole text alone.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text when nothing was learned.  Equal distances go to the first language
    name.  Repeated rows are all answered; other columns are not read.
    """
    columns = ["doc_id", *keep, "text"]
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    schema = ", ".join(kinds[:len(kinds) - (not keep_text)] + ["lang_pred string", "score double"])
    return docs.select(*columns).mapInArrow(_classify(profiles, profile, keep_text), schema)


def held_out():
    """True where the crc32 of the id as text is a multiple of 5 (null id: false)."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def learn_from_rest(docs: DataFrame, **kw) -> dict[str, np.ndarray]:
    """Profiles learned from the documents that are not held out."""
    return learn(docs.where(~held_out() & F.col("doc_id").isNotNull()), **kw)
