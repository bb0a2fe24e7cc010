"""Operator 2: mixing by iterative proportional fitting.

Documents are counted into cells (source, language, topic) of tokens.  The
cells' weights are raked: scaled to one marginal after the other until all
three hold their target shares.  A cell's ratio of raked weight to tokens gives
its documents' probability, and a hash of the id decides, so the sample does
not depend on partitions and expected token shares equal the targets.

Raking runs on the cell table, which is far smaller than the documents: per
step a sum over one dimension's value.  Nothing of it reaches the driver but
the error of a round.  A small cell table sits in one partition, where these
steps need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import broadcast_if_light, kept_table, words

DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 0.9}  # target share of a value: its token share to this power
NONE = "(none)"
WHOLE = "whole"  # the budget of all tokens there are
TOLERANCE, ROUNDS, ROUNDS_PER_JOB = 1e-7, 40, 4
CELLS_PER_PARTITION = 100_000

# The kinds of text that stand for topics, first match wins.
TOPICS = (("licence", ("icensed under", "rights reserved", "General Public License")), ("contact", ("@",)),
          ("table", (" | ",)), ("shouting", ("!! ",)))


def topic_of(text: Column) -> Column:
    """Topic of a whole text by marks it contains; ``prose`` without any."""
    out = None
    for name, marks in TOPICS:
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.contains(text, F.lit(m))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("prose")


def _features(docs: DataFrame, keep: list[str]) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col("doc_id").alias("key"),
                       F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
                       F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
                       topic_of(text).alias("topic"), F.size(words(text)).cast("long").alias("n_tokens"))


def target_shares(cells: DataFrame, dimension: str, target: float | dict[str, float]) -> DataFrame:
    """v, share: from a tempering power, or given shares (values left out get none; the rest are scaled to one)."""
    sums = cells.groupBy(F.col(dimension).alias("v")).agg(F.sum("tokens").alias("t"))
    if isinstance(target, dict):
        given = F.lit(0.0)
        for v, s in target.items():
            given = F.when(F.col("v") == v, float(s)).otherwise(given)
        sums = sums.select("v", given.alias("x"))
    else:
        sums = sums.select("v", F.pow(F.col("t").cast("double"), F.lit(float(target))).alias("x"))
    total = sums.agg(F.sum("x")).first()[0] or 1.0
    return sums.select("v", (F.col("x") / F.lit(float(total))).alias("share"))


def rake(cells: DataFrame, targets: dict[str, float | dict[str, float]], tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens > 0) with ``weight``: token weights whose marginals hold the targets.

    Stops when no share is off by ``tolerance`` of itself, or after ``rounds``
    (targets that no weights can meet, as when a value occurs only in cells
    whose other values have no share).
    """
    cells = kept_table(cells)
    parts = cells.count() // CELLS_PER_PARTITION + 1
    names, now = cells.columns, cells.coalesce(parts)
    for d, t in targets.items():
        share = target_shares(now, d, t).select(F.col("v").alias(f"v_{d}"), F.col("share").alias(f"share_{d}"))
        now = now.join(share, F.col(d) == F.col(f"v_{d}")).drop(f"v_{d}")
    whole = F.lit(float(cells.agg(F.sum("tokens")).first()[0] or 0))
    now = kept_table(now.withColumn("weight", F.col("tokens").cast("double"))).coalesce(parts)
    for _ in range(0, rounds, ROUNDS_PER_JOB):
        for k in range(ROUNDS_PER_JOB):
            off = F.lit(0.0)
            for d in targets:
                now = now.withColumn(f"m_{d}", F.sum("weight").over(W.partitionBy(d)))
                want = F.col(f"share_{d}") * whole
                off = F.greatest(off, F.when((F.col(f"m_{d}") > 0) & (want > 0), F.abs(F.col(f"m_{d}") / want - 1)).otherwise(0.0))
                now = now.withColumn("weight", F.when(F.col(f"m_{d}") > 0, F.col("weight") * want / F.col(f"m_{d}")).otherwise(0.0))
        now = kept_table(now.withColumn("off", off).drop(*[f"m_{d}" for d in targets])).coalesce(parts)
        if (now.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
        now = now.drop("off")
    return now.select(*names, "weight")


def mix(docs: DataFrame, targets: dict[str, float | dict[str, float]] | None = None, budget: float | str | None = None,
        keep: tuple[str, ...] = ("doc_id",), seed: int = 0) -> DataFrame:
    """The columns ``keep`` of every document, with mix_source, mix_lang, mix_topic, mix_tokens, weight, probability, kept, repeats.

    ``weight`` is the raked weight per token.  Without ``budget`` the
    probabilities are the largest that keep every ratio, so the rarest cell
    limits all; with one (in tokens, or ``WHOLE``) they aim at it and are cut at
    1.  ``repeats`` is not cut: it says how often a document is to be taken for
    expected token shares that equal the targets (0 where not kept).  Null sources and languages are the value
    ``(none)``.  A document without words has weight 0 and is not kept (there is
    nothing to sample).  Repeated rows draw alike; a null id draws as such.
    """
    targets = targets or TEMPER
    rows = _features(docs, list(keep))
    cells = rows.where("n_tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    raked = kept_table(rake(cells, targets).withColumn("ratio", F.col("weight") / F.col("tokens")))
    most, total, tokens = raked.agg(F.max("ratio"), F.sum("weight"), F.sum("tokens")).first()
    aim = tokens if budget == WHOLE else budget
    scale = (1 / most if aim is None else aim / total) if most else 0.0
    raked = raked.select(*[F.col(d).alias(f"c_{d}") for d in DIMENSIONS], "ratio")
    raked = broadcast_if_light(raked, F.length(F.concat(*[f"c_{d}" for d in DIMENSIONS])))
    draw = F.shiftrightunsigned(F.xxhash64(F.col("key").cast("string"), F.lit(f"mix {seed}")), 11) / F.lit(float(1 << 53))
    met = rows.join(raked, (F.col("source") == F.col("c_source")) & (F.col("lang") == F.col("c_lang")) & (F.col("topic") == F.col("c_topic")), "left")
    met = met.withColumn("weight", F.when(F.col("n_tokens") > 0, F.coalesce("ratio", F.lit(0.0))).otherwise(0.0))
    times = F.col("weight") * scale
    met = met.withColumn("probability", F.least(F.lit(1.0), times))
    return met.select("row.*", F.col("source").alias("mix_source"), F.col("lang").alias("mix_lang"), F.col("topic").alias("mix_topic"),
                      F.col("n_tokens").alias("mix_tokens"), "weight", "probability", (draw < F.col("probability")).alias("kept"),
                      (F.floor(times) + (draw < times - F.floor(times)).cast("long")).alias("repeats"))
