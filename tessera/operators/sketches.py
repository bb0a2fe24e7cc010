"""Mergeable summaries: distinct counts (A12) and quantiles (A25) that need no rows once made.

A sketch per group is a small binary value.  Sketches of finer groups, or of the
batches of a stream, are merged into those of coarser ones, so a roll-up reads
the rows once, whatever the number of levels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12  # log2 of an HLL sketch's slots
KLL_K = 200  # accuracy of a KLL sketch
# fixed values of the sketches: relative standard error of HLL is 1.04 / sqrt(slots); a KLL sketch with k = 200 is
# within 1.65 % of the rank in 99 of 100 cases
HLL_ERRORS = 3  # standard errors that the stated bound allows
KLL_RANK_ERROR = 0.0165


def hll_bound(lg_k: int = LG_K) -> float:
    """Relative error that an estimate stays within (three standard errors)."""
    return HLL_ERRORS * 1.04 / math.sqrt(1 << lg_k)


def distinct_sketches(df: DataFrame, keys: list[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """``keys``, sketch: the distinct non-null values of each group as an HLL sketch."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups (or of one group over several batches) from finer ones."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str | Column = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def distinct_levels(df: DataFrame, levels: list[list[str]], value: str, lg_k: int = LG_K) -> DataFrame:
    """level, the keys (null where a level has none), n_estimate: distinct values at every level.

    Levels go from fine to coarse, each one's keys among those of the one before.
    The rows are read for the finest; the others merge its sketches.
    """
    every = levels[0]
    at, found = distinct_sketches(df, every, value, lg_k), []
    for i, keys in enumerate(levels):
        at = at if i == 0 else merged_distinct(at, keys)
        kind = {f.name: f.dataType for f in df.schema.fields}
        found.append(at.select(F.lit(i).alias("level"), *[F.col(k) if k in keys else F.lit(None).cast(kind[k]).alias(k) for k in every],
                               estimate().alias("n_estimate")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = KLL_K) -> DataFrame:
    """``keys``, sketch: the non-null values of each group as a KLL sketch (null if it has none)."""
    # a sketch of no value cannot be asked for a quantile
    some = df.where(F.col(value).isNotNull())
    return some.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: list[str], k: int = KLL_K) -> DataFrame:
    """Sketches of coarser groups (or of one group over several batches) from finer ones."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile(p: float, sketch: str | Column = "sketch") -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(p))
