"""Ordered-series and id-set operators.

The reference solves each on one small list; here every group of a table is
solved at once.  Input shape: ``(g, pos, v)`` (0-based ``pos``) or points
``(g, pos, x, y)``.  Per-group windows go through
:mod:`tessera.operators.segmented` so a hot group is split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import segmented

ID_BLOCK = 1 << 20  # ids generated per block when enumerating an expected range


def smaller_count(series: DataFrame) -> DataFrame:
    """How many values of the group are smaller.

    Rows are first counted per (g, v), so a value that a whole group shares is
    one row; a running sum over the distinct values is joined back.
    """
    counts = series.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    s = segmented.slice_groups(counts, ["g"], ["v"])
    w = Window.partitionBy("g", segmented.SLICE).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = s.withColumn("_in", F.coalesce(F.sum("n").over(w), F.lit(0)))
    sums = s.groupBy("g", segmented.SLICE).agg(F.sum("n").alias("_s"))
    before = sums.withColumn("_off", F.coalesce(F.sum("_s").over(segmented._earlier_slices(["g"])), F.lit(0)))
    below = segmented._with_summary(local, before, ["g"], ["_off"]).select(
        F.col("g").alias("_g"), F.col("v").alias("_v"), (F.col("_in") + F.col("_off")).alias("smaller"))
    return series.join(below, F.col("g").eqNullSafe(F.col("_g")) & F.col("v").eqNullSafe(F.col("_v"))).select("g", "pos", "v", "smaller")


def best_rise(series: DataFrame, order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """max(v - lowest earlier v) per group, at least 0."""
    m = segmented.min_before(series, ["g"], list(order), "v", out="_prev_min")
    return m.groupBy("g").agg(
        F.greatest(F.lit(0).cast("bigint"), F.coalesce(F.max(F.col("v") - F.col("_prev_min")), F.lit(0).cast("bigint"))).alias("best_rise"))


def path_length(points: DataFrame, order: tuple[str, ...] = ("pos",)) -> DataFrame:
    """W03 + F18: sum of max(|dx|, |dy|) between neighbours; 0 under two points."""
    p = segmented.previous_row(points, ["g"], list(order), ["x", "y"])
    step = F.greatest(F.abs(F.col("x") - F.col("prev_x")), F.abs(F.col("y") - F.col("prev_y")))
    return p.groupBy("g").agg(F.coalesce(F.sum(step), F.lit(0).cast("bigint")).alias("path_length"))


def pair_sum(series: DataFrame, target: int) -> DataFrame:
    """Per group the first index pair (lowest i, then lowest j), i < j,
    with v_i + v_j = target; groups without one are absent.

    No pairs are enumerated: a per-(g, value) table of last positions says
    whether element i has a partner after it (equi-join on ``target - v``),
    the lowest such i wins, and its partner is the first matching position
    after it.  Each join matches one row per element.
    """
    stats = series.groupBy("g", "v").agg(F.max("pos").alias("last_pos"))
    cand = (series.alias("e")
            .join(stats.alias("s"), (F.col("e.g") == F.col("s.g")) & (F.col("s.v") == F.lit(target) - F.col("e.v")))
            .where(F.col("s.last_pos") > F.col("e.pos"))
            .select(F.col("e.g").alias("g"), F.col("e.pos").alias("pos"), F.col("e.v").alias("v")))
    first_i = cand.groupBy("g").agg(F.min(F.struct("pos", "v")).alias("i"))
    i = first_i.select("g", F.col("i.pos").alias("i"), F.col("i.v").alias("vi"))
    j = (series.join(i, "g")
         .where((F.col("v") == F.lit(target) - F.col("vi")) & (F.col("pos") > F.col("i")))
         .groupBy("g", "i", "vi").agg(F.min("pos").alias("j")))
    return j.select("g", "i", "j", F.col("vi").alias("v_i"), (F.lit(target) - F.col("vi")).alias("v_j"))


def has_duplicates(series: DataFrame) -> DataFrame:
    """count(*) > count(distinct v) per group."""
    return series.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("n_distinct")).withColumn(
        "has_duplicates", F.col("n") > F.col("n_distinct"))


def missing_by_sum(values: DataFrame) -> DataFrame:
    """The one missing number of 0..n from n values, ``n(n+1)/2 - sum``."""
    a = values.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    # decimal, since n * (n + 1) passes 64 bits at three thousand million rows; halving it is exact
    n = F.col("n").cast("decimal(19,0)")
    return a.select("g", "n", ((n * (n + 1) * F.expr("0.5BD")) - F.col("s")).cast("bigint").alias("missing"))


def expected_ids(bounds: DataFrame, lo: str = "lo", hi: str = "hi", block: int = ID_BLOCK) -> DataFrame:
    """Enumerate lo..hi per bounds row without one task doing all of it:
    blocks of ``block`` ids are exploded first and spread over partitions,
    then each block expands to its ids."""
    blocks = bounds.select(*[c for c in bounds.columns if c not in (lo, hi)], lo, hi, F.explode(
        F.when(F.col(hi) >= F.col(lo), F.sequence(F.floor(F.col(lo) / block).cast("bigint"), F.floor(F.col(hi) / block).cast("bigint")))
        .otherwise(F.array().cast("array<bigint>"))).alias("_b"))
    spread = blocks.repartition("_b")
    start = F.greatest(F.col(lo), F.col("_b") * block)
    end = F.least(F.col(hi), F.col("_b") * block + block - 1)
    keep = [c for c in bounds.columns if c not in (lo, hi)]
    return spread.select(*keep, F.explode(F.sequence(start.cast("bigint"), end.cast("bigint"))).alias("id"))


def missing_ranges(present: DataFrame, bounds: DataFrame) -> DataFrame:
    """U02 as intervals (lo, hi): the gaps between neighbouring present ids of one lo..hi ``bounds`` row.

    Gaps and islands: each id meets the one before it (skew-safe, by slices),
    so the work follows the ids that are present, never the width of the range.
    A NULL bound gives no gap.
    """
    edge = bounds.select(F.col("lo").cast("bigint").alias("_lo"), F.col("hi").cast("bigint").alias("_hi")).where("_lo <= _hi")
    first = edge.first()
    if first is None:
        return edge.select(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))
    lo, hi = first["_lo"], first["_hi"]
    have = present.select(F.col("id").cast("bigint").alias("id")).where(F.col("id").between(lo, hi)).distinct()
    # the first id has no neighbour before it, and the range ends after the last
    have = have.union(have.sparkSession.createDataFrame([(hi + 1,)], "id bigint"))
    next_to = segmented.previous_row(have, [], ["id"], ["id"])
    gaps = next_to.select((F.coalesce("prev_id", F.lit(lo - 1)) + 1).alias("lo"), (F.col("id") - 1).alias("hi"))
    return gaps.where("lo <= hi")


def missing_ids(present: DataFrame, bounds: DataFrame) -> DataFrame:
    """Ids of the expected range that are not present: the gaps, expanded in blocks."""
    return expected_ids(missing_ranges(present, bounds)).select("id")


def membership(left: DataFrame, right: DataFrame, key_left: str, key_right: str) -> DataFrame:
    """Rows of ``left`` whose key is in ``right`` (``left_semi``)."""
    return left.join(right.select(F.col(key_right).alias(key_left)), key_left, "left_semi")
