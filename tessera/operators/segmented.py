"""Skew-safe per-group ordered computations (ranks, running minimum, previous row).

A window ``PARTITION BY g ORDER BY o`` sends every row of ``g`` to one task.
When one group may hold a third of the table that task is the job.  These
helpers split each group into ordered *slices* instead:

1. the rows are range-partitioned by (g, o): Spark samples the bounds, equal
   keys share a partition, a hot group spans many.  The partition number is the
   slice.  The result is written once as a reliable checkpoint, so every branch
   of the plan and every task that runs again sees the same slices, and the
   input is computed once;
2. the window runs per ``(g, slice)`` -- bounded by the slice size;
3. a per-(g, slice) summary (one row per slice, small) gives what earlier
   slices contribute -- counts for ranks, minimum for running minimum, last
   row for the previous-row lookup -- and is joined back.

Slices are as many as ``spark.sql.shuffle.partitions`` (sized for the data, as
for any shuffle).  Keys are ascending, NULL first; a NULL group is a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

SLICE = "_slice"


def slice_groups(df: DataFrame, group: list[str], order: list[str], n: int | None = None) -> DataFrame:
    """Tag each row with its ordered slice of (group, order); materialised once.  Rows that are sliced stay as they are."""
    if SLICE in df.columns:
        return df
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    spread = df.repartitionByRange(n, *group, *order) if n > 1 else df.coalesce(1)
    return cut_lineage(spread.withColumn(SLICE, F.spark_partition_id()))


def _earlier_slices(w_group: list[str]):
    return Window.partitionBy(*w_group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _with_summary(rows: DataFrame, summary: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """Join a per-(group, slice) summary back; NULL groups meet NULL groups."""
    right = summary.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, SLICE])], *cols)
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*group, SLICE])]
    return rows.join(right, reduce(lambda a, b: a & b, on)).drop(*[f"_k{i}" for i in range(len(on))])


def ranked(df: DataFrame, group: list[str], order: list[str], out: str = "rank",
           method: str = "rank", n: int | None = None) -> DataFrame:
    """``rank()`` (ties share the lowest) or ``row_number()`` within ``group``, as bigint.

    Equal (group, order) keys always land in one slice, so ties never
    straddle a slice boundary and ``rank`` stays exact.
    """
    s = slice_groups(df, group, order, n)
    w = Window.partitionBy(*group, SLICE).orderBy(*order)
    fn = F.rank() if method == "rank" else F.row_number()
    local = s.withColumn("_local", fn.over(w))
    counts = s.groupBy(*group, SLICE).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(_earlier_slices(group)), F.lit(0)))
    j = _with_summary(local, offsets, group, ["_off"])
    return j.withColumn(out, F.col("_local").cast("bigint") + F.col("_off")).drop("_local", "_off", SLICE)


def min_before(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
               n: int | None = None) -> DataFrame:
    """Minimum of ``value`` over the earlier rows of the group (NULL for the first)."""
    return running(df, group, order, value, out, fn="min", inclusive=False, n=n)


def previous_row(df: DataFrame, group: list[str], order: str | list[str], cols: list[str], prefix: str = "prev_",
                 n: int | None = None, next_prefix: str | None = None) -> DataFrame:
    """Values of ``cols`` on the previous row of the group, and on the next one if ``next_prefix`` is given."""
    order = [order] if isinstance(order, str) else order
    s = slice_groups(df, group, order, n)
    w = Window.partitionBy(*group, SLICE).orderBy(*order)
    per_group = Window.partitionBy(*group).orderBy(SLICE)
    key = F.struct(*order)
    local = s.withColumn("_before", F.lag(F.struct(*cols)).over(w)).withColumn("_after", F.lead(F.struct(*cols)).over(w))
    ends = s.groupBy(*group, SLICE).agg(F.max_by(F.struct(*cols), key).alias("_last"), F.min_by(F.struct(*cols), key).alias("_first"))
    ends = ends.withColumn("_prev", F.lag("_last").over(per_group)).withColumn("_next", F.lead("_first").over(per_group))
    j = _with_summary(local, ends, group, ["_prev", "_next"])
    for c in cols:
        j = j.withColumn(prefix + c, F.coalesce("_before", "_prev")[c])
        if next_prefix:
            j = j.withColumn(next_prefix + c, F.coalesce("_after", "_next")[c])
    return j.drop("_before", "_after", "_prev", "_next", SLICE)


def running(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
            fn: str = "max", inclusive: bool = True, n: int | None = None) -> DataFrame:
    """Running ``min`` / ``max`` of ``value`` in (group, order) order, over the
    rows up to the current one (``inclusive``) or before it; NULLs skipped."""
    agg = F.max if fn == "max" else F.min
    comb = F.greatest if fn == "max" else F.least
    s = slice_groups(df, group, order, n)
    end = Window.currentRow if inclusive else -1
    w = Window.partitionBy(*group, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = s.withColumn("_lrun", agg(value).over(w))
    per = s.groupBy(*group, SLICE).agg(agg(value).alias("_srun"))
    before = per.withColumn("_brun", agg("_srun").over(_earlier_slices(group)))
    j = _with_summary(local, before, group, ["_brun"])
    return j.withColumn(out, comb("_lrun", "_brun")).drop("_lrun", "_brun", SLICE)
