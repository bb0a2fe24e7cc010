"""Per-document error isolation (T06) and quality metrics.

T06: instead of a try/except around each document, every check is a column
expression; rows with an error go to a quarantine frame or folder and the rest
go on.  Expressions that can fail on a value are ``try_`` forms, so an error is
a row's own and has the name of the expression.
A25: metrics named in the requirements prose -- a percentile latency-style
summary and precision / recall / F1 / accuracy from conditional sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import bracket_chars, brackets_balanced
from tessera.operators import segmented
from tessera.session import shared

# fixed values: quarantine reasons
NO_TEXT = "no text"
LENGTH_MISMATCH = "length mismatch"
UNBALANCED = "unbalanced brackets"


def document_errors(docs: DataFrame) -> DataFrame:
    """``error`` column (NULL when the document is fine)."""
    return docs.withColumn("error", F.when(F.col("text").isNull(), F.lit(NO_TEXT))
                           .when(F.length("text") != F.col("n_chars"), F.lit(LENGTH_MISMATCH))
                           .when(~brackets_balanced(bracket_chars("text")), F.lit(UNBALANCED)))


def isolated(df: DataFrame, parts: dict[str, tuple[str, Column]]) -> DataFrame:
    """Evaluate expressions that may fail, each on its own: one bad value never stops the job or hides the others.

    ``parts`` maps a new column to (the column it reads, an expression that gives
    NULL instead of raising: ``try_cast``, ``try_variant_get``, ``try_divide`` ...).
    An expression failed where its input is there and its value is not; the names
    of those that did are the array ``errors`` (empty when all is well).
    """
    out = df.select("*", *[e.alias(name) for name, (_, e) in parts.items()])
    failed = [F.when(F.col(of).isNotNull() & F.col(name).isNull(), F.lit(name)) for name, (of, _) in parts.items()]
    return out.withColumn("errors", F.filter(F.array(*failed), lambda x: x.isNotNull()))


def json_field(text: str, path: str, kind: str) -> Column:
    """A field of a JSON text as ``kind``; NULL if the text is no JSON, or the field is absent or of another kind."""
    return F.try_variant_get(F.try_parse_json(F.col(text)), path, kind)


def quarantine(df: DataFrame, folder: str, errors: str = "errors") -> DataFrame:
    """T06 sink: rows with errors are appended to ``folder`` (Parquet, one row each, with the names of what failed);
    returns the other rows.  Both come from one checkpoint, so they fit together even if an input changes."""
    df = shared(df)
    df.where(F.size(errors) > 0).write.mode("append").parquet(folder)
    return df.where(F.size(errors) == 0).drop(errors)


def split_errors(df: DataFrame, error_col: str = "error"):
    """(good rows, quarantine rows) -- one pass each, no driver loop."""
    return df.where(F.col(error_col).isNull()).drop(error_col), df.where(F.col(error_col).isNotNull())


def percentile_by(df: DataFrame, group: str, value: str, p: float = 0.9) -> DataFrame:
    """Exact percentile (linear interpolation) and count per group.

    Values are counted first, then a running count over the distinct values
    (sliced, see :mod:`segmented`) finds the two neighbours of the wanted
    place; no group's values meet in one buffer.  NULL values do not count.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    s = segmented.slice_groups(counts, ["g"], ["v"])
    w = Window.partitionBy("g", segmented.SLICE).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = s.withColumn("_in", F.coalesce(F.sum("k").over(w), F.lit(0)))
    sums = s.groupBy("g", segmented.SLICE).agg(F.sum("k").alias("_s"))
    before = sums.withColumn("_off", F.coalesce(F.sum("_s").over(segmented._earlier_slices(["g"])), F.lit(0)))
    at = segmented._with_summary(local, before, ["g"], ["_off"]).select("g", "v", "k", (F.col("_in") + F.col("_off")).alias("lo"))
    total = s.groupBy(F.col("g").alias("_g")).agg(F.sum("k").alias("n"))
    at = at.join(total, F.col("g").eqNullSafe(F.col("_g"))).withColumn("place", (F.col("n") - 1) * F.lit(p))
    low, high = F.floor("place"), F.ceil("place")
    inside = lambda x: (F.col("lo") <= x) & (x < F.col("lo") + F.col("k"))
    ends = at.groupBy("g").agg(F.max("n").alias("n"), F.max("place").alias("place"),
                               F.max(F.when(inside(low), F.col("v"))).alias("a"), F.max(F.when(inside(high), F.col("v"))).alias("b"))
    out = F.round(F.col("a") + (F.col("b") - F.col("a")) * (F.col("place") - F.floor("place")), 6)
    # groups whose values are all NULL keep their row
    every = df.groupBy(F.col(group).alias("_e")).agg(F.count(F.lit(1)).alias("rows"))
    return every.join(ends, F.col("_e").eqNullSafe(F.col("g")), "left").select(
        F.col("_e").alias(group), F.col("rows").alias("n"), out.alias(f"p{int(p * 100)}"))


def binary_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row of tp / fp / fn / tn, precision, recall, F1, accuracy."""
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    c = df.agg(F.count(F.when(a & p, 1)).alias("tp"), F.count(F.when(~a & p, 1)).alias("fp"),
               F.count(F.when(a & ~p, 1)).alias("fn"), F.count(F.when(~a & ~p, 1)).alias("tn"))
    prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return c.select("tp", "fp", "fn", "tn", F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                    F.round(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 6).alias("f1"),
                    F.round(F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")), 6)
                    .alias("accuracy"))
