"""Editor operations on a text table (P05-P08, W10), re-aimed as table jobs.

The editor keeps records in an array and edits them by index; here records
carry a key column and every operation is a relational step: search is a
filter, an edit is a join with an edits table, a delete is an anti join, and
the record cursor is a ranked listing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip
from tessera.operators import segmented
from tessera.session import shared

# fixed values of the listing
RECORD_LABEL = "Record "
EMPTY_LABEL = "(empty)"


def search_any(df: DataFrame, query: str) -> DataFrame:
    """Rows where any column contains the (trimmed, lower-cased) query."""
    q = query.strip().lower()
    if q == "":
        return df
    conds = [F.coalesce(F.lower(F.col(f"`{c}`").cast("string")).contains(F.lit(q)), F.lit(False)) for c in df.columns]
    return df.where(reduce(lambda a, b: a | b, conds))


def apply_edits(df: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """``edits(key, column, value)`` in long form, pivoted and joined;
    an edited cell takes the new value, the rest keep theirs.  The last edit
    (highest ``seq``) of a cell wins."""
    cols = [c for c in df.columns if c != key]
    last = edits.groupBy(key, "column").agg(F.max_by("value", "seq").alias("value"))
    wide = last.groupBy(key).pivot("column", cols).agg(F.first("value"))
    j = df.join(wide.select(key, *[F.col(f"`{c}`").alias(f"_e_{c}") for c in cols]), key, "left")
    return j.select(key, *[F.coalesce(F.col(f"_e_{c}"), F.col(f"`{c}`")).alias(c) for c in cols])


def delete_rows(df: DataFrame, deletes: DataFrame, key: str) -> DataFrame:
    """Drop the rows whose key is in ``deletes`` (``left_anti``)."""
    return df.join(deletes.select(key).distinct(), key, "left_anti")


def listing(df: DataFrame, filtered: DataFrame, key: str, order_col: str, first_col: str, second_col: str | None) -> DataFrame:
    """P08 + W10: sidebar labels and the record cursor over the filtered set.

    ``record_no`` is the 1-based position in the whole table, ``position``
    the 1-based position among the filtered rows, ``n`` their count, and
    ``prev_key`` / ``next_key`` the neighbours (what the arrows move to).
    Title: first column trimmed, ``Record <record_no>`` when empty/missing,
    ``(empty)`` when only spaces; subtitle: second column trimmed or ''.
    Positions use the skew-safe ranking (no single-partition window).
    """
    numbered = segmented.ranked(df.select(key, order_col), [], [order_col], out="record_no", method="row_number")
    f = filtered.join(numbered.select(key, "record_no"), key)
    pos = shared(segmented.ranked(f, [], [order_col], out="position", method="row_number"))
    both = segmented.previous_row(pos, [], "position", [key], prefix="prev_", next_prefix="next_")
    out = both.withColumn("n", pos.agg(F.count(F.lit(1))).scalar())
    v0 = F.col(f"`{first_col}`")
    title = (F.when(F.coalesce(v0, F.lit("")) == "", F.concat(F.lit(RECORD_LABEL), F.col("record_no").cast("string")))
             .when(strip(v0) == "", F.lit(EMPTY_LABEL)).otherwise(strip(v0)))
    subtitle = strip(F.coalesce(F.col(f"`{second_col}`"), F.lit(""))) if second_col else F.lit("")
    return out.select(key, "record_no", "position", "n", F.col(f"prev_{key}").alias("prev_key"),
                      F.col(f"next_{key}").alias("next_key"), title.alias("title"), subtitle.alias("subtitle"))
