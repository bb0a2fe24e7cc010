"""Sinks: JSON records (S09), report rows (S12), run summary.

Nested output is built per record (``to_json`` of a struct holding bounded
arrays); no sink gathers a whole group or table into one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JSON_OPTIONS = {"ignoreNullFields": "false"}


def json_records(df: DataFrame, keys: list[str]) -> DataFrame:
    """S09 + F23: ``keys`` plus one JSON text per row holding every column."""
    return df.select(*keys, F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("json"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines, one record per row, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def report_rows(parts: list[tuple[str, DataFrame, str, str, str | None]]) -> DataFrame:
    """Every number a report prints as tidy ``(section, rank, label, value)`` rows.

    ``parts``: (section name, frame, label column, value column, rank column
    or None).  Values become doubles; the union keeps every part's rows.
    """
    out = None
    for section, df, label, value, rank in parts:
        r = df.select(F.lit(section).alias("section"),
                      (F.col(rank) if rank else F.lit(0)).cast("int").alias("rank"),
                      F.col(label).cast("string").alias("label"), F.col(value).cast("double").alias("value"))
        out = r if out is None else out.unionByName(r)
    return out


def metric_rows(df: DataFrame, section: str, metrics: list[str]) -> DataFrame:
    """One-row frame -> (section, 0, metric name, value) rows via ``stack``."""
    args = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    return df.selectExpr(f"'{section}' AS section", "0 AS rank", f"stack({len(metrics)}, {args}) AS (label, value)")
