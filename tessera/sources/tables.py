"""Parquet scans of the driver tables (S04, S06) and the required-column check.

Every loader takes the columns it needs so the scan's ``ReadSchema`` is
pruned at the source; filters applied later are pushed into the parquet
reader by Catalyst.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan one driver table; ``cols`` prunes the read schema."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


class MissingColumnsError(ValueError):
    """Raised by :func:`require_columns` with every missing column listed."""

    def __init__(self, missing: list[str]):
        super().__init__("missing required columns: " + ", ".join(missing))
        self.missing = missing


def require_columns(df: DataFrame, required) -> DataFrame:
    """Fail before planning if any required column is absent (lists all)."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise MissingColumnsError(missing)
    return df


def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document corpus, ordered by id like a sorted file listing."""
    return table(spark, sf_dir, "documents", "doc_id", "text")


def binary_file_scan(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """S04 for raw files: one row per matching file below ``folder``: path, name, modified, n_bytes, sha256, content.

    Name, size and time come from the file's metadata, so a query that asks for
    these alone reads no content.  Spark plans no row for a file of no bytes.  Folders without a match, and folders that do
    not exist, give an empty frame with the same columns.
    """
    try:
        found = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"),
                        F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"), "content")


def page_urls(ids: DataFrame, base_url: str, id_col: str = "issue_id") -> DataFrame:
    """Build page URLs from ids (``base + id``)."""
    return ids.withColumn("url", F.concat(F.lit(base_url), F.col(id_col).cast("string")))
