"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, scratch_path
from tessera.sources.tables import table

# Fixed value: the white space of every contract here, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def no_space(text: Column) -> Column:
    """``text`` without any white-space character (null: empty)."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACE:  # byte searches; translate() looks every character up in a map
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def words(text: Column) -> Column:
    """The words of ``text`` in order (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def kept_table(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: computed once, survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffle_files_removed(spark: SparkSession):
    """Plans made inside remove their shuffle files when their action ends; they are run once."""
    return _set(spark, CLEANUP, "true")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
LIGHT_ROWS = 1000


def light_batches(spark: SparkSession):
    """Plans run inside hand Python fewer rows at a time: a batch of whole texts is held by the JVM and by Python, once for each task."""
    return _set(spark, BATCH_ROWS, str(LIGHT_ROWS))


class Tables:
    """Intermediate tables of one job, Parquet below the shared folder.

    They are compressed, and the shuffle files behind a table go when it is
    there, so they take less disk than checkpoints.  ``drop`` removes a table
    that nothing reads any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "table")
        with shuffle_files_removed(self.spark), light_batches(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table))[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_BYTES = 64 << 20


def broadcast_if_light(df: DataFrame, size: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a materialised frame if the sum of ``size`` (bytes per row) is at most ``most``; else leave it."""
    n = df.agg(F.sum(size + 64)).first()[0] or 0
    return F.broadcast(df) if n <= most else df


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file; ``folder`` overrides the installed one."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)
