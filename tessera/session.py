"""Spark session settings and shared-folder helpers.

Everything here is plain Spark configuration.  The library never picks a
machine-local folder on its own when running on a cluster: scratch output goes
below ``spark.checkpoint.dir`` (a shared path the cluster names), and only when
that is unset -- local runs, tests -- do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of shared() inputs are removed once their frame is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``shuffle_partitions`` defaults to the core count in local mode; on a
    cluster it is left to the cluster's own setting unless given.
    """
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    master = master or os.environ.get("SPARK_MASTER", f"local[{cpus}]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions or master.startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Read from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting).  Only when it is unset *and* the master
    is local (tests, a laptop) is a local folder created; on a cluster a
    missing setting is an error, never a machine-local fallback.
    """
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - Spark Connect: the server owns the folder
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS / object store)") from e
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS / object store)")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared dir, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared(df: DataFrame) -> DataFrame:
    """Materialise an input that several branches of one plan read.

    Without it each branch re-runs the input's joins (column pruning makes
    the branches differ, so Spark cannot reuse the exchange).  A reliable
    checkpoint in the shared folder computes it once, cuts the lineage and
    survives executor loss; it is not looked up again by later queries.
    """
    return cut_lineage(df)


def broadcast_if_light(df: DataFrame, row_bytes, most: int) -> DataFrame:
    """Broadcast a materialised ``df`` if its rows take at most ``most`` bytes.

    ``row_bytes`` is a Column; its sum is one small job.  Beyond the bound the
    frame is returned unchanged and the planner shuffles instead.
    """
    from pyspark.sql import functions as F
    size = df.agg(F.sum(row_bytes + F.lit(64))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check is one small job (``limit(max_rows + 1).count()``); above the
    bound the frame is returned unchanged and the planner shuffles instead.
    """
    from pyspark.sql import functions as F
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
