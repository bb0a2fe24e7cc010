"""Structured Streaming forms of the incremental jobs (ST01-ST04).

Sources are file streams over the table folders; every query runs with a
checkpoint in the shared checkpoint folder and ``trigger(availableNow=True)``
so it processes what has arrived and stops (use ``processingTime`` for a
standing job).  Sinks are idempotent per micro-batch: a retried batch
overwrites its own output (``batch_id`` folder), so a lost executor or a
restarted driver never duplicates rows.  State that outlives a batch is in a
:class:`tessera.streaming.store.BucketStore` or the RocksDB state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, shared
from tessera.streaming.store import BucketStore


def stream_table(spark: SparkSession, folder: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of ``<folder>/<name>*.parquet``, files or folders of part files, with the table's schema."""
    path = f"{folder.rstrip('/')}/{name}*.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def run_available(writer, checkpoint: str) -> None:
    """Start with ``availableNow`` and wait until the available input is done."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The static side of a stream, aggregated once into a table; batches only join to it."""
    from tessera.plans import bindings
    path = scratch_path(spark, "order_lines")
    bindings.order_lines(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


# --- ST01: running counters --------------------------------------------------------

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COUNT_SCHEMA = "device string, release_type string, n bigint, batch bigint"


def newest_counts(rows: DataFrame) -> DataFrame:
    """Of each key the count that the last batch gave."""
    last = rows.groupBy("device", "release_type").agg(F.max(F.struct("batch", "n")).alias("l"))
    return last.select("device", "release_type", F.col("l.n").alias("n"), F.col("l.batch").alias("batch"))


def count_store(spark: SparkSession, path: str, **options) -> BucketStore:
    return BucketStore(spark, path, COUNT_SCHEMA, ["device", "release_type"], merge=newest_counts, **options)


def running_release_counts(spark: SparkSession, sf_dir: str, orders_stream: DataFrame, out: str, **options) -> str:
    """ST01: A07 counts over arriving orders (stream-static joins to the other
    tables).  The counts are stateful, in the RocksDB state store, and the output
    mode is ``update``: a batch emits only the keys it changed, and these go to
    a bucketed store under the batch's number.  A key's newest row is its count,
    so a batch that runs again changes nothing; the state restarts from the
    checkpoint.  Returns the store (:func:`read_release_counts`)."""
    from tessera.operators import analyzer
    from tessera.plans import bindings
    rows = analyzer.analyzer_rows(bindings.config_rows(spark, sf_dir, orders=orders_stream, lines=_stored_lines(spark, sf_dir)))
    counts = analyzer.release_counts(rows)
    store, provider = count_store(spark, out, **options), "spark.sql.streaming.stateStore.providerClass"

    def write(batch: DataFrame, batch_id: int):
        store.add(batch.select("device", "release_type", "n", F.lit(batch_id).cast("bigint").alias("batch")), batch_id)

    before = spark.conf.get(provider)
    spark.conf.set(provider, ROCKSDB)  # read when the query starts
    try:
        run_available(counts.writeStream.outputMode("update").foreachBatch(write), out + "._checkpoint")
    finally:
        spark.conf.set(provider, before)
    return out


def read_release_counts(spark: SparkSession, out: str) -> DataFrame:
    return newest_counts(count_store(spark, out).read()).drop("batch")


def running_app_counts(spark: SparkSession, sf_dir: str, orders_stream: DataFrame, store: str) -> str:
    """ST01 (A03, A10): app and app-pair counters over arriving orders.

    Each micro-batch writes its *partial* counts to its own ``batch_id``
    folder (stateless, idempotent on retry); the running totals are the sum of
    the partials (:func:`read_counters`).  No state store, no per-key state.
    """
    from tessera.operators import analyzer
    from tessera.plans import bindings
    rows = analyzer.analyzer_rows(bindings.config_rows(spark, sf_dir, orders=orders_stream, lines=_stored_lines(spark, sf_dir)))

    def write(batch: DataFrame, batch_id: int):
        apps = analyzer.global_app_counts(batch).select("side", F.lit("app").alias("kind"), F.col("app").alias("a"),
                                                         F.lit(None).cast("string").alias("b"), "n")
        pairs = analyzer.pair_counts(batch).select("side", F.lit("pair").alias("kind"), F.col("app_a").alias("a"),
                                                   F.col("app_b").alias("b"), "n")
        apps.unionByName(pairs).write.mode("overwrite").parquet(_batch_folder(store, batch_id))

    run_available(rows.writeStream.foreachBatch(write), store + "._checkpoint")
    return store


def read_counters(spark: SparkSession, store: str) -> DataFrame:
    """Running totals: the per-batch partial counts summed."""
    return (spark.read.parquet(store).drop("batch_id").groupBy("side", "kind", "a", "b")
            .agg(F.sum("n").alias("n")))


# --- ST02: insert-if-absent as items arrive ------------------------------------------

def _batch_folder(store: str, batch_id: int) -> str:
    return f"{store}/batch_id={batch_id}"


FIRST_SCHEMA = "seq bigint, ticket_id string, content string, content_hash string"
VERSION_SCHEMA = "ticket_id string, content_hash string, first_seq bigint, content string, version bigint"


def streaming_first_per_hash(spark: SparkSession, tickets_stream: DataFrame, path: str, **options) -> str:
    """ST02 (D02/D03): keep the first row of every content hash across batches.

    Per batch: first row per hash (min seq, deterministic), minus hashes
    already stored by earlier batches (``left_anti``).  The state is a stored
    table bucketed by the hash, of which a batch reads the hashes of the buckets
    it touches; it is not bounded by memory.
    """
    from tessera.operators import ingest
    store = BucketStore(spark, path, FIRST_SCHEMA, ["content_hash"], **options)

    def write(batch: DataFrame, batch_id: int):
        firsts = shared(ingest.first_per_hash(batch))
        seen = store.read(["content_hash"], store.touched(firsts), batch_id)
        store.add(firsts.join(seen, "content_hash", "left_anti"), batch_id)

    run_available(tickets_stream.writeStream.foreachBatch(write), path + "._checkpoint")
    return path


def read_firsts(spark: SparkSession, path: str) -> DataFrame:
    return BucketStore(spark, path, FIRST_SCHEMA, ["content_hash"]).read()


def dedup_within_watermark(stream: DataFrame, ts_col: str, delay: str, keys: list[str]) -> DataFrame:
    """ST02, bounded-state form: ``dropDuplicatesWithinWatermark`` on an event
    time (``timestamp_ntz`` is cast to ``timestamp`` first, UTC session)."""
    s = stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return s.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(keys)


def hourly_keys(events: DataFrame, out: str, delay: str = "2 hours") -> str:
    """ST02, bounded state: one (user, event type, hour of the event) each.

    The hour is part of the key and the state of a key lives for ``delay``,
    longer than an hour, so every duplicate of an hour meets it however the
    input is cut into batches, as long as batches come in time order."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    keyed = events.select("user_id", "event_type", "ts", hour.alias("hour"))
    d = dedup_within_watermark(keyed, "ts", delay, ["user_id", "event_type", "hour"])
    run_available(d.select("user_id", "event_type", "hour").writeStream.format("parquet").option("path", out), out + "._checkpoint")
    return out


# --- ST03: batch upsert with versions ---------------------------------------------------

def streaming_versions(spark: SparkSession, tickets_stream: DataFrame, path: str, **options) -> str:
    """ST03 (D04/D05): new distinct (ticket, content) pairs get the next
    version numbers after those already stored for the ticket.  The store is
    bucketed by ticket; a batch reads keys and versions of the buckets it touches."""
    from tessera.functions.text import content_hash
    from tessera.operators import segmented
    store = BucketStore(spark, path, VERSION_SCHEMA, ["ticket_id"], **options)

    def write(batch: DataFrame, batch_id: int):
        h = batch.withColumn("content_hash", content_hash("content"))
        firsts = shared(h.groupBy("ticket_id", "content_hash").agg(F.min(F.struct("seq", "content")).alias("f")).select(
            "ticket_id", "content_hash", F.col("f.seq").alias("first_seq"), F.col("f.content").alias("content")))
        stored = store.read(["ticket_id", "content_hash", "version"], store.touched(firsts), batch_id)
        new = firsts.join(stored.select("ticket_id", "content_hash"), ["ticket_id", "content_hash"], "left_anti")
        base = stored.groupBy("ticket_id").agg(F.max("version").alias("_base"))
        ranked = segmented.ranked(new, ["ticket_id"], ["first_seq"], out="_n", method="row_number")
        store.add(ranked.join(base, "ticket_id", "left").select(
            "ticket_id", "content_hash", "first_seq", "content",
            (F.coalesce(F.col("_base"), F.lit(0)) + F.col("_n")).cast("bigint").alias("version")), batch_id)

    run_available(tickets_stream.writeStream.foreachBatch(write), path + "._checkpoint")
    return path


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The versions table with ``is_latest`` (highest version of the ticket)."""
    v = BucketStore(spark, path, VERSION_SCHEMA, ["ticket_id"]).read()
    top = v.groupBy("ticket_id").agg(F.max("version").alias("_max"))
    return v.join(top, "ticket_id").withColumn("is_latest", F.col("version") == F.col("_max")).drop("_max")


# --- ST04: append results to CSV as they arrive -------------------------------------------

def streaming_csv(result_stream: DataFrame, folder: str) -> str:
    """ST04 / S10: append each batch's rows to a CSV folder (header in each
    part file; the file sink's log makes the output exactly-once)."""
    from tessera.sources.csvfiles import CSV_TEXT_OPTIONS
    w = result_stream.writeStream.format("csv").outputMode("append").options(**CSV_TEXT_OPTIONS).option("path", folder)
    run_available(w, folder + "._checkpoint")
    return folder


def fresh(spark: SparkSession, name: str) -> str:
    """A new output folder below the shared checkpoint dir."""
    return scratch_path(spark, name)
