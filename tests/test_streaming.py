"""Streaming jobs over several micro-batches equal the batch operators."""

from pyspark.sql import functions as F

from tessera.operators import ingest
from tessera.streaming import jobs
from tessera.streaming.store import BucketStore

SF = "/root/testdata/sf0.001"


def split_events(spark, tmp_path, parts=4):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    folder = str(tmp_path / "events_in")
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        chunk = ev.where((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step))
        chunk.coalesce(1).write.parquet(f"{folder}/part{i}")
    import glob
    import os
    import shutil
    import time
    now = time.time()
    for i in range(parts):  # one folder of events<i>.parquet files; modification times give arrival order
        f = glob.glob(f"{folder}/part{i}/*.parquet")[0]
        dst = f"{folder}/events{i}.parquet"
        shutil.copy(f, dst)
        os.utime(dst, (now - 100 + i * 10, now - 100 + i * 10))
    return folder


def write_in_order(df, col, parts, folder, first=None, skip=0):
    """``parts`` files of equal size by ``col``, arriving in that order."""
    import os
    import time
    rows = df.toPandas().sort_values(col)
    os.makedirs(folder, exist_ok=True)
    step, now = -(-len(rows) // parts), time.time()
    for i in range(skip, parts if first is None else first):
        dst = f"{folder}/events{i}.parquet"
        df.sparkSession.createDataFrame(rows[i * step:(i + 1) * step], df.schema).toPandas().to_parquet(
            dst, index=False, coerce_timestamps="us")
        os.utime(dst, (now - 100 + i * 10, now - 100 + i * 10))


def tickets_of(df):
    return df.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("ticket_id"),
                     F.concat("event_type", F.lit(":"), F.floor("value").cast("bigint").cast("string")).alias("content"))


def test_versions_and_dedup_across_batches(spark, tmp_path):
    folder = split_events(spark, tmp_path)
    stream = tickets_of(jobs.stream_table(spark, folder, "events", max_files_per_trigger=1))
    store = jobs.streaming_versions(spark, stream, str(tmp_path / "versions"))
    got = jobs.read_versions(spark, store)
    batch = ingest.versions(tickets_of(spark.read.parquet(f"{SF}/events.parquet")))
    cols = ["ticket_id", "content_hash", "first_seq", "version", "is_latest"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert spark.read.parquet(store).select("batch_id").distinct().count() == 4

    stream2 = tickets_of(jobs.stream_table(spark, folder, "events", max_files_per_trigger=1))
    store2 = jobs.streaming_first_per_hash(spark, stream2, str(tmp_path / "dedup"))
    got2 = spark.read.parquet(store2).select("seq", "content_hash")
    want2 = ingest.first_per_hash(tickets_of(spark.read.parquet(f"{SF}/events.parquet"))).select("seq", "content_hash")
    assert sorted(map(tuple, got2.collect())) == sorted(map(tuple, want2.collect()))


def test_hourly_keys_do_not_depend_on_batches(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    want = {tuple(r) for r in ev.select("user_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz")).distinct().collect()}
    for files in (1, 6):
        folder = str(tmp_path / f"in{files}")
        write_in_order(ev, "ts", files, folder)
        out = jobs.hourly_keys(jobs.stream_table(spark, folder, "events", max_files_per_trigger=1), str(tmp_path / f"wm{files}"))
        got = [tuple(r) for r in spark.read.parquet(out).select("user_id", "event_type", "hour").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    folder, store = str(tmp_path / "in"), str(tmp_path / "versions")
    write_in_order(ev, "event_id", 4, folder, first=2)
    jobs.streaming_versions(spark, tickets_of(jobs.stream_table(spark, folder, "events", 1)), store)
    write_in_order(ev, "event_id", 4, folder, skip=2)
    jobs.streaming_versions(spark, tickets_of(jobs.stream_table(spark, folder, "events", 1)), store)
    cols = ["ticket_id", "content_hash", "first_seq", "version", "is_latest"]
    want = ingest.versions(tickets_of(ev)).select(cols).collect()
    assert sorted(map(tuple, jobs.read_versions(spark, store).select(cols).collect())) == sorted(map(tuple, want))


def test_store_raises_on_anything_but_a_missing_path(spark, tmp_path):
    import glob

    import pytest
    store = BucketStore(spark, str(tmp_path / "bad"), "a long", ["a"], buckets=1)
    assert store.read().count() == 0
    store.add(spark.createDataFrame([(1,)], "a long"), 0)
    assert store.read().count() == 1
    for f in glob.glob(f"{tmp_path}/bad/batch_id=0/bucket=0/*.parquet"):
        with open(f, "w") as out:
            out.write("no parquet")
        crc = f"{f[:f.rindex('/')]}/.{f[f.rindex('/') + 1:]}.crc"
        open(crc, "w").close()
    with pytest.raises(Exception, match="(?i)parquet|footer|file|checksum"):
        store.read().collect()


def test_files_read_do_not_grow_with_history(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "s"), "k long, batch long", ["k"], buckets=4, max_pieces=3)
    most = []
    for i in range(14):
        rows = spark.range(40).select(F.col("id").alias("k"), F.lit(i).cast("long").alias("batch"))
        buckets = store.touched(rows)
        seen = store.read(["k"], buckets, before=i)
        assert seen.count() == 40 * i
        most.append(max([len(seen.inputFiles()), 0]))
        store.add(rows, i)
    assert len(buckets) == 4 and max(most) <= 4 * 3 and max(most[7:]) <= max(most[:7])
    assert store.read().count() == 40 * 14
    few = spark.range(1).select(F.col("id").alias("k"))
    one = store.read(["k"], store.touched(few))
    assert one.count() < 40 * 14 and len(one.inputFiles()) <= 3  # a batch of one key reads one bucket


def test_a_crash_before_the_switch_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    import pytest
    store = BucketStore(spark, str(tmp_path / "s"), "k long", ["k"], buckets=2, max_pieces=2)
    rows = lambda lo: spark.range(lo, lo + 10).select(F.col("id").alias("k"))
    for i in range(3):
        store.add(rows(10 * i), i)

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(store, "_switch", crash)
        with pytest.raises(RuntimeError):
            store.add(rows(30), 3)  # data and compacted pieces are written, the manifest is not
    again = BucketStore(spark, str(tmp_path / "s"), "k long", ["k"], buckets=2, max_pieces=2)
    assert sorted(r[0] for r in again.read().collect()) == list(range(30))
    for _ in range(2):  # the batch runs again, and once more
        again.add(rows(30), 3)
        assert sorted(r[0] for r in again.read().collect()) == list(range(40))
    assert sorted(r[0] for r in again.read(before=2).collect()) == list(range(20))


def test_first_per_hash_and_versions_with_compaction(spark, tmp_path):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    folder = str(tmp_path / "in")
    write_in_order(ev, "event_id", 6, folder)
    stream = lambda: tickets_of(jobs.stream_table(spark, folder, "events", 1))
    small = {"buckets": 3, "max_pieces": 2}
    a = jobs.streaming_first_per_hash(spark, stream(), str(tmp_path / "a"), **small)
    want = ingest.first_per_hash(tickets_of(ev)).select("seq", "content_hash").collect()
    assert sorted(map(tuple, jobs.read_firsts(spark, a).select("seq", "content_hash").collect())) == sorted(map(tuple, want))
    b = jobs.streaming_versions(spark, stream(), str(tmp_path / "b"), **small)
    cols = ["ticket_id", "content_hash", "first_seq", "version", "is_latest"]
    want = ingest.versions(tickets_of(ev)).select(cols).collect()
    assert sorted(map(tuple, jobs.read_versions(spark, b).select(cols).collect())) == sorted(map(tuple, want))


def test_update_mode_counts_equal_the_batch_answer_over_a_restart(spark, tmp_path):
    import glob
    import os
    import shutil
    import time

    from tessera.operators import analyzer
    from tessera.plans import bindings
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    folder, store, now = str(tmp_path / "in"), str(tmp_path / "counts"), time.time()
    os.makedirs(folder)
    for part in (range(3), range(3, 6)):
        for i in part:
            orders.where(F.col("o_orderkey") % 6 == i).coalesce(1).write.parquet(f"{tmp_path}/p{i}")
            shutil.copy(glob.glob(f"{tmp_path}/p{i}/*.parquet")[0], f"{folder}/orders{i}.parquet")
            os.utime(f"{folder}/orders{i}.parquet", (now - 100 + i * 10, now - 100 + i * 10))
        jobs.running_release_counts(spark, SF, jobs.stream_table(spark, folder, "orders", 1), store, buckets=2, max_pieces=2)
        arrived = orders.where(F.col("o_orderkey") % 6 <= part[-1])
        want = analyzer.release_counts(analyzer.analyzer_rows(bindings.config_rows(spark, SF, orders=arrived)))
        got = jobs.read_release_counts(spark, store)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    assert len(glob.glob(f"{store}/batch_id=*")) >= 6
    assert glob.glob(f"{store}._checkpoint/state/0/0/*.zip") + glob.glob(f"{store}._checkpoint/state/0/0/*.changelog")  # RocksDB's


def test_partial_counters_across_batches(spark, tmp_path):
    import glob
    import os
    import shutil
    import time

    from tessera.operators import analyzer
    from tessera.plans import bindings
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    folder = str(tmp_path / "orders_in")
    now = time.time()
    for i in range(3):
        orders.where(F.col("o_orderkey") % 3 == i).coalesce(1).write.parquet(f"{folder}/p{i}")
        dst = f"{folder}/orders{i}.parquet"
        shutil.copy(glob.glob(f"{folder}/p{i}/*.parquet")[0], dst)
        os.utime(dst, (now - 100 + i * 10, now - 100 + i * 10))
    stream = jobs.stream_table(spark, folder, "orders", max_files_per_trigger=1)
    store = jobs.running_app_counts(spark, SF, stream, str(tmp_path / "counters"))
    got = jobs.read_counters(spark, store)
    assert spark.read.parquet(store).select("batch_id").distinct().count() == 3
    rows = analyzer.analyzer_rows(bindings.config_rows(spark, SF))
    want_pairs = {(r.side, r.app_a, r.app_b): r.n for r in analyzer.pair_counts(rows).collect()}
    got_pairs = {(r.side, r.a, r.b): r.n for r in got.where("kind = 'pair'").collect()}
    assert got_pairs == want_pairs
    want_apps = {(r.side, r.app): r.n for r in analyzer.global_app_counts(rows).collect()}
    assert {(r.side, r.a): r.n for r in got.where("kind = 'app'").collect()} == want_apps


def test_stream_of_a_folder_of_part_files(spark, tmp_path):
    from tessera.plans.queries import QUERIES
    rows = [(i, f"http://h/{i}", f"<html><title>T {i}</title></html>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.repartition(3).write.parquet(f"{tmp_path}/folder/pages.parquet")
    assert jobs.stream_table(spark, f"{tmp_path}/folder/", "pages").isStreaming
    got = QUERIES["stream_csv"](spark, f"{tmp_path}/folder").collect()
    assert sorted(map(tuple, got)) == sorted((str(i), u, f"T {i}") for i, u, _ in rows)
    # part files that come later to the same folder are new input
    stream = lambda: jobs.stream_table(spark, f"{tmp_path}/folder", "pages", 1).select(F.col("page_id").cast("string"))
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.streaming_csv(stream(), out)
        n = spark.read.parquet(f"{tmp_path}/folder/pages.parquet").count()
        assert spark.read.options(header="true").csv(out).count() == n
        pages.withColumn("page_id", F.col("page_id") + 100).write.mode("append").parquet(f"{tmp_path}/folder/pages.parquet")
