"""Metamorphic checks: slice counts, repartitioning and re-merging do not change results."""

from pyspark.sql import functions as F

from tessera.operators import ingest, profiles, segmented, series
from tessera.plans import bindings

SF = "/root/testdata/sf0.001"


def rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_slice_count_does_not_matter(spark):
    s = bindings.series(spark, SF).select("g", "pos", "v")
    base = rows(segmented.ranked(s, ["g"], ["v"], out="r", n=1), ["g", "pos", "r"])
    for n in (3, 17, 64):
        assert rows(segmented.ranked(s, ["g"], ["v"], out="r", n=n), ["g", "pos", "r"]) == base
        got = segmented.min_before(s, ["g"], ["pos"], "v", out="m", n=n)
        ref = segmented.min_before(s, ["g"], ["pos"], "v", out="m", n=1)
        assert rows(got, ["g", "pos", "m"]) == rows(ref, ["g", "pos", "m"])
        prev = segmented.previous_row(s, ["g"], "pos", ["v"], n=n)
        assert rows(prev, ["g", "pos", "prev_v"]) == rows(segmented.previous_row(s, ["g"], "pos", ["v"], n=1), ["g", "pos", "prev_v"])


def test_repartition_does_not_matter(spark):
    t = bindings.tickets(spark, SF)
    a = rows(ingest.versions(t), ["ticket_id", "content_hash", "version", "is_latest"])
    b = rows(ingest.versions(t.repartition(13, "content").sortWithinPartitions(F.rand(3))),
             ["ticket_id", "content_hash", "version", "is_latest"])
    assert a == b
    s = bindings.series(spark, SF).select("g", "pos", "v")
    assert rows(series.pair_sum(s, 100), ["g", "i", "j"]) == rows(series.pair_sum(s.repartition(7), 100), ["g", "i", "j"])


def test_merge_twice_equals_once(spark):
    cfg = bindings.config_rows(spark, SF)
    once = profiles.merged_report_rows(cfg)
    # feed the merged rows back as report rows (lists re-rendered as text)
    from tessera.functions.text import list_text
    again_in = once.select(F.monotonically_increasing_id().alias("rid"), "device", "build_type", "fingerprint",
                           "same_device_fingerprints", list_text("base").alias("priv_base_apps"),
                           list_text("variant").alias("priv_var_apps"))
    twice = profiles.merged_report_rows(again_in)
    cols = ["device", "build_type", "fp_code", "sdp_code", "base", "variant"]
    assert rows(once, cols) == rows(twice, cols)


def test_grouping_set_parts_add_up(spark):
    merged = profiles.merged_report_rows(bindings.config_rows(spark, SF))
    st = profiles.level_statistics(merged).collect()
    overall = [r for r in st if r.level == "overall"][0]
    per_device = [r for r in st if r.level == "device"]
    per_bt = [r for r in st if r.level == "build_type_device"]
    for f in ("total_rows", "total_base", "total_var"):
        assert sum(r[f] for r in per_device) == overall[f] == sum(r[f] for r in per_bt)
