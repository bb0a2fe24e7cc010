"""Large-CSV analyzer operators.

The reference walks a file in chunks and updates nested counters; here the
chunks are input splits and each counter is one aggregate.  Statistics drop
rows whose device or release type is NULL (the reference's ``groupby`` does),
and every count is a ``groupBy().count()`` with map-side partial aggregation,
so a hot device costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import clean_empty_list, list_parse_error, parse_list_analyzer, path_segment
from tessera.operators.profiles import top_k
from tessera.plans.bindings import to_canonical

# --- fixed values of the analyzer -------------------------------------------------
EXCLUDED_RELEASE = "SMR"
EXCLUDED_VR = "TRUE"
TOP_DEVICES = 5
TOP_FINGERPRINTS = 3
TOP_APPS_PER_FP = 3
DIVERSITY_DEVICES = 10
# ------------------------------------------------------------------------------


def keep_row():
    """Drop rows with release_type 'SMR' or vr_qualified 'TRUE' (NULL kept)."""
    return ~(F.coalesce(F.col("release_type") == EXCLUDED_RELEASE, F.lit(False))
             | F.coalesce(F.col("vr_qualified") == EXCLUDED_VR, F.lit(False)))


def analyzer_rows(df: DataFrame) -> DataFrame:
    """P01 + P02 + F05 + F04: filtered rows with extracted keys and app lists."""
    df = to_canonical(df).where(keep_row())
    base = clean_empty_list("priv_base_apps")
    var = clean_empty_list("priv_var_apps")
    return df.select(
        "rid", "device", "release_type",
        path_segment("fingerprint").alias("fp"),
        path_segment("same_device_fingerprints").alias("sdp"),
        parse_list_analyzer(base).alias("base_apps"),
        parse_list_analyzer(var).alias("variant_apps"),
        (list_parse_error(base) | list_parse_error(var)).alias("parse_error"),
    )


def counted_rows(rows: DataFrame) -> DataFrame:
    """Rows that enter the statistics: device and release type both present."""
    return rows.where(F.col("device").isNotNull() & F.col("release_type").isNotNull())


def release_counts(rows: DataFrame) -> DataFrame:
    """Rows per (device, release_type)."""
    return counted_rows(rows).groupBy("device", "release_type").agg(F.count(F.lit(1)).alias("n"))


def _side_apps(rows: DataFrame, keys) -> DataFrame:
    both = F.concat(
        F.transform("base_apps", lambda a: F.struct(F.lit("base").alias("side"), a.alias("app"))),
        F.transform("variant_apps", lambda a: F.struct(F.lit("variant").alias("side"), a.alias("app"))))
    return rows.select(*keys, F.explode(both).alias("sa")).select(*keys, "sa.side", "sa.app")


def keyed_app_counts(rows: DataFrame, key: str = "fp") -> DataFrame:
    """App counts per (device, release_type, key, side).

    Rows whose key is '' are skipped; a NULL key is counted under NULL (the
    reference's NaN is truthy).
    """
    r = counted_rows(rows).where(F.col(key).isNull() | (F.col(key) != ""))
    ex = _side_apps(r, ["device", "release_type", key])
    return ex.groupBy("device", "release_type", key, "side", "app").agg(F.count(F.lit(1)).alias("n"))


def global_app_counts(rows: DataFrame) -> DataFrame:
    """A03 (analyzer): app counts per side over all counted rows."""
    return _side_apps(counted_rows(rows), []).groupBy("side", "app").agg(F.count(F.lit(1)).alias("n"))


def list_pairs(rows: DataFrame, keys: list[str], items: str) -> DataFrame:
    """The columns ``keys`` with app_a, app_b: all pairs of places i < j of the array ``items`` (duplicates kept).

    Two generators follow each other, the places of the first and the rest of
    the list behind each, so no row holds all its pairs at once.  An array that
    is null or has under two items gives none.
    """
    first = rows.select(*keys, items, F.posexplode(items).alias("_i", "app_a"))
    rest = F.slice(items, F.col("_i") + 2, F.size(items))
    return first.select(*keys, "app_a", F.explode(rest).alias("app_b"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """A10: co-occurrence counts of app pairs per side.

    Pairs are generated per row from that row's own list (bounded by the app
    vocabulary), never across rows, and aggregated with map-side combine.
    """
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.array_sort(f"{side}_apps").alias("apps")) for side in ("base", "variant")])
    lists = counted_rows(rows).select(F.explode(sides).alias("x")).select("x.side", "x.apps")
    return list_pairs(lists, ["side"], "apps").groupBy("side", "app_a", "app_b").agg(F.count(F.lit(1)).alias("n"))


def capped(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The first ``max_rows`` kept rows in input order (exact cap); off unless asked for."""
    return rows if max_rows is None else rows.orderBy("rid").limit(max_rows)


def list_errors(rows: DataFrame) -> DataFrame:
    """counted rows per device and how many had list text that did not parse."""
    return counted_rows(rows).groupBy("device").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("parse_error"), 1)).alias("n_errors"))


def report_tops(rows: DataFrame, apps: int = 10, pairs: int = 5) -> DataFrame:
    """(section, rank, label, value) of the most frequent apps and app pairs per side."""
    a = top_k(global_app_counts(rows), ["side"], [F.desc("n"), F.asc("app")], apps)
    p = top_k(pair_counts(rows), ["side"], [F.desc("n"), F.asc("app_a"), F.asc("app_b")], pairs)
    return a.select(F.concat(F.lit("top_apps_"), "side").alias("section"), "rank", F.col("app").alias("label"), F.col("n").alias("value")).unionByName(
        p.select(F.concat(F.lit("top_pairs_"), "side").alias("section"), "rank", F.concat("app_a", F.lit(" + "), "app_b").alias("label"),
                 F.col("n").alias("value")))


def device_release_share(counts: DataFrame) -> DataFrame:
    """Totals per device and per release type, with share of all rows."""
    g = counts.groupingSets([["device"], ["release_type"]], "device", "release_type").agg(
        F.grouping_id().alias("gid"), F.sum("n").alias("n"))
    dim = F.when(F.col("gid") == 1, F.lit("device")).otherwise(F.lit("release_type"))
    key = F.when(F.col("gid") == 1, F.col("device")).otherwise(F.col("release_type"))
    # both dimensions total the same rows: one partial-aggregated sum (scalar subquery)
    total = counts.agg(F.sum("n")).scalar()
    return g.select(dim.alias("dimension"), key.alias("key"), "n", F.round(F.col("n") / total, 4).alias("share"))


def top_fingerprints(rows: DataFrame) -> DataFrame:
    """K03 + W08: top five devices by entries; inside each (device, release)
    the three fingerprints with most app occurrences and their top three
    base / variant apps.  Ties: count desc, then name asc."""
    counts = release_counts(rows)
    dev = counts.groupBy("device").agg(F.sum("n").alias("device_total"))
    top_dev = top_k(dev.withColumn("g", F.lit(0)), ["g"], [F.desc("device_total"), F.asc("device")],
                    TOP_DEVICES, "device_rank").drop("g")
    fpc = keyed_app_counts(rows, "fp").join(top_dev.select("device"), "device", "left_semi")
    fp_tot = fpc.groupBy("device", "release_type", "fp").agg(F.sum("n").alias("fp_total_apps"))
    top_fp = top_k(fp_tot, ["device", "release_type"], [F.desc("fp_total_apps"), F.asc_nulls_last("fp")],
                   TOP_FINGERPRINTS, "fp_rank")
    apps = top_k(fpc.join(top_fp.select("device", "release_type", "fp"), ["device", "release_type", "fp"], "left_semi"),
                 ["device", "release_type", "fp", "side"], [F.desc("n"), F.asc("app")], TOP_APPS_PER_FP, "app_rank")
    txt = apps.groupBy("device", "release_type", "fp").agg(*[
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct(
            "app_rank", F.concat("app", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("t"))))),
            lambda x: x["t"]), ", ").alias(f"top_{s}") for s in ("base", "variant")])
    return (top_fp.join(txt, ["device", "release_type", "fp"], "left")
            .join(counts.withColumnRenamed("n", "entries"), ["device", "release_type"])
            .join(top_dev, "device")
            .select("device_rank", "device", "device_total", "release_type", "entries", "fp_rank",
                    F.col("fp").alias("fingerprint"), "fp_total_apps", "top_base", "top_variant"))


def headline(rows: DataFrame) -> DataFrame:
    """K08 + A12: one row of headline numbers (absent values are NULL).

    Each number is an aggregate over the rows, attached as a scalar subquery.
    """
    c = counted_rows(rows)
    apps = global_app_counts(rows)
    top_app = top_k(apps.where(F.col("side") == "base").withColumn("g", F.lit(1)), ["g"], [F.desc("n"), F.asc("app")], 1)
    pairs = pair_counts(rows).where(F.col("side") == "base")
    top_pair = top_k(pairs.withColumn("g", F.lit(1)), ["g"], [F.desc("n"), F.asc("app_a"), F.asc("app_b")], 1)
    out = c.agg(F.count_distinct("device").alias("total_devices"), F.count(F.lit(1)).alias("total_entries")).select(
        "*",
        apps.agg(F.count(F.when(F.col("side") == "base", 1))).scalar().alias("unique_base"),
        apps.agg(F.count(F.when(F.col("side") == "variant", 1))).scalar().alias("unique_variant"),
        top_app.select("app").scalar().alias("top_base_app"), top_app.select("n").scalar().alias("top_base_n"),
        top_pair.select("app_a").scalar().alias("top_pair_a"), top_pair.select("app_b").scalar().alias("top_pair_b"),
        top_pair.select("n").scalar().alias("top_pair_n"))
    return out.withColumn("high_diversity", F.col("total_devices") > DIVERSITY_DEVICES)
