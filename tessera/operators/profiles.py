"""Configuration-report operators (P*, A*, K*, U*, W07).

Design notes for scale:

* Lists are exploded into ``(key, side, app)`` rows and aggregated with
  ``collect_set`` / ``count`` so map-side partial aggregation collapses
  duplicates before the shuffle; a hot key (a third of all rows) then sends
  one small set per map task instead of every row's list.
* Merged lists are bounded by the app vocabulary, never by the row count.
* Grouping levels are one ``GROUPING SETS`` aggregate (Expand + one shuffle),
  not one scan per level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import fingerprint_code, parse_list
from tessera.session import shared
from tessera.sources.tables import require_columns

REPORT_COLUMNS = ("fingerprint", "same_device_fingerprints", "priv_base_apps",
                  "priv_var_apps", "build_type", "device")
MERGE_KEYS = ("device", "build_type", "fp_code", "sdp_code")

# --- fixed values of the report ------------------------------------------------
LEVEL_OVERALL = "overall"
LEVEL_DEVICE = "device"
LEVEL_BUILD_DEVICE = "build_type_device"
# ------------------------------------------------------------------------------


def parse_report_rows(df: DataFrame) -> DataFrame:
    """S08 + F01 + F02: checked columns, fingerprint codes and parsed lists."""
    require_columns(df, REPORT_COLUMNS)
    return df.select(
        "*",
        fingerprint_code("fingerprint").alias("fp_code"),
        fingerprint_code("same_device_fingerprints").alias("sdp_code"),
        parse_list("priv_base_apps").alias("base"),
        parse_list("priv_var_apps").alias("variant"),
    )


def self_comparison(df: DataFrame):
    """Column that is true for rows comparing a fingerprint with itself.

    Null-safe: two NULL codes compare equal (the reference compares the text
    'nan'), NULL against a value does not.
    """
    return F.col("fp_code").eqNullSafe(F.col("sdp_code"))


def drop_self_comparisons(df: DataFrame) -> DataFrame:
    """Keep rows whose two codes differ."""
    return df.where(~self_comparison(df))


def _side_rows(df: DataFrame, keys, extra=()) -> DataFrame:
    """(keys, extra, pos, side, app): one row per app of either list, and one
    row with NULL pos/app for an input row without apps (``explode_outer``)."""
    apps = F.concat(
        F.transform("base", lambda a: F.struct(F.lit("base").alias("side"), a.alias("app"))),
        F.transform("variant", lambda a: F.struct(F.lit("variant").alias("side"), a.alias("app"))),
    )
    first = df.select(*keys, *extra, F.posexplode_outer(apps).alias("pos", "sa"))
    names = [c for c in first.columns if c not in ("pos", "sa")]
    return first.select(*names, "pos", F.col("sa.side").alias("side"), F.col("sa.app").alias("app"))


def merge_duplicates(df: DataFrame) -> DataFrame:
    """One row per (device, build_type, fp_code, sdp_code), NULL keys kept.

    First raw values (lowest ``rid``) are carried; lists become the sorted
    distinct union of all rows of the group; ``n_rows`` = rows merged.  One
    aggregate over the exploded apps: the partial aggregate dedups apps map
    side, so the shuffle carries at most one set per key and map task.
    """
    raw = F.struct("rid", "fingerprint", "same_device_fingerprints", "priv_base_apps", "priv_var_apps")
    rows = _side_rows(df, MERGE_KEYS, extra=(raw.alias("raw"),))
    # the raw values travel on the first app's row only
    rows = rows.withColumn("raw", F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("raw")))
    merged = rows.groupBy(*MERGE_KEYS).agg(
        F.min("raw").alias("first"),
        F.count(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.lit(1))).alias("n_rows"),
        F.array_sort(F.collect_set(F.when(F.col("side") == "base", F.col("app")))).alias("base"),
        F.array_sort(F.collect_set(F.when(F.col("side") == "variant", F.col("app")))).alias("variant"),
    )
    return merged.select(
        *MERGE_KEYS,
        F.col("first.fingerprint").alias("fingerprint"),
        F.col("first.same_device_fingerprints").alias("same_device_fingerprints"),
        F.col("first.priv_base_apps").alias("priv_base_apps"),
        F.col("first.priv_var_apps").alias("priv_var_apps"),
        "base", "variant", "n_rows",
    )


def merged_report_rows(df: DataFrame) -> DataFrame:
    """parse -> drop self comparisons -> merge (the report's preprocessing)."""
    return merge_duplicates(drop_self_comparisons(parse_report_rows(df)))


def level_statistics(merged: DataFrame) -> DataFrame:
    """A05 at three levels (A06): overall, per device, per build type x device.

    The exploded lists are first counted per (device, build_type, side, app),
    where every merged row also contributes one marker (``side`` NULL); one
    ``GROUPING SETS ((), (device), (build_type, device))`` aggregate over those
    counts gives rows = markers, totals = app rows per side (merged lists are
    distinct) and distinct apps = ``count(DISTINCT)`` per side.  One pass over
    ``merged``; averages are 0 for no rows.  A NULL device is an ordinary
    group; ``level`` tells it from the total.
    """
    sets = [[], ["device"], ["build_type", "device"]]
    marker = F.array(F.struct(F.lit(None).cast("string").alias("side"), F.lit(None).cast("string").alias("app")))
    apps = F.concat(
        marker,
        F.transform("base", lambda a: F.struct(F.lit("base").alias("side"), a.alias("app"))),
        F.transform("variant", lambda a: F.struct(F.lit("variant").alias("side"), a.alias("app"))))
    ex = merged.select("device", "build_type", F.explode(apps).alias("sa")).select("device", "build_type", "sa.side", "sa.app")
    ex = ex.groupBy("device", "build_type", "side", "app").agg(F.count(F.lit(1)).alias("k"))
    base_app = F.when(F.col("side") == "base", F.col("app"))
    var_app = F.when(F.col("side") == "variant", F.col("app"))

    def total(which):
        return F.coalesce(F.sum(F.when(which, F.col("k"))), F.lit(0).cast("bigint"))

    g = ex.groupingSets(sets, "build_type", "device").agg(
        F.grouping_id().alias("gid"),
        total(F.col("side").isNull()).alias("total_rows"),
        total(base_app.isNotNull()).alias("total_base"), F.count_distinct(base_app).alias("unique_base"),
        total(var_app.isNotNull()).alias("total_var"), F.count_distinct(var_app).alias("unique_var"))
    return g.select(
        _level_from(F.col("gid")), "device", "build_type", "total_rows", "total_base", "unique_base",
        "total_var", "unique_var",
        F.coalesce(F.round(F.try_divide("total_base", "total_rows"), 4), F.lit(0.0)).alias("avg_base"),
        F.coalesce(F.round(F.try_divide("total_var", "total_rows"), 4), F.lit(0.0)).alias("avg_var"))


def _level_from(gid):
    return F.when(gid == 3, F.lit(LEVEL_OVERALL)).when(gid == 2, F.lit(LEVEL_DEVICE)).otherwise(
        F.lit(LEVEL_BUILD_DEVICE)).alias("level")


# --- step 2: counts, top-k, distinct values, relations -------------------------

# fixed values: relation texts of the build-type comparison
REL_EQUAL = "{a} = {b} (equal)"
REL_SUPERSET = "{a} ⊇ {b} (superset)"
REL_SUBSET = "{a} ⊆ {b} (subset)"
REL_DIFFERENT = "{a} ≠ {b} (different)"
SUMMARY_SINGLE = "Single build type"
SUMMARY_CHAIN = "Build types have equal or subset app relationships"
SUMMARY_DIFFERENT = "Build types have different app sets"


def app_counts(rows: DataFrame, keys=()) -> DataFrame:
    """(keys, side, app, n) -- how many rows list each app, per side."""
    exploded = _side_rows(rows, keys).where(F.col("app").isNotNull())
    return exploded.groupBy(*keys, "side", "app").agg(F.count(F.lit(1)).alias("n"))


def top_k(counts: DataFrame, partition, order, k: int, rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per partition, ties broken by ``order``.

    ``row_number`` over a window with a ``<= k`` filter plans as a
    ``WindowGroupLimit`` (partial top-k before the shuffle) in Spark 3.5+.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return counts.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def combo_label(fp="fp_code", sdp="sdp_code"):
    """K02: 'FP vs SDP'; a missing code prints as 'nan' like the reference."""
    return F.concat(F.coalesce(F.col(fp), F.lit("nan")), F.lit(" vs "), F.coalesce(F.col(sdp), F.lit("nan")))


def distinct_in_order(df: DataFrame, columns, order_col: str = "rid") -> DataFrame:
    """U05 + W13: distinct non-null values per column, in first-seen order."""
    stacked = df.select(order_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("cv"))
    firsts = (stacked.select(order_col, "cv.*").where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.min(order_col).alias("first_" + order_col)))
    # a column may hold many distinct values: rank in slices, not one task per column
    from tessera.operators import segmented
    return segmented.ranked(firsts, ["column_name"], ["first_" + order_col], out="pos", method="row_number")


def raw_combinations(df: DataFrame) -> DataFrame:
    """J02 + A02 + F03: observed (device, build_type, fingerprint, sdp) combos.

    Raw keys, NULL keys dropped (the reference lists non-null values only);
    lists are the order-preserving distinct union over the combo's rows in
    ``rid`` order.  No cross join: only observed pairs are grouped.
    """
    from tessera.functions.text import parse_list_keep_blank
    keys = ["device", "build_type", "fingerprint", "same_device_fingerprints"]
    rows = df.where(F.col("device").isNotNull() & F.col("build_type").isNotNull()
                    & F.col("fingerprint").isNotNull() & F.col("same_device_fingerprints").isNotNull())
    items = rows.select(*keys, "rid", F.posexplode_outer(F.concat(
        F.transform(F.when(F.col("priv_base_apps").isNotNull(), parse_list_keep_blank("priv_base_apps"))
                    .otherwise(F.array().cast("array<string>")), lambda a: F.struct(F.lit("base").alias("side"), a.alias("app"))),
        F.transform(F.when(F.col("priv_var_apps").isNotNull(), parse_list_keep_blank("priv_var_apps"))
                    .otherwise(F.array().cast("array<string>")), lambda a: F.struct(F.lit("variant").alias("side"), a.alias("app"))),
    )).alias("pos", "sa")).select(*keys, "rid", "pos", "sa.side", "sa.app")
    # one chain, no branch: per (combo, side, app) the first (rid, pos); every
    # input row also leaves one marker item (first position or no apps at all)
    # so rows per combination and the first rid come out of the same pass
    per_app = items.groupBy(*keys, "side", "app").agg(
        F.min(F.struct("rid", "pos")).alias("at"), F.min("rid").alias("_rid"),
        F.count(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, 1)).alias("_rows"))
    out = per_app.groupBy(*keys).agg(
        F.min("_rid").alias("first_rid"), F.sum("_rows").alias("n_rows"),
        F.array_sort(F.collect_list(F.when((F.col("side") == "base") & F.col("app").isNotNull(), F.struct("at", "app")))).alias("b"),
        F.array_sort(F.collect_list(F.when((F.col("side") == "variant") & F.col("app").isNotNull(), F.struct("at", "app")))).alias("v"))
    empty = F.array().cast("array<string>")
    return out.select(
        *keys,
        fingerprint_code("fingerprint").alias("fp_code"),
        fingerprint_code("same_device_fingerprints").alias("sdp_code"),
        F.coalesce(F.transform("b", lambda x: x["app"]), empty).alias("base"),
        F.coalesce(F.transform("v", lambda x: x["app"]), empty).alias("variant"),
        "first_rid", "n_rows")


def app_profile(combos: DataFrame, section=("device", "build_type"), top: int = 5) -> DataFrame:
    """A04 + A13 + A14 per section: distinct / total apps, singles (n = 1),
    dominant (n > 1), top five, average apps per combination, smallest and
    largest combination (total apps), for base and variant."""
    section = list(section)
    counts = shared(app_counts(combos, section))  # one row per app of a section
    topn = top_k(counts, section + ["side"], [F.desc("n"), F.asc("app")], top)
    top_text = topn.groupBy(*section, "side").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.concat_ws(":", "app", F.col("n").cast("string")).alias("t")))),
                                 lambda x: x["t"]), ", ").alias("top"))
    per_side = counts.groupBy(*section, "side").agg(
        F.count(F.lit(1)).alias("uniq"), F.sum("n").alias("total"),
        F.count(F.when(F.col("n") == 1, 1)).alias("single"), F.count(F.when(F.col("n") > 1, 1)).alias("dominant"))
    per_side = per_side.join(top_text, section + ["side"], "left")
    wide = per_side.groupBy(*section).pivot("side", ["base", "variant"]).agg(
        F.first("uniq").alias("unique"), F.first("total").alias("total"),
        F.first("single").alias("single"), F.first("dominant").alias("dominant"), F.first("top").alias("top5"))
    sizes = combos.groupBy(*section).agg(
        F.count(F.lit(1)).alias("n_combos"),
        F.sum(F.size("base")).alias("base_total_"), F.sum(F.size("variant")).alias("var_total_"),
        F.min(F.size("base") + F.size("variant")).alias("min_combo_apps"),
        F.max(F.size("base") + F.size("variant")).alias("max_combo_apps"))
    j = sizes.join(wide, section, "left")
    z = F.lit(0).cast("bigint")
    return j.select(
        *section, "n_combos",
        F.coalesce("base_unique", z).alias("base_unique"), F.coalesce("base_total_", z).alias("base_total"),
        F.coalesce("base_single", z).alias("base_single"), F.coalesce("base_dominant", z).alias("base_dominant"),
        F.coalesce("base_top5", F.lit("")).alias("base_top5"),
        F.coalesce("variant_unique", z).alias("var_unique"), F.coalesce("var_total_", z).alias("var_total"),
        F.coalesce("variant_single", z).alias("var_single"), F.coalesce("variant_dominant", z).alias("var_dominant"),
        F.coalesce("variant_top5", F.lit("")).alias("var_top5"),
        F.round(F.coalesce(F.try_divide("base_total_", "n_combos"), F.lit(0.0)), 4).alias("avg_base"),
        F.round(F.coalesce(F.try_divide("var_total_", "n_combos"), F.lit(0.0)), 4).alias("avg_var"),
        "min_combo_apps", "max_combo_apps")


def build_type_sets(merged: DataFrame) -> DataFrame:
    """Per (device, build_type) the distinct base, variant and all apps."""
    ex = _side_rows(merged, ("device", "build_type"))
    return ex.groupBy("device", "build_type").agg(
        F.array_sort(F.collect_set(F.when(F.col("side") == "base", F.col("app")))).alias("base_set"),
        F.array_sort(F.collect_set(F.when(F.col("side") == "variant", F.col("app")))).alias("var_set"),
        F.array_sort(F.collect_set("app")).alias("all_set"))


def build_type_relation(merged: DataFrame) -> DataFrame:
    """W07 + U04: build types of a device ordered by set size (desc, then
    name); each compared with the next: equal / superset / subset / different;
    per-device summary.  Devices with one build type get 'Single build type'."""
    sets = build_type_sets(merged).where(F.col("device").isNotNull() & F.col("build_type").isNotNull())
    w = Window.partitionBy("device").orderBy(F.desc(F.size("all_set")), F.asc("build_type"))
    s = (sets.withColumn("pos", F.row_number().over(w))
         .withColumn("next_build_type", F.lead("build_type").over(w))
         .withColumn("next_set", F.lead("all_set").over(w))
         .withColumn("n_types", F.count(F.lit(1)).over(Window.partitionBy("device"))))
    a, b = F.col("all_set"), F.col("next_set")
    b_in_a = F.size(F.array_except(b, a)) == 0
    a_in_b = F.size(F.array_except(a, b)) == 0

    def fmt(t):
        return F.replace(F.replace(F.lit(t), F.lit("{a}"), F.col("build_type")), F.lit("{b}"), F.col("next_build_type"))

    rel = (F.when(b.isNull(), F.lit(None).cast("string"))
           .when(b_in_a & a_in_b, fmt(REL_EQUAL))
           .when(b_in_a, fmt(REL_SUPERSET))
           .when(a_in_b, fmt(REL_SUBSET))
           .otherwise(fmt(REL_DIFFERENT)))
    s = s.withColumn("relation", rel).withColumn("is_different", b.isNotNull() & ~b_in_a & ~a_in_b)
    any_diff = F.max(F.col("is_different").cast("int")).over(Window.partitionBy("device"))
    summary = (F.when(F.col("n_types") < 2, F.lit(SUMMARY_SINGLE))
               .when(any_diff == 1, F.lit(SUMMARY_DIFFERENT)).otherwise(F.lit(SUMMARY_CHAIN)))
    return s.select("device", "pos", "build_type", "next_build_type", "relation",
                    F.size("base_set").alias("base_count"), F.size("var_set").alias("var_count"),
                    F.size("all_set").alias("all_count"), summary.alias("summary"))


def build_counts(merged: DataFrame) -> DataFrame:
    """Merged rows and combinations (fp != sdp) per (device, build_type)."""
    return merged.groupBy("device", "build_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(~F.col("fp_code").eqNullSafe(F.col("sdp_code")), 1)).alias("n_combinations"))


def merge_audit(parsed: DataFrame) -> DataFrame:
    """Original rows, self comparisons removed, rows merged away, final."""
    keys = [F.col(k) for k in MERGE_KEYS]
    kept = F.when(~F.col("fp_code").eqNullSafe(F.col("sdp_code")), F.struct(*keys))
    agg = parsed.agg(
        F.count(F.lit(1)).alias("original_rows"),
        F.count(F.when(F.col("fp_code").eqNullSafe(F.col("sdp_code")), 1)).alias("self_removed"),
        F.count(kept).alias("after_self"),
        F.count_distinct(kept).alias("distinct_keys"))
    # count_distinct skips structs that are NULL, not structs holding NULLs
    return agg.select("original_rows", "self_removed", "after_self",
                      (F.col("after_self") - F.col("distinct_keys")).alias("merged_away"),
                      F.col("distinct_keys").alias("final_rows"))
