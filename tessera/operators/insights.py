"""Per-section statistics and rule-based insight text.

A section is a (device, build_type) pair; its combinations are the observed
(fingerprint, same-device fingerprint) pairs (J02).  Order follows the
reference: combinations run in first-seen fingerprint order, then first-seen
same-device order; apps are counted once per combination and listed in
first-seen order.  Lists that reach the text are capped (3 / 2 / 5 items),
so no unbounded list is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import int_percent, parse_list_keep_blank
from tessera.operators import segmented
from tessera.session import shared

SECTION = ["device", "build_type"]

# --- fixed values: insight texts (templates use {name} fields) -------------------
H_BASE = "**PRIV BASE APPS INSIGHT**"
H_VAR = "\n**PRIV VARIANT APPS INSIGHT**"
H_COMBINED = "\n**COMBINED ANALYSIS**"
H_FINDINGS = "\n**KEY FINDINGS**"
BASE_DOMINANT = ("Analysis identified {n} dominant base app(s) appearing across multiple combinations: {apps}. "
                 "These represent core privileged applications consistently required for this device configuration.")
BASE_ALL_UNIQUE = ("All {n} base apps are unique across combinations, indicating highly specialized privileged "
                   "application requirements for each fingerprint pairing. No single app dominates the configuration.")
BASE_SPREAD = "The {n} unique base apps show a distributed pattern across {c} combinations, averaging {avg} apps per combination."
BASE_SINGLES = "Notable: {n} apps ({pct}%) appear only once, suggesting fingerprint-specific requirements."
VAR_DOMINANT = ("Variant apps show {n} recurring application(s): {apps}. "
                "These likely represent shared system components across device variants.")
VAR_ALL_UNIQUE = ("Each of the {n} variant apps is unique to its combination, indicating distinct customization "
                  "per fingerprint configuration.")
VAR_SPREAD = "The variant app distribution shows {n} unique apps averaging {avg} per combination."
MORE_BASE = ("Base apps ({b}) show more diversity than variant apps ({v}), suggesting privileged base configurations "
             "are more variable than system variants for this build type.")
MORE_VAR = ("Variant apps ({v}) exceed base app diversity ({b}), indicating system customization varies more than "
            "core privileged app requirements.")
SAME_DIVERSITY = "Base and variant apps show similar diversity ({b} each), suggesting balanced configuration complexity."
RANGE = "Combination complexity ranges from {lo} to {hi} total apps, indicating variable configuration requirements."
F_CORE = "• Core dependencies: {apps} appear in multiple configurations"
F_SPECIAL = "• {n} specialized base apps suggest fingerprint-specific requirements"
F_DENSE = "• High base app density ({avg} avg) indicates complex privileged requirements"
F_STANDARD = "• Variant apps are more standardized than base apps across this configuration"
F_DEFAULT_1 = "• Configuration shows standard distribution with {c} combinations"
F_DEFAULT_2 = "• No single app dominates - distributed privileged requirements"
COMBO_LINE = "\n{i}. FP: {fp} | SDP: {sdp}\n   Base Apps ({nb}): {b}{bm}\n   Var Apps ({nv}): {v}{vm}\n"
PREVIEW = 5
ELLIPSIS = "..."
# ------------------------------------------------------------------------------


def fill(template: str, **cols) -> F.Column:
    """Template with ``{name}`` fields filled from string columns."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(cols[name].cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def one_decimal(p, q) -> F.Column:
    """One decimal of the quotient of integers p >= 0, q >= 0, rounded from the
    double's exact value (7/20 is just below 0.35, so 0.3); 0 when q = 0."""
    return F.when(q > 0, F.call_function("format_number", p / q, F.lit("0.0"))).otherwise("0")


def combination_items(df: DataFrame) -> DataFrame:
    """(section, fp, sdp, fp_first, sdp_first, side, app, rid, pos) for rows with
    all keys present, plus first-seen ranks of fingerprints per section."""
    rows = df.where(F.col("device").isNotNull() & F.col("build_type").isNotNull())
    fp_first = rows.where(F.col("fingerprint").isNotNull()).groupBy(*SECTION, "fingerprint").agg(F.min("rid").alias("fp_first"))
    sdp_first = rows.where(F.col("same_device_fingerprints").isNotNull()).groupBy(*SECTION, "same_device_fingerprints").agg(
        F.min("rid").alias("sdp_first"))
    keyed = (rows.where(F.col("fingerprint").isNotNull() & F.col("same_device_fingerprints").isNotNull())
             .join(fp_first, [*SECTION, "fingerprint"]).join(sdp_first, [*SECTION, "same_device_fingerprints"]))
    empty = F.array().cast("array<string>")
    apps = F.concat(
        F.transform(F.when(F.col("priv_base_apps").isNotNull(), parse_list_keep_blank("priv_base_apps")).otherwise(empty),
                    lambda a: F.struct(F.lit("base").alias("side"), a.alias("app"))),
        F.transform(F.when(F.col("priv_var_apps").isNotNull(), parse_list_keep_blank("priv_var_apps")).otherwise(empty),
                    lambda a: F.struct(F.lit("variant").alias("side"), a.alias("app"))))
    return keyed.select(*SECTION, "fingerprint", "same_device_fingerprints", "fp_first", "sdp_first", "rid",
                        F.posexplode_outer(apps).alias("pos", "sa")).select(
        *SECTION, "fingerprint", "same_device_fingerprints", "fp_first", "sdp_first", "rid", "pos",
        F.col("sa.side").alias("side"), F.col("sa.app").alias("app"))


def section_stats(df: DataFrame) -> DataFrame:
    """A24 + A04 + A13 + A14 per section, with the capped ordered lists the text uses."""
    items = combination_items(df)
    combo_keys = [*SECTION, "fingerprint", "same_device_fingerprints"]
    # one aggregate per (combination, side, app) -- a combination without apps
    # keeps one NULL-app row -- materialised once for the branches below
    per_app = shared(items.groupBy(*combo_keys, "fp_first", "sdp_first", "side", "app")
                     .agg(F.min(F.struct("rid", "pos")).alias("at")))
    in_combo = per_app.where(F.col("app").isNotNull())
    combos = per_app.groupBy(*combo_keys, "fp_first", "sdp_first").agg(
        F.count(F.when(F.col("side") == "base", 1)).alias("nb"),
        F.count(F.when(F.col("side") == "variant", 1)).alias("nv"))
    per_section = combos.groupBy(*SECTION).agg(
        F.count(F.lit(1)).alias("n_combos"),
        F.sum("nb").alias("base_total"), F.sum("nv").alias("var_total"),
        F.min_by(F.struct("nb", "nv"), F.struct((F.col("nb") + F.col("nv")).alias("s"), "fp_first", "sdp_first")).alias("min_combo"),
        F.max_by(F.struct("nb", "nv"), F.struct((F.col("nb") + F.col("nv")).alias("s"), (-F.col("fp_first")).alias("a"),
                                                (-F.col("sdp_first")).alias("b"))).alias("max_combo"))
    app = in_combo.groupBy(*SECTION, "side", "app").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("fp_first", "sdp_first", "at")).alias("first"))
    # one row per distinct dominant app of a section: bounded by the app vocabulary
    dom = app.where(F.col("n") > 1).withColumn(
        "dom_rank", F.row_number().over(Window.partitionBy(*SECTION, "side").orderBy("first")))
    dom3 = dom.where(F.col("dom_rank") <= 3).groupBy(*SECTION, "side").agg(
        F.array_sort(F.collect_list(F.struct("dom_rank", "app"))).alias("_d"))
    per_side = app.groupBy(*SECTION, "side").agg(
        F.count(F.lit(1)).alias("uniq"), F.count(F.when(F.col("n") == 1, 1)).alias("single"),
        F.count(F.when(F.col("n") > 1, 1)).alias("dominant")).join(dom3, [*SECTION, "side"], "left")
    wide = per_side.groupBy(*SECTION).pivot("side", ["base", "variant"]).agg(
        F.first("uniq").alias("uniq"), F.first("single").alias("single"), F.first("dominant").alias("dominant"),
        F.first("_d").alias("d"))
    out = per_section.join(wide, SECTION, "left")
    z = F.lit(0).cast("bigint")
    names = lambda c, k: F.array_join(F.transform(F.slice(F.coalesce(F.col(c), F.array()), 1, k), lambda x: x["app"]), ", ")
    return out.select(
        *SECTION, "n_combos", F.coalesce("base_total", z).alias("base_total"), F.coalesce("var_total", z).alias("var_total"),
        F.coalesce("base_uniq", z).alias("base_unique"), F.coalesce("variant_uniq", z).alias("var_unique"),
        F.coalesce("base_single", z).alias("base_single"), F.coalesce("base_dominant", z).alias("base_dominant"),
        F.coalesce("variant_dominant", z).alias("var_dominant"),
        names("base_d", 3).alias("base_dom3"), names("base_d", 2).alias("base_dom2"), names("variant_d", 3).alias("var_dom3"),
        F.col("min_combo.nb").alias("min_nb"), F.col("min_combo.nv").alias("min_nv"),
        F.col("max_combo.nb").alias("max_nb"), F.col("max_combo.nv").alias("max_nv"))


def insight_text(stats: DataFrame) -> DataFrame:
    """The rule-based insight text of each section (F16 integer percent,
    F17 one-decimal averages)."""
    c = F.col
    n, bu, vu, bt, vt = c("n_combos"), c("base_unique"), c("var_unique"), c("base_total"), c("var_total")
    bs, bd, vd = c("base_single"), c("base_dominant"), c("var_dominant")
    avg_b, avg_v = one_decimal(bt, n), one_decimal(vt, n)
    pct = int_percent(bs, bu)
    base_line = (F.when(bd > 0, fill(BASE_DOMINANT, n=bd, apps=c("base_dom3")))
                 .when((bu == bt) & (bu > 0), fill(BASE_ALL_UNIQUE, n=bu))
                 .otherwise(fill(BASE_SPREAD, n=bu, c=n, avg=avg_b)))
    singles = F.when((bs * 10 > bu * 7) & (bu > 0), fill(BASE_SINGLES, n=bs, pct=pct))
    var_line = (F.when(vd > 0, fill(VAR_DOMINANT, n=vd, apps=c("var_dom3")))
                .when((vu == vt) & (vu > 0), fill(VAR_ALL_UNIQUE, n=vu))
                .otherwise(fill(VAR_SPREAD, n=vu, avg=avg_v)))
    combined = (F.when(bu > vu, fill(MORE_BASE, b=bu, v=vu)).when(vu > bu, fill(MORE_VAR, b=bu, v=vu))
                .otherwise(fill(SAME_DIVERSITY, b=bu)))
    differs = (c("min_nb") != c("max_nb")) | (c("min_nv") != c("max_nv"))
    rng = F.when((n > 0) & differs, fill(RANGE, lo=c("min_nb") + c("min_nv"), hi=c("max_nb") + c("max_nv")))
    f1 = F.when(bd > 0, fill(F_CORE, apps=c("base_dom2")))
    f2 = F.when(bs > 2, fill(F_SPECIAL, n=bs))
    f3 = F.when(bt > n * 2, fill(F_DENSE, avg=avg_b))
    f4 = F.when((vu < bu) & (vu > 0), F.lit(F_STANDARD))
    none = f1.isNull() & f2.isNull() & f3.isNull() & f4.isNull()
    d1 = F.when(none, fill(F_DEFAULT_1, c=n))
    d2 = F.when(none, F.lit(F_DEFAULT_2))
    text = F.concat_ws("\n", F.lit(H_BASE), base_line, singles, F.lit(H_VAR), var_line, F.lit(H_COMBINED), combined, rng,
                       F.lit(H_FINDINGS), f1, f2, f3, f4, d1, d2)
    return stats.select(*SECTION, "n_combos", "base_unique", "base_total", "var_unique", "var_total", text.alias("insight"))


def insight_sections(insights: DataFrame) -> DataFrame:
    """(section, idx, is_header, text): insight text split at blank lines
    or before a '**' line, trimmed, '**' removed; empty pieces dropped."""
    from tessera.functions.text import insight_sections as split_sections, strip
    parts = insights.select(*SECTION, F.posexplode(split_sections("insight")).alias("idx", "raw"))
    t = strip(F.col("raw"))
    return parts.where(t != "").select(
        *SECTION, "idx", t.rlike(r"^\*\*.*\*\*$").alias("is_header"), F.replace(t, F.lit("**"), F.lit("")).alias("text"))


def request_lines(df: DataFrame) -> DataFrame:
    """F27 + K09: one request line per combination of a section, numbered in
    the reference's combination order; app previews show five items then '...'.
    The lines of a section form its request text; no section is gathered."""
    from tessera.operators.profiles import raw_combinations
    rc = raw_combinations(df)
    rows = df.where(F.col("device").isNotNull() & F.col("build_type").isNotNull())
    fp_first = rows.where(F.col("fingerprint").isNotNull()).groupBy(*SECTION, "fingerprint").agg(F.min("rid").alias("fp_first"))
    sdp_first = rows.where(F.col("same_device_fingerprints").isNotNull()).groupBy(*SECTION, "same_device_fingerprints").agg(
        F.min("rid").alias("sdp_first"))
    rc = rc.join(fp_first, [*SECTION, "fingerprint"]).join(sdp_first, [*SECTION, "same_device_fingerprints"])
    numbered = segmented.ranked(rc, SECTION, ["fp_first", "sdp_first"], out="combo_no", method="row_number")

    def preview(col):
        return F.array_join(F.slice(F.col(col), 1, PREVIEW), ", ")

    def more(col):
        return F.when(F.size(col) > PREVIEW, F.lit(ELLIPSIS)).otherwise(F.lit(""))

    line = fill(COMBO_LINE, i=F.col("combo_no"), fp=F.col("fp_code"), sdp=F.col("sdp_code"),
                nb=F.size("base"), b=preview("base"), bm=more("base"),
                nv=F.size("variant"), v=preview("variant"), vm=more("variant"))
    return numbered.select(*SECTION, "combo_no", line.alias("text"))


def request_summary(rc: DataFrame, top: int = 3) -> DataFrame:
    """the data summary and statistics of each section's request, per side:
    combinations, distinct codes, unique and total apps, the most common ones
    (count desc, name asc) and how many occur more than once."""
    from tessera.operators.profiles import app_counts, top_k
    rc = shared(rc)
    heads = rc.groupBy(*SECTION).agg(F.count(F.lit(1)).alias("n_combinations"), F.count_distinct("fp_code").alias("n_fp_codes"),
                                     F.count_distinct("sdp_code").alias("n_sdp_codes"))
    freq = shared(app_counts(rc, SECTION))
    stats = freq.groupBy(*SECTION, "side").agg(F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("n_total"),
                                               F.count(F.when(F.col("n") > 1, 1)).alias("n_dominant"))
    best = top_k(freq, [*SECTION, "side"], [F.desc("n"), F.asc("app")], top)
    names = best.groupBy(*SECTION, "side").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "app", "n"))), lambda x: F.concat(x["app"], F.lit(" ("), x["n"].cast("string"), F.lit(")"))),
        ", ").alias("most_common"))
    return heads.join(stats, SECTION).join(names, [*SECTION, "side"])
