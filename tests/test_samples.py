"""The report's two sample tables against the golden results in FIXTURES.md sections 2 and 3."""

from pyspark.sql import functions as F

from samples import INSIGHT_SAMPLE, REPORT_SAMPLE, frame
from tessera.operators import insights, profiles


def test_report_sample(spark):
    parsed = profiles.parse_report_rows(frame(spark, REPORT_SAMPLE))
    audit = profiles.merge_audit(parsed).first()
    assert (audit.original_rows, audit.after_self, audit.final_rows) == (17, 16, 15)
    removed = profiles.drop_self_comparisons(parsed)
    assert sorted(set(r.rid for r in parsed.collect()) - set(r.rid for r in removed.collect())) == [11]
    merged = profiles.merge_duplicates(removed)
    row = merged.where("device = 'Pixel_4a' AND build_type = 'userdebug' AND fp_code = 'ISH' AND sdp_code = 'OLE'").first()
    assert row.base == ["com.google.camera", "com.google.dialer", "com.google.duplicate.app"]
    assert row.variant == ["com.android.duplicate.var", "com.android.systemui"]
    assert row.fingerprint == REPORT_SAMPLE[0][0]

    stats = {(r.level, r.device, r.build_type): r for r in profiles.level_statistics(merged).collect()}
    want = {("overall", None, None): (15, 22, 22, 19, 19, 1.4667, 1.2667),
            ("device", "Pixel_4a", None): (11, 17, 17, 15, 15, 1.5455, 1.3636),
            ("device", "Galaxy_S10", None): (4, 5, 5, 4, 4, 1.25, 1.0),
            ("build_type_device", "Pixel_4a", "userdebug"): (7, 13, 13, 11, 11, 1.8571, 1.5714),
            ("build_type_device", "Pixel_4a", "user"): (4, 4, 4, 4, 4, 1.0, 1.0)}
    for k, v in want.items():
        r = stats[k]
        assert (r.total_rows, r.total_base, r.unique_base, r.total_var, r.unique_var, r.avg_base, r.avg_var) == v, k

    combos = {r.combo: r.n for r in merged.groupBy(profiles.combo_label().alias("combo")).count().withColumnRenamed("count", "n").collect()}
    assert combos.pop("FIN vs OLE") == 2 and combos.pop("ISH vs OLE") == 2 and combos.pop("ISH vs VEN") == 2
    assert sorted(combos.values()) == [1] * 9

    rel = {(r.device, r.build_type): r for r in profiles.build_type_relation(merged).collect()}
    assert rel[("Pixel_4a", "userdebug")].relation == "userdebug ≠ user (different)"
    assert rel[("Pixel_4a", "userdebug")].all_count == 24 and rel[("Pixel_4a", "user")].all_count == 8
    assert rel[("Pixel_4a", "userdebug")].summary == "Build types have different app sets"
    assert rel[("Galaxy_S10", "eng")].summary == "Single build type"


def test_insight_sample(spark):
    df = frame(spark, INSIGHT_SAMPLE)
    st = {(r.device, r.build_type): r for r in insights.section_stats(df).collect()}
    ud = st[("Pixel_4a", "userdebug")]
    assert (ud.n_combos, ud.base_total, ud.base_unique, ud.var_total, ud.var_unique) == (7, 12, 12, 10, 10)
    assert (ud.min_nb + ud.min_nv, ud.max_nb + ud.max_nv) == (2, 5)
    us = st[("Pixel_4a", "user")]
    assert (us.n_combos, us.base_total, us.base_unique, us.var_total, us.var_unique) == (4, 4, 4, 4, 4)
    gx = st[("Galaxy_S10", "eng")]
    assert (gx.n_combos, gx.base_total, gx.base_unique, gx.var_total, gx.var_unique) == (4, 5, 5, 4, 4)
    assert (gx.min_nb + gx.min_nv, gx.max_nb + gx.max_nv) == (2, 3)

    text = {(r.device, r.build_type): r.insight for r in insights.insight_text(insights.section_stats(df)).collect()}
    t = text[("Pixel_4a", "userdebug")]
    assert "All 12 base apps are unique across combinations" in t
    assert "Notable: 12 apps (100%) appear only once" in t
    assert "Each of the 10 variant apps is unique to its combination" in t
    assert "Base apps (12) show more diversity than variant apps (10)" in t
    assert "Combination complexity ranges from 2 to 5 total apps" in t
    assert "• 12 specialized base apps" in t and "• Variant apps are more standardized" in t
    u = text[("Pixel_4a", "user")]
    assert "All 4 base apps are unique" in u and "Notable: 4 apps (100%)" in u
    assert "similar diversity (4 each)" in u and "ranges from" not in u and "• 4 specialized base apps" in u
    g = text[("Galaxy_S10", "eng")]
    assert "ranges from 2 to 3" in g and "• 5 specialized base apps" in g and "more standardized" in g
    lines = insights.request_lines(df).where("device = 'Pixel_4a' AND build_type = 'userdebug'").orderBy("combo_no").collect()
    assert len(lines) == 7 and lines[0].text.startswith("\n1. FP: ISH | SDP: OLE\n   Base Apps (2): com.google.camera, com.google.dialer")
