"""Operators on the hand-made fixtures of FIXTURES.md sections 5-10."""

import os

from pyspark.sql import functions as F

from tessera.operators import analyzer, csvedit, documents, hierarchy, ingest, pages, profiles, segmented, series
from tessera.sources import csvfiles, sinks


# --- section 5: analyzer rows ------------------------------------------------------

def analyzer_fixture(spark):
    rows = [
        (1, "A", "R1", "FALSE", "g/x/1", "['b','a','a']", "[]"),
        (2, "A", "R1", "TRUE", "g/x/1", "['z']", "['z']"),
        (3, "A", "SMR", "FALSE", "g/x/1", "['z']", "['z']"),
        (4, "A", "R2", "FALSE", "g/y/1", "a, b , ,c", "[ ]"),
        (5, None, "R1", "FALSE", "g/y/1", "['z']", "['z']"),
        (6, "B", "R1", "FALSE", "", "['a']", "['v','w']"),
    ]
    schema = ("rid long, device string, release_type string, vr_qualified string, fingerprint string, "
              "priv_app_in_base_only string, priv_app_in_variant_only string")
    df = spark.createDataFrame(rows, schema).withColumn("same_device_fingerprint", F.col("fingerprint"))
    return analyzer.analyzer_rows(df)


def as_dict(rows, key_cols, val_col):
    return {tuple(r[k] for k in key_cols): r[val_col] for r in rows}


def test_analyzer_counts(spark):
    rows = analyzer_fixture(spark)
    assert sorted(r.rid for r in rows.collect()) == [1, 4, 5, 6]
    assert as_dict(analyzer.release_counts(rows).collect(), ["device", "release_type"], "n") == {
        ("A", "R1"): 1, ("A", "R2"): 1, ("B", "R1"): 1}
    apps = as_dict(analyzer.global_app_counts(rows).collect(), ["side", "app"], "n")
    assert apps == {("base", "a"): 4, ("base", "b"): 2, ("base", "c"): 1, ("variant", "v"): 1, ("variant", "w"): 1}
    pairs = as_dict(analyzer.pair_counts(rows).collect(), ["side", "app_a", "app_b"], "n")
    assert pairs == {("base", "a", "b"): 3, ("base", "a", "a"): 1, ("base", "a", "c"): 1, ("base", "b", "c"): 1,
                     ("variant", "v", "w"): 1}
    fp = as_dict(analyzer.keyed_app_counts(rows, "fp").where("side = 'base'").collect(),
                 ["device", "release_type", "fp", "app"], "n")
    assert fp == {("A", "R1", "x", "a"): 2, ("A", "R1", "x", "b"): 1, ("A", "R2", "y", "a"): 1,
                  ("A", "R2", "y", "b"): 1, ("A", "R2", "y", "c"): 1}


# --- report merge on a tiny sample (FIXTURES section 2 shape) -------------------------

def test_merge_and_self_removal(spark):
    rows = [
        (0, "google/sunfish/a", "google/oriole/b", "['x', 'y']", "['v']", "userdebug", "Pixel"),
        (1, "google/catfish/a", "google/oriole/c", "['y', 'z']", "[]", "userdebug", "Pixel"),
        (2, "google/sunfish/a", "google/sunfish/b", "['q']", "['q']", "userdebug", "Pixel"),
        (3, "google/redfin/a", None, "['x']", None, "user", "Pixel"),
    ]
    schema = ("rid long, fingerprint string, same_device_fingerprints string, priv_base_apps string, "
              "priv_var_apps string, build_type string, device string")
    parsed = profiles.parse_report_rows(spark.createDataFrame(rows, schema))
    audit = profiles.merge_audit(parsed).first()
    assert (audit.original_rows, audit.self_removed, audit.merged_away, audit.final_rows) == (4, 1, 1, 2)
    merged = {(r.fp_code, r.sdp_code): r for r in profiles.merge_duplicates(profiles.drop_self_comparisons(parsed)).collect()}
    assert merged[("ISH", "OLE")].base == ["x", "y", "z"] and merged[("ISH", "OLE")].fingerprint == "google/sunfish/a"
    assert merged[("FIN", None)].variant == []
    stats = {r.level: r for r in profiles.level_statistics(profiles.merge_duplicates(profiles.drop_self_comparisons(parsed))).collect()
             if r.level == "overall"}
    assert stats["overall"].total_rows == 2 and stats["overall"].total_base == 4 and stats["overall"].unique_base == 3


# --- section 6: section facts -----------------------------------------------------------

def test_section_facts(spark):
    lines = ["FACT: dropped because no header", "TOPIC: Budget Plan", "FACT: Budget increased by ten", "FACT: NONE",
             "TOPIC: Zebra", "FACT: lost under unmatched one", "TOPIC: time", "FACT: Phase two started"]
    ln = spark.createDataFrame([(7, i, s) for i, s in enumerate(lines)], "doc_id long, line_no long, line string")
    topics = spark.createDataFrame([(0, "Budget"), (1, "Project Timeline")], "topic_pos int, topic string")
    got = sorted((r.topic, r.fact) for r in documents.section_facts(ln, topics).collect())
    assert got == [("Budget", "[7] Budget increased by ten"), ("Project Timeline", "[7] Phase two started")]


def test_topic_consolidation(spark):
    lines = ["TOPIC: Budget", "TOPIC: budget ", "2) Staffing", "* abc"]
    ln = spark.createDataFrame([(1, i, s) for i, s in enumerate(lines)], "doc_id long, line_no long, line string")
    got = [(r.topic_pos, r.topic) for r in documents.consolidate_topics(documents.list_items(ln)).orderBy("topic_pos").collect()]
    assert got == [(0, "Budget"), (1, "Staffing")]


# --- section 7: tickets ----------------------------------------------------------------

def tickets(spark, rows):
    return spark.createDataFrame(rows, "seq long, ticket_id string, content string")


def test_ticket_dedup_and_versions(spark):
    t = tickets(spark, [(1, "T1", "a"), (2, "T1", "b"), (3, "T1", "a"), (4, "T2", "a"), (5, "T1", "c")])
    assert sorted(r.seq for r in ingest.first_per_hash(t).collect()) == [1, 2, 5]
    ins = {r.seq: (r.created, r.reason) for r in ingest.insert_if_absent(t).collect()}
    assert ins == {1: (True, None), 2: (True, None), 3: (False, "exists"), 4: (False, "hash_taken"), 5: (True, None)}
    v = {(r.ticket_id, r.content): (r.version, r.is_latest) for r in ingest.versions(t).collect()}
    assert v == {("T1", "a"): (1, False), ("T1", "b"): (2, False), ("T1", "c"): (3, True), ("T2", "a"): (1, True)}


def test_batch_ingest(spark):
    store = tickets(spark, [(1, "T1", "a")])
    batch = tickets(spark, [(2, "T1", "b"), (3, "T2", "a"), (4, "T2", "d"), (5, "T3", "d")])
    assert sorted((r.ticket_id, r.content) for r in ingest.batch_ingest(store, batch).collect()) == [("T1", "b"), ("T2", "d")]
    batch2 = tickets(spark, [(3, "T2", "a"), (4, "T2", "d"), (5, "T3", "d")])
    assert sorted((r.ticket_id, r.content) for r in ingest.batch_ingest(store, batch2).collect()) == [("T2", "a"), ("T2", "d")]


# --- section 9: series, sets, trees -------------------------------------------------------

def series_df(spark, groups):
    return spark.createDataFrame([(g, i, v) for g, vs in groups.items() for i, v in enumerate(vs)], "g string, pos int, v long")


def test_series_ops(spark):
    s = series_df(spark, {"a": [7, 1, 5, 3, 6, 4], "b": [5, 4, 3], "c": [9], "d": [8, 1, 2, 2, 3]})
    rise = as_dict(series.best_rise(s).collect(), ["g"], "best_rise")
    assert rise == {("a",): 5, ("b",): 0, ("c",): 0, ("d",): 2}
    smaller = [r.smaller for r in series.smaller_count(s.where("g = 'd'")).orderBy("pos").collect()]
    assert smaller == [4, 0, 1, 1, 3]
    ps = series_df(spark, {"x": [2, 7, 11, 15], "y": [3, 3], "z": [1, 2]})
    got = {r.g: (r.i, r.j) for r in series.pair_sum(ps.where("g = 'x'"), 9).collect()}
    assert got == {"x": (0, 1)}
    assert {r.g: (r.i, r.j) for r in series.pair_sum(ps.where("g != 'x'"), 6).collect()} == {"y": (0, 1)}
    dup = as_dict(series.has_duplicates(series_df(spark, {"q": [1, 2, 3, 1]})).collect(), ["g"], "has_duplicates")
    assert dup == {("q",): True}
    miss = series.missing_by_sum(series_df(spark, {"m": [3, 0, 1]}).select("g", "v")).first()
    assert miss.missing == 2


def test_skew_safe_rank_matches_window(spark):
    """A group holding most rows is split into slices; ranks equal a plain window."""
    from pyspark.sql import Window
    df = spark.range(0, 3000).select((F.when(F.col("id") < 2000, F.lit("hot")).otherwise((F.col("id") % 7).cast("string"))).alias("g"),
                                     (F.col("id") * 7919 % 101).alias("v"))
    got = segmented.ranked(df, ["g"], ["v"], out="r", method="rank", n=16)
    ref = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy("v")))
    assert sorted(map(tuple, got.select("g", "v", "r").collect())) == sorted(map(tuple, ref.select("g", "v", "r").collect()))
    hot_slices = segmented.slice_groups(df, ["g"], ["v"], n=16).where("g = 'hot'").select("_slice").distinct().count()
    assert hot_slices > 4


def test_missing_ids_and_path(spark):
    present = spark.createDataFrame([(v,) for v in [4, 3, 2, 7, 8, 2, 3, 1]], "id long")
    bounds = spark.createDataFrame([(1, 8)], "lo long, hi long")
    assert sorted(r.id for r in series.missing_ids(present, bounds).collect()) == [5, 6]
    pts = spark.createDataFrame([("p", 0, 1, 1), ("p", 1, 3, 4), ("p", 2, -1, 0), ("s", 0, 5, 5)], "g string, pos int, x long, y long")
    assert as_dict(series.path_length(pts).collect(), ["g"], "path_length") == {("p",): 7, ("s",): 0}


def test_trees(spark):
    nodes = [(1, "1", None, None, 1), (1, "2", "1", "L", 2), (1, "3", "1", "R", 3), (1, "4", "2", "L", 4),
             (1, "5", "2", "R", 5), (1, "6", "3", "L", 6)]
    df = spark.createDataFrame(nodes, "tree_id int, node_id string, parent_id string, side string, value long")
    assert sorted(r.branch_sum for r in hierarchy.branch_sums(df).collect()) == [7, 8, 10]
    expr = [(1, "a", None, None, -1), (1, "b", "a", "L", -2), (1, "c", "b", "L", 8), (1, "d", "b", "R", -3),
            (1, "e", "d", "L", 7), (1, "f", "d", "R", 2), (1, "g", "a", "R", -4), (1, "h", "g", "L", 2), (1, "i", "g", "R", 3),
            (2, "r", None, None, -3), (2, "s", "r", "L", -2), (2, "t", "s", "L", 1), (2, "u", "s", "R", 8), (2, "w", "r", "R", 2)]
    e = spark.createDataFrame(expr, "tree_id int, node_id string, parent_id string, side string, value long")
    assert as_dict(hierarchy.evaluate(e).collect(), ["tree_id"], "result") == {(1,): 11, (2,): -3}


# --- section 8: quoted CSV -------------------------------------------------------------------

def test_quoted_csv(spark, tmp_path):
    from tessera.sources import csvfiles
    text = 'id,name,n\n1,"a,""b""\nc",2\n2,short\n , , \n3,x,y,z\n4,ok,5\n'
    p = tmp_path / "in.csv"
    p.write_text(text)
    df = csvfiles.read_quoted_csv(spark, str(p))
    assert sorted(map(tuple, df.collect())) == [("1", 'a,"b"\nc', "2"), ("4", "ok", "5")]
    assert [r.id for r in csvedit.search_any(df, " OK ").collect()] == ["4"]
    mixed = tmp_path / "mixed.csv"
    mixed.write_bytes(text.replace("\n", "\r\n", 2).encode())
    df2 = csvfiles.read_quoted_csv(spark, str(mixed), normalise=True)
    assert sorted(map(tuple, df2.collect())) == [("1", 'a,"b"\nc', "2"), ("4", "ok", "5")]
    out = csvfiles.write_csv(df.where("id = '1'").select("name", F.lit("plain").alias("x")), str(tmp_path / "out"))
    body = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert '"a,""b""\nc",plain' in body


# --- section 10: page fields -------------------------------------------------------------------

def test_page_fields(spark):
    html = ["<title>Bug [12] - Issue Tracker</title><p>desc</p><script>var t='</p>';</script><p>c1</p><p>desc</p>",
            "<title>Bug - Issue Tracker</title><p>only</p>", "<title>Bug</title>", "<html></html>"]
    p = spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    titles = [r.t for r in p.orderBy("page_id").select(pages.page_title().alias("t")).collect()]
    assert titles == ["Bug", "Bug", "Bug", "Title not parseable from page_title"]
    out = {r.page_id: r.all_comments_concatenated for r in pages.comments_concat(p).collect()}
    # an entry with the description's text again is a comment of its own
    assert out[0].startswith("--- Comment ID: p1 ---\nAuthor: Unknown") and out[0].endswith("Text:\ndesc")
    assert [(r.raw_pos, r.text) for r in pages.page_items(p.where("page_id = 0")).collect()] == [(0, "desc"), (1, "c1"), (2, "desc")]
    assert out[1] == "No subsequent comments found." and out[3] == "No comments or description found."


# --- T06 / A25 ---------------------------------------------------------------------------------

def test_quarantine_and_metrics(spark):
    from tessera.operators import quality
    docs = spark.createDataFrame([(1, "ok (fine)", 9), (2, None, 0), (3, "abc", 4), (4, "x ( y", 5)],
                                 "doc_id long, text string, n_chars long")
    good, bad = quality.split_errors(quality.document_errors(docs))
    assert [r.doc_id for r in good.collect()] == [1]
    assert {r.doc_id: r.error for r in bad.collect()} == {2: "no text", 3: "length mismatch", 4: "unbalanced brackets"}
    lab = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "a int, p int")
    m = quality.binary_metrics(lab, "a", "p").first()
    assert (m.tp, m.fp, m.fn, m.tn) == (2, 1, 1, 1) and abs(m.f1 - 2 / 3) < 1e-6


# --- options and sinks that no registered query uses -------------------------------

def test_list_pairs_of_short_null_and_repeated_items(spark):
    df = spark.createDataFrame([("a", ["x", "y", "y"]), ("b", ["x"]), ("c", []), ("d", None)], "side string, apps array<string>")
    got = sorted(tuple(r) for r in analyzer.list_pairs(df, ["side"], "apps").collect())
    assert got == [("a", "x", "y"), ("a", "x", "y"), ("a", "y", "y")]


def test_row_cap_is_exact_and_off_by_default(spark):
    rows = spark.range(100).select(F.col("id").alias("rid")).repartition(7)
    assert sorted(r.rid for r in analyzer.capped(rows, 10).collect()) == list(range(10))
    assert analyzer.capped(rows).count() == 100 and analyzer.capped(rows, 0).count() == 0


def test_topic_cap_keeps_the_first_distinct_topics(spark):
    items = spark.createDataFrame([(1, 1, "Beta"), (1, 2, "alpha"), (2, 1, " beta "), (2, 2, "Gamma")],
                                  "doc_id long, line_no long, item string")
    got = {r.topic_pos: r.topic for r in documents.consolidate_topics(items, max_topics=2).collect()}
    assert got == {0: "Beta", 1: "alpha"}
    assert documents.consolidate_topics(items).count() == 3


def test_json_lines_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, 'q"uote')], "id long, name string")
    path = sinks.write_json(df, str(tmp_path / "out"))
    lines = sorted(line for r in spark.read.text(path).collect() for line in [r.value])
    assert lines == ['{"id":1,"name":null}', '{"id":2,"name":"q\\"uote"}']


def test_appended_csv_parts_have_their_own_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    for part in ([(1, "a")], [(2, "b"), (3, None)]):
        csvfiles.append_csv(spark.createDataFrame(part, "id long, name string"), path)
    got = sorted((r.id, r.name) for r in spark.read.option("header", "true").csv(path).collect())
    assert got == [("1", "a"), ("2", "b"), ("3", None)]


def test_left_out_turns_differ_between_conversations(spark):
    from tessera.plans import queries
    missing = {r.missing for r in queries.QUERIES["missing_by_sum"](spark, "/root/testdata/sf0.001").collect()}
    assert len(missing) > 1


def test_document_report_counts_topics_without_facts(spark):
    topics = spark.createDataFrame([(0, "Beta"), (1, "alpha")], "topic_pos long, topic string")
    facts = spark.createDataFrame([(1, 2, "Beta", "[1] x"), (2, 2, "Beta", "[2] y")], "doc_id long, line_no long, topic string, fact string")
    pages_of = spark.createDataFrame([(1,), (1,), (2,), (3,)], "doc_id long")
    got = sorted(tuple(r) for r in documents.report_numbers(facts, topics, pages_of).collect())
    assert got == [("document_totals", 0, "documents", 3.0), ("document_totals", 0, "facts", 2.0), ("document_totals", 0, "topics", 2.0),
                   ("topic_facts", 0, "Beta", 2.0), ("topic_facts", 1, "alpha", 0.0)]
    none = {r.label: r.value for r in documents.report_numbers(facts.where("false"), topics.where("false"), pages_of.where("false")).collect()}
    assert none == {"documents": 0.0, "topics": 0.0, "facts": 0.0}
