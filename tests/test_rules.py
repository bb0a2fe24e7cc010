"""Rules that hold for any data: trees with shared ids, NULL groups, big numbers, whole lists."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import documents, hierarchy, ingest, quality, segmented, series

NODES = "tree_id int, node_id string, parent_id string, side string, value long"


def test_trees_that_share_node_ids(spark):
    a = [(t, "0", None, None, -1) for t in (1, 2)] + [(1, "1", "0", "L", 5), (1, "2", "0", "R", 7), (2, "1", "0", "L", 2), (2, "2", "0", "R", 4)]
    df = spark.createDataFrame(a, NODES)
    assert sorted(map(tuple, hierarchy.evaluate(df).collect())) == [(1, 12), (2, 6)]
    sums = sorted((r.tree_id, r.leaf_id, r.branch_sum) for r in hierarchy.branch_sums(df).collect())
    assert sums == [(1, "1", 4), (1, "2", 6), (2, "1", 1), (2, "2", 3)]


def test_cycles_raise(spark):
    loop = spark.createDataFrame([(1, "r", None, None, -1), (1, "x", "r", "L", 3), (1, "a", "b", "L", -1), (1, "b", "a", "L", -1)], NODES)
    for f in (hierarchy.evaluate, hierarchy.branch_sums):
        with pytest.raises(hierarchy.TreeError):
            f(loop)


def test_deep_tree(spark):
    rows = [(1, "n0", None, None, -1)]
    for d in range(1, 20):
        rows += [(1, f"n{d}", f"n{d - 1}", "L", -1), (1, f"l{d}", f"n{d - 1}", "R", d)]
    rows.append((1, "end", "n19", "L", 100))
    assert [tuple(r) for r in hierarchy.evaluate(spark.createDataFrame(rows, NODES)).collect()] == [(1, 100 + sum(range(1, 20)))]


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 0, 5), (None, 1, 9), ("a", 0, 3), ("a", 1, 1)], "g string, pos long, v long")
    for n in (1, 4):
        got = {(r.g, r.pos): r.k for r in segmented.ranked(df, ["g"], ["pos"], out="k", method="row_number", n=n).collect()}
        assert got == {(None, 0): 1, (None, 1): 2, ("a", 0): 1, ("a", 1): 2}
    assert {r.g: r.best_rise for r in series.best_rise(df).collect()} == {None: 4, "a": 0}
    assert {(r.g, r.pos): r.smaller for r in series.smaller_count(df).collect()} == {(None, 0): 0, (None, 1): 1, ("a", 0): 1, ("a", 1): 0}
    pts = df.withColumn("x", F.col("v")).withColumn("y", F.lit(0))
    assert {r.g: r.path_length for r in series.path_length(pts).collect()} == {None: 4, "a": 2}
    t = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "t", "c")], "seq long, ticket_id string, content string")
    assert {(r.ticket_id, r.version, r.is_latest) for r in ingest.versions(t).collect()} == {(None, 1, False), (None, 2, True), ("t", 1, True)}
    assert {(r.ticket_id, r.max_version, r.content) for r in ingest.latest(t).collect()} == {(None, 2, "b"), ("t", 1, "c")}


def test_hot_value_of_a_hot_group(spark):
    df = spark.range(6000).select(F.lit("hot").alias("g"), F.col("id").alias("pos"), F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("v"))
    got = {r.pos: r.smaller for r in series.smaller_count(df).collect()}
    assert got[0] == got[4999] == 0 and got[5000] == 5000 and got[5999] == 5999


def test_previous_and_next_row_across_slices(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("g"))
    for n in (1, 7):
        for r in segmented.previous_row(df, ["g"], "k", ["k"], n=n, next_prefix="next_").collect():
            assert r.prev_k == (r.k - 1 if r.k else None) and r.next_k == (r.k + 1 if r.k < 49 else None)


def test_sums_of_long_ranges(spark):
    n = 200_000_001
    s = n * (n + 1) // 2 - 17
    one = spark.createDataFrame([("g", n, s)], "g string, n long, s long")
    half = F.col("n").cast("decimal(19,0)") * (F.col("n") + 1) * F.expr("0.5BD") - F.col("s")
    assert one.select(half.cast("bigint")).first()[0] == 17
    assert spark.range(1).select(T.int_percent(F.lit(10**15 * 7), F.lit(3))).first()[0] == 10**15 * 700 // 3


def test_list_parsing_edges(spark):
    df = spark.createDataFrame([('"x"',), ("'y'",), ("\t \n",), ("['a',\n 'b']",), ("plain",)], "t string")
    got = [r.a for r in df.select(T.parse_list("t").alias("a")).collect()]
    assert got == [["x"], ["y"], [], ["a", "b"], ["plain"]]
    assert [r.a for r in df.select(T.parse_list_analyzer("t").alias("a")).collect()][3] == ["a", "b"]


def test_one_decimal_is_the_doubles(spark):
    from tessera.operators.insights import one_decimal
    pairs = [(p, q) for q in range(1, 41) for p in range(0, 60, 7)]
    df = spark.createDataFrame(pairs, "p long, q long")
    assert [r[0] for r in df.select(one_decimal(F.col("p"), F.col("q"))).collect()] == [f"{p / q:.1f}" for p, q in pairs]


def test_percentiles_without_a_buffer(spark):
    import numpy as np
    r = np.random.default_rng(1)
    rows = [("a", float(x)) for x in r.normal(size=333)] + [("b", 2.0)] * 50 + [(None, 1.0), (None, 3.0), ("c", None)]
    got = {x.g: (x.n, x.p90) for x in quality.percentile_by(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert got["a"] == (333, pytest.approx(np.quantile([v for g, v in rows if g == "a"], 0.9), abs=1e-6))
    assert got["b"] == (50, 2.0) and got[None] == (2, 2.8) and got["c"] == (1, None)


def test_facts_of_every_line_and_topic(spark):
    lines = [(1, 0, "TOPIC: alpha"), (1, 1, "FACT: the first long fact"), (1, 2, "FACT: the second long fact"), (1, 3, "TOPIC: zzz"),
             (1, 4, "FACT: under no topic at all"), (1, 5, "TOPIC: Alpha and more"), (1, 6, "FACT: the third long fact")]
    df = spark.createDataFrame(lines, "doc_id long, line_no long, line string")
    topics = spark.createDataFrame([(0, "alpha"), (1, "beta")], "topic_pos long, topic string")
    got = sorted((r.topic, r.line_no) for r in documents.section_facts(df, topics).collect())
    assert got == [("alpha", 1), ("alpha", 2), ("alpha", 6)]
    many = spark.range(60).select(F.lit(1).alias("doc_id"), F.col("id").alias("line_no"), F.concat(F.lit("TOPIC: topic "), F.col("id").cast("string")).alias("line"))
    items = documents.list_items(many)
    assert documents.consolidate_topics(items).count() == 60 and documents.consolidate_topics(items, 25).count() == 25


def test_vector_topk_does_not_depend_on_the_index(spark):
    v = spark.range(40).select(F.col("id").alias("vec_id"), F.array(F.sin("id"), F.cos("id"), F.lit(0.5)).alias("embedding"))
    q = v.where("vec_id < 9").select(F.col("vec_id").alias("query_id"), F.col("vec_id").cast("string").alias("query_label"), F.col("embedding").alias("query_vec"))
    one = sorted(map(tuple, documents.vector_topk(v, q, 3).collect()))
    from tessera.operators import vector_index
    for pivots, rings in ((1, 1), (2, 3), (40, 1)):
        index = vector_index.build(v, pivots, rings)
        assert sorted(map(tuple, vector_index.search(index, q, 3).collect())) == one and len(one) == 27


def test_plain_csv_is_read_in_splits(spark, tmp_path):
    from tessera.sources import csvfiles
    df = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.lit('say "hi", you').alias("t"))
    path = csvfiles.write_csv(df.coalesce(1), str(tmp_path / "big"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        back = csvfiles.read_csv(spark, path, required=["k", "t"])
        assert back.rdd.getNumPartitions() > 1 and back.where(F.col("t") == 'say "hi", you').count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
