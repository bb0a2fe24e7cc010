"""Indexes: exact vector top-k, label containment, tree pointers, id gaps."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import containment, hierarchy, series, vector_index


def brute_topk(vectors, queries, k):
    out = []
    for qi, label, q in queries:
        q = np.array(q, float)
        q = q / np.linalg.norm(q) if np.linalg.norm(q) > 0 else q
        own = sorted(((-float(np.dot(np.array(v, float), q)), i) for i, v in vectors if v is not None))[:k]
        out += [(label, qi, r, i, round(-s, 6)) for r, (s, i) in enumerate(own, 1)]
    return sorted(out)


def clustered(seed, n, clusters, dim, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dim)) * 3
    return [(i, (centres[i % clusters] + r.normal(size=dim) * spread).tolist()) for i in range(n)]


VEC = "vec_id long, embedding array<double>"
QUERY = "query_id long, query_label string, query_vec array<double>"


def test_vector_topk_is_exact_and_scores_few_pairs(spark):
    vectors = clustered(1, 3000, 40, 16, 0.2)
    queries = [(i, f"q{i}", vectors[i][1]) for i in range(0, 400, 20)]
    index = vector_index.build(spark.createDataFrame(vectors, VEC))
    found, pairs = vector_index.search_counted(index, spark.createDataFrame(queries, QUERY), 10)
    got = sorted(map(tuple, found.collect()))
    want = brute_topk(vectors, queries, 10)
    assert [x[:4] for x in got] == [x[:4] for x in want] and np.allclose([x[4] for x in got], [x[4] for x in want], atol=1e-6)
    assert pairs < len(vectors) * len(queries) / 3


@pytest.mark.parametrize("pivots, rings", [(1, 1), (7, 3), (500, 2)])
def test_vector_topk_on_scattered_vectors(spark, pivots, rings):
    r = np.random.default_rng(pivots)
    vectors = [(i, (r.normal(size=5) * r.choice([0.1, 1, 20])).tolist()) for i in range(300)]
    vectors += [(1000 + i, [1.0] * 5) for i in range(150)]  # one very common vector: ties go to the lower id
    vectors.append((5000, None))
    queries = [(1, "a", [1.0] * 5), (2, "b", [0.0] * 5), (3, "c", r.normal(size=5).tolist()), (4, "far", [-50.0, 3.0, 1.0, 0.0, 0.0])]
    index = vector_index.build(spark.createDataFrame(vectors, VEC), pivots, rings)
    for k in (1, 25):
        got = sorted(map(tuple, vector_index.search(index, spark.createDataFrame(queries, QUERY), k).collect()), key=str)
        want = sorted(brute_topk([(i, v) for i, v in vectors], [(i, str(x), q) for i, x, q in queries], k), key=str)
        assert {(x[1], x[2]): x[3] for x in got} == {(x[1], x[2]): x[3] for x in want}


def test_vector_topk_with_fewer_vectors_than_k_and_none(spark):
    queries = spark.createDataFrame([(1, "a", [1.0, 0.0])], QUERY)
    two = spark.createDataFrame([(5, [0.5, 1.0]), (4, [0.5, 2.0])], VEC)
    assert sorted((x["rank"], x["vec_id"]) for x in vector_index.search(vector_index.build(two), queries, 10).collect()) == [(1, 4), (2, 5)]
    assert vector_index.search(vector_index.build(two.where("false")), queries, 10).collect() == []
    assert vector_index.search(vector_index.build(two), queries.where("false"), 10).collect() == []


def brute_first(names, topics):
    out = {}
    for name in {n for n in names if n is not None}:
        hits = [(p, t) for p, t in topics if t is not None and (name in t.lower() or t.lower() in name)]
        if hits:
            out[name] = min(hits)[1]
    return out


def test_containment_matches_brute_force(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.randint(1, 7)))
    for empties in ([], ["", None]):
        names = [word() for _ in range(120)] + empties + ["a", "ab", "q", "xyz"]
        topics = list(enumerate([word().upper() for _ in range(60)] + ["B", "aé"] + empties[:1]))
        got = containment.first_containing(spark.createDataFrame([(n,) for n in names], "name string"),
                                           spark.createDataFrame(topics, "topic_pos long, topic string"))
        assert {x["name"]: x["topic"] for x in got.collect()} == brute_first(names, topics)
    none = spark.createDataFrame([], "topic_pos long, topic string")
    assert containment.first_containing(spark.createDataFrame([("a",), ("",)], "name string"), none).collect() == []


def test_containment_compares_few_pairs(spark):
    r = random.Random(5)
    label = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(r.randint(6, 24)))
    long = sorted({label() for _ in range(10_000)})
    short = sorted({x[2:8] for x in long[:5000]} | {label() for _ in range(5000)})
    both = spark.createDataFrame([(0, x) for x in short] + [(1, x) for x in long], "side int, s string")
    pairs = containment.containment_pairs(both)
    assert {r["side"] for r in pairs.select("side").distinct().collect()} == {0, 1}
    n, hits = pairs.agg(F.count(F.lit(1)), F.count(F.when(F.col("long").contains(F.col("short")), 1))).first()
    assert hits >= 5000 and n < len(short) * len(long) / 500


# --- H01: pointer doubling ---------------------------------------------------------

TREE = "tree_id long, node_id string, parent_id string, side string, value long"


def brute_branches(nodes):
    parent = {(t, n): (t, p) if p is not None else None for t, n, p, _, _ in nodes}
    value = {(t, n): v for t, n, _, _, v in nodes}
    out = []
    for leaf in set(parent) - set(parent.values()):
        path = [leaf]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        out.append((*leaf, path[-1][1], sum(value[x] for x in path), len(path), tuple(x[1] for x in reversed(path))))
    return sorted(out)


def leaves(df):
    return sorted((r["tree_id"], r["leaf_id"], r["root_id"], r["branch_sum"], r["depth"], tuple(r["path"])) for r in df.collect())


def test_branch_sums_of_random_forests(spark):
    r = random.Random(8)
    nodes = []
    for t in range(6):
        for n in range(r.randint(1, 60)):
            up = r.choice([None, *range(n)]) if n and r.random() < 0.1 else (r.randrange(max(0, n - 3), n) if n else None)
            nodes.append((t, f"n{n}", None if up is None else f"n{up}", None, r.randint(-9, 9)))
    got = leaves(hierarchy.branch_sums(spark.createDataFrame(nodes, TREE)))
    assert got == brute_branches(nodes) and max(x[4] for x in got) > 10


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    chain = [(1, f"n{i}", f"n{i - 1}" if i else None, None, 1) for i in range(5000)]
    rounds, once = [], hierarchy._doubled
    monkeypatch.setattr(hierarchy, "_doubled", lambda *a: rounds.append(1) or once(*a))
    got = hierarchy.branch_sums(spark.createDataFrame(chain, TREE)).collect()
    assert len(rounds) <= 15 and len(got) == 1
    assert (got[0]["leaf_id"], got[0]["root_id"], got[0]["branch_sum"], got[0]["depth"]) == ("n4999", "n0", 5000, 5000)
    assert got[0]["path"] == [f"n{i}" for i in range(5000)]


@pytest.mark.parametrize("bad", [[("a", "b"), ("b", "a")], [("a", None), ("b", "nowhere")], [("a", "a")], [("a", None), ("b", "c"), ("c", "d"), ("d", "b")]])
def test_trees_that_are_none_raise(spark, bad):
    rows = spark.createDataFrame([(1, n, p, None, 1) for n, p in bad], TREE)
    with pytest.raises(hierarchy.TreeError):
        hierarchy.branch_sums(rows).collect()


# --- U02: gaps between ids -------------------------------------------------------------

def ids_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def bounds_of(spark, lo, hi):
    return spark.createDataFrame([(lo, hi)], "lo long, hi long")


@pytest.mark.parametrize("lo, hi", [(0, 100), (40, 60), (-5, 3), (200, 300), (10, 9), (50, 50)])
def test_missing_ids_match_brute_force(spark, lo, hi):
    r = random.Random(lo)
    have = [r.randrange(-20, 120) for _ in range(90)] + [None, 50]
    want = sorted(set(range(lo, hi + 1)) - set(have))
    assert sorted(x["id"] for x in series.missing_ids(ids_of(spark, have), bounds_of(spark, lo, hi)).collect()) == want
    gaps = [(x["lo"], x["hi"]) for x in series.missing_ranges(ids_of(spark, have), bounds_of(spark, lo, hi)).collect()]
    assert sorted(i for a, b in gaps for i in range(a, b + 1)) == want
    assert all(b + 1 not in {a for a, _ in gaps} for _, b in gaps)  # neighbouring gaps are one


def test_a_huge_range_costs_its_gaps_alone(spark):
    have = [0, 3, 5 * 10**11, 10**12]
    got = sorted((x["lo"], x["hi"]) for x in series.missing_ranges(ids_of(spark, have), bounds_of(spark, 0, 10**12)).collect())
    assert got == [(1, 2), (4, 5 * 10**11 - 1), (5 * 10**11 + 1, 10**12 - 1)]
    assert series.missing_ids(ids_of(spark, []), bounds_of(spark, 10**12, 10**12 + 4)).count() == 5
    assert series.missing_ids(ids_of(spark, []), bounds_of(spark, None, None)).count() == 0
