"""A hot group holding most rows: the skew-safe operators against brute force."""

import random

from tessera.operators import ingest, series


def hot_series(spark):
    rnd = random.Random(7)
    groups = {"hot": [rnd.randrange(0, 60) for _ in range(3000)]}
    for g in "abcde":
        groups[g] = [rnd.randrange(0, 60) for _ in range(25)]
    rows = [(g, i, v) for g, vs in groups.items() for i, v in enumerate(vs)]
    return groups, spark.createDataFrame(rows, "g string, pos int, v long")


def test_series_on_hot_group(spark):
    groups, df = hot_series(spark)
    want_rise = {g: max([0] + [vs[j] - min(vs[:j]) for j in range(1, len(vs))]) for g, vs in groups.items()}
    assert {r.g: r.best_rise for r in series.best_rise(df).collect()} == want_rise
    got_smaller = {(r.g, r.pos): r.smaller for r in series.smaller_count(df).collect()}
    for g, vs in groups.items():
        for i, v in enumerate(vs):
            assert got_smaller[(g, i)] == sum(1 for x in vs if x < v)
    want_pair = {}
    for g, vs in groups.items():
        for i in range(len(vs)):
            js = [j for j in range(i + 1, len(vs)) if vs[i] + vs[j] == 70]
            if js:
                want_pair[g] = (i, js[0])
                break
    assert {r.g: (r.i, r.j) for r in series.pair_sum(df, 70).collect()} == want_pair


def test_versions_on_hot_ticket(spark):
    rnd = random.Random(11)
    rows = [(s, "HOT" if s % 4 else f"T{s % 7}", f"c{rnd.randrange(0, 400)}") for s in range(4000)]
    df = spark.createDataFrame(rows, "seq long, ticket_id string, content string")
    want = {}
    for seq, t, c in sorted(rows):
        seen = want.setdefault(t, {})
        if c not in seen:
            seen[c] = len(seen) + 1
    got = {(r.ticket_id, r.content): r.version for r in ingest.versions(df).collect()}
    assert got == {(t, c): v for t, cs in want.items() for c, v in cs.items()}
