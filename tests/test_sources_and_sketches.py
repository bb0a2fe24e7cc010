"""Error isolation, rejected CSV lines, raw files and mergeable sketches."""

import hashlib
import random

from pyspark.sql import functions as F

from tessera.operators import quality, sketches
from tessera.sources import csvfiles, sinks, tables


def test_each_failing_expression_is_named_and_stops_nothing(spark, tmp_path):
    rows = [(1, '{"k": 5, "s": "a"}', "2.5"), (2, '{"k": ', "1"), (3, '{"k": "five"}', "x"), (4, None, None), (5, "[]", "7"), (6, '{"k": 6}', ""), (7, "", "8")]
    df = spark.createDataFrame(rows, "id long, j string, n string")
    parts = {"k": ("j", quality.json_field("j", "$.k", "int")), "num": ("n", F.expr("try_cast(n AS double)"))}
    got = {r["id"]: (r["k"], r["num"], r["errors"]) for r in quality.isolated(df, parts).collect()}
    assert got == {1: (5, 2.5, []), 2: (None, 1.0, ["k"]), 3: (None, None, ["k", "num"]), 4: (None, None, []), 5: (None, 7.0, ["k"]),
                   6: (6, None, ["num"]), 7: (None, 8.0, ["k"])}
    folder = str(tmp_path / "bad")
    for _ in range(2):  # each run appends its own rows
        good = quality.quarantine(quality.isolated(df, parts), folder)
        assert sorted(r["id"] for r in good.collect()) == [1, 4] and "errors" not in good.columns
    assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == [2, 2, 3, 3, 5, 5, 6, 6, 7, 7]
    none = quality.quarantine(quality.isolated(df.where("false"), parts), str(tmp_path / "none"))
    assert none.count() == 0 and spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_rows_and_rejects_are_all_the_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['a,b,c', '1,"x, ""y""",3', '2,only', '', '3,p,q,r', ' , , ', '4,,', '5,"open', '6,é,z', '"7","8","9"']
    (tmp_path / "in" / "f.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    good, bad = csvfiles.read_csv_with_rejects(spark, str(tmp_path / "in"), ["a", "b", "c"])
    assert sorted(tuple(r) for r in good.fillna("").collect()) == [("1", 'x, "y"', "3"), ("4", "", ""), ("6", "é", "z"), ("7", "8", "9")]
    assert sorted(r["line"] for r in bad.collect()) == ["2,only", "3,p,q,r", '5,"open']
    assert all(r["path"].endswith("f.csv") for r in bad.collect())
    (tmp_path / "in" / "f.csv").write_text('a,b\n1,"two\nlines"\n2\n', encoding="utf-8")
    good, bad = csvfiles.read_csv_with_rejects(spark, str(tmp_path / "in"), ["a", "b"], multi_line=True)
    assert [tuple(r) for r in good.collect()] == [("1", "two\nlines")] and [r["line"].strip() for r in bad.collect()] == ["2"]


def test_raw_files_by_pattern_and_empty_folders(spark, tmp_path):
    deep = tmp_path / "raw" / "deep"
    deep.mkdir(parents=True)
    contents = {"a.pdf": b"%PDF\x00\xff", "b.txt": b"no", "deep/c.pdf": b"x", "empty.pdf": b""}
    for name, data in contents.items():
        (tmp_path / "raw" / name).write_bytes(data)
    got = {r["name"]: r for r in tables.binary_file_scan(spark, str(tmp_path / "raw")).collect()}
    assert set(got) == {"a.pdf", "c.pdf"} and bytes(got["a.pdf"]["content"]) == contents["a.pdf"] and got["c.pdf"]["n_bytes"] == 1
    assert got["a.pdf"]["sha256"] == hashlib.sha256(contents["a.pdf"]).hexdigest() and got["a.pdf"]["modified"] is not None
    want = tables.binary_file_scan(spark, str(tmp_path / "raw")).schema.simpleString()
    for folder, glob in ((tmp_path / "raw", "*.doc"), (tmp_path / "nowhere", "*.pdf")):
        empty = tables.binary_file_scan(spark, str(folder), glob)
        assert empty.count() == 0 and empty.schema.simpleString() == want


def test_distinct_sketches_merge_over_levels_and_batches(spark):
    r = random.Random(2)
    rows = [(r.choice("ab"), r.choice(["x", "y", None]), r.randrange(6000)) for _ in range(20_000)] + [("c", "x", None)]
    df = spark.createDataFrame(rows, "a string, b string, v long").repartition(5)
    got = {(x["level"], x["a"], x["b"]): x["n_estimate"] for x in sketches.distinct_levels(df, [["a", "b"], ["a"], []], "v").collect()}
    def exact(keep):
        return len({v for a, b, v in rows if v is not None and keep(a, b)})
    for (level, a, b), n in got.items():
        want = exact(lambda x, y: (level == 2 or x == a) and (level > 0 or y == b))
        assert abs(n - want) <= max(1, want * sketches.hll_bound())
    assert len(got) == 7 + 3 + 1 and got[(1, "c", None)] == 0
    halves = [sketches.distinct_sketches(df.where(F.col("v") % 2 == i), ["a"], "v") for i in (0, 1)]
    both = sketches.merged_distinct(halves[0].unionByName(halves[1]), ["a"]).select("a", sketches.estimate().alias("n"))
    assert {x["a"]: x["n"] for x in both.collect() if x["a"] != "c"} == {a: got[(1, a, None)] for a in "ab"}


def test_quantile_sketches_merge_within_their_rank_error(spark):
    r = random.Random(3)
    rows = [(r.choice("ab"), r.randrange(7), r.gauss(0, 1) if r.random() < 0.7 else 1.5) for _ in range(30_000)] + [("n", 1, None)]
    df = spark.createDataFrame(rows, "g string, part int, v double")
    fine = sketches.quantile_sketches(df, ["g", "part"], "v")
    merged = sketches.merged_quantiles(fine, ["g"])
    for p in (0.1, 0.5, 0.9):
        for x in merged.select("g", sketches.quantile(p).alias("q")).collect():
            own = sorted(v for g, _, v in rows if g == x["g"] and v is not None)
            below, upto = sum(v < x["q"] for v in own), sum(v <= x["q"] for v in own)
            slack = len(own) * sketches.KLL_RANK_ERROR + 1
            assert below <= p * len(own) + slack and upto >= p * len(own) - slack
    assert {x["g"] for x in merged.collect()} == {"a", "b"}  # a group of nulls has no quantile


def test_json_and_appended_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b, \"q\"", None)], "t string, n int")
    sinks.write_json(df, str(tmp_path / "j"))
    assert sorted(map(str, spark.read.schema("t string, n int").json(str(tmp_path / "j")).collect())) == sorted(map(str, df.collect()))
    for _ in range(2):
        csvfiles.append_csv(csvfiles.as_text_columns(df), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in csvfiles.read_csv(spark, str(tmp_path / "c")).collect()) == sorted([("a", "1"), ('b, "q"', None)] * 2)
