"""Scalar helpers against the golden values of FIXTURES.md sections 4, 6, 7, 9."""

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.vectors import dot, l2_normalize


def col_values(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_fingerprint_code_and_segment(spark):
    vals = ["google/sunfish/sunfish:11/RQ3A", "a/xy/b", "a//b", "noslash", None]
    assert col_values(spark, vals, T.fingerprint_code) == ["ISH", "XY", "", "noslash", None]
    assert col_values(spark, vals, T.path_segment) == ["sunfish", "xy", "", "noslash", None]


def test_parse_list_strict(spark):
    vals = ["['a', 'b']", None, "", "   ", "[]", "[1,'z']", "x, y", "['a', 'it's']", "{'a':1}"]
    got = col_values(spark, vals, T.parse_list)
    assert got == [["a", "b"], [], [], [], [], ["1", "z"], ["x, y"], ["['a', 'it's']"], ["{'a':1}"]]


def test_parse_list_analyzer(spark):
    vals = ["['a', 'b']", None, "", "[]", "[1,'z']", "x, y", "a, b , ,c", "['a', 'it's']", "{'a':1}"]
    got = col_values(spark, vals, T.parse_list_analyzer)
    assert got == [["a", "b"], [], [], [], ["1", "z"], ["x", "y"], ["a", "b", "c"], [], ["{'a':1}"]]
    errs = col_values(spark, vals, T.list_parse_error)
    assert errs == [False, False, False, False, False, False, False, True, False]


def test_clean_empty_list(spark):
    assert col_values(spark, ["[]", "[ ]", "['a']", None], T.clean_empty_list) == ["", "", "['a']", None]


def test_list_items(spark):
    vals = ["TOPIC: Budget", "- Plans", "* abc", "2) Staffing", "plain", "  TOPIC:  Team TOPIC: x "]
    got = col_values(spark, vals, T.list_item)
    assert got == ["Budget", "Plans", None, "Staffing", None, "Team  x"]


def test_chunks(spark):
    got = col_values(spark, ["x" * 1500, ""], lambda c: F.transform(T.chunks(c), lambda s: F.length(s)))
    assert got == [[800, 800, 100], []]


def test_content_hash(spark):
    assert col_values(spark, ["abc"], T.content_hash) == [
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"]


def test_anagram_key(spark):
    keys = col_values(spark, ["listen", "silent", "rat", "car"], T.anagram_key)
    assert keys[0] == keys[1] and keys[2] != keys[3]


def test_brackets(spark):
    vals = ["()[]{}", "(]", "([)]", "{[]}", "", "("]
    assert col_values(spark, vals, T.brackets_balanced) == [True, False, False, True, True, False]


def test_trunc_div(spark):
    df = spark.createDataFrame([(7, -2), (-7, 2), (7, 0), (8, 3)], "a long, b long")
    assert [r[0] for r in df.select(T.trunc_div("a", "b")).collect()] == [-3, -3, None, 2]


def test_int_percent_and_short_label(spark):
    df = spark.createDataFrame([(12, 12, "com.google.android.camera")], "a long, b long, s string")
    r = df.select(T.int_percent("a", "b"), T.short_label("s")).first()
    assert r[0] == 100 and r[1] == "camera"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0])], "a array<double>, b array<double>")
    r = df.select(l2_normalize("a").alias("n"), dot("a", "b").alias("d")).first()
    assert r["n"] == [0.6, 0.8] and r["d"] == 11.0


def test_insight_sections(spark):
    txt = "**A**\nline one\n\n**B**\nx"
    got = col_values(spark, [txt], T.insight_sections)
    assert got == [["**A**\nline one", "**B**\nx"]]


def test_long_us_date(spark):
    import datetime
    df = spark.createDataFrame([(datetime.date(2026, 12, 2),)], "d date")
    assert df.select(T.long_us_date("d")).first()[0] == "December 2, 2026"
