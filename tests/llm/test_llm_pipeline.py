"""The pipeline's stages against brute force, each on its own input."""

import re

import pytest

import corpus_pipeline as P
from tessera.llm import line_templates
from test_llm_operators import SF, WORD, brute_components, brute_lines


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "12 -- 34", None, None, 8), (9003, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    out = [docs]
    for name, f in P.STAGES:
        path = str(folder / name)
        f(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "mixing", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns and df.dtypes == stages[0].dtypes


def test_language_drops_texts_without_letters(stages):
    want = {i for i, t in texts(stages[0]) if t and any(c.isalpha() for c in t)}
    assert {i for i, _ in texts(stages[1])} == want


def test_lines_match_brute_force(stages):
    before = texts(stages[1])
    want = {i: t for i, t in brute_lines(before, **line_templates.WHOLE_JOB).items() if WORD.search(t)}
    assert dict(texts(stages[2])) == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_document_of_each_group_stays(stages):
    want = {i for i, (_, c) in brute_components(texts(stages[2]), **P.NEAR).items() if i == c}
    assert {i for i, _ in texts(stages[3])} == want


def test_mixing_keeps_whole_documents(stages):
    before, after = dict(texts(stages[3])), texts(stages[4])
    assert 0 < len(after) <= len(before) and all(before[i] == t for i, t in after) and len({i for i, _ in after}) == len(after)


def test_packing_holds_every_document(stages):
    rows = stages[5].collect()
    ends = {}
    for r in rows:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {r["doc_id"] for r in rows} == {i for i, _ in texts(stages[4])}
    for own in ends.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048


def test_run_gives_the_last_stage(spark, stages):
    assert re.match(r"doc_id|piece", P.run(spark, SF).columns[0])
    assert P.run(spark, SF).columns == stages[5].columns
