"""Operators 11 to 13 against brute force, and the odd rows each must stand."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import bottom_k, collocations, periodic_runs
from tessera.llm.registry import op13_periodic_runs
from test_llm_operators import SF, WORD, frame, odd


# -- op 11 -----------------------------------------------------------------------

def brute_counts(rows, longest):
    """(lang, phrase) -> occurrences, by lists of words."""
    out = collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            out.update((lang or "und", " ".join(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
            out[lang or "und", ""] += len(w)
    return out


def talk(n, seed=1):
    r = random.Random(seed)
    vocabulary = ["a", "b", "New", "york", "c", "É", "x.y", "d\x0be", "f\tg", "zz!", "h"]
    return [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 30))), r.choice(["en", "fr", None, "und"])) for i in range(n)]


@pytest.mark.parametrize("limits", [(2048, 600_000), (3, 25)])
def test_phrase_counts_when_containers_burst_and_subtrees_spill(spark, monkeypatch, limits):
    rows = talk(300)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for longest in (2, 3, 4):
        counter = collocations.Counter(longest, limits[1])
        monkeypatch.setattr(collocations, "BURST", limits[0])
        got, spills = collections.Counter(), 0
        for _, text, lang in rows:
            found = collocations.tokens(text.encode())
            if found:
                counter.add(lang or "und", [*found, collocations.BREAK])
            while counter.full():
                spills += 1
                for where, phrase, n in counter.spill(limits[1] // 2):
                    names = list(phrase) if isinstance(phrase, list) else phrase.to_pylist()
                    assert names == sorted(names, key=lambda x: [w.encode() for w in x.split(" ")])  # a run is sorted
                    got.update(dict(zip([(where, x) for x in names], map(int, n), strict=True)))
        for where, phrase, n in counter.spill(0):
            got.update(dict(zip([(where, x) for x in (phrase if isinstance(phrase, list) else phrase.to_pylist())], map(int, n), strict=True)))
        want = {k: v for k, v in brute_counts([(x, t) for _, t, x in rows], longest).items() if v}
        assert dict(got) == want and counter.entries == 0 and (spills > 3) == (limits[1] < 100)
        if longest == 3 and limits[1] > 100:
            assert {(r["lang"], r["phrase"]): r["f"] for r in collocations.phrase_counts(df, longest).collect()} == want


def test_bit_table_of_any_size_loses_nothing(spark):
    rows = talk(500, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = {k: v for k, v in brute_counts([(x, t) for _, t, x in rows], 3).items() if v >= 6}
    for bits in (7, 12, 20):
        got = collocations.phrase_counts(df, 3, 6, max_entries=200, filter_bits=bits)
        assert {(r["lang"], r["phrase"]): r["f"] for r in got.collect()} == want and len(want) > 30


@pytest.mark.parametrize("min_count", [2, 10, 255, 256, 1500])
def test_packed_hashes_keep_every_count(min_count):
    r = np.random.default_rng(min_count)
    h = np.unique(r.integers(0, 1 << 40, 50_000).astype(np.uint64))
    n = r.integers(1, 2000, len(h))
    rows = collocations._packed(h, n, min_count)
    back, counts = collocations._summed(*([x] for x in collocations._unpacked(rows)))
    assert (back == h).all() and (counts == np.minimum(n, min_count)).all()
    parts = [rows.slice(i, 90) for i in range(0, rows.num_rows, 90)] + [rows.slice(0, 0)]
    often = np.concatenate([b.column(0).to_numpy() for b in collocations._often(min_count)(parts)]).view(np.uint64)
    assert (often == h[n >= min_count]).all()


def test_collocations_match_sql(spark, tmp_path):
    rows = talk(400, 7) + [(i, "hot dog stand, hot dog", "en") for i in range(30)] + [(None, None, None), (7, "", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = con.execute(collocations.SQL).fetchall()
    assert len(want) > 50 and sorted(map(tuple, collocations.collocations(df).collect())) == sorted(want)


def test_collocations_longer_phrases_and_large_numbers(spark):
    d = frame(spark, [(i, "one two three four", ) for i in range(12)])
    got = {r["phrase"]: r["score"] for r in collocations.collocations(d, max_words=4).collect()}
    assert got == {"one two three four": 1_000_000}  # all others are contained in it
    assert {r["phrase"] for r in collocations.collocations(d, max_words=4, contained_percent=101).collect()} == {
        "one two", "two three", "three four", "one two three", "two three four", "one two three four"}


def test_collocations_odd_rows(spark):
    got = collocations.collocations(odd(spark), min_count=2).collect()
    assert ("en", "one two three four five six") not in {(r["lang"], r["phrase"]) for r in got}
    assert {r["n"] for r in got if r["lang"] == "en"} == {18} and all(r["rank"] > 0 for r in got)
    assert {r["lang"] for r in got} <= {"en", "fr", "und"}
    assert collocations.collocations(odd(spark).where("false")).collect() == []


# -- op 12 -----------------------------------------------------------------------

def brute_near(rows, width, percent):
    sets = []
    for i, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        sets.append((i, {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[top(k)] = min(least.get(top(k), i), i)
    return {i: (len(s), least[top(k)]) for k, (i, s) in enumerate(sets)}


def near_texts(seed):
    """Bases with chains of ever more distant copies, a passage that many share, and rows of their own."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(8):
        w = [word() for _ in range(r.choice([4, 8, 40, 90, 400]))]
        for _ in range(12):
            out.append(" ".join(w))
            w = list(w)
            for _ in range(max(1, len(w) // 90)):
                w[r.randrange(len(w))] = word()
    out += [" ".join([word() for _ in range(r.randint(0, 50))] + passage) for _ in range(40)]
    out += ["", None, "Solo", "solo"]
    r.shuffle(out)
    return list(enumerate(out, 100))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed):
    rows = near_texts(seed)
    want = brute_near(rows, 5, 85)
    assert len({c for _, c in want.values()}) < len(rows) - 20
    got = bottom_k.near_duplicates(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_other_parameters(spark):
    rows = near_texts(3)
    got = bottom_k.near_duplicates(frame(spark, rows), percent=70, width=3, k_first=64, k=128).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_near(rows, 3, 70)


def test_least_shared_is_safe():
    r = np.random.default_rng(5)
    for k, percent in ((32, 85), (256, 85), (64, 70)):
        t = bottom_k.least_shared(k, percent)
        union = 1000
        seen = r.hypergeometric(int(union * percent / 100), union - int(union * percent / 100), k, 200_000)
        assert 0 < t < k * percent / 100 and seen.min() >= t
    assert bottom_k.least_shared(8, 50) == 0  # a sketch too small to settle anything


def test_union_sketch_leaves_distant_pairs():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 1 << 62, 4000).astype(np.uint64))
    least = bottom_k.least_shared(256, 85)
    for share, linked in ((0.95, True), (0.5, False)):
        b = np.where(r.random(len(a)) < share, a, a ^ np.uint64(1))
        assert bottom_k.links(a, np.unique(b), 256, 85, least) is linked


def test_near_duplicates_odd_rows(spark):
    got = collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in bottom_k.near_duplicates(odd(spark)).collect())
    assert got == {(1, 1, True): 2, (2, 1, False): 1, (None, 1, False): 1, (3, 3, True): 1, (4, 4, True): 1, (5, 5, True): 1, (6, 6, True): 1,
                   (7, 7, True): 2, (8, 8, True): 1}
    assert bottom_k.near_duplicates(odd(spark).where("false")).collect() == []


# -- op 13 -----------------------------------------------------------------------

def brute_runs(w, exponent=4, min_length=6):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        s = 0
        while s + q < len(w):
            e = s + q
            while e < len(w) and w[e] == w[e - q]:
                e += 1
            if e - s >= max(min_length, exponent * q):
                out.setdefault((s, e), q)
            s = max(e - q, s) + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda x: (x[0], x[2]))


def periodic_texts(n):
    r = random.Random(3)
    for k in range(n):
        size, letters = r.randint(0, 160), r.choice([1, 2, 2, 3, 50])
        w = [str(r.randrange(letters)) for _ in range(size)]
        for _ in range(r.randrange(4) if size > 4 else 0):
            a, p = r.randrange(size), r.randint(1, size // 5 + 1)
            for i in range(a, min(size, a + r.randint(1, size))):
                w[i] = w[a + (i - a) % p]
        if k % 7 == 0:  # periods inside periods
            u = [str(r.randrange(3)) for _ in range(r.randint(1, 4))] * r.randint(3, 9) + ["z"] * r.randint(0, 5)
            w = (u * r.randint(3, 7))[:r.randint(1, 500)]
        yield " ".join(w)


def test_runs_match_brute_force(spark):
    texts = list(periodic_texts(2500))
    seen = 0
    for t, (n, runs, kept) in zip(texts, periodic_runs.runs_of(texts), strict=True):
        w = t.split()
        assert n == len(w) and runs == brute_runs(w), t
        dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
        assert kept.decode() == " ".join(x for i, x in enumerate(w) if i not in dropped)
        seen += len(runs)
    assert seen > 1000


def test_registered_runs_match_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op13_periodic_runs(spark, SF).collect()
    assert len(got) == len(docs)
    sha, some = lambda x: hashlib.sha256(x.encode()).hexdigest(), 0
    for r in got:
        w = WORD.findall(docs[r["doc_id"]] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(w)
        some += len(runs)
        dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(x for i, x in enumerate(w) if i not in dropped))
    assert some > 3


def test_runs_odd_rows(spark):
    got = collections.Counter((r["doc_id"], r["n_words"], len(r["runs"])) for r in periodic_runs.periodic_runs(odd(spark)).collect())
    assert got == {(1, 6, 0): 2, (2, 6, 0): 1, (None, 6, 0): 1, (3, 0, 0): 1, (4, 0, 0): 1, (5, 0, 0): 1, (6, 60_000, 1): 1, (7, 5, 0): 1, (7, 6, 0): 1, (8, 2, 0): 1}
    assert periodic_runs.periodic_runs(odd(spark).where("false")).collect() == []
    long = periodic_runs.periodic_runs(odd(spark)).where("doc_id = 6").collect()[0]
    assert [tuple(r) for r in long["runs"]] == [(0, 60_000, 977)] and long["collapsed"].count(" ") == 976
    one = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(spark.createDataFrame([(3, None, "x")], "doc_id long, text string, w string")))).collect()[0]
    assert one["n_runs"] == 0 and one["start"] is None and one["runs_sha256"] == hashlib.sha256(b"").hexdigest() == one["collapsed_sha256"]
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(odd(spark), exponent=3)
