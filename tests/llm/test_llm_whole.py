"""Cases in which an operator or a stage once did less than the whole job."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline as P
from tessera.llm import best_fit_packing, html_text, jaccard_join, registry, token_ids
from tessera.llm.common import BATCH_ROWS, LIGHT_ROWS, Tables, tokenizer_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def saved(spark, folder, rows):
    """A data folder whose documents are ``rows``."""
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# -- op 6 and the lines stage -------------------------------------------------------

def test_short_lines_that_repeat_go(spark, tmp_path):
    own = ["The harbour was quiet in winter", "Nobody had asked for another bridge", "Seven ships left before the storm"]
    rows = [(1, f"All rights reserved.\n{own[0]}\nPage 1\n東京都の天気は晴れです"), (2, f"{own[1]}\nAll  rights\treserved.\nPage 2\n東京都の天気は晴れです"),
            (3, f"Page 1\n{own[2]}\n-")]
    want = {1: rows[0][1], 2: f"{own[1]}\nPage 2", 3: f"{own[2]}\n-"}
    got = {r["doc_id"]: r["text"] for r in registry.op6_line_templates(spark, saved(spark, tmp_path / "d", rows)).collect()}
    assert got == want
    assert {r["doc_id"]: r["text"] for r in P.lines(spark, frame(spark, rows), "").collect()} == want


def test_documents_with_lines_of_their_own_stay(spark):
    licence = "This text is free for all to use"
    rows = [(1, f"{licence}\nOne"), (2, f"{licence}\nRoses are red\nviolets blue"), (3, f"{licence}\n\n"), (4, f"{licence}\nOne")]
    got = {r["doc_id"]: r["text"] for r in P.lines(spark, frame(spark, rows), "").collect()}
    assert got == {1: rows[0][1], 2: "Roses are red\nviolets blue"}


def test_rows_of_fields_and_two_alike_stay(spark, tmp_path):
    rows = [(1, "2019 12 30 44 51\nHe went to the store\nA copy of this line is here"), (2, "2020 17 22 9 80\nHe went to the park\nA copy of this line is here"),
            (3, "2019 12 30 44 51\nShe sold 7 of the old blue chairs today"), (4, "She sold 8 of the old blue chairs today")]
    rows += [(10 + k, f"user u{k} logged in from host a at {k}:00") for k in range(5)]
    want = dict(rows) | {2: "2020 17 22 9 80\nHe went to the park", 3: "She sold 7 of the old blue chairs today"} | {10 + k: "" for k in range(1, 5)}
    got = {r["doc_id"]: r["text"] for r in registry.op6_line_templates(spark, saved(spark, tmp_path / "d", rows)).collect()}
    assert got == want


# -- near_duplicates stage ----------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_near(rows, width=5, percent=80):
    """The least id of each component, links by ``width`` words and ``percent``."""
    s, up = {}, {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(s)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i for i in ids if root(i) == i}


def test_near_copies_of_the_stage_are_five_words_and_80(spark):
    r, rows = random.Random(4), []
    for k in range(30):
        base = [f"w{r.randint(0, 400)}" for _ in range(r.choice([3, 40, 100, 150]))]
        for c in range(3):
            w = list(base)
            for _ in range(c):
                w[r.randrange(len(w))] = "other"
            rows.append((10 * k + c, " ".join(w)))
    want = brute_near(rows)
    assert want != brute_near(rows, 3, 90)
    got = [x["doc_id"] for x in P.near_duplicates(spark, frame(spark, rows), "").collect()]
    assert sorted(got) == sorted(want)


def test_null_ids_and_repeated_rows_leave_one_of_each_group(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcd")
    rows = [(None, a), (None, b), (3, b), (5, c), (5, c), (6, c), (7, a.upper() + " x"), (8, d), (8, "a text of its own here"), (None, "only null"),
            (None, "only null"), (9, "")]
    got = [(r["doc_id"], r["text"]) for r in P.near_duplicates(spark, frame(spark, rows), "").collect()]
    assert collections.Counter(got) == collections.Counter([(7, rows[6][1]), (3, b), (5, c), (8, d), (8, rows[8][1]), (None, "only null"), (9, "")])


# -- op 2 and the mixing stage ------------------------------------------------------

def test_one_rare_cell_does_not_throttle_all(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(99_999, "!! " + "word " * 29, "xx", "odd0", 148)], DOCS)
    n, base = docs.count(), P.mixing(spark, docs, SF).count()
    got = P.mixing(spark, docs.unionByName(odd), SF)
    assert base > 0.7 * n and got.count() > 0.7 * n and got.where("doc_id = 99999").count() == 1
    docs.unionByName(odd).write.parquet(f"{tmp_path}/d/documents.parquet")
    rows = registry.op2_source_mixing(spark, f"{tmp_path}/d").collect()
    assert sum(r["kept"] for r in rows) > 0.7 * n
    tokens, wanted, taken = collections.Counter(), collections.Counter(), 0
    for r in rows:
        assert r["repeats"] >= r["kept"] and (r["repeats"] > 0) == r["kept"]
        assert abs(r["repeats"] - r["weight"]) < 1 + 1e-6
        tokens[r["mix_source"]] += r["mix_tokens"]
        wanted[r["mix_source"]] += r["mix_tokens"] * r["weight"]
        taken += r["mix_tokens"] * r["repeats"]
    z, whole = sum(v ** 0.7 for v in tokens.values()), sum(tokens.values())
    assert all(abs(wanted[v] / whole - tokens[v] ** 0.7 / z) < 1e-3 for v in tokens)
    assert abs(taken / whole - 1) < 0.2


# -- op 7 ---------------------------------------------------------------------------

def test_wrappers_named_for_layout_keep_their_page():
    text = "<h1>Title</h1><p>A long passage of text that makes up the page.</p>"
    want = "Title\nA long passage of text that makes up the page."
    for page in (f"<body class='no-sidebar'>{text}</body>", f"<div class='content with-sidebar'>{text}</div>",
                 f"<article class='post comments-open'>{text}</article>", f"<div id='page' class='site has-menu'>{text}</div>",
                 f"<form id=f>{text}</form>", f"<div class='menu'><main>{text}</main></div>",
                 f"<article>{text.replace('<h1>Title</h1>', '<header><h1>Title</h1></header>')}</article>",
                 f"<article>{text.replace('<h1>Title</h1>', '<div class=article-header>Title</div>')}</article>"):
        assert html_text.main_text(page) == want, page
    long = "much " * 99
    for other in (f"<nav>{long}</nav>", f"<div class='comments-area'><p>{long}</p></div>", "<div class='sidebar-left'>x</div>", "<header>Site</header>",
                  "<div class='widget ad'>x</div>", "<aside><article>card</article></aside>", "<div id=menu>x</div>"):
        assert html_text.main_text(f"<body>{other}<article>{text}</article></body>") == want, other


def test_template_without_article_keeps_whole_article(spark):
    def page(k, h1):
        return (f"<html><body><div class=top>Site name</div><ul class=nav><li><a href=x>Home</a></ul><div class=content><h1>{h1}</h1><p>First part {k} of a text<p>"
                f"second part {k}<blockquote>A word {k}</blockquote><p>third and much longer part {k} of the text</div><p class=foot>fine print</p></body></html>")
    rows = [(100 * g + k, f"http://h{g}.example/{k}", page(k, "Title" if g == 0 else f"Title {k}")) for g in (0, 1) for k in range(5)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, _ in rows:
        k = i % 100
        assert got[i] == "\n".join(["Title" if i < 100 else f"Title {k}", f"First part {k} of a text", f"second part {k}", f"A word {k}",
                                    f"third and much longer part {k} of the text"])


def test_small_hosts_and_every_kind_of_page_have_a_template(spark):
    def page(k, kind):
        body = f"<div class=content><p>First part {k} of the text<p>second part {k} and more words</div>"
        return (f"<html><body><div class=top>Site name</div>{body}<div class=fine>fine print</div></body></html>" if kind == 0 else
                f"<html><body><section class=lead>Shop name</section><section class=story>{body}</section><section class=end>all rights</section></body></html>")
    rows = [(100 * n + k, f"http://h{n}.example/{k}", page(k, 0)) for n in (2, 4, 5) for k in range(n)]  # one rule for hosts of any size
    rows += [(1000 + k, "http://two.example/", page(k, k % 3 == 0)) for k in range(9)]  # two kinds on one host
    # all of the article hangs on tags that are not on every page
    rows += [(2000 + k, "http://odd.example/", f"<html><body><div class=top>Site</div><div class=body><h{k % 3 + 1}>Head {k}</h{k % 3 + 1}>"
              f"<div class={'xyz'[k % 3]}>Part {k} of a text</div></div><div class=fine>fine print</div></body></html>") for k in range(6)]
    rows += [(3000 + k, "http://same.example/", page(1, 0)) for k in range(3)]  # copies of one page
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        k = i % 100
        want = f"First part {k} of the text\nsecond part {k} and more words" if i < 2000 else f"Head {k}\nPart {k} of a text" if i < 3000 else (
            "Site name\nFirst part 1 of the text\nsecond part 1 and more words\nfine print")
        assert got[i] == want, i


def texts_of(spark, rows):
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return {r["url"]: r["text"] for r in got}


def test_classes_nested_in_a_slot_say_what_of_it_is_content(spark):
    def page(k):
        box = "<div class=box><h4>Stay informed</h4><p>Leave your address with us</p></div>" if k % 2 else ""
        links = "".join(f"<div class=item><h5><a href=x>Other page {i}</a></h5></div>" for i in range(k, 2 * k % 5 + k + 1))
        notes = "".join(f"<div class=note><h5>Note {k}.{i}</h5><p>Its text {k * i}</p></div>" for i in range(k % 3))
        return (f"<html><body><div class=top>Site name</div><div class=body><p>First part {k} of a text</p>{box}<p>second part {k}</p>{links}{notes}</div>"
                f"<div class=fine>fine print</div></body></html>")
    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(12)]
    notes = {k: [x for i in range(k % 3) for x in (f"Note {k}.{i}", f"Its text {k * i}")] for k in range(12)}
    assert texts_of(spark, rows) == {u: "\n".join([f"First part {k} of a text", f"second part {k}", *notes[k]]) for k, u, _ in rows}


def test_kinds_of_pages_under_half_of_a_host_have_a_nested_class(spark):
    def page(k):
        x, text = "abc"[k % 3], f"<h2>Head {k}</h2>Part {k} of a text with many words in it<p>and part {k} of more"
        return (f"<html><body><section class={x}><i>Shop name</i></section><div class={x}>{text}</div><section class={x}z>all rights reserved</section>"
                f"</body></html>")
    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(12)]
    assert texts_of(spark, rows) == {u: f"Head {k}\nPart {k} of a text with many words in it\nand part {k} of more" for k, u, _ in rows}


def test_hosts_without_a_class_on_half_their_pages_have_a_template(spark):
    def page(k):
        x = "abc"[k % 3]
        return f"<div class={x}t><b>Shop name</b></div><div class={x}><h2>Head {k}</h2>Part {k} of a text with many words</div><div class={x}z>all rights</div>"
    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(12)]
    rows.append((12, "http://h.example/12", "<div class=dt><b>Shop name</b></div><article>Its <a href=x>own</a></article>"))
    want = {u: f"Head {k}\nPart {k} of a text with many words" if k < 12 else "Its own" for k, u, _ in rows}
    assert texts_of(spark, rows) == want


def test_one_text_on_two_pages_is_no_nested_template(spark):
    def page(k):
        k, table = k % 11, f"<table><caption>Table</caption><thead><tr><th>All of the {k % 11} numbers that were counted in it</th></tr></thead></table>"
        return (f"<html><body><div class=top>Site name</div><div class=body><p>Part {k} of a text with many words in it</p>{table if k < 1 else ''}</div><div class=fine>fine print</div>"
                f"</body></html>")
    rows = [(k, f"http://h.example/{k}", page(k) + f"<!-- {k} -->") for k in range(12)]  # the first one comes again as the last
    got = texts_of(spark, rows)
    assert got["http://h.example/0"] == got["http://h.example/11"] == "Part 0 of a text with many words in it\nTable\nAll of the 0 numbers that were counted in it"
    assert got["http://h.example/5"] == "Part 5 of a text with many words in it"


def test_a_class_in_no_common_order_leaves_those_tokens_that_have_one(spark):
    def page(k):
        a, b = f"<div class=ann><h3>Ann {k}</h3>says {k}</div>", f"<div class=bob><h4>Bob {k}</h4>says {k * k}</div>"
        return (f"<html><body><div class=top>Site name</div><div class=body>Part {k} of a text{a + b if k % 2 else b + a}</div><div class=fine>fine print</div>"
                f"</body></html>")
    rows = [(k, f"http://h.example/{k}", page(k)) for k in range(8)]
    a, b = {k: f"Ann {k}\nsays {k}" for k in range(8)}, {k: f"Bob {k}\nsays {k * k}" for k in range(8)}
    assert texts_of(spark, rows) == {u: "\n".join([f"Part {k} of a text", *((a[k], b[k]) if k % 2 else (b[k], a[k]))]) for k, u, _ in rows}


def test_pages_without_an_id_or_with_one_id_have_a_template(spark):
    def page(k, x):
        return (f"<html><body><div class={x}t>Site name</div><div class={x}>Part {k} of a text</div><div class={x}f>fine print</div></body></html>")
    for i in (None, 7):
        rows = [(i, f"http://h.example/{k}", page(k, "ab"[k % 2])) for k in range(8)]
        assert texts_of(spark, rows) == {u: f"Part {k} of a text" for k, (_, u, _) in enumerate(rows)}


# -- op 3 and op 5 ------------------------------------------------------------------

def test_listed_characters_cut_as_the_rule_by_class():
    rules = {"word": r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+",
             "byte": r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"}
    plain = [c for c in map(chr, range(0x3000)) if not token_ids._OTHER.search(c)]
    rng = random.Random(3)
    texts = ["".join(plain), "".join(f"a{c}1{c} {c}{c}'s{c}\n" for c in plain)]
    texts += ["".join(rng.choices([*plain, *" \n\t'ssltdmrvexX0_-"], k=200)) for _ in range(300)]
    for kind, rule in rules.items():
        own, want = re.compile(token_ids.splits()[kind]).findall, re.compile(rule).findall
        for t in texts:
            t = t.lower() if kind == "word" else t
            assert own(t) == want(t), (kind, t)


def test_texts_cut_together_have_the_ids_of_the_library():
    rng = random.Random(5)
    plain = [c for c in map(chr, range(0x2100)) if not token_ids._OTHER.search(c)]
    alphabets = plain, [c for c in plain if c < "\u0100"], [*"ab   \n\t'!?12", "'s", "'re", "don't", " 've", "''s", "'S", " 'M", ".'t", "<|", "\0"]
    texts = ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(0, 40))) for _ in range(2000)] + ["Ʈrash Ⱥ ȺȾ", None, "", " "]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        for size in (50, 1_000_000):
            enc = token_ids.Encoder(tokenizer_path(name), size)
            for lo in range(0, len(texts), 200):
                for t, ids in zip(texts[lo:lo + 200], enc.encode(texts[lo:lo + 200]), strict=True):
                    assert np.frombuffer(ids, "<u4").tolist() == enc.library.encode(t or "", add_special_tokens=False).ids, (name, t)


def test_frequent_pre_tokens_met_late_stay_known():
    enc, asked = token_ids.Encoder(tokenizer_path("word_bpe_49k.json"), 100), []
    learn = enc._learn
    enc._learn = lambda new: (asked.extend(new), learn(new))[1]
    name = lambda k: "".join(chr(97 + int(d)) for d in str(k))
    enc.encode([" ".join("x" + name(k) for k in range(90))])  # once each, and first
    for k in range(40):  # ten words in every text, beside 20 new ones
        enc.encode([" ".join(["often" + name(j) for j in range(10)] + ["y" + name(20 * k + j) for j in range(20)])])
    own = [p for p in asked if p.startswith((b"often", "often")[isinstance(p, str)])]
    assert len(own) == 10 and len(enc.known) <= 130


# -- memory of a worker -------------------------------------------------------------

def test_counters_of_a_scan_are_added_in_place(monkeypatch):
    import pyspark
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    rng = random.Random(9)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(60)) for _ in range(200)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(201), pa.int64()), pa.array(texts, pa.string()), pa.array(range(201), pa.int64())], names=["id", "text", "th"])
    jaccard_join._powers(1 << 16)
    tracemalloc.start()
    out = list(jaccard_join._scan(3)([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    counts = b"".join(b"".join(x for x in b.column("counts").to_pylist() if x) for b in out)
    assert np.frombuffer(counts, np.uint8).sum() == sum(len(s) for s in jaccard_join.shingle_sets(texts))
    assert most < 3 * 4 << jaccard_join.SKETCH_BITS  # the counters, and less than twice as much beside them


def test_kept_tables_hand_python_few_rows_at_a_time(spark):
    before = spark.conf.get(BATCH_ROWS)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
    tables = Tables(spark)
    out = tables.keep(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"))
    found = [r["n"] for r in out.collect()]
    assert sum(found) == 5000 and max(found) <= LIGHT_ROWS and spark.conf.get(BATCH_ROWS) == before
    tables.drop(out)


def test_encoders_go_when_all_texts_are_cut():
    token_ids.encoder(tokenizer_path("byte_bpe_50k.json")).encode(["some text"])
    list(best_fit_packing._placed([], 2048, 0, ["length"])(iter([])))
    assert token_ids.encoder.cache_info().currsize == 0
