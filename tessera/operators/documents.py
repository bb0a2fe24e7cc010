"""Document jobs.

The reference loops over documents and topics on threads; here rows flow
``documents -> lines / chunks -> facts / scores`` and tasks replace threads.
Small query-side inputs (topic list, query vectors, query terms) are joined
as broadcasts only after their size is checked.
"""

from __future__ import annotations

import hashlib
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import (CHUNK_SIZE, CHUNK_STEP, FACT_PREFIX, MIN_FACT_LENGTH, NONE_MARK, TOPIC_PREFIX,
                                    chunk_starts, chunks, list_item, strip)
from tessera.functions.vectors import dot, l2_normalize
from tessera.operators import segmented, vector_index
from tessera.operators.containment import first_containing
from tessera.operators.profiles import top_k
from tessera.session import broadcast_if_light, shared
from tessera.sources import sinks

# --- fixed values of the document jobs ---------------------------------------------
PAGE_SEPARATOR = "\n\n"
CHUNK_SEPARATOR = "\n\n"
TOP_CHUNKS = 15
EMBED_DIM = 64
EMBED_BATCH = 16
# bytes up to which the query terms are broadcast
QUERY_TERM_BYTES = 64 << 20
# ------------------------------------------------------------------------------


def assemble_pages(pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text") -> DataFrame:
    """One document per ``doc`` from its pages in order, joined by a blank line.

    The collected list holds one document's pages, which is the output row itself.
    """
    g = pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t")))).alias("_pages"))
    return g.select(doc, "n_pages", F.array_join(F.transform("_pages", lambda x: x["t"]), PAGE_SEPARATOR).alias("text"))


def chunk_rows(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, chunk_idx, chunk, n_chunks) -- 800 characters every 700."""
    c = docs.select(doc, chunks(text).alias("_c"))
    return c.select(doc, F.size("_c").alias("n_chunks"), F.posexplode("_c").alias("chunk_idx", "chunk"))


def term_counts(df: DataFrame, ids: list[str], text: str) -> DataFrame:
    """Lower-cased whitespace tokens and their counts per ``ids``."""
    t = df.select(*ids, F.explode(F.split(F.lower(F.col(text)), r"\s+")).alias("term")).where(F.col("term") != "")
    return t.groupBy(*ids, "term").agg(F.count(F.lit(1)).alias("tf"))


def relevant_text(docs: DataFrame, query_terms: DataFrame, doc: str = "doc_id", text: str = "text",
                  top: int = TOP_CHUNKS) -> DataFrame:
    """T01 + F09: keep a document's best ``top`` chunks, back in position order.

    Score = cosine of whitespace-token counts between the chunk and the query
    bag (``term, qtf``), from exact integer sums, so ties are real ties; ties
    go to the lower chunk index.  Every document takes the same path; only
    scores and chunk indices move: the kept indices (at most ``top`` per
    document) are joined back to the document once and the text is rebuilt from
    the original with a lambda, so document text is shuffled once, not per step.
    A text without chunks stays as it is.
    """
    n_chunks = F.size(chunk_starts(text))
    big = docs.select(doc, text, n_chunks.alias("n_chunks"))
    ch = docs.select(doc, F.posexplode(chunks(text)).alias("chunk_idx", "chunk"))
    toks = ch.select(doc, "chunk_idx", F.sort_array(F.array_remove(F.split(F.lower("chunk"), r"\s+"), "")).alias("_t"))
    # |chunk|^2 = sum of squared term counts, row-local: runs of the sorted tokens
    zero = F.lit(0).cast("bigint")
    runs = F.aggregate(
        "_t", F.struct(F.lit(None).cast("string").alias("p"), zero.alias("run"), zero.alias("acc")),
        lambda st, x: F.when(x == st["p"], F.struct(x.alias("p"), (st["run"] + 1).alias("run"), st["acc"].alias("acc")))
        .otherwise(F.struct(x.alias("p"), F.lit(1).cast("bigint").alias("run"), (st["acc"] + st["run"] * st["run"]).alias("acc"))),
        lambda st: st["acc"] + st["run"] * st["run"])
    # chunk . query = sum of the query weight over the chunk's token occurrences:
    # tokens meet the (checked, broadcast) query terms, and the per-chunk sum is
    # combined map-side -- every token of a chunk is in that chunk's task, so one
    # row per chunk is shuffled, never the tokens.  |chunk|^2 travels with them,
    # and a chunk without tokens or terms keeps its row: one pass over the text
    query_terms = shared(query_terms)   # tokenised once
    q = broadcast_if_light(query_terms.select(F.col("term").alias("q_term"), "qtf"), F.length("q_term") * 4, QUERY_TERM_BYTES)
    q2 = query_terms.agg(F.sum(F.col("qtf") * F.col("qtf"))).scalar()   # scalar subquery
    each = toks.select(doc, "chunk_idx", F.when(F.size("_t") > 0, runs).alias("c2"), "_t").select(
        doc, "chunk_idx", "c2", F.explode_outer("_t").alias("term"))
    all_idx = each.join(q, F.col("term") == F.col("q_term"), "left").groupBy(doc, "chunk_idx").agg(
        F.max("c2").alias("c2"), F.coalesce(F.sum("qtf"), zero).alias("dot"))
    score = F.coalesce(F.try_divide(F.col("dot").cast("double"), F.sqrt((F.col("c2") * q2).cast("double"))), F.lit(0.0))
    best = top_k(all_idx.withColumn("score", score), [doc], [F.desc("score"), F.asc("chunk_idx")], top, "chunk_rank")
    kept = best.groupBy(doc).agg(F.array_sort(F.collect_list("chunk_idx")).alias("_idx"))
    t = F.col(text)
    rebuilt = F.array_join(F.transform("_idx", lambda i: F.substring(t, i * CHUNK_STEP + 1, CHUNK_SIZE)), CHUNK_SEPARATOR)
    return big.join(kept, doc, "left").select(
        doc, F.col("n_chunks").cast("int").alias("n_chunks"), F.coalesce(F.size("_idx"), F.lit(0)).alias("n_kept"),
        F.when(F.col("_idx").isNull(), t).otherwise(rebuilt).alias(text))


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """T02 + J06 + F10 + F11 + W11: the ``k`` rows with the highest dot product
    against each (L2-normalised) query vector; ties to the lower ``vec_id``.

    The vectors are indexed by pivots and only cells whose bound reaches the
    k-th score are scored (:mod:`tessera.operators.vector_index`).
    """
    return vector_index.search(vector_index.build(vectors), queries, k)


def list_items(lines: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """F06 + F22: (doc_id, line_no, item) for every list-item line."""
    return lines.select("doc_id", "line_no", list_item("line", prefix).alias("item")).where(F.col("item").isNotNull())


def consolidate_topics(items: DataFrame, max_topics: int | None = None) -> DataFrame:
    """T03 = W09 + K05: first of each case-insensitive, trimmed duplicate in
    (doc, line) order -> (topic_pos, topic).  ``max_topics`` (off by default) keeps the first ones."""
    first = items.groupBy(F.lower(F.trim("item")).alias("_key")).agg(
        F.min(F.struct("doc_id", "line_no", "item")).alias("f"))
    numbered = segmented.ranked(first.select("f.*"), [], ["doc_id", "line_no"], out="_n", method="row_number")
    out = numbered.select((F.col("_n") - 1).alias("topic_pos"), F.col("item").alias("topic"))
    return out if max_topics is None else out.where(F.col("topic_pos") < max_topics)


def section_facts(lines: DataFrame, topics: DataFrame) -> DataFrame:
    """F07 = W04 + J05 + P13: facts under the current section header.

    A 'TOPIC:' line opens a section and is matched to the first topic (by
    position) that contains it or is contained in it, case-insensitively; an
    unmatched header closes the section.  'FACT:' lines inside a matched
    section are kept when longer than ten characters and not 'NONE', with a
    '[doc] ' prefix.  The header in force is a running max of header line
    numbers (skew-safe), then one equi-join to the matched headers.
    """
    sl = strip("line")
    after = lambda prefix: strip(F.replace(sl, F.lit(prefix), F.lit("")))
    is_header, fact = sl.startswith(TOPIC_PREFIX), after(FACT_PREFIX)
    is_fact = sl.startswith(FACT_PREFIX) & (F.length(fact) > MIN_FACT_LENGTH) & (F.upper(fact) != NONE_MARK)
    # headers and facts alone go on; the slices are written once and read by both
    s = lines.where(is_header | is_fact).select(
        "doc_id", "line_no", F.when(is_header, F.col("line_no")).alias("_hdr"), F.when(is_header, F.lower(after(TOPIC_PREFIX))).otherwise(fact).alias("body"))
    s = segmented.slice_groups(s, ["doc_id"], ["line_no"])
    headers = s.where(F.col("_hdr").isNotNull()).select("doc_id", F.col("line_no").alias("h_line"), F.col("body").alias("name"))
    # each *distinct* header name meets the topics that share its rarest gram, or whose rarest gram it holds
    first = first_containing(headers.select("name"), topics)
    matched = headers.join(first, "name").select("doc_id", "h_line", "topic")
    cur = segmented.running(s, ["doc_id"], ["line_no"], "_hdr", out="h_line", fn="max", inclusive=True)
    facts = cur.where(F.col("_hdr").isNull() & F.col("h_line").isNotNull()).select("doc_id", "line_no", "h_line", F.col("body").alias("fact"))
    j = facts.join(matched, ["doc_id", "h_line"])
    return j.select("topic", "doc_id", "line_no",
                    F.concat(F.lit("["), F.col("doc_id").cast("string"), F.lit("] "), F.col("fact")).alias("fact"))


def facts_by_topic(facts: DataFrame, topics: DataFrame) -> DataFrame:
    """A19 + A20: per topic with facts: fact count, document count and the
    first fact (by document, line).  Facts stay rows; no per-topic list."""
    g = facts.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_facts"), F.count_distinct("doc_id").alias("n_docs"),
        F.min(F.struct("doc_id", "line_no", "fact")).getField("fact").alias("first_fact"))
    return g.join(topics, "topic").select("topic_pos", "topic", "n_facts", "n_docs", "first_fact")


def report_numbers(facts: DataFrame, topics: DataFrame, pages: DataFrame) -> DataFrame:
    """S12 (documents): the report's numbers as ``(section, rank, label, value)`` rows.

    ``document_totals`` holds documents, topics and facts, ``topic_facts`` the
    facts of every topic in topic order; a topic without facts has 0.  The
    counts come from one pass over the facts, added up before the shuffle.
    """
    counts = facts.groupBy(F.col("topic").alias("_topic")).agg(F.count(F.lit(1)).alias("n"))
    per_topic = shared(topics.join(counts, F.col("topic") == F.col("_topic"), "left")
                       .select("topic_pos", "topic", F.coalesce("n", F.lit(0)).alias("n_facts")))
    totals = per_topic.agg(F.count(F.lit(1)).alias("topics"), F.coalesce(F.sum("n_facts"), F.lit(0)).alias("facts")).select(
        "*", pages.agg(F.count_distinct("doc_id")).scalar().alias("documents"))
    rows = sinks.report_rows([("topic_facts", per_topic, "topic", "n_facts", "topic_pos")])
    return rows.unionByName(sinks.metric_rows(totals, "document_totals", ["documents", "topics", "facts"]))


# --- T05: batched scoring with a pluggable numpy scorer --------------------------------

def hash_embed(texts, dim: int = EMBED_DIM) -> np.ndarray:
    """Plain numpy scorer: lower-cased whitespace tokens hashed (first eight hex
    digits of their MD5) into ``dim`` buckets, L2-normalised.  Deterministic
    across processes."""
    out = np.zeros((len(texts), dim), dtype=np.float64)
    bucket: dict[str, int] = {}
    for i, t in enumerate(texts):
        if not isinstance(t, str):
            continue
        tokens = t.lower().split()
        for tok in tokens:
            if tok not in bucket:
                bucket[tok] = int(hashlib.md5(tok.encode("utf-8")).hexdigest()[:8], 16) % dim
        out[i] = np.bincount([bucket[tok] for tok in tokens], minlength=dim)[:dim] if tokens else 0.0
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def _ship_by_value(fn) -> None:
    """Pickle ``fn``'s module by value, so Python workers need not import this
    package (on a cluster it is otherwise shipped with ``--py-files``)."""
    import sys

    from pyspark import cloudpickle
    mod = sys.modules.get(getattr(fn, "__module__", ""), None)
    if mod is not None and mod.__name__.startswith("tessera"):
        cloudpickle.register_pickle_by_value(mod)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def embed(df: DataFrame, id_cols: list[str], text: str, scorer=hash_embed, batch: int = EMBED_BATCH) -> DataFrame:
    """``mapInPandas`` over Arrow batches; the scorer is called on
    ``batch`` texts at a time (the reference's 16 texts per call) -> (ids, vec)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*id_cols).schema.fields) + ", vec array<double>"
    _ship_by_value(scorer)

    def run(batches):
        for pdf in batches:
            texts = pdf[text].tolist()
            vecs = [v for i in range(0, len(texts), batch) for v in scorer(texts[i:i + batch])]
            out = pdf[id_cols].copy()
            out["vec"] = vecs
            yield out

    return df.select(*id_cols, text).mapInPandas(run, schema)


def batched_scores(chunk_df: DataFrame, query_texts: DataFrame) -> DataFrame:
    """Embed chunks and query texts with the scorer, sum and normalise the
    query vectors (F10), score each chunk by dot product (F11)."""
    qv = embed(query_texts, ["item_id"], "text")
    summed = qv.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    qvec = summed.agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("_s")).select(
        l2_normalize(F.transform("_s", lambda e: e["x"]))).scalar()   # one EMBED_DIM vector
    cv = embed(chunk_df, ["doc_id", "chunk_idx"], "chunk")
    # the scalar is projected first: subqueries may not sit inside a lambda
    return cv.select("doc_id", "chunk_idx", "vec", qvec.alias("_q")).select(
        "doc_id", "chunk_idx", F.round(dot("vec", "_q"), 6).alias("score"))


