"""Operator 8: n-gram Jaccard self-join with prefix trees.

Every document becomes the set of its word shingles (64-bit hashes); documents
with equal sets form one class.  All sets are sorted by one global order, rare
shingles first.  Counts of all documents in a fixed-size table decide, then the
hash; shingles that still are frequent among the prefixes under that order are
moved behind all others.  Any one order gives the same links; a better one gives
fewer candidates.  Two sets that link share a shingle in their prefixes, so
classes meet by prefix shingle:

1. in a first turn each class meets CENTRES classes of every prefix shingle (stars,
   not all pairs) that are not yet in its component; what links is joined into
   components;
2. in the last turn the classes of one prefix shingle that still are in
   *different* components meet, so a large group of near copies costs a few
   pairs per member, and no link between components is lost.

A pair must pass the bounds on lengths and on the places of the shared shingle:
before the *first* shingle that two sets share, neither holds one of the
other's, so what remains from there on limits the overlap.  The parities of the
elements by 256 bits give another bound: each differing bit is a differing
element.
The rest is verified: the partners of one class, their sets stored as a prefix
tree in the global order, are traversed; partners share the overlap counted
along a common path, and a subtree is left as soon as the elements remaining
cannot lift the overlap to what the lengths require.  Verification is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import Tables, broadcast_if_light, light_batches, shuffle_files_removed

WIDTH = 3
PERCENT = 90
SKETCH_BITS = 22  # counters of the shingle counts: 4 MB, whatever the input
CHUNK_BITS = 16
FREQUENT, FREQUENT_MOST = 3, 1_000_000  # prefixes that make a shingle frequent; how many of these are told to the tasks (12 MB)
CENTRES, TURNS = 8, 1
MEET = 512  # counter rows added in one group
PARTNERS = 256  # per verification group

_B = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i below n; the table grows as needed."""
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_B), -1, 1 << 64))
        for k, b in enumerate((_B, inverse)):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            _POWERS[k] = np.multiply.accumulate(a)
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text; A-Z count as lower case."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    a = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    a = np.where((a >= 65) & (a <= 90), a + 32, a)
    word = ~((a == 32) | ((a >= 9) & (a <= 13)))
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(lo, starts)  # first word of each text
    with np.errstate(over="ignore"):
        power, inverse = _powers(len(a) + 1)
        total = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[:len(a)], out=total[1:])
        h = _mix((total[hi] - total[lo]) * inverse[lo] + (hi - lo).astype(np.uint64))
        n = max(len(h) - width + 1, 0)
        shingle = np.full(n, width, np.uint64)
        for k in range(width):
            shingle = _mix(shingle * _B + h[k:k + n])
        out = []
        for b, e in zip(first[:-1], first[1:], strict=True):
            if e - b >= width:
                out.append(np.unique(shingle[b:e - width + 1]))
            elif e > b:  # the whole short sequence as one
                x = np.full(1, e - b, np.uint64)
                for k in range(b, e):
                    x = _mix(x * _B + h[k:k + 1])
                out.append(x)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sets(batches, width, step=64):
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            yield batch, lo, shingle_sets(batch.column("text").slice(lo, step).to_pylist(), width)
    _POWERS[:] = [np.ones(1, np.uint64)] * 2  # workers live on: give back what long texts took
    pa.default_memory_pool().release_unused()


_SCAN = "id bigint, th bigint, n bigint, sid binary, chunk int, part int, counts binary"


def _scan(width: int):
    def run(batches):
        """A row (id, th, n, sid) per document and, per task, the counts of its shingles in 2^SKETCH_BITS counters (chunk, part, counts)."""
        from pyspark import TaskContext
        count = np.zeros(1 << SKETCH_BITS, np.uint32)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        names = [c.split()[0] for c in _SCAN.split(", ")]

        def batch_of(*columns):
            n = len(next(c for c in columns if c is not None))
            return pa.RecordBatch.from_arrays([pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch, lo, sets in _sets(batches, width):
            yield batch_of(*[batch.column(c).slice(lo, len(sets)).to_pylist() for c in ("id", "th")], [len(x) for x in sets], [_set_id(x) for x in sets], None, None, None)
            # in place: counters of every addition would take more memory than all else here
            np.add.at(count, (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
        if count.any():
            task, chunks = TaskContext.get().partitionId(), count.reshape(-1, 1 << CHUNK_BITS)
            # few counters of a task pass 255: a byte each travels
            yield batch_of(None, None, None, None, range(len(chunks)), [task // MEET] * len(chunks),
                           [np.minimum(c, 255).astype(np.uint8).tobytes() for c in chunks])
    return run


def _add(width: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, width).astype(np.uint32) for c in pdf["counts"])
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "part": [pdf["part"].iloc[0] // MEET], "counts": [total.astype("<u4").tobytes()]})
    return run


def shingle_weights(rows: DataFrame) -> np.ndarray:
    """Logarithmic counts over all documents, by the leading bits of a shingle (4 MB at most)."""
    schema = "chunk int, part int, counts binary"
    rows = rows.where("chunk is not null").select("chunk", "part", "counts")
    # tasks meet in two rounds of at most MEET each
    rows = rows.groupBy("chunk", "part").applyInPandas(_add("u1"), schema).groupBy("chunk", "part").applyInPandas(_add("<u4"), schema)
    total = np.zeros(1 << SKETCH_BITS, np.uint32).reshape(-1, 1 << CHUNK_BITS)
    for r in rows.collect():
        total[r["chunk"]] += np.frombuffer(r["counts"], "<u4")
    total = total.ravel()
    return np.where(total > 0, 1 + np.floor(4 * np.log2(np.maximum(total, 1))), 0).astype(np.uint8)


class Order:
    """The global order: by level, then by hash.  Levels come from the count table, and from ``frequent`` shingles' own counts."""

    def __init__(self, weights: np.ndarray, frequent: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.weights = weights
        self.frequent = np.zeros(0, np.uint64) if frequent is None else np.sort(frequent)
        if len(self.frequent):
            by = counts[np.argsort(frequent)]
            self.levels = (128 + np.floor(4 * np.log2(by))).clip(128, 255).astype(np.uint8)

    def levels_of(self, s: np.ndarray) -> np.ndarray:
        out = self.weights[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, s), len(self.frequent) - 1)
            out = np.where(self.frequent[at] == s, self.levels[at], out)
        return out

    def sorted(self, s: np.ndarray) -> np.ndarray:
        return s[np.argsort(self.levels_of(s), kind="stable")]


def refined_order(prefixes: DataFrame, weights: np.ndarray) -> Order:
    """Order that puts shingles in FREQUENT prefixes or more last; the FREQUENT_MOST commonest of them reach the driver."""
    with shuffle_files_removed(prefixes.sparkSession), light_batches(prefixes.sparkSession):
        common = (prefixes.select(F.explode_outer("prefix").alias("shingle")).where("shingle is not null").groupBy("shingle")
                  .agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= FREQUENT))
        found = common.orderBy(F.desc("k"), "shingle").limit(FREQUENT_MOST).toArrow()
    return Order(weights, found.column("shingle").to_numpy().view(np.uint64), found.column("k").to_numpy())


def parity(s: np.ndarray) -> list[int]:
    """256 bits, each the parity of the elements that fall on it: two sets differ in as many elements, at least, as bits."""
    bits = np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1
    return np.packbits(bits.astype(np.uint8)).view("<i8").tolist()


def _prefixes(order: Order, percent: int, width: int):
    def run(batches):
        for _, _, sets in _sets(batches, width):
            out = [], [], [], []
            for s in sets:
                n = len(s)
                if n * (100 - percent) < percent:  # too small to link with a different set
                    continue
                own = order.sorted(s)[:n - (-(-percent * n // 100)) + 1]
                w = order.levels_of(own)
                out[0].append(_set_id(s))
                out[1].append(n)
                # a shingle counted once has no partner
                out[2].append(pa.array(own.view(np.int64), mask=w <= 1))
                out[3].append(parity(s))
            if out[0]:
                ends = np.cumsum([0] + [len(x) for x in out[2]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(out[2])),
                                                  pa.array(out[3], pa.list_(pa.int64()))], names=["sid", "n", "prefix", "bits"])
    return run


def need(n, m, percent: int):
    """Least overlap of linking sets of n and m elements."""
    return F.ceil((n + m) * percent / F.lit(100.0 + percent) - F.lit(1e-9))


def _may_link(percent: int):
    """Bounds on the lengths, on the places of the shared shingle and on the parity bits."""
    short, long = F.least("n", "m"), F.greatest("n", "m")
    most = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("other_place"))  # at the first shared shingle
    least = need(F.col("n"), F.col("m"), percent)
    differ = sum((F.bit_count(F.get("bits", F.lit(k)).bitwiseXOR(F.get("other_bits", F.lit(k)))) for k in range(4)), F.lit(0))
    return (short * 100 >= long * percent) & (most >= least) & (F.col("n") + F.col("m") - differ >= least * 2)


def tree_links(probe: np.ndarray, partners: list[np.ndarray], rank, percent: int) -> list[bool]:
    """Which partner sets link with ``probe``; all are arrays in the global order.

    Sorted partners and the length of the path each shares with the one before
    are the prefix tree; ``overlap[d]`` is the overlap after d elements of the
    current path, valid down to ``depth``.
    """
    order = sorted(range(len(partners)), key=lambda i: rank(partners[i]))
    out = [False] * len(partners)
    path, overlap, depth = np.zeros(0, np.uint64), np.zeros(1, np.int64), 0
    dead = None  # (depth, overlap) at which the last partner's path was left
    sorted_probe = np.sort(probe)
    place = np.argsort(probe)
    for i in order:
        s = partners[i]
        least = -(-percent * (len(s) + len(probe)) // (100 + percent))
        same = min(len(path), len(s))
        differ = np.flatnonzero(path[:same] != s[:same])
        shared = int(differ[0]) if len(differ) else same
        if dead and shared >= dead[0] and dead[1] + len(s) - dead[0] < least:
            continue  # the same pruned subtree
        known = min(shared, depth)
        rest = s[known:]
        at = np.minimum(np.searchsorted(sorted_probe, rest), len(probe) - 1)
        hit = sorted_probe[at] == rest
        grown = overlap[known] + np.concatenate([[0], np.cumsum(hit)])
        # elements of the probe still ahead, after the last one matched
        last = np.maximum.accumulate(np.concatenate([[-1], np.where(hit, place[at], -1)]))
        bound = grown + np.minimum(len(rest) - np.arange(len(rest) + 1), len(probe) - 1 - last)
        low = np.flatnonzero(bound < least)
        stop = int(low[0]) if len(low) else len(rest)
        path, overlap, depth = s, np.concatenate([overlap[:known], grown]), known + stop
        dead = (known + stop, int(grown[stop])) if len(low) else None
        out[i] = not len(low) and int(grown[-1]) >= least
    return out


def _verify(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["b"].isna()]
        rest = pdf[~pdf["b"].isna()]
        if own.empty or rest.empty:
            return rest.iloc[:0][["a", "b"]]
        probe = np.frombuffer(own["elements"].iloc[0], np.uint64)
        sets = [np.frombuffer(e, np.uint64) for e in rest["elements"]]
        links = tree_links(probe, sets, lambda s: s.astype(">u8").tobytes(), percent)
        out = rest[links]
        return pd.DataFrame({"a": out["a"], "b": out["b"]})
    return run


def _linked(pairs: DataFrame, rows: DataFrame, docs: DataFrame, order: Order, percent: int, width: int, tables: Tables) -> DataFrame:
    """The pairs (a, b) of set ids that link, verified by whole sets."""
    wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
    reps = (rows.join(wanted, F.col("sid") == F.col("w"), "left_semi").groupBy("sid")
            .agg(F.min("id").alias("rep")))
    reps = tables.keep(reps)
    texts = docs.join(broadcast_if_light(reps, F.lit(40)), F.col("id").eqNullSafe(F.col("rep"))).select("sid", "text")

    def elements(batches):
        for batch, lo, sets in _sets(batches, width):
            sid = batch.column("sid").slice(lo, len(sets)).to_pylist()
            keep = [(x, order.sorted(s).tobytes()) for x, s in zip(sid, sets, strict=True) if _set_id(s) == x]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.binary()), pa.array([k[1] for k in keep], pa.binary())],
                                             names=["sid", "elements"])

    sets = tables.keep(texts.mapInArrow(elements, "sid binary, elements binary").dropDuplicates(["sid"]))
    # the partners of one class in groups of a bounded size
    spread = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("partners") / PARTNERS)))
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"))
    group = pairs.join(sizes, "a").select("a", "b", spread.alias("part"))
    own = group.select("a", "part").distinct().join(sets, F.col("a") == F.col("sid")).select(
        "a", F.lit(None).cast("binary").alias("b"), "part", "elements")
    others = group.join(sets, F.col("b") == F.col("sid")).select("a", "b", "part", "elements")
    links = own.unionByName(others).groupBy("a", "part").applyInPandas(_verify(percent), "a binary, b binary")
    links = tables.keep(links)
    tables.drop(reps, sets)
    return links


def components(links: DataFrame, tables: Tables | None = None) -> DataFrame:
    """sid, label: the least set id of the component, for every set id with a link.

    Large-star and small-star steps: each is one aggregate and one join, and
    every edge moves towards the least node, so long chains halve.
    """
    tables = tables or Tables(links.sparkSession)
    edges = tables.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small_least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        step = large.join(small_least, F.col("u") == F.col("w"))
        before, edges = edges, tables.keep(step.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                                           .union(step.select("u", F.col("m").alias("v"))).distinct())
        tables.drop(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    label = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("sid"), "label")
    label = tables.keep(label.union(label.select(F.col("label").alias("sid"), "label").distinct()))
    tables.drop(edges)
    return label


def text_hash() -> Column:
    """With its id, what tells a document apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _labelled(docs: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(id, th, n, label) of the rows with words, and (id, th, n, sid) of those without."""
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"), text_hash().alias("th"))
    tables = Tables(docs.sparkSession)
    scanned = tables.keep(docs.mapInArrow(_scan(width), _SCAN))
    rows, weights = scanned.where("sid is not null").select("id", "th", "n", "sid"), shingle_weights(scanned)
    schema = "sid binary, n bigint, prefix array<bigint>, bits array<bigint>"
    order = refined_order(docs.select("text").mapInArrow(_prefixes(Order(weights), percent, width), schema), weights)
    prefixes = tables.keep(docs.select("text").mapInArrow(_prefixes(order, percent, width), schema))
    postings = prefixes.select("sid", "n", "bits", F.posexplode_outer("prefix").alias("place", "shingle")).where("shingle is not null")
    met = (postings.select("shingle", F.xxhash64("sid").alias("s")).groupBy("shingle").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
           .where("lo <> hi").select(F.col("shingle").alias("met")))
    met = tables.keep(met)
    postings = tables.keep(postings.join(broadcast_if_light(met, F.lit(16)), F.col("shingle") == F.col("met"), "left_semi")
                           .groupBy("shingle", "sid").agg(F.first("n").alias("n"), F.first("place").alias("place"), F.first("bits").alias("bits")))
    tables.drop(prefixes, met)
    links, label, tried = None, None, None
    for turn in range(TURNS + 1):
        named = postings if label is None else postings.join(label.withColumnRenamed("sid", "l"), F.col("sid") == F.col("l"), "left")
        named = named.select("shingle", "sid", "n", "place", "bits", (F.col("sid") if label is None else F.coalesce("label", "sid")).alias("label"))
        split = named.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(F.col("shingle").alias("met"))
        named = tables.keep(named.join(split, F.col("shingle") == F.col("met"), "left_semi"))
        centres = named
        if turn < TURNS:  # a few classes of each shingle; in the last turn every class
            by = W.partitionBy("shingle").orderBy(F.xxhash64("sid", F.lit(turn)), "sid")
            centres = named.withColumn("k", F.row_number().over(by)).where(F.col("k") <= CENTRES)
        centres = centres.select(F.col("shingle").alias("of"), F.col("sid").alias("a"), F.col("n").alias("m"),
                                 F.col("place").alias("other_place"), F.col("bits").alias("other_bits"), F.col("label").alias("other_label"))
        last = F.col("a") < F.col("sid") if turn == TURNS else F.lit(True)
        pairs = (named.join(centres, (F.col("shingle") == F.col("of")) & (F.col("label") != F.col("other_label")) & last & _may_link(percent))
                 .groupBy(F.least("a", "sid").alias("x"), F.greatest("a", "sid").alias("y")).agg(F.min("a").alias("a"))
                 .select("x", "y", "a", F.when(F.col("a") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("b")))
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = tables.keep(pairs)
        tables.drop(named)
        if pairs.isEmpty():
            continue
        tried = pairs.select("x", "y") if tried is None else tried.union(pairs.select("x", "y"))
        found = _linked(pairs.select("a", "b"), rows, docs, order, percent, width, tables)
        links = found if links is None else links.union(found)
        label = components(links, tables)
    tables.drop(postings)

    if label is None:
        label = rows.where("false").select("sid", F.col("sid").alias("label"))
    full = rows.where("n > 0").join(label.withColumnRenamed("sid", "l"), F.col("sid") == F.col("l"), "left").select(
        "id", "th", "n", F.coalesce("label", "sid").alias("label"))
    return full, rows.where("n = 0")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    A text without words (or null) has an empty set, links with nothing and is
    its own component.  Equal sets always link.  Rows that repeat an id are
    separate documents under one id; a component whose ids are all null has a
    null id.  Other columns are not read; an empty table gives an empty result.
    """
    full, empty = _labelled(docs, percent, width)
    least = full.groupBy("label").agg(F.min("id").alias("component_id")).withColumnRenamed("label", "g")
    out = full.join(least, F.col("label") == F.col("g")).select("id", "n", "component_id")
    out = out.union(empty.select("id", "n", "id"))
    return out.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """keep_id, keep_th, copies: the document (id and text hash) that stands for each component, and how many rows repeat it.

    It is the one with the least id, a null id last; under one id the least
    text hash.  A text without words stands for itself.
    """
    full, empty = _labelled(docs, percent, width)
    each = full.groupBy("label", "id", "th").agg(F.count(F.lit(1)).alias("copies"))
    first = each.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th", "copies")).alias("f")).select("f.id", "f.th", "f.copies")
    first = first.union(empty.groupBy("id", "th").agg(F.count(F.lit(1)).alias("copies")))
    return first.toDF("keep_id", "keep_th", "copies")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS k
  FROM w),
n AS (SELECT w.doc_id, count(s.k) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM o JOIN n nx ON o.x = nx.doc_id JOIN n ny ON o.y = ny.doc_id WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT n.doc_id, n.n AS n_shingles, min(r.reached) AS component_id FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY n.doc_id, n.n
"""
