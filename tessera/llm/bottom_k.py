"""Operator 12: near duplicates by bottom-k sketches from one hash function.

Each document is the set of its word shingles under one 64-bit hash; equal sets
form one class.  The k least hashes of a set are its sketch, and a sample of the
union of two sets is the k least of their two sketches together.

1. **Overlaps.**  Inverted lists of the retained values say how many values of a
   sketch some other class retains too.  Sets that link share ``least_shared``
   retained values or more (all but MISS of them, by Chernoff's bound, which also
   holds for samples without replacement; exactly when the sketches are the whole
   sets), so a class with fewer cannot link.  A small sketch settles most classes.
2. **Lists.**  The rest get a longer sketch.  With the values in one order, rare
   ones first, two classes that share t of s values meet in the first s - t + 1,
   so only these are listed, and what follows a common value bounds the overlap.
   Frequent passages are at the end and hardly ever listed.
3. **Pairs.**  In the first turns each class of a list meets CENTRES classes of
   it, those that share most values first, and the one it meets most often is
   verified; what links becomes one component.  In the last turn the classes of a
   list that still are in *different* components meet.  A large group of near
   copies so costs a few pairs per member, and no link between components is lost.
4. **Verification.**  The union sketch estimates the similarity; a pair under the
   same bound is left, any other is decided by the whole sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import broadcast_if_light, kept_table
from tessera.llm.jaccard_join import _set_id, _sets, components

WIDTH = 5
PERCENT = 85
K_FIRST, K_SECOND = 32, 1024
MISS = 1e-12  # chance that a linking pair shares fewer retained values than is asked for
CENTRES, TURNS = 4, 1
PARTNERS = 256  # pairs of one class that meet one copy of its set


def least_shared(k: int, percent: int, miss: float = MISS) -> int:
    """How many of the k least values of the union two sets of that similarity share, at least (chance of fewer: ``miss``)."""
    p = percent / 100

    def chance(x):  # Chernoff: x or fewer of k
        q = x / k
        return math.exp(-k * ((q * math.log(q / p) if q else 0.0) + (1 - q) * math.log((1 - q) / (1 - p))))

    t = 0
    while t < k * p and chance(t) <= miss:
        t += 1
    return t


def least_of_one(n, k: int, percent: int):
    """Retained values that a set of n elements shares with any set it links with (Column)."""
    whole = F.ceil(n * percent / F.lit(100.0) - F.lit(1e-9))  # partners have n * 100 / percent elements at most
    return F.when(n * 100 <= k * percent, whole).otherwise(least_shared(k, percent)).cast("int")


def _scan(width: int, k: int):
    def run(batches):
        for batch, lo, sets in _sets(batches, width):
            ends = np.cumsum([0] + [min(len(s), k) for s in sets]).astype(np.int32)
            least = np.concatenate([s[:k] for s in sets]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(lo, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_id(s) for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(least))], names=["id", "n", "sid", "sketch"])
    return run


def _elements(width: int):
    def run(batches):
        for batch, lo, sets in _sets(batches, width):
            wanted = batch.column("sid").slice(lo, len(sets)).to_pylist()
            keep = [(x, s) for x, s in zip(wanted, sets, strict=True) if _set_id(s) == x]
            if keep:  # rows that repeat an id may hold another text
                ends = np.cumsum([0] + [len(s) for _, s in keep]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in keep], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([s for _, s in keep]).view(np.int64)))], names=["sid", "elements"])
    return run


def _shared_values(posts: DataFrame) -> DataFrame:
    """(met, c): the values that two classes or more retain, and how many do."""
    return posts.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("v").alias("met"), "c")


def survivors(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """sid of the classes whose sketch shares enough values with others to link at all."""
    posts = classes.select("sid", "n", F.explode("sketch").alias("v"))
    shared = kept_table(_shared_values(posts))
    own = posts.join(shared, F.col("v") == F.col("met")).groupBy("sid").agg(F.count(F.lit(1)).alias("s"), F.first("n").alias("n"))
    return own.where(F.col("s") >= least_of_one(F.col("n"), k, percent)).select("sid")


def inverted_lists(sets: DataFrame, k: int, percent: int) -> DataFrame:
    """v, sid, n, shared, rest: the rarest retained values of each class, as many as a linking pair needs to meet.

    ``rest`` counts the retained values after v in the order that others retain
    too, so no pair that meets first at v shares more than rest + 1.
    """
    posts = sets.select("sid", F.size("elements").alias("n"), F.explode(F.slice("elements", 1, k)).alias("v"))
    own = (posts.join(_shared_values(posts), F.col("v") == F.col("met")).groupBy("sid")
           .agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("c", "v"))).alias("own")))  # k values at most
    own = own.select("sid", "n", F.size("own").alias("shared"), "own", least_of_one(F.col("n"), k, percent).alias("t")).where("shared >= t")
    met = own.select("sid", "n", "shared", F.posexplode(F.expr("slice(own, 1, shared - t + 1)")).alias("place", "x"))
    return met.select(F.col("x.v").alias("v"), "sid", "n", "shared", (F.col("shared") - F.col("place") - 1).alias("rest"))


def _may_link(k: int, percent: int):
    """Bounds on the sizes and on what the two sketches can still share."""
    short, long = F.least("n", "m"), F.greatest("n", "m")
    both = F.ceil((F.col("n") + F.col("m")) * percent / F.lit(100.0 + percent) - F.lit(1e-9))
    least = F.when(long <= k, both).otherwise(least_of_one(short, k, percent))
    return (short * 100 >= long * percent) & (F.least("rest", "other_rest") + 1 >= least)


def links(a: np.ndarray, b: np.ndarray, k: int, percent: int, least: int) -> bool:
    """Whether two sorted sets link: first by the estimate from the union sketch, then by the whole sets."""
    if max(len(a), len(b)) > k:
        union, both = np.union1d(a[:k], b[:k]), np.intersect1d(a[:k], b[:k], assume_unique=True)
        if np.searchsorted(both, union[k - 1], "right") < least:
            return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return bool(100 * common >= percent * (len(a) + len(b) - common))


def _verify(k: int, percent: int):
    least = least_shared(k, percent)

    def run(batches):
        for batch in batches:
            sides = []
            for c in ("left", "right"):
                col = batch.column(c)
                sides.append((col.offsets.to_numpy(), col.values.to_numpy().view(np.uint64)))
            (p, x), (q, y) = sides
            keep = [links(x[p[i]:p[i + 1]], y[q[i]:q[i + 1]], k, percent, least) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
        pa.default_memory_pool().release_unused()
    return run


def _linked(pairs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link.  The set of a class with many partners goes to several places, PARTNERS pairs each."""
    parts = pairs.groupBy(F.col("a").alias("of")).agg(F.ceil(F.count(F.lit(1)) / F.lit(PARTNERS)).cast("int").alias("parts"))
    left = sets.join(parts, F.col("sid") == F.col("of")).select(
        "of", F.col("elements").alias("left"), "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    salted = pairs.join(parts.withColumnRenamed("parts", "all_parts"), F.col("a") == F.col("of")).select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("all_parts")).cast("int").alias("at"))
    rows = salted.join(left, (F.col("a") == F.col("of")) & (F.col("at") == F.col("part"))).select("a", "b", "left")
    rows = rows.join(sets.select("sid", F.col("elements").alias("right")), F.col("b") == F.col("sid")).select("a", "b", "left", "right")
    return kept_table(rows.mapInArrow(_verify(k, percent), "a binary, b binary"))


def _classes_and_labels(docs: DataFrame, percent: int, width: int, k_first: int, k: int) -> tuple[DataFrame, DataFrame | None]:
    """(id, n, sid) of every row, and (sid, label) of the classes that link with another."""
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    rows = kept_table(docs.mapInArrow(_scan(width, k_first), "id bigint, n bigint, sid binary, sketch array<bigint>"))
    classes = kept_table(rows.where("n > 0").groupBy("sid").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    wanted = kept_table(classes.select(F.col("sid"), "rep").join(survivors(classes, k_first, percent).withColumnRenamed("sid", "w"), F.col("sid") == F.col("w"), "left_semi"))
    texts = docs.join(broadcast_if_light(wanted, F.lit(40)), F.col("id").eqNullSafe(F.col("rep"))).select("sid", "text")
    sets = kept_table(texts.mapInArrow(_elements(width), "sid binary, elements array<bigint>").dropDuplicates(["sid"]))
    lists = kept_table(inverted_lists(sets, k, percent))
    found, label, tried = None, None, None
    for turn in range(TURNS + 1):
        named = lists.withColumn("label", F.col("sid")) if label is None else (
            lists.join(label.withColumnRenamed("sid", "l"), F.col("sid") == F.col("l"), "left").withColumn("label", F.coalesce("label", "sid")).drop("l"))
        split = named.groupBy("v").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select(F.col("v").alias("met"))
        named = kept_table(named.join(split, F.col("v") == F.col("met"), "left_semi"))
        centres = named
        if turn < TURNS:  # a few classes of each list; in the last turn every class
            first = F.desc("shared") if turn == 0 else F.xxhash64("sid", F.lit(turn))
            centres = named.withColumn("r", F.row_number().over(W.partitionBy("v").orderBy(first, "sid"))).where(F.col("r") <= CENTRES)
        centres = centres.select(F.col("v").alias("of"), F.col("sid").alias("a"), F.col("n").alias("m"), F.col("rest").alias("other_rest"), F.col("label").alias("other_label"))
        last = F.col("a") < F.col("sid") if turn == TURNS else F.lit(True)
        met = named.join(centres, (F.col("v") == F.col("of")) & (F.col("label") != F.col("other_label")) & last & _may_link(k, percent))
        pairs = met.groupBy("a", F.col("sid").alias("b")).agg(F.count(F.lit(1)).alias("times"))
        if turn < TURNS:  # the centre a class meets most often
            pairs = pairs.groupBy("b").agg(F.max(F.struct("times", "a")).alias("best")).select("best.a", "b")
        pairs = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b")
        if tried is not None:
            pairs = pairs.join(tried, ["x", "y"], "left_anti")
        pairs = kept_table(pairs)
        if pairs.isEmpty():
            continue
        tried = pairs.select("x", "y") if tried is None else tried.union(pairs.select("x", "y"))
        new = _linked(pairs.select("a", "b"), sets, k, percent)
        found = new if found is None else found.union(new)
        label = components(found)
    return rows.select("id", "n", "sid"), label


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, k_first: int = K_FIRST, k: int = K_SECOND) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Documents link when the Jaccard similarity of their shingle sets is
    ``percent`` or more; ``component_id`` is the least doc_id that links reach.
    A text without words (or null) has an empty set, links with nothing and is
    its own component; one with fewer words than ``width`` is one shingle.  Equal
    sets always link.  Rows that repeat an id are separate documents under one
    id, and all of them are kept if it is the least; a null id is larger than
    any other, and a component of null ids alone has a null id and keeps all.
    Other columns are not read; an empty table gives an empty result.
    """
    rows, label = _classes_and_labels(docs, percent, width, k_first, k)
    if label is None:
        full = rows.where("n > 0").withColumn("label", F.col("sid"))
    else:
        full = rows.where("n > 0").join(label.withColumnRenamed("sid", "l"), F.col("sid") == F.col("l"), "left").withColumn("label", F.coalesce("label", "sid"))
    least = full.groupBy("label").agg(F.min("id").alias("component_id")).withColumnRenamed("label", "g")
    out = full.join(least, F.col("label") == F.col("g")).select("id", "n", "component_id")
    out = out.union(rows.where("n = 0").select("id", "n", "id"))
    kind = docs.schema["doc_id"].dataType
    return out.select(F.col("id").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component_id").cast(kind).alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS k
  FROM w),
n AS (SELECT w.doc_id, count(s.k) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM o JOIN n nx ON o.x = nx.doc_id JOIN n ny ON o.y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT n.doc_id, n.n AS n_shingles, min(r.reached) AS component_id, n.doc_id = min(r.reached) AS kept
FROM n JOIN r ON n.doc_id = r.doc_id GROUP BY n.doc_id, n.n
"""
