"""Operator 11: phrase collocations, counted by HAT-tries.

Each task walks its texts and puts the ``max_words`` words that start at every
place (fewer where the piece ends) into a trie over word ids: under each first
word a *container*, a hash table from the remaining words to a count.  A
container that grows past BURST entries bursts into one container per second
word, so containers stay small enough for the cache while rare words need one
small table.  When a task's tries hold more than MAX_ENTRIES entries, whole
subtrees, the largest first, are spilled as sorted runs: the counts of a prefix
are the sums below its node, so a run lists every phrase of the subtree, from
one word up to ``max_words``, in the order of the words.

A phrase is frequent only if all its neighbouring pairs of words are.  So a first
pass counts words and pairs as 64-bit hashes and marks the frequent ones in a
bit table of a fixed size; in the second pass a phrase ends before a pair that is
not marked.  Hashes and bits that meet by chance only let a phrase pass that the
exact counts drop later, so the table's size changes the work and no result.

Runs of all tasks meet by phrase: Spark's shuffle is the partition by prefix
(the whole phrase is hashed, so a frequent prefix is spread over partitions and
a phrase is one row a run, however often it occurs) and its aggregate the merge.
Phrases below the least count end there; scores, containment and ranks are joins
and windows over the frequent rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import kept_table, shuffle_files_removed

MAX_WORDS = 3
MIN_COUNT = 10
CONTAINED_PERCENT = 50
TOP = 2000
NO_LANG = "und"
BURST = 2_048  # entries of a container
MAX_ENTRIES = 700_000  # entries of a task's tries before subtrees are spilled: about 110 MB
STEP_BYTES = 1 << 20  # text that is counted before it goes into the trie
HASHES = 3 << 20  # hashes a task adds up before it sends them: about 150 MB
WORDS = 1 << 19  # words of the first pass's vocabulary before it starts anew
FILTER_BITS = 27  # 2^27 bits, 16 MB, whatever the input
DROPPED = np.uint64(24)  # a hash travels with its leading 40 bits; more would change nothing in a table of that size
REST_BITS = np.uint64(24)  # of the 40 bits, 16 name the bucket and 24 are sent

BREAK = b"."
# The characters that end a piece, [.,;:!?\x0A-\x0D], and the white space between words, [\x20\x09].
_TABLE = bytes.maketrans(b",;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ", BREAK * 9 + b"abcdefghijklmnopqrstuvwxyz")


_M = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


class Frequent:
    """The bit table of the frequent words and pairs: a bit that is not set belongs to no frequent one."""

    def __init__(self, table: np.ndarray):
        self.table = table  # 64-bit words

    def __call__(self, h: np.ndarray) -> np.ndarray:
        h = h >> DROPPED
        word = self.table[(h & np.uint64(len(self.table) - 1)).astype(np.int64)]
        return (word >> (h >> np.uint64(34)) & np.uint64(1)) == 1


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case, with BREAK between pieces (BREAK cannot be part of a word)."""
    return text.translate(_TABLE).replace(BREAK, b" . ").split()


class HatTrie:
    """Counts of word sequences of one language: first word -> container, or -> second word -> container."""

    def __init__(self):
        self.roots: dict[int, dict] = {}  # containers: remaining word ids as one number -> count
        self.burst: dict[int, dict[int, dict]] = {}
        self.sizes: dict[int, int] = {}

    def add(self, first: int, rest: list[int], counts: list[int], shift: int) -> int:
        """Adds counts below ``first``; returns how many entries are new."""
        if first in self.burst:
            new, below = 0, self.burst[first]
            for r, c in zip(rest, counts, strict=True):
                box = below.setdefault(r >> shift, {})
                new += r not in box
                box[r] = box.get(r, 0) + c
        else:
            box = self.roots.setdefault(first, {})
            new = -len(box)
            for r, c in zip(rest, counts, strict=True):
                box[r] = box.get(r, 0) + c
            new += len(box)
            if len(box) > BURST:
                below = self.burst[first] = {}
                for r, c in self.roots.pop(first).items():
                    below.setdefault(r >> shift, {})[r] = c
        self.sizes[first] = self.sizes.get(first, 0) + new
        return new

    def take(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Removes the subtree of ``first``; returns its entries."""
        boxes = self.burst.pop(first).values() if first in self.burst else [self.roots.pop(first)]
        n = self.sizes.pop(first)
        rest = np.fromiter((r for b in boxes for r in b), np.int64, n)
        return rest, np.fromiter((c for b in boxes for c in b.values()), np.int64, n)


class Vocabulary:
    """Word ids of one task and the hashes of its words."""

    def __init__(self):
        self.words: list[bytes] = [b""]  # id 0: the end of the piece
        self.ids: dict[bytes, int] = {b"": 0}
        self.hashes = np.zeros(1, np.uint64)

    def encode(self, found: list[bytes]) -> np.ndarray:
        coded = pa.array(found, pa.binary()).dictionary_encode()
        own = coded.dictionary.to_pylist()
        known = len(self.words)
        to = np.empty(len(own), np.int64)
        for i, x in enumerate(own):
            to[i] = 0 if x == BREAK else self.ids.setdefault(x, len(self.ids))
            if to[i] == len(self.words):
                self.words.append(x)
        if len(self.words) > known:
            new = np.fromiter((_hash(x) for x in self.words[known:]), np.uint64, len(self.words) - known)
            self.hashes = np.concatenate([self.hashes, new])
        return to[coded.indices.to_numpy()]

    def hashed(self, lang: str, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words and of the pairs that start at each place (pairs across pieces are to be ignored)."""
        with np.errstate(over="ignore"):
            h = self.hashes[w]
            one = _mix(h + np.uint64(_hash(lang.encode())))
            two = one.copy()
            two[:-1] = _mix(one[:-1] * _M + h[1:])
        return one, two


class Counter:
    """The tries of one task, by language, over one vocabulary."""

    def __init__(self, max_words: int, max_entries: int, frequent: Frequent | None = None):
        self.k, self.limit, self.frequent = max_words, max_entries, frequent
        self.bits = 62 // max_words
        self.clear()

    def clear(self):
        self.vocabulary = Vocabulary()
        self.tries: dict[str, HatTrie] = {}
        self.total: dict[str, int] = {}
        self.entries = 0

    def add(self, lang: str, found: list[bytes]):
        """Counts the tokens of some texts (each ended by BREAK)."""
        w = self.vocabulary.encode(found)
        key, ended, start = w.copy(), np.zeros(len(w), bool), w > 0
        self.total[lang] = self.total.get(lang, 0) + int(start.sum())
        if self.frequent:
            one, two = self.vocabulary.hashed(lang, w)
            start &= self.frequent(one)
            goes_on = self.frequent(two)
        for k in range(1, self.k):
            after = np.zeros_like(w)
            after[:-k] = w[k:]
            ended |= after == 0
            if self.frequent:  # the pair of the words k - 1 and k
                pair = np.zeros(len(w), bool)
                pair[:len(w) - k + 1] = goes_on[k - 1:]
                ended |= ~pair
            key = key << self.bits | np.where(ended, 0, after)
        key, counts = np.unique(key[start], return_counts=True)
        if not len(key):
            return
        shift = self.bits * (self.k - 1)
        first = key >> shift
        rest = key & ((1 << shift) - 1)
        edge = np.flatnonzero(np.diff(first, prepend=-1))
        trie = self.tries.setdefault(lang, HatTrie())
        for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(key)], strict=True):
            self.entries += trie.add(int(first[lo]), rest[lo:hi].tolist(), counts[lo:hi].tolist(), shift - self.bits)

    def full(self) -> bool:
        return self.entries > self.limit or len(self.vocabulary.words) >> (self.bits - 1) > 0

    def spill(self, down_to: int):
        """Sorted runs (lang, phrase, count) of the largest subtrees, until ``down_to`` entries are left."""
        sizes = sorted(((n, lang, first) for lang, t in self.tries.items() for first, n in t.sizes.items()), reverse=True)
        chosen: dict[str, list[int]] = {}
        for n, lang, first in sizes:
            if self.entries <= down_to:
                break
            chosen.setdefault(lang, []).append(first)
            self.entries -= n
        if not down_to:
            yield from ((lang, [""], [n]) for lang, n in self.total.items() if n)
            self.total = {}
        if not chosen:
            return
        words = self.vocabulary.words
        order = pc.sort_indices(pa.array(words, pa.binary()))
        rank = np.empty(len(words), np.int64)
        rank[order.to_numpy()] = np.arange(len(words))
        spelled = pa.array(words, pa.binary()).take(order).cast(pa.string())  # by rank; the end of a piece is the least
        for lang, firsts in chosen.items():
            trie, shift = self.tries[lang], self.bits * (self.k - 1)
            keys, counts = [], []
            for f in firsts:
                rest, c = trie.take(f)
                keys.append(rest | f << shift)
                counts.append(c)
            key, count = np.concatenate(keys), np.concatenate(counts)
            columns = [rank[key >> self.bits * (self.k - 1 - j) & ((1 << self.bits) - 1)] for j in range(self.k)]
            sort = np.lexsort(columns[::-1])
            columns, count = [c[sort] for c in columns], count[sort]
            phrase, differs = None, np.zeros(len(count), bool)
            differs[0] = True
            for j in range(self.k):
                # a prefix of j + 1 words starts where one of its words differs from the row before
                differs[1:] |= columns[j][1:] != columns[j][:-1]
                at = np.flatnonzero(differs)
                total = np.add.reduceat(count, at)
                whole = columns[j][at] > 0
                for c in range(j + 1):
                    w = spelled.take(pa.array(columns[c][at[whole]]))
                    phrase = w if c == 0 else pc.binary_join_element_wise(phrase, w, " ")
                if whole.any():
                    yield lang, phrase, total[whole]


def _steps(batches):
    """{language: tokens} of about STEP_BYTES of whole texts each."""
    waiting, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found = tokens(text.encode("utf-8", "surrogatepass")) if text else []
            if found:
                own = waiting.setdefault(lang, [])
                own += found
                own.append(BREAK)
                size += len(text)
            if size > STEP_BYTES:
                yield waiting
                waiting, size = {}, 0
    yield waiting
    pa.default_memory_pool().release_unused()


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, ascending, with the sums of their counts."""
    h, n = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(n, first)


def _packed(h: np.ndarray, n: np.ndarray, min_count: int) -> pa.RecordBatch:
    """One row a bucket: the rest of its hashes (ascending), three bytes each, then their counts, a byte each.

    Counts stand together because most are one and compress well.  A count above ``min_count`` says no more than ``min_count``; one above a byte takes several places.
    """
    n = np.minimum(n, min_count)
    places = (n + 254) // 255
    if places.max() > 1:
        h = np.repeat(h, places)
        last = np.zeros(len(h), bool)
        last[np.cumsum(places) - 1] = True
        n = np.where(last, np.repeat(n - 255 * (places - 1), places), 255)
    bucket = (h >> REST_BITS).astype(np.int32)
    edge = np.flatnonzero(np.diff(bucket, prepend=-1))
    size = np.diff(edge, append=len(h)).astype(np.int32)
    data = np.empty(4 * len(h), np.uint8)
    place = np.arange(len(h), dtype=np.int32) - np.repeat(edge.astype(np.int32), size)
    at = 4 * np.repeat(edge.astype(np.int32), size) + place  # the bucket's first byte and the place in it
    for i in range(3):
        data[at + 2 * place + i] = (h >> np.uint64(8 * i) & np.uint64(255)).astype(np.uint8)
    data[at + 3 * np.repeat(size, size)] = n
    offsets = (np.concatenate([edge, [len(h)]]) * 4).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(edge), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[edge]), blobs], names=["bucket", "counted"])


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of :func:`_packed` rows."""
    size = pc.binary_length(batch.column("counted")).to_numpy(zero_copy_only=False) // 4
    edge = np.cumsum(size) - size
    data = np.frombuffer(b"".join(batch.column("counted").to_pylist()), np.uint8)
    place = np.arange(len(data) // 4) - np.repeat(edge, size)
    at = 4 * np.repeat(edge, size) + place
    h = np.repeat(batch.column("bucket").to_numpy().astype(np.uint64), size) << REST_BITS
    for i in range(3):
        h |= data[at + 2 * place + i].astype(np.uint64) << np.uint64(8 * i)
    return h, data[at + 3 * np.repeat(size, size)].astype(np.int64)


def _hash_counts(min_count: int):
    """Rows (bucket, counted): occurrences of words and pairs by hash."""
    def run(batches):
        vocabulary, hashes, counts, size = Vocabulary(), [], [], 0
        for step in _steps(batches):
            for lang, found in step.items():
                w = vocabulary.encode(found)
                one, two = vocabulary.hashed(lang, w)
                pair = (w[:-1] > 0) & (w[1:] > 0)
                h, n = np.unique(np.concatenate([one[w > 0], two[:-1][pair]]) >> DROPPED, return_counts=True)
                hashes.append(h)
                counts.append(n)
                size += len(h)
            if len(vocabulary.words) > WORDS:
                vocabulary = Vocabulary()
            if size > HASHES:
                h, n = _summed(hashes, counts)
                if len(h) > HASHES // 2:
                    yield _packed(h, n, min_count)
                    hashes, counts, size = [], [], 0
                else:
                    hashes, counts, size = [h], [n], len(h)
        if size:
            yield _packed(*_summed(hashes, counts), min_count)
    return run


def _often(min_count: int):
    """Hashes that occur ``min_count`` times or more, from rows sorted by bucket; at most one bucket waits for its end."""
    def run(batches):
        hashes, counts, size = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h, n = _unpacked(batch)
            last = h[-1] >> REST_BITS
            hashes.append(h)
            counts.append(n)
            size += len(h)
            if size > HASHES or h[0] >> REST_BITS != last:
                h, n = _summed(hashes, counts)
                ended = np.searchsorted(h, last << REST_BITS)
                own = h[:ended][n[:ended] >= min_count]
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["h"])
                hashes, counts, size = [h[ended:]], [n[ended:]], 0
        if hashes:
            h, n = _summed(hashes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(h[n >= min_count].view(np.int64))], names=["h"])
    return run


def frequent_pairs(rows: DataFrame, min_count: int, bits: int = FILTER_BITS) -> Frequent:
    """The bit table of words and pairs that occur ``min_count`` times or more: at most 2^bits / 64 rows reach the driver.

    A hash's leading bits are its bucket, so a shuffled row is a bucket's share of a task and a hash takes three bytes of it and one for its count.
    """
    counted = rows.mapInArrow(_hash_counts(min_count), "bucket int, counted binary").repartition("bucket").sortWithinPartitions("bucket")
    often = counted.mapInArrow(_often(min_count), "h bigint")
    words = often.select(F.col("h").bitwiseAND((1 << bits - 6) - 1).cast("int").alias("word"), F.shiftrightunsigned("h", 34).cast("int").alias("bit"))
    with shuffle_files_removed(rows.sparkSession):
        words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask")).toArrow()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return Frequent(table)


def _runs(max_words: int, max_entries: int, frequent: Frequent | None):
    names = ["lang", "phrase", "n"]

    def run(batches):
        counter = Counter(max_words, max_entries, frequent)

        def rows(down_to):
            for lang, phrase, n in counter.spill(down_to):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(phrase, pa.string()), pa.array(n, pa.int64())], names=names)

        for step in _steps(batches):
            for lang, found in step.items():
                counter.add(lang, found)
            if counter.full():
                yield from rows(max_entries // 2 if counter.entries > max_entries else 0)
                if not counter.entries:
                    counter.clear()
        yield from rows(0)
        counter.clear()
    return run


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = 1, max_entries: int = MAX_ENTRIES,
                  filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, phrase, f: the phrases of up to ``max_words`` words that occur ``min_count`` times within pieces; the empty phrase has the count of all words."""
    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.col("text").alias("text"))
    frequent = frequent_pairs(rows, min_count, filter_bits) if min_count > 1 else None
    runs = rows.mapInArrow(_runs(max_words, max_entries, frequent), "lang string, phrase string, n bigint")
    return runs.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= min_count) | (F.col("phrase") == ""))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, contained_percent: int = CONTAINED_PERCENT,
                 top: int | None = TOP, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases of 2 to ``max_words`` words by score.

    The score is floor(1,000,000 a a / (l r)) at the worst cut of the phrase.  A
    phrase inside a longer one that has ``contained_percent`` of its occurrences
    or more is dropped.  Ties go to the more frequent, then to the lesser phrase
    in byte order.  A null language is ``und``; a null, empty or blank text has
    no words, and rows that repeat an id count as often as they occur.  Other
    columns are not read; an empty table gives an empty result.
    """
    # parts of a phrase are at least as frequent as the phrase, so nothing else is needed
    counts = kept_table(phrase_counts(docs, max_words, min_count, max_entries))
    n = counts.where("phrase = ''").select(F.col("lang").alias("n_lang"), F.col("f").alias("n"))
    longer = counts.where("phrase like '% %'").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda lo, size: F.array_join(F.slice("w", lo, size), " ")
    size = F.size("w")
    cuts = longer.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size - F.col("k")).alias("right"))
    for side in ("left", "right"):
        of = counts.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("of"), F.col("f").alias(f"f_{side}"))
        cuts = cuts.join(of, (F.col("lang") == F.col("of_lang")) & (F.col(side) == F.col("of"))).drop("of_lang", "of", side)
    # decimals of 38 places: exact up to 10^16 occurrences
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("over", (wide("a") * wide("a")).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("under", (wide("f_left") * wide("f_right")).cast("decimal(38,0)"))
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("over div under").alias("score"), "k", "f_left", "f_right")).alias("c"))
    # sub-phrases of longer phrases, with the most frequent longer one
    inner = longer.where(size > 2).select("lang", "a", "w", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("lo"))
    inner = inner.groupBy(F.col("lang").alias("in_lang"), part(F.col("lo"), F.col("m")).alias("inner")).agg(F.max("a").alias("most"))
    kept = worst.join(inner, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left")
    kept = kept.where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * contained_percent))
    out = kept.select("lang", "phrase", "a", F.col("c.f_left").alias("l"), F.col("c.f_right").alias("r"), F.col("c.score").alias("score"))
    out = out.join(F.broadcast(n), F.col("lang") == F.col("n_lang")).drop("n_lang")  # one row a language
    out = out.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS phrase
  FROM w WHERE len(w) > 0),
f AS (SELECT lang, phrase, lang || chr(10) || phrase AS id, count(*) AS f, len(string_split(phrase, ' ')) AS k FROM g GROUP BY lang, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT lang, phrase, a, 1 AS place, lang || chr(10) || w[1] AS x, lang || chr(10) || array_to_string(w[2:], ' ') AS y FROM c
  UNION ALL SELECT lang, phrase, a, 2, lang || chr(10) || w[1] || ' ' || w[2], lang || chr(10) || w[3] FROM c WHERE k = 3),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, cut.place, fx.f AS l, fy.f AS r,
         (1000000::HUGEINT * cut.a * cut.a // (fx.f::HUGEINT * fy.f))::BIGINT AS score
  FROM cut JOIN f fx ON fx.id = cut.x JOIN f fy ON fy.id = cut.y),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) AS o FROM s),
i AS (
  SELECT lang || chr(10) || phrase AS id, max(a) AS a FROM (
    SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE k = 3)
  GROUP BY id),
k AS (
  SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM b LEFT JOIN i ON i.id = b.lang || chr(10) || b.phrase
  WHERE b.o = 1 AND (i.a IS NULL OR 100 * i.a < 50 * b.a)),
o AS (SELECT k.*, n.n, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.phrase) AS rank FROM k JOIN n ON n.lang = k.lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""
