"""Operator 13: periodic runs of words by string synchronising sets.

A run is a stretch of words that keeps its smallest period ``q`` as long as it
can and is at least four periods long.  Runs are found scale by scale, for
tau = 4, 8, 16, ...; the scale tau is answerable for the periods tau to
2 tau - 1 (periods below four are read off directly: neighbours at that
distance are equal).

* Each window of tau words gets a hash.  Windows that themselves have a period
  of tau / 4 or less are left out: they lie in runs of small periods, which the
  smaller scales have found already, so no repetition floods the set.
* Position i is *synchronising* when the least hash among the windows at
  i .. i + tau is the first or the last of them.  That depends on the next
  2 tau words alone, so equal contexts are chosen alike, and every stretch of
  tau positions that is not highly periodic holds one.
* In a run of period p the first such position i has its context again at
  i + p, and nowhere between.  So each position meets the next one with the
  same context of 2 tau words, and their distance is a proposed period.
* A proposal is verified and extended on the words themselves.  A stretch that
  a smaller period gave already is the same run.

Hashes only propose; what is returned has been compared word by word.  Every
text is read whole in one task (a run may span all of it); texts are independent
rows, so nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import words

EXPONENT = 4  # the completeness argument above needs four periods
MIN_LENGTH = 6
SMALL = 3  # periods read off directly
SLICE_WORDS = 200_000  # words of short texts handled at once; a longer text is a slice of its own

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_B = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` (a power of two) neighbours."""
    k = 1
    while k < width:
        a = np.minimum(a[:-k], a[k:])
        k *= 2
    return a


def synchronising(window: np.ndarray, tau: int, left_out: np.ndarray) -> np.ndarray:
    """Synchronising positions for the hashes ``window`` of all windows of tau words."""
    ids = np.where(left_out, _NONE, window)
    if len(ids) <= tau:
        return np.zeros(0, np.int64)
    least = np.minimum(_window_min(ids, tau)[:len(ids) - tau], ids[tau:])
    return np.flatnonzero((least != _NONE) & ((least == ids[:-tau]) | (least == ids[tau:])))


def _extend(w: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """The longest stretch around w[i:i+p] that keeps period p (separators end it)."""
    end, step = i + p, 4 * p
    while end < len(w):
        same = w[end:end + step] == w[end - p:end - p + step][:len(w) - end]
        if same.all():
            end += len(same)
            step *= 2
        else:
            end += int(np.argmin(same))
            break
    start, step = i, 4 * p
    while start > 0:
        low = max(0, start - step)
        same = (w[low:start] == w[low + p:start + p])[::-1]
        if same.all():
            start = low
            step *= 2
        else:
            start -= int(np.argmin(same))
            break
    return start, end


def find_runs(w: np.ndarray, longest: int, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of every run of ``exponent`` periods or more in ``w``.

    ``w`` may hold several texts, each ended by a separator that occurs once;
    ``longest`` is the length of the longest.
    """
    found: dict[tuple[int, int], int] = {}
    for q in range(1, SMALL + 1):
        if len(w) <= q:
            break
        edge = np.diff((w[:-q] == w[q:]).astype(np.int8), prepend=0, append=0)
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for k in np.flatnonzero(hi - lo >= (exponent - 1) * q):
            found.setdefault((int(lo[k]), int(hi[k]) + q), q)
    tau = SMALL + 1
    with np.errstate(over="ignore"):
        window = _mix(w.astype(np.uint64) + _B)
        for k in (1, 2):
            window = _mix(window[:-k] * _B + window[k:])
        while exponent * tau <= longest:
            outside = np.zeros(len(window) + 1, np.int32)
            for (s, e), q in found.items():
                if 4 * q <= tau <= e - s:
                    outside[s] += 1
                    outside[e - tau + 1] -= 1
            at = synchronising(window, tau, np.cumsum(outside)[:-1] > 0)
            window = _mix(window[:-tau] * _B + window[tau:])  # now of 2 tau words: the contexts
            context = window[at]
            order = np.argsort(context, kind="stable")
            same = np.flatnonzero(context[order[1:]] == context[order[:-1]])
            i = at[order[same]]
            p = at[order[same + 1]] - i
            near = (p >= tau) & (p < 2 * tau)
            last: dict[int, int] = {}
            for a, q in sorted(zip(i[near].tolist(), p[near].tolist(), strict=True)):
                if a < last.get(q, -1):
                    continue  # inside the stretch seen last
                s, e = _extend(w, a, q)
                last[q] = e - q
                if e - s >= exponent * q:
                    found.setdefault((s, e), q)
            tau *= 2
    return sorted((s, e, q) for (s, e), q in found.items())


def _slices(texts: list[str | None]):
    """Groups of (place, words) with about SLICE_WORDS words, or one long text."""
    group, size = [], 0
    for k, t in enumerate(texts):
        own = (t or "").encode("utf-8", "surrogatepass").split()  # of bytes: splits at \x20 and \x09-\x0D alone
        if group and size + len(own) > SLICE_WORDS:
            yield group
            group, size = [], 0
        group.append((k, own))
        size += len(own)
    if group:
        yield group


def runs_of(texts: list[str | None], exponent: int = EXPONENT, min_length: int = MIN_LENGTH):
    """Per text: (words, runs as (start, length, period) by start and period, kept words joined by one space)."""
    for group in _slices(texts):
        code: dict[bytes, int] = {}
        ids, starts = [], []
        for k, own in group:
            starts.append(len(ids))
            ids.extend([code.setdefault(x, len(code)) for x in own])
            ids.append(-1 - k)
        w = np.array(ids, np.int64)
        runs: list[list] = [[] for _ in group]
        for s, e, q in find_runs(w, max(len(own) for _, own in group), exponent):
            if e - s >= min_length:
                g = int(np.searchsorted(starts, s, "right")) - 1
                runs[g].append((s - starts[g], e - s, q))
        for (_, own), mine in zip(group, runs, strict=True):
            mine.sort(key=lambda r: (r[0], r[2]))
            kept = own
            if mine:
                drop = np.zeros(len(own), bool)
                for s, n, q in mine:
                    drop[s + q:s + n] = True
                kept = [own[j] for j in np.flatnonzero(~drop)]
            yield len(own), mine, b" ".join(kept)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and collapsed text of every row of ``docs`` (doc_id, text).

    A run is at least ``exponent`` (four or more) periods and ``min_length``
    words long; overlapping runs are all listed, by start, then period.
    ``collapsed`` keeps of each run its first period alone and joins the words
    by one space.  A null, empty or blank text has no words, no runs and an
    empty ``collapsed``.  Rows that repeat an id are rows of their own.  Other
    columns are not read; an empty table gives an empty result.
    """
    if exponent < EXPONENT:
        raise ValueError(f"exponent must be {EXPONENT} or more")

    def scan(batches):
        for batch in batches:
            n, runs, kept = [], [], []
            for count, mine, text in runs_of(batch.column("text").to_pylist(), exponent, min_length):
                n.append(count)
                runs.append([{"start": s, "length": k, "period": q} for s, k, q in mine])
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """The registered query's own input: in a tenth of the documents (by crc32 of the id) the words from place a on repeat a period p."""
    h = F.crc32(F.col("doc_id").cast("string"))
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), F.when(h % 10 == 0, F.floor(h / 10).cast("long")).alias("g"))
    d = d.withColumn("w", F.when(F.col("g").isNotNull(), words(F.col("text"))))
    n = F.size("w")
    d = d.withColumn("a", F.when(n > 0, F.col("g") % n))
    d = d.withColumn("p", F.floor((n - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    a, p = F.col("a"), F.col("p")
    again = F.transform("w", lambda x, i: F.when(i < a, x).otherwise(F.get("w", (a + (i - a) % p).cast("int"))))
    return d.select("doc_id", F.when(a.isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def _greatest() -> Column:
    """The run with the greatest length / period; runs come by start and period, so the first of equals stays."""
    r = F.col("runs")
    return F.aggregate(F.slice(r, 2, F.greatest(F.size(r), F.lit(1))), F.get(r, F.lit(0)),
                       lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """The registered query's columns from the operator's rows."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = found.withColumn("best", _greatest())
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                      F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                      F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("runs_sha256"),
                      F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))
