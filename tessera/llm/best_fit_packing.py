"""Operator 5: packing by linear grouping, few-size configurations and best fit.

Documents longer than a sequence are cut; whole-length pieces fill a sequence
each.  For the rest the packing depends on the histogram of lengths alone,
which has fewer entries than a sequence has tokens, whatever the input:

1. large lengths are sorted and cut into groups of equal cardinality, each
   rounded up to its longest member;
2. configurations of these few sizes are chosen one by one: the largest size
   left, filled up as far as a subset-sum table allows, as often as stock lasts;
3. actual lengths replace the rounded ones, longest first, so a configuration
   splits into runs of sequences with the same lengths;
4. small lengths go, longest first, to the run with the least room that holds
   them, then to new sequences.

A run is stored as (length, first rank, count, first sequence, offset).  Spark
ranks the pieces of each length (rank inside a task plus a running sum over
tasks) and a piece finds its run by its length and rank.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import kept_table, light_batches, tokenizer_path
from tessera.llm.token_ids import encoder, give_back

LENGTH = 2048
GROUPS = 512
END_ID = 0

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, block int, local bigint, ids binary"


def _cut(path: str, end_id: int, cap: int, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext
        block, enc = TaskContext.get().partitionId(), encoder(path)
        end, seen = np.array([end_id], "<u4").tobytes(), np.zeros(cap + 1, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                docs, texts = (batch.column(c).slice(lo, 512).to_pylist() for c in ("doc_id", "text"))
                rows = []
                for d, raw in zip(docs, enc.encode(texts), strict=True):
                    raw += end
                    n = len(raw) // 4
                    first = n % cap or cap
                    for k, a in enumerate([0, *range(first, n, cap)]):
                        z = first + k * cap
                        own = raw[4 * a:4 * z]
                        rows.append((d, k, a, z - a, zlib.crc32(own), block, int(seen[z - a]), own if with_ids else None))
                        seen[z - a] += 1
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 names=[c.split()[0] for c in _PIECES.split(", ")])
        give_back()
    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """The pieces of every document (null text: empty, so the end id alone), materialised once."""
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    with light_batches(docs.sparkSession):
        return kept_table(rows.mapInArrow(_cut(tokenizer, end_id, length, with_ids), _PIECES))


def _fill(sizes: list[int], stock: list[int], room: int) -> list[int]:
    """Copies of each size, within stock, whose sum comes closest to ``room``."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for s, n in zip(sizes, stock, strict=True):
        steps.append(reach)
        for _ in range(min(n, room // s)):
            new = (reach | (reach << s)) & mask
            if new == reach:
                break
            reach = new
    at, copies = reach.bit_length() - 1, [0] * len(sizes)
    for g in range(len(sizes) - 1, -1, -1):
        while not (steps[g] >> at) & 1:
            at -= sizes[g]
            copies[g] += 1
    return copies


def plan_runs(histogram: dict[int, int], cap: int = LENGTH, groups: int = GROUPS, small: int | None = None):
    """Pack pieces shorter than ``cap`` given the count of each length.

    Returns (runs, sequences): runs are (length, first rank, count, first
    sequence, offset); the i-th piece of a run goes to sequence first + i.
    """
    small = cap // 8 if small is None else small
    cursor: dict[int, int] = dict.fromkeys(histogram, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    total = 0

    def put(length: int, count: int, seq: int, offset: int) -> None:
        runs.append((length, cursor[length], count, seq, offset))
        cursor[length] += count

    # 1. equal-cardinality groups of the large lengths, longest first
    large = [[n, histogram[n]] for n in sorted(histogram, reverse=True) if n > small and histogram[n]]
    share = -(-sum(c for _, c in large) // groups) if large else 0
    grouped: list[list[list[int]]] = []
    left = 0
    for n, c in large:
        while c:
            if not left:
                grouped.append([])
                left = share
            take = min(c, left)
            grouped[-1].append([n, take])
            c, left = c - take, left - take
    sizes = [g[0][0] for g in grouped]
    stock = [sum(c for _, c in g) for g in grouped]

    room: list[list[tuple[int, int]]] = [[] for _ in range(cap + 1)]  # by room: (first sequence, count)
    # 2. configurations
    while any(stock):
        top = next(g for g, n in enumerate(stock) if n)
        rest = [n - (g == top) for g, n in enumerate(stock)]
        copies = _fill(sizes, rest, cap - sizes[top])
        copies[top] += 1
        times = min(stock[g] // k for g, k in enumerate(copies) if k)
        # 3. actual lengths, longest first, slot by slot
        slots = []
        for g, k in enumerate(copies):
            stock[g] -= k * times
            for _ in range(k):
                need, part = times, []
                while need:
                    n, c = grouped[g][0]
                    take = min(c, need)
                    part.append((n, take))
                    need -= take
                    if take == c:
                        grouped[g].pop(0)
                    else:
                        grouped[g][0][1] -= take
                slots.append(part)
        done = 0
        where = [0] * len(slots)
        have = [p[0][1] for p in slots]
        while done < times:
            step, offset = min(have), 0
            for i, p in enumerate(slots):
                n = p[where[i]][0]
                put(n, step, total + done, offset)
                offset += n
                have[i] -= step
                if not have[i] and where[i] + 1 < len(p):
                    where[i] += 1
                    have[i] = p[where[i]][1]
            room[cap - offset].append((total + done, step))
            done += step
        total += times

    # 4. best fit of the small lengths
    free = [r for r in range(cap + 1) if room[r]]
    for n in sorted((x for x in histogram if x <= small), reverse=True):
        count = histogram[n]
        i = bisect.bisect_left(free, n)
        while count and i < len(free):
            r = free[i]
            per = r // n
            old, room[r] = room[r], []
            for seq, m in old:
                full = min(m, count // per)
                odd = count - full * per if full < m else 0
                for t in range(per if full else 0):
                    put(n, full, seq, cap - r + t * n)
                if full:
                    room[r - per * n].append((seq, full))
                if odd:
                    for t in range(odd):
                        put(n, 1, seq + full, cap - r + t * n)
                    room[r - odd * n].append((seq + full, 1))
                if full + bool(odd) < m:
                    room[r].append((seq + full + bool(odd), m - full - bool(odd)))
                count -= full * per + odd
            i += 1
        if count:
            per = cap // n
            full, odd = divmod(count, per)
            for t in range(per if full else 0):
                put(n, full, total, t * n)
            if full:
                room[cap - per * n].append((total, full))
            for t in range(odd):
                put(n, 1, total + full, t * n)
            if odd:
                room[cap - odd * n].append((total + full, 1))
            total += full + bool(odd)
        free = [r for r in range(cap + 1) if room[r]]
    return runs, total


def _placed(runs, cap: int, total: int, schema_names: list[str]):
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 40) + table[:, 1]

    def run(batches):
        give_back(encoders=True)  # all texts are cut
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            seq, offset = total + rank, np.zeros(len(rank), np.int64)
            short = length < cap
            if short.any():
                at = np.searchsorted(keys, (length[short] << 40) + rank[short], side="right") - 1
                seq[short] = table[at, 3] + rank[short] - table[at, 1]
                offset[short] = table[at, 4]
            cols = {"sequence_id": pa.array(seq), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays([cols[c] if c in cols else b.column(c) for c in schema_names], names=schema_names)
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         groups: int = GROUPS, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and ids (little-endian, 32 bits) if asked for.  Every row of
    ``docs`` is packed, repeated ones too; a null id is kept as null; other
    columns are not read.  An empty table gives no piece.
    """
    cut = pieces(docs, tokenizer, length, end_id, with_ids)
    counts = cut.groupBy("block", "length").agg(F.max("local").alias("most"))
    histogram = {r[0]: r[1] for r in counts.where(F.col("length") < length).groupBy("length")
                 .agg(F.sum(F.col("most") + 1).alias("n")).collect()}  # below ``length`` rows
    runs, total = plan_runs(histogram, length, groups)
    base = counts.select(F.col("block").alias("b"), F.col("length").alias("l"),
                         (F.sum(F.col("most") + 1).over(W.partitionBy("length").orderBy("block")) - F.col("most") - 1).alias("base"))
    ranked = (cut.join(base, (F.col("block") == F.col("b")) & (F.col("length") == F.col("l")))
              .withColumn("rank", F.col("base") + F.col("local")))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    schema = ", ".join(f"{c} {'int' if c == 'piece' else 'binary' if c == 'ids' else 'bigint'}" for c in names)
    need = [c for c in names if c not in ("sequence_id", "offset")] + ["rank"]
    return ranked.select(*need).mapInArrow(_placed(runs, length, total, names), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids (binary), from the pieces of ``pack(..., with_ids=True)``; a group is one sequence."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.aggregate(
        own, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
