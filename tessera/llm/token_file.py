"""Operator 3: token-id shards with a minimal perfect hash index.

``write`` encodes whole texts, range-partitions the documents by id and writes

* ``payload``: one row per shard, raw little-endian ids of a run of documents
  in ascending id order, with their ids and offsets;
* ``index``: one row per bucket of keys.  A bucket holds a minimal perfect hash
  (hash and displace: groups of keys share a displacement that sends every key
  to a slot of its own, n slots for n keys) and, per slot, a 32-bit fingerprint
  and the place (part, shard, offset, length) of the document.

``lookup`` finds a key in constant time: bucket, displacement, slot,
fingerprint, then one slice of one shard.  Buckets are built and read in
separate tasks; both tables are Parquet written by Spark's commit protocol, so
lost executors leave no half-written shard.  The only global step is a running
sum over one row per partition.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import tokenizer_path
from tessera.llm.token_ids import encoder, give_back

SHARD_IDS = 1 << 20
BUCKET_KEYS = 4096
END_ID = 1

_PAYLOAD = "part int, seq int, n_ids bigint, doc_ids array<bigint>, copies array<int>, offsets array<bigint>, payload binary"
_INDEX = ("bucket bigint, n_keys int, shift binary, fingerprint binary, part binary, seq binary, offset binary, length binary")


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _slots(h2: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    """Slot of each key from its second hash and its group's displacement (below 0: the slot itself)."""
    with np.errstate(over="ignore"):
        free = _mix(h2 + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)
    return np.where(shift < 0, -shift - 1, free.astype(np.int64))


def build_mph(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Displacements (int64, one per group) of a minimal perfect hash of the keys (h1, h2), uint64 each."""
    n = len(h1)
    groups = max(1, -(-n // 3))
    of = (h1 % np.uint64(groups)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    lo = np.searchsorted(of[order], np.arange(groups + 1))
    sizes = np.diff(lo)
    shift, used = np.zeros(groups, np.int64), np.zeros(n, bool)
    for size in sorted(set(sizes.tolist()) - {0, 1}, reverse=True):
        left = np.flatnonzero(sizes == size)
        keys = h2[order[lo[left][:, None] + np.arange(size)]]
        for d in range(1 << 22):  # all groups of this size try the same displacement at once
            slots = _slots(keys, np.full(keys.shape, d, np.int64), n)
            fits = ~used[slots].any(axis=1) & (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
            # of groups that want one slot the first gets it
            at = np.flatnonzero(fits)
            flat = slots[at].ravel()
            _, first = np.unique(flat, return_index=True)
            won = np.bincount(first // size, minlength=len(at)) == size
            used[slots[at[won]].ravel()] = True
            shift[left[at[won]]] = d
            rest = np.ones(len(left), bool)
            rest[at[won]] = False
            left, keys = left[rest], keys[rest]
            if not len(left):
                break
        else:
            raise ValueError("keys are not distinct")
    single = np.flatnonzero(sizes == 1)
    shift[single] = -np.flatnonzero(~used)[:len(single)] - 1
    return shift


def mph_slot(h1: np.ndarray, h2: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    return _slots(h2, shift[(h1 % np.uint64(len(shift))).astype(np.int64)], n)


def _bucket_row(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    shift = build_mph(h1, h2)
    slot = mph_slot(h1, h2, shift, len(h1))
    at = np.empty(len(h1), np.int64)
    at[slot] = np.arange(len(h1))
    row = {"bucket": [pdf["bucket"].iloc[0]], "n_keys": [len(h1)], "shift": [shift.astype("<i8").tobytes()],
           "fingerprint": [(h1[at] >> np.uint64(32)).astype("<u4").tobytes()]}
    for c in ("part", "seq", "offset", "length"):
        row[c] = [pdf[c].to_numpy(np.int64)[at].astype("<i8").tobytes()]
    return pd.DataFrame(row)


def _find(key: tuple, keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Place of each key of one bucket; keys whose slot holds another fingerprint are absent."""
    if keys.empty or index.empty:
        return pd.DataFrame({"key": pd.Series([], dtype=object)} | {c: np.zeros(0, np.int64) for c in ("part", "seq", "offset", "length")})
    row = index.iloc[0]
    h1, h2 = (keys[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    slot = mph_slot(h1, h2, np.frombuffer(row["shift"], "<i8"), int(row["n_keys"]))
    there = np.frombuffer(row["fingerprint"], "<u4")[slot] == (h1 >> np.uint64(32)).astype(np.uint32)
    out = {"key": keys["key"].to_numpy()[there]}
    for c in ("part", "seq", "offset", "length"):
        out[c] = np.frombuffer(row[c], "<i8")[slot][there]
    return pd.DataFrame(out)


def _hashed(df: DataFrame, buckets: int) -> DataFrame:
    return (df.withColumn("h1", F.xxhash64("key")).withColumn("h2", F.xxhash64("key", F.lit("second")))
            .withColumn("bucket", F.pmod(F.xxhash64("key", F.lit("bucket")), F.lit(buckets))))


def _key(doc_id, copy):
    """Documents that repeat an id are told apart by their number among them."""
    return F.concat_ws("#", F.coalesce(doc_id.cast("string"), F.lit("null")), F.when(copy > 0, copy.cast("string")))


def _encode(path: str, end_id: int, shard_ids: int, id_bytes: int):
    def run(batches):
        from pyspark import TaskContext
        part, enc = TaskContext.get().partitionId(), encoder(path)
        seq, last, copy = 0, object(), 0
        ids, copies, offsets, chunks = [], [], [0], []
        end = np.array([end_id], "<u4").tobytes()

        def shard():
            row = [[part], [seq], [offsets[-1]], [ids], [copies], [offsets], [b"".join(chunks)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
                                                      pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()), strict=True)],
                names=["part", "seq", "n_ids", "doc_ids", "copies", "offsets", "payload"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                doc, text = (batch.column(c).slice(lo, 512).to_pylist() for c in ("doc_id", "text"))
                for d, raw in zip(doc, enc.encode(text), strict=True):
                    raw += end
                    copy = copy + 1 if d == last else 0
                    last = d
                    if ids and offsets[-1] + len(raw) // 4 > shard_ids:
                        yield shard()
                        seq, ids, copies, offsets, chunks = seq + 1, [], [], [0], []
                    ids.append(d)
                    copies.append(copy)
                    offsets.append(offsets[-1] + len(raw) // 4)
                    chunks.append(raw if id_bytes == 4 else np.frombuffer(raw, "<u4").astype("<u2").tobytes())
        if ids:
            yield shard()
        give_back()
    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
          shard_ids: int = SHARD_IDS, id_bytes: int = 2, bucket_keys: int = BUCKET_KEYS) -> None:
    """Encode ``docs`` (doc_id, text) and write the shards and their index below ``path``.

    Null texts count as empty, so they hold the end id alone.  Documents lie in
    ascending id order (null first; equal ids by text).  Other columns are not
    read.  ``id_bytes`` is 2 for vocabularies below 65,536 ids, else 4.  A shard
    closes before it passes ``shard_ids``; a longer document has one of its own.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_encode(tokenizer, end_id, shard_ids, id_bytes), _PAYLOAD)
     .write.mode("overwrite").option("parquet.block.size", str(16 << 20)).parquet(f"{path}/payload"))
    records = _records(spark, path)
    buckets = records.count() // bucket_keys + 1
    (_hashed(records, buckets).select("bucket", "h1", "h2", "part", "seq", "offset", "length")
     .groupBy("bucket").applyInPandas(_bucket_row, _INDEX)
     .withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/index"))


def _records(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document from the shards' headers: key and place."""
    shards = spark.read.schema(_PAYLOAD).parquet(f"{path}/payload").select("part", "seq", "doc_ids", "copies", "offsets")
    each = shards.select("part", "seq", "offsets", F.posexplode(F.arrays_zip("doc_ids", "copies")).alias("i", "r"))
    return each.select(_key(F.col("r.doc_ids"), F.col("r.copies")).alias("key"), "part", "seq",
                       F.get("offsets", F.col("i")).alias("offset"),
                       (F.get("offsets", F.col("i") + 1) - F.get("offsets", F.col("i"))).alias("length"))


def places(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """key, part, seq, offset, length of the stored documents among ``keys`` (key string), through the index."""
    index = spark.read.schema(_INDEX + ", buckets bigint").parquet(f"{path}/index")
    first = index.select("buckets").first()
    asked = _hashed(keys.select("key"), first[0] if first else 1)
    return (asked.groupBy("bucket").cogroup(index.drop("buckets").groupBy("bucket"))
            .applyInPandas(_find, "key string, part bigint, seq bigint, offset bigint, length bigint"))


def lookup(spark: SparkSession, path: str, keys: DataFrame, id_bytes: int = 2) -> DataFrame:
    """key and raw ids (binary, little-endian, ``id_bytes`` each) of the stored documents among ``keys``."""
    shards = spark.read.schema(_PAYLOAD).parquet(f"{path}/payload").select("part", "seq", "payload")
    return (places(spark, path, keys).join(shards, ["part", "seq"])
            .select("key", F.substring("payload", (F.col("offset") * id_bytes + 1).cast("int"),
                                       (F.col("length") * id_bytes).cast("int")).alias("ids")))


def _digests(id_bytes: int):
    def run(batches):
        give_back(encoders=True)  # the file is written
        for b in batches:
            for part, seq, docs, copies, offsets, payload in zip(*(b.column(c).to_pylist() for c in (
                    "part", "seq", "doc_ids", "copies", "offsets", "payload")), strict=True):
                ids = np.frombuffer(payload, f"<u{id_bytes}").astype("<u4")
                n = len(docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * n, pa.int64()), pa.array([seq] * n, pa.int64()), pa.array(offsets[:-1], pa.int64()),
                    pa.array(docs, pa.int64()), pa.array(copies, pa.int32()),
                    pa.array([zlib.crc32(ids[a:z].tobytes()) for a, z in zip(offsets, offsets[1:], strict=False)], pa.int64())],
                    names=["part", "seq", "offset", "doc_id", "copy", "ids_crc32"])
    return run


def read_back(spark: SparkSession, path: str, id_bytes: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document.

    Every key is looked up in the index, and the document at the place it names
    must have that key: an index that mixes two keys up loses both.  The shard
    bytes there give the checksum, and the shards before it give the start.
    """
    shards = spark.read.schema(_PAYLOAD).parquet(f"{path}/payload")
    ids = (shards.select("part", "seq", "doc_ids", "copies", "offsets", "payload")
           .mapInArrow(_digests(id_bytes), "part bigint, seq bigint, offset bigint, doc_id bigint, copy int, ids_crc32 bigint")
           .withColumn("key", _key(F.col("doc_id"), F.col("copy"))))
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per partition
    before = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    within = sizes.select("part", "seq", (F.sum("n_ids").over(W.partitionBy("part").orderBy("seq")) - F.col("n_ids")).alias("inner"))
    starts = within.join(before, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("first"))
    found = places(spark, path, _records(spark, path))
    return (found.join(ids, ["part", "seq", "offset", "key"]).join(starts, ["part", "seq"])
            .select("doc_id", (F.col("first") + F.col("offset")).alias("start"), F.col("length").alias("n_tokens"), "ids_crc32"))
