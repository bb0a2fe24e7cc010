"""Content-hash dedup, versioning and batch ingest.

Input rows: ``(seq, ticket_id, content)``; ``seq`` is the arrival order.
"First wins" is always ``min(struct(seq, ...))`` per key -- an aggregate with
map-side partial reduction -- rather than a ``row_number`` window, so a hot
hash or ticket never has to sit in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import content_hash
from tessera.operators import segmented
from tessera.session import shared

# fixed values: reasons an insert is not created
EXISTS = "exists"
HASH_TAKEN = "hash_taken"


def with_hash(items: DataFrame, col: str = "content") -> DataFrame:
    """Add the SHA-256 content hash."""
    return items.withColumn("content_hash", content_hash(col))


def first_per_hash(items: DataFrame) -> DataFrame:
    """The first row of every content hash (global uniqueness)."""
    h = with_hash(items)
    f = h.groupBy("content_hash").agg(F.min(F.struct("seq", "ticket_id", "content")).alias("f"))
    return f.select("f.seq", "f.ticket_id", "f.content", "content_hash")


def insert_if_absent(items: DataFrame) -> DataFrame:
    """D03 / J08 in arrival order: ``created`` for the first row of a hash;
    a later row of the same ticket already exists; a later row of another
    ticket is rejected because the hash is taken."""
    h = with_hash(items)
    first = h.groupBy("content_hash").agg(F.min(F.struct("seq", "ticket_id")).alias("f"))
    j = h.join(first, "content_hash")
    created = F.col("seq") == F.col("f.seq")
    reason = F.when(created, F.lit(None).cast("string")).when(F.col("ticket_id") == F.col("f.ticket_id"), F.lit(EXISTS)).otherwise(F.lit(HASH_TAKEN))
    return j.select("seq", "ticket_id", "content_hash", created.alias("created"), reason.alias("reason"))


def _firsts(items: DataFrame) -> DataFrame:
    """One row per ticket and distinct content: where it came first."""
    return with_hash(items).groupBy("ticket_id", "content_hash").agg(
        F.min("seq").alias("first_seq"), F.first("content").alias("content")).select("ticket_id", "content_hash", "first_seq", "content")


def versions(items: DataFrame) -> DataFrame:
    """D04 + W05 + W06: per ticket, every new distinct content is a version
    (1, 2, ... by first arrival); repeats of earlier content are ignored;
    ``is_latest`` marks the highest version."""
    firsts = shared(_firsts(items))
    v = segmented.ranked(firsts, ["ticket_id"], ["first_seq"], out="version", method="row_number")
    top = firsts.groupBy(F.col("ticket_id").alias("_t")).agg(F.count(F.lit(1)).alias("_max"))
    return (v.join(top, F.col("ticket_id").eqNullSafe(F.col("_t")))
            .withColumn("is_latest", F.col("version") == F.col("_max")).drop("_max", "_t"))


def latest(items: DataFrame) -> DataFrame:
    """The latest version of each ticket: its number is the count
    of the ticket's distinct contents, so nothing is ranked."""
    return _firsts(items).groupBy("ticket_id").agg(
        F.count(F.lit(1)).alias("max_version"), F.max(F.struct("first_seq", "content", "content_hash")).alias("l")).select(
        "ticket_id", "max_version", "l.content", "l.content_hash")


def batch_ingest(store: DataFrame, batch: DataFrame) -> DataFrame:
    """D05 + J03 + W12: new rows of a batch.

    Hashes already stored for *any* ticket named in the batch are skipped
    (``left_semi`` on tickets, then ``left_anti`` on hashes), and repeats
    inside the batch keep their first row.  The row count is the number the
    reference returns.
    """
    s = with_hash(store)
    b = with_hash(batch)
    batch_tickets = b.select("ticket_id").distinct()
    existing = s.join(batch_tickets, "ticket_id", "left_semi").select("content_hash").distinct()
    fresh = b.join(existing, "content_hash", "left_anti")
    f = fresh.groupBy("content_hash").agg(F.min(F.struct("seq", "ticket_id", "content")).alias("f"))
    return f.select("f.seq", "f.ticket_id", "f.content", "content_hash")
