"""Operator 10: exact dedup by deterministic block naming.

The normalised text (white space deleted) is cut into blocks of a fixed number
of characters.  Equal blocks get equal integer names and different blocks
different ones; then neighbouring names are named in pairs, level by level,
until each document has one name (Karp, Miller and Rosenberg).  Two documents
are equal when their lengths and last names agree.

A name is (bucket, rank): the bucket is a 64-bit hash of the unit, the rank its
place among the *different* units of that bucket in sorted order.  One
aggregate per level over the distinct units finds the buckets that hold more
than one.  There are almost none, so ranks are
sorted and joined only for those, and no block text is joined back.  Names
depend on the units alone, never on partitions, so a task that runs again
gives the same names.  Different units never share a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import kept_table, no_space

BLOCK_CHARS = 2048


def _bucket(unit: Column, bits: int) -> Column:
    h = F.xxhash64(unit)
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def _named(docs: DataFrame, bits: int) -> DataFrame:
    """Replace the array ``units`` by the array ``names`` of (bucket, rank)."""
    # explode_outer: explode would infer a filter below that computes the units a second time
    units = docs.select(F.explode_outer("units").alias("unit")).withColumn("bucket", _bucket(F.col("unit"), bits))
    mixed = (units.groupBy("bucket", "unit").agg(F.lit(1)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("bucket"))
    mixed = kept_table(mixed)
    if mixed.isEmpty():
        return docs.withColumn("names", F.transform("units", lambda u: F.struct(
            _bucket(u, bits).alias("bucket"), F.lit(0).alias("rank")))).drop("units")
    ranked = (units.join(mixed, "bucket").distinct()
              .withColumn("rank", F.row_number().over(W.partitionBy("bucket").orderBy("unit")) - 1))
    # one document's names are bounded by its own length
    per_doc = (docs.select("doc_id", "sha", F.posexplode("units").alias("pos", "unit")).distinct()
               .withColumn("bucket", _bucket(F.col("unit"), bits))
               .join(ranked, ["bucket", "unit"], "left")
               .groupBy("doc_id", "sha")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "bucket", F.coalesce("rank", F.lit(0)).alias("rank")))).alias("n")))
    per_doc = per_doc.select(F.col("doc_id").alias("d"), F.col("sha").alias("s"),
                             F.transform("n", lambda x: F.struct(x["bucket"].alias("bucket"), x["rank"].alias("rank"))).alias("names"))
    return (docs.drop("units").join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("sha") == F.col("s")))
            .drop("d", "s"))


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS, name_bits: int = 64) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, n_norm, sha, name.

    ``name_bits`` makes the buckets smaller, so that tests reach the ranked names.
    """
    text = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("raw"))
    text = text.select("doc_id", F.length("raw").cast("long").alias("n_chars"), no_space(F.col("raw")).alias("t"))
    last = (F.greatest(F.length("t"), F.lit(1)) - 1) / F.lit(block_chars)
    rows = text.select("doc_id", "n_chars", F.length("t").cast("long").alias("n_norm"), F.sha2(F.encode("t", "UTF-8"), 256).alias("sha"),
                       F.transform(F.sequence(F.lit(0), F.floor(last).cast("int")),
                                   lambda i: F.substring(F.col("t"), i * block_chars + 1, F.lit(block_chars))).alias("units"))
    rows = kept_table(_named(rows, name_bits))
    most = rows.agg(F.max(F.size("names"))).first()[0] or 1
    while most > 1:
        pairs = F.transform(F.sequence(F.lit(0), ((F.size("names") - 1) / F.lit(2)).cast("int")),
                            lambda i: F.struct(F.get("names", i * 2).alias("a"), F.get("names", i * 2 + 1).alias("b")))
        rows = kept_table(_named(rows.withColumn("units", pairs).drop("names"), name_bits))
        most = (most + 1) // 2
    return rows.select("doc_id", "n_chars", "n_norm", "sha", F.get("names", F.lit(0)).alias("name"))


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS, name_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Texts are equal when identical without white space; null counts as empty,
    and all empty texts form one group.  The longest original text stays, then
    the smallest doc_id (a null id comes last).  Rows that repeat a doc_id and
    its text are the same document and share one verdict.  Other columns are
    not read.  An empty table gives an empty result.
    """
    rows = identities(docs, block_chars, name_bits)
    best = rows.groupBy("n_norm", "name").agg(
        F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"))).alias("best"),
        F.count(F.lit(1)).alias("group_size"))
    best = best.select(F.col("n_norm").alias("g_norm"), F.col("name").alias("g_name"),
                       F.col("best.id").alias("keep_id"), (-F.col("best.n")).alias("keep_chars"), "group_size")
    out = rows.join(best, (F.col("n_norm") == F.col("g_norm")) & (F.col("name") == F.col("g_name")))
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
                      F.col("sha").alias("text_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k
  FROM documents),
g AS (
  SELECT doc_id, n, k, count(*) OVER (PARTITION BY k) AS group_size,
         first_value(doc_id) OVER (PARTITION BY k ORDER BY n DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM g
"""
