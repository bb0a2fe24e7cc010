"""The corpus pipeline: five stages over ``documents``, each one operator of tessera.llm.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it
as Parquet into the shared folder and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import best_fit_packing, jaccard_join, language_id, line_templates, source_mixing
from tessera.llm.common import WORD, Tables, broadcast_if_light
from tessera.session import scratch_path
from tessera.sources.tables import table

NEAR = {"percent": 80, "width": 5}  # the stage's own; 90 and three words are op8's contract
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a language: no text or no letter.  Learns from its own input."""
    profiles = language_id.learn_from_rest(docs)
    found = language_id.predict(docs, profiles, keep=COLUMNS[2:], keep_text=True)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines, and documents of which these leave no word."""
    out = line_templates.drop_recurring_lines(docs, keep=COLUMNS[2:4], **line_templates.WHOLE_JOB)
    out = out.where((F.col("n_dropped") == 0) | F.col("text").rlike(WORD))
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the least id, a null id last; of rows that repeat it, one."""
    found = Tables(spark).keep(jaccard_join.representatives(docs, **NEAR))
    rows = docs.select(*COLUMNS, jaccard_join.text_hash().alias("th"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("th") == F.col("keep_th"))
    out = rows.join(found.where("copies = 1"), same, "left_semi").select(*COLUMNS)
    repeated = found.where("copies > 1")
    if repeated.isEmpty():
        return out
    repeated = rows.join(broadcast_if_light(repeated, F.lit(24)), same, "left_semi")
    return out.union(repeated.groupBy("doc_id", "th").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents to the tempered shares of source, language and topic, with all tokens as the budget.

    A document is taken once at most, so cells that should grow stay whole.
    """
    return source_mixing.mix(docs, budget=source_mixing.WHOLE, keep=COLUMNS).where("kept").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens: one row per piece."""
    return best_fit_packing.pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

# raking, packing and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
