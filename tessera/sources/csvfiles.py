"""CSV sources and sinks.

Everything is read as text (never inferred) like the editor, which keeps
every cell a string.  The quoted reader uses Spark's own CSV parser
(``multiLine``, ``""`` escape, ``DROPMALFORMED``); no hand-written parser.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage, scratch_path

CSV_TEXT_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


class CsvFormatError(ValueError):
    """Empty file (no header) or duplicate header names."""


def read_csv(spark: SparkSession, path: str, required=None) -> DataFrame:
    """Header CSV, every column text; input splits replace the
    reference's row chunks (``spark.sql.files.maxPartitionBytes``)."""
    df = spark.read.options(**CSV_TEXT_OPTIONS).option("inferSchema", "false").csv(path)
    if required:
        from tessera.sources.tables import require_columns
        require_columns(df, required)
    return df


def normalise_line_endings(spark: SparkSession, path: str) -> str:
    """CRLF / CR -> LF for whole files (one task per file), written to a
    fresh folder below the shared checkpoint dir; returns that folder."""
    out = scratch_path(spark, "csv-lf")
    txt = spark.read.option("wholetext", "true").text(path)
    txt.select(F.regexp_replace("value", "\r\n?", "\n").alias("value")).write.option("lineSep", "\n").text(out)
    return out


def read_quoted_csv(spark: SparkSession, path: str, normalise: bool = False) -> DataFrame:
    """Quoted CSV text.  First row is the header; ``""`` escapes a quote;
    newlines may sit inside quotes; rows with the wrong number of fields are
    dropped (``DROPMALFORMED``); all-blank rows are dropped; an empty file or
    a repeated header name is an error.  ``normalise`` first rewrites mixed
    line endings (needed only when quoted fields hold line breaks)."""
    src = normalise_line_endings(spark, path) if normalise else path
    header = spark.read.options(**CSV_TEXT_OPTIONS).option("multiLine", "true").csv(src)
    cols = header.columns
    if not cols:
        raise CsvFormatError("empty CSV: no header row")
    if len(set(cols)) != len(cols):
        dup = sorted({c for c in cols if cols.count(c) > 1})
        raise CsvFormatError("duplicate header names: " + ", ".join(dup))
    schema = ", ".join(f"`{c}` string" for c in cols)
    df = (spark.read.options(**CSV_TEXT_OPTIONS).option("multiLine", "true").option("mode", "DROPMALFORMED")
          .schema(schema).csv(src))
    non_blank = reduce(lambda a, b: a | b, [F.length(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit("")))) > 0 for c in cols])
    return df.where(non_blank)


CORRUPT = "_corrupt_record"


def read_csv_with_rejects(spark: SparkSession, path: str, columns: list[str], header: bool = True, multi_line: bool = False):
    """(good rows, rejected lines) of a quoted CSV; nothing is lost in silence.

    ``PERMISSIVE`` mode with a corrupt-record column: a line with fewer or more
    fields than ``columns``, or with an unterminated quote, is a reject and keeps
    its raw text (column ``line``) and file (``path``).  All-blank lines are
    neither.  The file is parsed once, into a checkpoint both frames come from.
    """
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    raw = (spark.read.options(**(CSV_TEXT_OPTIONS | {"header": str(header).lower()})).option("multiLine", str(multi_line).lower())
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", "true").schema(schema).csv(path))
    rows = cut_lineage(raw.select(*[F.col(f"`{c}`") for c in columns], F.col(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("path")))
    blank = reduce(lambda a, b: a & b, [F.length(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit("")))) == 0 for c in columns])
    good = rows.where(F.col("line").isNull() & ~blank).select(*[F.col(f"`{c}`") for c in columns])
    return good, rows.where(F.col("line").isNotNull()).select("line", "path")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header row; fields quoted only when needed, inner quotes doubled."""
    (df.write.mode(mode).options(**CSV_TEXT_OPTIONS).option("quoteAll", "false")
     .option("lineSep", "\n").csv(path))
    return path


def append_csv(df: DataFrame, path: str) -> str:
    """Append rows; every part file carries its own header, and readers
    use ``header=true`` so each part is read correctly."""
    return write_csv(df, path, mode="append")


def as_text_columns(df: DataFrame) -> DataFrame:
    """Every column cast to string (the editor's data model)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
