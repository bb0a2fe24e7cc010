"""A table kept by micro-batches, bucketed by a hash of its key (state of ST01-ST03).

    <path>/batch_id=<n>/bucket=<b>/...     what batch n added
    <path>/_compact/<n>/bucket=<b>/...     a bucket's older pieces as one
    <path>/_manifest/<n>                   which folders make up the table after batch n

A batch reads only the buckets its rows fall into, and of these only the columns
it asks for.  A bucket of more than ``max_pieces`` pieces is compacted, so the
files a batch reads do not grow with the number of batches before it.

A batch is in the table when its manifest is: the manifest is written beside its
place and renamed into it, which is one atomic step.  A crash before that leaves
the table as it was, and the batch, run again, overwrites what it had written.
Each batch starts from the newest manifest *before* its own number, so running a
batch twice gives the same table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32
MAX_PIECES = 8


class BucketStore:
    """``keys`` decide the bucket; ``schema`` is the DDL of the rows.  ``merge`` turns a bucket's rows into fewer ones when
    it is compacted (by default they stay)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = BUCKETS,
                 max_pieces: int = MAX_PIECES, merge: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.buckets, self.max_pieces, self.merge = buckets, max_pieces, merge
        jvm = spark._jvm.org.apache.hadoop.fs
        self._file = jvm.Path
        self._fs = jvm.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # -- manifests ------------------------------------------------------------------

    def _versions(self) -> list[int]:
        folder = self._file(f"{self.path}/_manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def pieces(self, before: int | None = None) -> dict[int, list[str]]:
        """Bucket -> folders of the newest manifest (of a batch before ``before``)."""
        versions = [v for v in self._versions() if before is None or v < before]
        if not versions:
            return {}
        text = self.spark.read.option("wholetext", "true").text(f"{self.path}/_manifest/{versions[-1]}").first()[0]
        return {int(b): own for b, own in json.loads(text).items()}

    def _switch(self, batch_id: int, pieces: dict[int, list[str]]) -> None:
        """Writes the manifest of a batch beside its place and renames it: from here on the batch is in the table."""
        text = json.dumps({str(b): own for b, own in sorted(pieces.items())})
        waiting, place = self._file(f"{self.path}/_manifest/.{batch_id}"), self._file(f"{self.path}/_manifest/{batch_id}")
        out = self._fs.create(waiting, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if self._fs.exists(place):  # the batch runs again
            self._fs.delete(place, False)
        if not self._fs.rename(waiting, place):
            raise OSError(f"cannot rename the manifest of batch {batch_id}")

    # -- rows ---------------------------------------------------------------------------

    def _load(self, folders: list[str], columns: list[str] | None) -> DataFrame:
        if folders:
            df = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])
        else:
            df = self.spark.createDataFrame([], self.schema)
        return df.select(*columns) if columns else df

    def read(self, columns: list[str] | None = None, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The table (after the batches before ``before``), or some buckets of it."""
        pieces = self.pieces(before)
        return self._load([f for b in (pieces if buckets is None else buckets) for f in pieces.get(b, [])], columns)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that ``rows`` fall into: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Appends a batch's rows; buckets that have too many pieces by then are compacted first."""
        pieces = self.pieces(before=batch_id)
        names = [f.name for f in self._load([], None).schema.fields]
        folder = f"batch_id={batch_id}"
        (rows.select(*names, self.bucket().alias("bucket")).repartition(F.col("bucket")).write.mode("overwrite")
         .partitionBy("bucket").parquet(f"{self.path}/{folder}"))
        new = self._buckets_in(folder)
        heavy = [b for b in new if len(pieces.get(b, [])) + 1 > self.max_pieces]
        for b in new:
            pieces.setdefault(b, []).append(f"{folder}/bucket={b}")
        if heavy:
            place = f"_compact/{batch_id}"
            old = self._load([f for b in heavy for f in pieces[b]], None)
            old = self.merge(old) if self.merge else old
            (old.select(*names, self.bucket().alias("bucket")).repartition(F.col("bucket")).write.mode("overwrite")
             .partitionBy("bucket").parquet(f"{self.path}/{place}"))
            for b in heavy:
                pieces[b] = [f"{place}/bucket={b}"]
        self._switch(batch_id, pieces)

    def _buckets_in(self, folder: str) -> list[int]:
        found = [s.getPath().getName() for s in self._fs.listStatus(self._file(f"{self.path}/{folder}"))]
        return sorted(int(n.removeprefix("bucket=")) for n in found if n.startswith("bucket="))
