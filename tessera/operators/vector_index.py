"""Exact top-k by dot product over a metric index.

Vectors are assigned to the nearest of a bounded number of pivots, and each
pivot's vectors are cut into rings by their distance to it.  For a query q and a
cell (pivot c, distances d_lo .. d_hi, norms up to n_hi) the triangle inequality
bounds every dot product in the cell without looking at a vector:

    q.x <= q.c + |q| d_hi
    q.x <= (|q|^2 + n_hi^2 - gap^2) / 2,   gap = max(0, |q - c| - d_hi, d_lo - |q - c|)

Cells are visited in the order of their bounds, in rounds that take more and
more of them; a query is done when no unvisited cell's bound reaches its k-th
score.  What is returned is exact: a cell is left out only if nothing in it can
be among the k.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.functions.vectors import dot, l2_normalize, norm
from tessera.operators.profiles import top_k
from tessera.session import broadcast_if_light, cut_lineage

PIVOTS = 64
RINGS = 8
FIRST_VISIT = 4     # a first round visits cells with at least this many times k vectors
GROWTH = 4          # each further round visits so many times more
SLACK = 1e-9        # on bounds, for rounding
VISIT_BYTES = 32 << 20


@dataclass
class VectorIndex:
    """``rows``: vec_id, embedding, cell, ring; ``cells``: one row per (cell, ring), at most pivots x rings."""

    rows: DataFrame
    cells: DataFrame


def _assign(pivots: np.ndarray):
    squares = (pivots * pivots).sum(axis=1)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            cell = np.argmin(squares - 2 * (x @ pivots.T), axis=1)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(cell, pa.int32()), pa.array(away), pa.array(np.sqrt((x * x).sum(axis=1)))],
                names=["vec_id", "embedding", "cell", "away", "size"])
    return run


def build(vectors: DataFrame, pivots: int = PIVOTS, rings: int = RINGS) -> VectorIndex:
    """Index of ``vectors`` (vec_id, embedding).

    Pivots are the vectors with the least id hashes, so they follow the data's
    density.  A null embedding has no score and is not indexed.  The index is
    one checkpoint; the driver sees the pivots alone.
    """
    vectors = vectors.where(F.col("embedding").isNotNull())
    kind = vectors.schema["embedding"].dataType.simpleString()
    chosen = vectors.select(F.xxhash64("vec_id").alias("h"), "embedding").orderBy("h").limit(pivots).select("embedding").toArrow()
    centres = [np.array(v, np.float64) for v in chosen.column("embedding").to_pylist()]
    if not centres:
        empty = vectors.select("vec_id", "embedding", F.lit(0).alias("cell"), F.lit(0).alias("ring"))
        cells = empty.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.lit(0.0).alias("d_lo"), F.lit(0.0).alias("d_hi"),
                                                  F.lit(0.0).alias("n_hi"), F.first("embedding").alias("pivot"))
        return VectorIndex(empty, cells)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, embedding {kind}, cell int, away double, size double"
    rows = cut_lineage(vectors.select("vec_id", "embedding").mapInArrow(_assign(np.array(centres)), schema))
    radius = rows.groupBy(F.col("cell").alias("of")).agg(F.max("away").alias("radius"))
    rows = rows.join(F.broadcast(radius), F.col("cell") == F.col("of"))  # one row a pivot
    ring = F.when(F.col("radius") > 0, F.least(F.lit(rings - 1), F.floor(F.col("away") / F.col("radius") * rings))).otherwise(0).cast("int")
    rows = rows.select("vec_id", "embedding", "cell", ring.alias("ring"), "away", "size")
    cells = rows.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("d_lo"), F.max("away").alias("d_hi"), F.max("size").alias("n_hi"))
    spots = rows.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "of int, pivot array<double>")
    cells = cut_lineage(cells.join(F.broadcast(spots), F.col("cell") == F.col("of")).drop("of"))
    return VectorIndex(rows.select("vec_id", "embedding", "cell", "ring"), cells)


def _bounds(index: VectorIndex, queries: DataFrame) -> DataFrame:
    """Per query and cell the largest dot product that can be in it, and how many vectors lie in cells with larger bounds."""
    # at most pivots x rings cells, one array value for all queries
    cells = index.cells.agg(F.collect_list(F.struct("cell", "ring", "n", "d_lo", "d_hi", "n_hi", "pivot"))).scalar()
    met = queries.select("query_id", "qv", F.explode(cells).alias("x")).select("query_id", "qv", "x.*")
    q2 = F.pow(norm("qv"), F.lit(2))
    apart = F.sqrt(F.aggregate(F.zip_with("qv", "pivot", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    met = met.withColumn("apart", apart)
    gap = F.greatest(F.lit(0.0), F.col("apart") - F.col("d_hi"), F.col("d_lo") - F.col("apart"))
    bound = F.least(dot("qv", "pivot") + norm("qv") * F.col("d_hi"), (q2 + F.col("n_hi") * F.col("n_hi") - gap * gap) / 2) + SLACK
    met = met.select("query_id", "cell", "ring", "n", bound.alias("bound"))
    order = W.partitionBy("query_id").orderBy(F.desc("bound"), "cell", "ring").rowsBetween(W.unboundedPreceding, -1)
    return cut_lineage(met.withColumn("ahead", F.coalesce(F.sum("n").over(order), F.lit(0))))


def search(index: VectorIndex, queries: DataFrame, k: int) -> DataFrame:
    """query_label, query_id, rank, vec_id, score: the ``k`` highest dot products with each L2-normalised
    ``queries`` row (query_id, query_label, query_vec); equal scores go to the lower vec_id."""
    return search_counted(index, queries, k)[0]


def search_counted(index: VectorIndex, queries: DataFrame, k: int) -> tuple[DataFrame, int]:
    """As :func:`search`, with the number of (query, vector) pairs that were scored."""
    queries = cut_lineage(queries.select("query_id", "query_label", l2_normalize("query_vec").alias("qv")))
    left = _bounds(index, queries)
    best, scored_pairs, quota = None, 0, FIRST_VISIT * k
    while True:
        now = left.where(F.col("ahead") < quota)
        scored_pairs += now.agg(F.sum("n")).first()[0] or 0
        visit = now.select("query_id", F.col("cell").alias("c"), F.col("ring").alias("r")).join(queries.select("query_id", "qv"), "query_id")
        visit = broadcast_if_light(cut_lineage(visit), F.size("qv") * 8, VISIT_BYTES)
        scored = index.rows.join(visit, (F.col("cell") == F.col("c")) & (F.col("ring") == F.col("r"))).select(
            "query_id", "vec_id", dot("embedding", "qv").alias("score"))
        both = scored if best is None else best.select("query_id", "vec_id", "score").unionByName(scored)
        best = cut_lineage(top_k(both, ["query_id"], [F.desc("score"), F.asc("vec_id")], k))
        reached = best.where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").alias("least"))
        left = left.where(F.col("ahead") >= quota).join(reached, F.col("query_id") == F.col("of"), "left")
        left = cut_lineage(left.where(F.col("least").isNull() | (F.col("bound") >= F.col("least"))).drop("of", "least"))
        if left.isEmpty():
            break
        quota = max(quota * GROWTH, left.agg(F.min("ahead")).first()[0] + 1)
    out = best.join(queries.select(F.col("query_id").alias("of"), "query_label"), F.col("query_id") == F.col("of"))
    return out.select("query_label", "query_id", "rank", "vec_id", F.round("score", 6).alias("score")), scored_pairs
