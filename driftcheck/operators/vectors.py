"""Exact top-k of a table of vectors for a table of queries, in blocks.

Queries are cut into blocks whose bytes are bounded; each block is broadcast
and meets every vector once. A task multiplies its block with its vectors in
tiles of a bounded number of scores and keeps the k best of each query, with
every tie that could still count; a window over (block, query) merges the tasks. No pair becomes a row
before it is among a task's best, and no vector is shuffled. Blocks follow
from the number of queries, so any query table works; each block is one pass
over the vectors.

Scores are cosines (or dot products) in double precision. A null vector, one
of another length than the query's, one with a null or non-finite component
and (for cosines) a zero vector take no part on either side. Equal scores go
by vector id, null ids last. Repeated rows are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftcheck.session import cut_lineage, ship_package

BLOCK_BYTES = 16 << 20
#: Scores that a task holds at a time: a tile of ``TILE_QUERIES`` queries at most by as many vectors as fit.
TILE_SCORES = 1 << 20
TILE_QUERIES = 2048


def _valid(df: DataFrame, id_col: str, vec_col: str, cosine: bool) -> DataFrame:
    """(id, v, dim): the vectors that take part, in double precision."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    if cosine:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.select("id", "v", F.size("v").alias("dim"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int, cosine: bool) -> np.ndarray:
    return _scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), cosine)


def _scaled(m: np.ndarray, cosine: bool) -> np.ndarray:
    if cosine:
        m = m / np.abs(m).max(axis=1, keepdims=True)  # so that no square overflows
        m = m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m


def query_blocks(queries: DataFrame, block_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, numbers, vectors) of bounded size; a block has vectors of one length, eight bytes a component from the start."""
    numbers, vectors, dim = [], [], None
    for r in queries.orderBy("dim", "no").toLocalIterator():
        if vectors and (r["dim"] != dim or (len(vectors) + 1) * r["dim"] * 8 > block_bytes):
            yield dim, np.array(numbers, np.int64), np.stack(vectors)
            numbers, vectors = [], []
        dim = r["dim"]
        numbers.append(r["no"])
        vectors.append(np.array(r["v"], np.float64))
    if vectors:
        yield dim, np.array(numbers, np.int64), np.stack(vectors)


def _best(query, score, ids, null, k):
    """Places of the k best of each query: highest score, then smallest id, null ids last."""
    order = np.lexsort((ids, null, -score, query))
    q = query[order]
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
    return order[rank < k]


class _Tile:
    """The k best so far of some queries of a block."""

    def __init__(self, q: np.ndarray, k: int):
        self.q, self.k = q, k
        self.kept = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool)]
        self.least = np.full(len(q), -np.inf)

    def meet(self, v: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores = self.q @ v.T
        least = self.least
        if len(v) > self.k:  # what is below the k-th best of these vectors alone is not among the k best
            comparable = np.where(np.isnan(scores), -np.inf, scores)  # products that overflow in both directions have no score
            least = np.maximum(least, np.partition(comparable, len(v) - self.k, axis=1)[:, len(v) - self.k])
        row, col = np.nonzero(scores >= least[:, None])
        if not len(row):
            return
        fresh = [row, scores[row, col], ids[col], null[col]]
        self.kept = [np.concatenate(x) for x in zip(self.kept, fresh)]
        at_best = _best(*self.kept, self.k)
        self.kept = [x[at_best] for x in self.kept]
        full = np.bincount(self.kept[0], minlength=len(self.q)) >= self.k
        low = np.full(len(self.q), np.inf)
        np.minimum.at(low, self.kept[0], self.kept[1])
        self.least[full] = low[full]


def _search(shared, dim, k, cosine, batches):
    numbers, vectors = shared.value
    tiles = [_Tile(_scaled(vectors[a : a + TILE_QUERIES], cosine), k) for a in range(0, len(vectors), TILE_QUERIES)]
    rows = max(1, TILE_SCORES // min(TILE_QUERIES, len(vectors)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            v, ids = _matrix(part.column("v"), dim, cosine), part.column("id")
            ids, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            for tile in tiles:
                tile.meet(v, ids, null)
    for n, tile in enumerate(tiles):
        row, score, ids, null = tile.kept
        yield pa.RecordBatch.from_arrays([pa.array(numbers[n * TILE_QUERIES + row]), pa.array(ids, pa.int64(), mask=null), pa.array(score)], ["no", "vec_id", "score"])


def topk(queries: DataFrame, vectors: DataFrame, k: int, query_id: str = "query_id", vec_id: str = "vec_id", vec_col: str = "embedding", cosine: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest ``vectors`` (vec_id, vec_col) of each of ``queries`` (query_id, vec_col), all if fewer."""
    spark = queries.sparkSession
    ship_package(spark)
    asked = cut_lineage(_valid(queries, query_id, vec_col, cosine).withColumn("no", F.monotonically_increasing_id()))
    rows = _valid(vectors, vec_id, vec_col, cosine)
    found = [
        rows.where(F.col("dim") == dim).select("id", "v").mapInArrow(partial(_search, spark.sparkContext.broadcast((numbers, vecs)), dim, k, cosine), "no long, vec_id long, score double")
        for dim, numbers, vecs in query_blocks(asked, block_bytes)
    ]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("no", F.col("id").alias("query_id")), "no").select("query_id", "rank", "vec_id", "score")
