"""Operator 1: approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``tables`` hash tables cuts the unit vectors by ``m`` random
projections into cells of ``width``. A query visits, in each table, its own
cell and the perturbed cells in the order of their estimated success (expected
squared distances to the cell borders), ``probes`` cells in all. Cells are
dealt to tasks; a task searches the cells of its part, merges what one query
finds there and measures it exactly, so only a few rows of each query leave
it. Cells of more than ``block`` vectors are split, and queries go to every
part.

``m`` is at most a multiple of the logarithm of the number of vectors, so that
cells need not grow with the data, and is lowered until a sample of the queries
finds ``recall`` of its true neighbours (known from a pass over all vectors) in
the cells it visits. With ``m`` = 1 nearly all is visited: unit vectors are at
most one default width apart. A query for which the cells give too few neighbours is compared
with all vectors, in blocks. Of equal vectors the ``k`` + 1 smallest distinct
ids are indexed: no other can be among the nearest.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; vectors are compared
only with those of their own length; repeated rows count once; an id with
several vectors is one candidate, by its nearest, and never for a query of the
same id; equal scores go to the smaller id; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, releasing, splitmix, table

TABLES = 16
PROBES = 128
WIDTH = 2.0
BLOCK = 16_384
#: Share of a sample's true neighbours that must lie in visited cells; above the 0.9 asked for by more than the sample's error.
RECALL = 0.95
SAMPLED = 200


def projections_for(n: int) -> int:
    """The most projections of a table over ``n`` vectors."""
    return max(2, round(0.66 * math.log2(max(2, n))))


def probe_sets(m: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets over the 2m nearest borders, by rising expected squared distance; the first is empty."""

    def expected(j: int) -> float:
        if j <= m:
            return j * (j + 1) / (4 * (m + 1) * (m + 2))
        r = 2 * m + 1 - j
        return 1 - r / (m + 1) + r * (r + 1) / (4 * (m + 1) * (m + 2))

    z = [expected(j) for j in range(1, 2 * m + 1)]
    out: list[tuple[int, ...]] = [()]
    heap = [(z[0], (0,))]
    while heap and len(out) < probes:
        score, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - j not in chosen for j in chosen):  # not both borders of one projection
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - z[last] + z[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + z[last + 1], (*chosen, last + 1)))
    return out


class Cells:
    """The hash functions of all tables for vectors of one length; drawn from fixed seeds."""

    def __init__(self, dim: int, m: int, tables: int, width: float, probes: int):
        self.m, self.probes = m, probe_sets(m, probes)
        self.functions = []
        for t in range(tables):
            rng = np.random.default_rng([1, dim, m, t])
            self.functions.append((rng.normal(size=(dim, m)) / width, rng.uniform(0, 1, m)))

    @staticmethod
    def key(cells: np.ndarray) -> np.ndarray:
        """One 64-bit number for each row of cell coordinates."""
        h = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(cells.shape[-1]):
            h = splitmix(h * np.uint64(0x9E3779B97F4A7C15) + cells[..., j].astype(np.int64).view(np.uint64) + np.uint64(j + 1))
        return h.view(np.int64)

    def own(self, unit: np.ndarray, t: int) -> np.ndarray:
        a, b = self.functions[t]
        return self.key(np.floor(unit @ a + b))

    def visited(self, unit: np.ndarray, t: int) -> np.ndarray:
        """Keys of the cells that each row visits, most promising first."""
        a, b = self.functions[t]
        at = unit @ a + b
        home = np.floor(at)
        inside = at - home
        order = np.argsort(np.concatenate([inside, 1 - inside], axis=1), axis=1, kind="stable")
        cells = np.repeat(home[:, None, :], len(self.probes), axis=1)
        rows = np.arange(len(unit))
        for p, chosen in enumerate(self.probes):
            for j in chosen:
                border = order[:, j]
                cells[rows, p, border % self.m] += np.where(border < self.m, -1.0, 1.0)
        return self.key(cells)


def vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The double-precision vectors of a batch whose vectors have one length."""
    return np.stack([np.frombuffer(v, np.float64) for v in batch.column("v").to_pylist()])


def unit_rows(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)  # no overflow of very large components
    y = x / big
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def prepared(rows: DataFrame) -> DataFrame:
    """(vec_id, dim, v): the valid vectors as packed doubles."""
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    valid = valid.where("vec_id is not null and e is not null").where(finite & F.exists("e", lambda x: x != 0))

    def packed(batches):
        for batch in batches:
            e = [np.array(x, np.float64) + 0.0 for x in batch.column("e").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([len(x) for x in e], pa.int32()), pa.array([x.tobytes() for x in e], pa.binary())], ["vec_id", "dim", "v"])

    return valid.mapInArrow(packed, "vec_id long, dim int, v binary")


def true_neighbours(base: DataFrame, sample: list, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, query vectors, neighbour vectors), row by row: each sampled query with each of its ``k`` true neighbours."""
    by_dim: dict[int, list[int]] = {}
    for i, q in enumerate(sample):
        by_dim.setdefault(q.dim, []).append(i)
    asked = {d: (np.array(at), np.array([sample[i].vec_id for i in at]), unit_rows(np.stack([np.frombuffer(sample[i].v, np.float64) for i in at]))) for d, at in by_dim.items()}
    shared = base.sparkSession.sparkContext.broadcast(asked)

    def nearest(batches):
        best: dict[int, list] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in set(dims.tolist()) & shared.value.keys():
                part = batch.filter(pa.array(dims == d))
                numbers, own, y = shared.value[d]
                ids, v = part.column("vec_id").to_numpy(), part.column("v").to_pylist()
                score = y @ unit_rows(vectors(part)).T
                score[own[:, None] == ids[None, :]] = -math.inf
                for i, row in zip(numbers.tolist(), score):
                    some = np.argpartition(-row, k - 1)[:k] if len(row) > k else np.arange(len(row))
                    best[i] = heapq.nlargest(k, best.get(i, []) + [(float(row[j]), int(ids[j]), v[j]) for j in some if row[j] > -math.inf])
        flat = [(i, *x) for i, some in best.items() for x in some]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*flat)) or [()] * 4, (pa.int32(), pa.float64(), pa.int64(), pa.binary()))], ["q", "score", "vec_id", "v"])

    near = base.mapInArrow(nearest, "q int, score double, vec_id long, v binary")
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    pairs = near.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("q", "v").collect()
    out = []
    for d in by_dim:
        of = [p for p in pairs if sample[p.q].dim == d]
        if of:
            out.append((d, *(unit_rows(np.stack([np.frombuffer(v, np.float64) for v in side])) for side in ([sample[p.q].v for p in of], [p.v for p in of]))))
    return out


def found_share(pairs: list[tuple[int, np.ndarray, np.ndarray]], m: int, tables: int, width: float, probes: int) -> float:
    """Share of the pairs whose neighbour lies in a cell that its query visits."""
    hits = total = 0
    for d, x, y in pairs:
        cells, hit = Cells(d, m, tables, width, probes), np.zeros(len(x), bool)
        for t in range(tables):
            hit |= (cells.visited(x, t) == cells.own(y, t)[:, None]).any(axis=1)
        hits, total = hits + hit.sum(), total + len(x)
    return hits / total if total else 1.0


def search(rows: DataFrame, chosen, k: int = 5, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """``rows`` (vec_id, embedding array) -> query_id, rank, vec_id, score: the ``k`` largest cosines found.

    ``chosen`` is a condition on vec_id that says which rows are queries.
    """
    every = keep(prepared(rows).distinct())
    n = every.count()
    shards = max(4, -(-n // block))
    alike = Window.partitionBy("dim", "v").orderBy("vec_id")
    base = keep(every.withColumn("r", F.row_number().over(alike)).where(F.col("r") <= k + 1).drop("r"))
    queries = every.where(chosen)
    sample = queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id", "v").limit(SAMPLED).collect()
    pairs = true_neighbours(base, sample, k)
    m = next((m for m in range(projections_for(n), 1, -1) if found_share(pairs, m, tables, width, probes) >= recall), 1)

    def keyed(visits: bool, with_vector: bool = True):
        def emit(batches):
            made: dict[int, Cells] = {}
            for batch in batches:
                dims = batch.column("dim").to_numpy()
                for d in np.unique(dims):
                    part = batch.filter(pa.array(dims == d))
                    for lo in range(0, part.num_rows, 1024):
                        piece = part.slice(lo, 1024)
                        cells = made.setdefault(int(d), Cells(int(d), m, tables, width, probes))
                        unit = unit_rows(vectors(piece))
                        for t in range(tables):
                            yield from rows_of(piece, int(d), t, cells, unit)

        def rows_of(piece, d, t, cells, unit):
            if not visits:
                key = cells.own(unit, t)
                yield batch_of(piece, np.arange(len(key)), d, t, key % shards, key[:, None])
                return
            key = cells.visited(unit, t)
            shard = key % shards
            for s in range(shards):  # one row for each part that the query visits, with its cells there
                hit = shard == s
                some = np.flatnonzero(hit.any(axis=1))
                if len(some):
                    yield batch_of(piece, some, d, t, np.full(len(some), s), [key[i][hit[i]] for i in some])

        def batch_of(piece, at, d, t, shard, keys):
            lens = np.array([len(x) for x in keys])
            flat = pa.array(np.concatenate(list(keys)) if len(lens) else np.zeros(0, np.int64), pa.int64())
            cells = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)], pa.int32()), flat)
            took = piece.take(pa.array(at))
            columns = [took.column("vec_id"), pa.array(np.full(len(at), d, np.int32)), pa.array(np.full(len(at), t, np.int32)), pa.array(shard, pa.int64()), cells]
            return pa.RecordBatch.from_arrays(columns + ([took.column("v")] if with_vector else []), ["vec_id", "dim", "t", "shard", "cells"] + (["v"] if with_vector else []))

        return emit

    schema = "vec_id long, dim int, t int, shard long, cells array<long>"
    sizes = base.mapInArrow(keyed(False, False), schema).groupBy("dim", "t", "shard").count()
    parts = keep(sizes.select("dim", "t", "shard", F.ceil(F.col("count") / (4 * block)).cast("int").alias("parts")).where("parts > 1"))
    index = base.mapInArrow(keyed(False), schema + ", v binary")
    visits = queries.mapInArrow(keyed(True), schema + ", v binary")
    index, visits = index.withColumn("part", F.lit(0)), visits.withColumn("part", F.lit(0))
    if not parts.isEmpty():  # a part of the cells that holds too many vectors is split; queries go to each piece
        on = ["dim", "t", "shard"]
        index = index.drop("part").join(parts, on, "left").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        visits = visits.drop("part").join(parts, on, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")

    found = _within(index, visits, k)
    best = _nearest(found, k)
    # Queries with too few neighbours in their cells: all vectors of their length, in blocks.
    best = keep(best)
    want = base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    have = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("found"))
    short = queries.join(have, "vec_id", "left").join(F.broadcast(want), "dim").where(F.coalesce("found", F.lit(0)) < F.least(F.lit(k), F.col("n") - 1))
    short = keep(short.select("vec_id", "dim", "v"))
    if not short.isEmpty():
        one = F.array(F.lit(0).cast("long"))
        every_part = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
        flat = base.select("vec_id", "dim", F.lit(0).alias("t"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), one.alias("cells"), "v", F.lit(0).alias("part"))
        asked = short.select("vec_id", "dim", F.lit(0).alias("t"), one.alias("cells"), "v", F.lit(0).alias("part"), every_part.cast("long").alias("shard"))
        more = _within(flat, asked.select(*flat.columns), k)
        best = _nearest(best.select("query_id", "vec_id", "score").unionByName(more), k)
    return best


def _within(index: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): each query's best ``k`` in each part."""

    def search_part(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if left.num_rows and right.num_rows:
            left, right = left.combine_chunks(), right.combine_chunks()
            x = np.stack([np.frombuffer(v, np.float64) for v in left.column("v").to_pylist()])
            ids = left.column("vec_id").to_numpy()
            cell = np.array([c[0] for c in left.column("cells").to_pylist()], np.int64)
            order = np.lexsort((ids, cell))
            x, ids, cell = x[order], ids[order], cell[order]
            norm = np.linalg.norm(x, axis=1)
            rows = k * int(np.unique(ids, return_counts=True)[1].max())  # so many rows hold k ids, also of ids with several vectors
            asked = {}
            for q, v, cells in zip(right.column("vec_id").to_pylist(), right.column("v").to_pylist(), right.column("cells").to_pylist()):
                asked.setdefault((q, v), set()).update(cells)
            for (q, v), cells in asked.items():
                keys = np.array(sorted(cells), np.int64)
                lo, hi = np.searchsorted(cell, keys), np.searchsorted(cell, keys, side="right")
                at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi) if b > a] or [np.zeros(0, np.int64)])
                at = at[ids[at] != q]
                if not len(at):
                    continue
                y = np.frombuffer(v, np.float64)
                score = (x[at] @ y) / (norm[at] * np.linalg.norm(y))
                if len(at) > rows:  # all that may be among the k, ties at the end included
                    near = score >= np.partition(score, len(at) - rows)[len(at) - rows]
                    at, score = at[near], score[near]
                first = np.lexsort((ids[at], -score))
                if rows > k:
                    first = first[np.sort(np.unique(ids[at[first]], return_index=True)[1])]  # the best row of each id
                first = first[:k]
                out_q += [q] * len(first)
                out_v += ids[at[first]].tolist()
                out_s += score[first].tolist()
        return pa.table([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())], ["query_id", "vec_id", "score"])

    by = ["dim", "t", "shard", "part"]
    return index.groupBy(*by).cogroup(visits.groupBy(*by)).applyInArrow(releasing(search_part), "query_id long, vec_id long, score double")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: rows whose vec_id is divisible by 50 against all of ``embeddings``."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
