"""Exact top-k against a plain ranking of every pair."""

import math
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from driftcheck.operators import vectors as V


def plain(queries, vectors, k, cosine=True):
    def ok(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and (not cosine or any(v))

    out = []
    for q, a in queries:
        if not ok(a):
            continue
        scores = []
        for i, b in vectors:
            if ok(b) and len(a) == len(b):
                dot = sum(x * y for x, y in zip(a, b))
                scores.append((-(dot / math.sqrt(sum(x * x for x in a) * sum(x * x for x in b)) if cosine else dot), i is None, i or 0))
        out += [(q, n + 1, None if null else i, round(-s, 9)) for n, (s, null, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect()), key=str)


@pytest.mark.parametrize(("cosine", "block_bytes"), [(True, 1 << 20), (False, 200)])
def test_equals_a_plain_ranking(spark, cosine, block_bytes):
    rng = np.random.default_rng(3)
    grid = [[float(x) for x in rng.integers(-2, 3, 4)] for _ in range(150)]  # many ties
    odd = [None, [], [0.0] * 4, [1.0, float("nan"), 0.0, 0.0], [float("inf"), 1.0, 1.0, 1.0], [1.0, None, 2.0, 2.0], [3.0, 4.0], [1.0, 1.0]]
    if cosine:
        grid = [[x / 4 if any(v) else 0.25 for x in v] for v in grid]
    vectors = [(i, v) for i, v in enumerate(grid + odd)] + [(None, grid[0]), (7, grid[7]), (7, grid[7]), (-4, grid[1])]
    queries = [(i, v) for i, v in enumerate(grid[:40:3] + odd)] + [(None, grid[5])]
    v = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    q = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    got = V.topk(q, v, 6, cosine=cosine, block_bytes=block_bytes)
    exact = plain(queries, vectors, 6, cosine)
    if not cosine:
        assert rows(got) == exact
    else:  # equal cosines may differ in the last digit: ranks and scores agree, ids within equal scores may not
        assert [(a, b, d) for a, b, _, d in rows(got)] == [(a, b, d) for a, b, _, d in exact]


def test_no_rows(spark):
    none = spark.createDataFrame([], "query_id long, vec_id long, embedding array<float>")
    one = spark.createDataFrame([(1, 2, [1.0, 2.0])], "query_id long, vec_id long, embedding array<float>")
    assert V.topk(none, one, 3).collect() == [] and V.topk(one, none, 3).collect() == []
    assert rows(V.topk(one, one, 3)) == [(1, 1, 2, 1.0)]


def test_many_queries_hold_few_scores():
    """A block of queries and a batch of vectors never have all their scores in memory."""
    rng = np.random.default_rng(4)
    q, v = rng.standard_normal((2500, 8)), rng.standard_normal((4500, 8))
    v[100:200] = v[7]  # equal scores
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, 8), pa.int32()), pa.array(v.ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), vectors], ["id", "v"])
    tracemalloc.start()
    found = pa.Table.from_batches(V._search(SimpleNamespace(value=(np.arange(len(q)), q)), 8, 3, False, [batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
    exact = np.lexsort((np.broadcast_to(np.arange(len(v)), (len(q), len(v))), -np.stack([q[i : i + 1] @ v.T for i in range(len(q))])[:, 0]))[:, :3]
    got = found.sort_by([("no", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
    same = (got.column("vec_id").to_numpy().reshape(-1, 3) == exact).mean()
    assert got.num_rows == 7500 and same > 0.99  # sums in another order may differ in the last digit
