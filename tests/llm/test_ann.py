"""Operator 1: recall against brute force, exact scores, defined cases."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from driftcheck.llm.ann import Cells, op1_ann, probe_sets, search, unit_rows


def brute(rows, queries, k=5):
    """(query, rank) -> (vec_id, score) in double precision."""
    valid = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, y in valid:
        if q in queries:
            scores = [(-float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))), i) for i, x in valid if i != q and len(x) == len(y)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    t = pq.read_table(f"{path}/embeddings.parquet").to_pydict()
    rows = list(zip(t["vec_id"], t["embedding"]))
    want = brute(rows, {i for i in t["vec_id"] if i % 50 == 0})
    got = found(op1_ann(spark, path))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    scores = {i: np.array(v, float) for i, v in rows}
    hits = 0
    for q, near in got.items():
        hits += len({i for i, _ in near} & {i for i, _ in want[q]})
        for i, s in near:
            x, y = scores[i], scores[q]
            assert abs(s - x @ y / (np.linalg.norm(x) * np.linalg.norm(y))) < 1e-12
    assert hits >= 0.9 * sum(len(v) for v in want.values())


def test_odd_vectors(spark):
    rng = random.Random(1)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100, None), (101, []), (102, [0.0] * 6), (103, [nan] + [1.0] * 5), (104, [inf] + [1.0] * 5), (105, [None] + [1.0] * 5), (None, [1.0] * 6)]
    rows += [(200, [1.0, 2.0, 3.0]), (250, [3.0, 2.0, 1.0]), (300, rows[0][1]), (301, rows[0][1]), (50, [1e300] * 6), (400, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, label int, t string, score string")
    got = found(search(df, F.col("vec_id") % 50 == 0))
    assert got.keys() == {0, 50, 200, 250, 300, 400}
    assert [i for i, _ in got[200]] == [250]
    assert [i for i, _ in got[0]][:2] == [300, 301] and [i for i, _ in got[300]][:2] == [0, 301]
    assert all(len(got[q]) == 5 for q in (0, 50, 300, 400))
    assert not {100, 101, 102, 103, 104, 105} & {i for v in got.values() for i, _ in v}


def test_many_equal_vectors_and_split_cells(spark):
    """A third of the rows are one vector; parts of the cells are split."""
    rng = random.Random(2)
    same = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, same if i % 3 == 0 else [x + rng.gauss(0, 0.01) for x in same]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(search(df, F.col("vec_id") % 50 == 0, block=16))
    want = brute(rows, set(range(0, 600, 50)))
    for q, near in want.items():
        if q % 3 == 0:
            assert [i for i, _ in got[q]] == [i for i in range(0, 600, 3) if i != q][:5]
        assert len(got[q]) == 5
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_repeated_ids_push_out_nobody(spark):
    """One id ten times beside others with its vector; one id with ten near vectors."""
    rng = random.Random(3)
    same, other = ([rng.gauss(0, 1) for _ in range(8)] for _ in range(2))
    rows = [(1, same)] * 10 + [(i, same) for i in (50, 51, 52, 53, 54, 55)]
    rows += [(60, [x + rng.gauss(0, 1e-4) for x in other]) for _ in range(10)]
    rows += [(i, [x + rng.gauss(0, 0.01) for x in other]) for i in (61, 62, 63, 64, 65)] + [(100, other)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(201, 240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(search(df, F.col("vec_id").isin(50, 100)))
    assert [i for i, _ in got[50]] == [1, 51, 52, 53, 54]
    near = [i for i, _ in got[100]]
    assert near[0] == 60 and len(set(near)) == 5 and set(near) <= {60, 61, 62, 63, 64, 65}


@pytest.mark.parametrize("n", [1_000, 16_000])
def test_recall_does_not_fall_with_the_size(spark, n):
    """Random directions, few probes: the projections that the size alone allows would find too little."""
    x = np.random.default_rng(n).normal(size=(n, 32))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    step = n // 50
    got = found(search(df, F.col("vec_id") % step == 0, tables=8, probes=16))
    unit = unit_rows(x)
    hits = 0
    for q in range(0, n, step):
        score = unit @ unit[q]
        score[q] = -2
        hits += len({i for i, _ in got[q]} & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.9 * 5 * len(range(0, n, step))


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert search(df, F.col("vec_id") % 50 == 0).collect() == []


def test_probes_rise_in_expected_distance():
    sets = probe_sets(6, 60)
    assert sets[0] == () and sets[1] == (0,) and len(set(sets)) == len(sets) == 60
    assert all(11 - j not in s for s in sets for j in s)


def test_first_probe_is_the_own_cell():
    cells = Cells(8, 4, 3, 2.0, 20)
    unit = unit_rows(np.random.default_rng(0).normal(size=(50, 8)))
    for t in range(3):
        visited = cells.visited(unit, t)
        assert (visited[:, 0] == cells.own(unit, t)).all()
        assert all(len(set(v)) == len(v) for v in visited.tolist())
