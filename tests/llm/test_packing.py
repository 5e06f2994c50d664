"""Operator 6: every token once, sizes permitted, close to the best for small cases."""

import itertools
import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from driftcheck.llm.packing import CAPACITIES, OVERHEAD, best_size, pack, pack_documents, pack_lengths, shrunk


ROOT = Path(__file__).resolve().parents[2]


def cost(lengths, bins, sizes):
    return sum(dict(zip(bins, sizes)).values()) + OVERHEAD * len(set(bins))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_bins_hold_their_pieces(lengths):
    bins, offsets, sizes = pack_lengths(lengths, (8, 16, 32, 64), 2)
    for b in set(bins):
        held = sorted((offsets[i], lengths[i], sizes[i]) for i in range(len(lengths)) if bins[i] == b)
        assert [o for o, _, _ in held] == list(itertools.accumulate([0, *(n for _, n, _ in held)]))[:-1]
        content = sum(n for _, n, _ in held)
        assert {s for _, _, s in held} == {shrunk(content, [8, 16, 32, 64])}


def best_cost(lengths, capacities, overhead):
    """Least cost over all ways to split a few pieces into bins."""
    best = {0: 0}
    n = len(lengths)
    total = [sum(lengths[i] for i in range(n) if m >> i & 1) for m in range(1 << n)]
    for m in range(1, 1 << n):
        low = m & -m
        sub, found = m, None
        while sub:
            if sub & low and total[sub] <= capacities[-1]:
                c = best[m ^ sub] + shrunk(total[sub], capacities) + overhead
                found = c if found is None or c < found else found
            sub = (sub - 1) & m
        best[m] = found
    return best[(1 << n) - 1]


def test_close_to_the_best():
    rng = random.Random(6)
    ours = best = 0
    for _ in range(60):
        lengths = [rng.randint(1, 60) for _ in range(8)]
        bins, _, sizes = pack_lengths(lengths, (16, 32, 64), 2)
        ours += sum(dict(zip(bins, sizes)).values()) + 2 * len(set(bins))
        best += best_cost(lengths, [16, 32, 64], 2)
    assert best <= ours <= 1.1 * best


def test_several_sizes_beat_one():
    rng = random.Random(7)
    lengths = [min(8192, int(rng.paretovariate(1.1) * 100)) for _ in range(2000)]
    several, one = pack_lengths(lengths), pack_lengths(lengths, (8192,))
    assert cost(lengths, several[0], several[2]) <= cost(lengths, one[0], one[2])
    assert sum(lengths) / cost(lengths, several[0], several[2]) > 0.95


def test_size_with_nothing_to_come():
    assert best_size(600, [], [512, 1024, 2048], 8) == 1024


def test_fills_of_many_small_pieces():
    """819 pieces of 10 fill the largest size: 24 such bins; smaller sizes take the other 344 pieces."""
    bins, _, sizes = pack_lengths([10] * 20_000)
    assert sorted(dict(zip(bins, sizes)).values()) == [512, 1024, 2048] + [8192] * 24


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 64), st.lists(st.integers(1, 64), max_size=200))
def test_best_size_tries_whole_fills(length, others):
    others = sorted(n for n in others if n <= length)
    capacities, costs = [64, 256, 1024], []
    for c in capacities:
        filled = length
        for n in reversed(others):  # piece by piece, the longest first
            filled += n if filled + n <= c else 0
        costs.append(((shrunk(filled, capacities) + 8) / filled, c))
    count = {n: others.count(n) for n in others}
    assert best_size(length, sorted(count), capacities, 8, count) == min(costs)[1]


def check(rows, counts):
    seen, content = {}, {}
    for r in rows:
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        if r.bin_id is not None:
            content.setdefault(r.bin_id, []).append((r.bin_offset, r.length, r.capacity))
    for i, n in counts.items():
        assert [s for _, s, _ in sorted(seen[i])] == list(range(0, max(n, 1), CAPACITIES[-1])) and sum(x for _, _, x in seen[i]) == n
    for held in content.values():
        held.sort()
        assert [o for o, _, _ in held] == list(itertools.accumulate([0, *(n for _, n, _ in held)]))[:-1]
        assert {c for _, _, c in held} == {shrunk(sum(n for _, n, _ in held), list(CAPACITIES))}


def test_pieces_of_counts(spark):
    rng = random.Random(8)
    counts = {i: rng.choice([0, 1, 5, 100, 511, 512, 513, 8192, 8193, 30_000]) for i in range(300)}
    df = spark.createDataFrame([(i, n, "x") for i, n in counts.items()], "doc_id long, n_tokens long, capacity string").repartition(3)
    check(pack(df).collect(), counts)


def test_null_and_repeated_rows(spark):
    rows = [(1, None), (2, 0), (None, 7), (3, 40), (3, 40)]
    out = pack(spark.createDataFrame(rows, "doc_id long, n_tokens long")).collect()
    assert len(out) == 5 and sum(r.length for r in out) == 87
    assert {r.doc_id for r in out if r.bin_id is None} == {1, 2}


def test_edge_texts(edge_documents, edge_rows, no_documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = pack_documents(edge_documents, path).collect()
    assert {r.doc_id for r in out} == {i for i, _ in edge_rows}
    assert pack_documents(no_documents, path).collect() == []


def _shards(rows):
    return Counter(r.bin_id >> 32 for r in rows if r.bin_id is not None)


def test_null_and_equal_ids_use_many_shards(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, F.lit(5)).cast("long").alias("doc_id"), F.lit(100).alias("n_tokens"))
    rows = pack(df).collect()
    shards = _shards(rows)
    assert len(rows) == 30_000 and len(shards) == 64 and max(shards.values()) < 700
    assert Counter(r.doc_id for r in rows) == {5: 15_000, None: 15_000}


def test_pieces_count_for_the_shards(spark):
    """A few very long documents: as many shards as their pieces need."""
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(512 * 1500).cast("long").alias("n_tokens"))
    rows = pack(df, (256, 512), 8, shard_rows=500).collect()
    shards = _shards(rows)
    assert len(rows) == 60_000 and len(shards) == 120 and max(shards.values()) < 700
    assert all(len({r.start for r in rows if r.doc_id == i}) == 1500 for i in (0, 39))


def test_without_the_table_helper():
    """A session that never read through ``common.table`` packs too: workers find the package."""
    code = (
        "import os, sys\n"
        f"sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "os.chdir('/')\n"
        "from driftcheck.llm.packing import pack\n"
        "print('ROWS', pack(s.range(5).selectExpr('id AS doc_id', 'id * 10 AS n_tokens')).count())\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=300, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "ROWS 5" in out.stdout, out.stderr[-2000:]
