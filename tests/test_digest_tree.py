"""Stored versions: equal to the whole keyed diff, and only differing buckets are read."""

import glob
import os
import random

import pytest

from driftcheck.operators import digest_tree as D
from driftcheck.operators.parity import row_diff_keyed

SCHEMA = "k long, part string, price double, tags array<string>, attrs map<string,int>"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def some_rows(n, seed=1):
    r = random.Random(seed)
    return [
        (r.choice([i, i, i, None, 7]), r.choice(["a", "b", None]), r.choice([0.5 * i, None, float("nan")]), r.choice([["x", None], [], None]), r.choice([{"m": i}, None]))
        for i in range(n)
    ]


def listed(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


def spoil(path, keep=()):
    """Make the row files outside the folders ``keep`` unreadable; returns how many."""
    spoilt = [f for f in glob.glob(f"{path}/rows/top=*/*.parquet") if os.path.basename(os.path.dirname(f)) not in keep]
    for f in spoilt:
        with open(f, "wb") as out:
            out.write(b"not a parquet file")
    return len(spoilt)


@pytest.mark.parametrize(("keys", "leaf_rows"), [(["k"], (100_000, 100_000)), (["k", "part"], (1, 100_000)), (["k"], (1, 1))])
def test_equals_the_whole_diff(spark, tmp_path, keys, leaf_rows):
    old = some_rows(90)
    new = old[5:] + [(1000, "n", 1.0, None, None), (7, "b", 2.0, [], None)] + old[40:42]
    new[30] = (*new[30][:2], 99.25, *new[30][3:])
    a, b = table(spark, old), table(spark, new)
    va = D.store_version(a, keys, str(tmp_path / "a"), leaf_rows[0])
    vb = D.store_version(b, keys, str(tmp_path / "b"), leaf_rows[1])
    assert (va.depth, vb.depth) == tuple(D.depth_for(90, x) for x in leaf_rows)
    got = D.diff_versions(spark, va.path, vb.path)
    assert listed(got) == listed(row_diff_keyed(a, b, keys)) != []


def test_only_changed_buckets_are_read(spark, tmp_path):
    old = [(i, "p", float(i), ["t"], {"m": i}) for i in range(3300)]
    new = [r if r[0] != 1234 else (1234, "p", -1.0, ["t"], {"m": 1234}) for r in old if r[0] != 77]
    paths = [D.store_version(table(spark, rows), ["k"], str(tmp_path / n), 50).path for n, rows in (("a", old), ("b", new))]
    versions = [D.open_version(spark, p) for p in paths]
    nodes, level = D.differing_nodes(spark, *versions)
    tops = {f"top={r['node'] >> D.BITS * (level - D.top_level(level))}" for r in nodes.collect()}
    assert 1 <= len(tops) <= 2
    assert all(spoil(p, tops) > 50 for p in paths)
    assert listed(D.diff_versions(spark, *paths)) == ["(1234, 'changed', ['price'])", "(77, 'only_baseline', [])"]


def test_equal_versions_read_no_rows(spark, tmp_path):
    rows = some_rows(200)
    a = D.store_version(table(spark, rows), ["k"], str(tmp_path / "a"))
    shuffled = table(spark, rows[::-1]).select("attrs", "k", "tags", "price", "part")  # other order of rows and columns
    b = D.store_version(shuffled, ["k"], str(tmp_path / "b"))
    assert spoil(a.path) and spoil(b.path)
    assert D.diff_versions(spark, a.path, b.path).count() == 0


def test_repeated_rows_are_counted(spark, tmp_path):
    one = [(1, "a", 1.0, None, None)]
    paths = [D.store_version(table(spark, one * n), ["k"], str(tmp_path / str(n))).path for n in (2, 4)]
    assert listed(D.diff_versions(spark, *paths)) == ["(1, 'only_target', [])"] * 2


def test_values_swapped_between_keys_differ(spark, tmp_path):
    old = [(i, "a", float(i % 2), None, None) for i in range(2)]
    new = [(i, "a", float(1 - i % 2), None, None) for i in range(2)]
    paths = [D.store_version(table(spark, r), ["k"], str(tmp_path / n)).path for n, r in (("a", old), ("b", new))]
    assert listed(D.diff_versions(spark, *paths)) == ["(0, 'changed', ['price'])", "(1, 'changed', ['price'])"]


def test_other_columns_or_types_are_compared_whole(spark, tmp_path):
    a, b = table(spark, [(1, 1), (2, 2)], "k long, v int"), table(spark, [(1, 1, "x"), (2, 3, "y")], "k long, v long, extra string")
    paths = [D.store_version(df, ["k"], str(tmp_path / n)).path for n, df in (("a", a), ("b", b))]
    assert listed(D.diff_versions(spark, *paths)) == ["(2, 'changed', ['v'])"]


def test_columns_with_names_of_the_layout(spark, tmp_path):
    names = "leaf long, top string, row int, node int, `a.b` int"
    a, b = table(spark, [(1, "t", 1, 1, 1)], names), table(spark, [(1, "t", 1, 1, 2)], names)
    paths = [D.store_version(df, ["leaf", "top"], str(tmp_path / n)).path for n, df in (("a", a), ("b", b))]
    assert listed(D.diff_versions(spark, *paths)) == ["(1, 't', 'changed', ['a.b'])"]


def test_empty_versions(spark, tmp_path):
    empty, full = table(spark, []), table(spark, [(1, "a", 1.0, None, None)])
    for n, df in (("e", empty), ("e2", empty), ("f", full)):
        D.store_version(df, ["k"], str(tmp_path / n))
    diff = lambda x, y: listed(D.diff_versions(spark, str(tmp_path / x), str(tmp_path / y)))
    assert diff("e", "e2") == []
    assert diff("e", "f") == ["(1, 'only_target', [])"]
    assert diff("f", "e") == ["(1, 'only_baseline', [])"]


def test_unfinished_version_and_other_keys_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        D.open_version(spark, str(tmp_path / "none"))
    paths = [D.store_version(table(spark, some_rows(5)), [k], str(tmp_path / k)).path for k in ("k", "part")]
    with pytest.raises(ValueError):
        D.diff_versions(spark, *paths)
