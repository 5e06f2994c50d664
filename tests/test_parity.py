"""Parity checks: the original validator's six cases plus properties."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from driftcheck.operators import parity as P

CHECKS = json.dumps(
    [
        {"name": "row_count_match", "type": "exact", "severity": "critical"},
        {"name": "schema_match", "type": "exact", "severity": "critical"},
        {"name": "column_level_diff", "type": "tolerance", "severity": "warning", "config": {"tolerance": "0.0001"}},
        {"name": "null_count_diff", "type": "exact", "severity": "warning"},
    ]
)


def run(spark, base_rows, base_schema, tgt_rows, tgt_schema, checks=CHECKS):
    b = spark.createDataFrame(base_rows, base_schema)
    t = spark.createDataFrame(tgt_rows, tgt_schema)
    res, overall = P.validate([P.TablePair("p", b, t)], checks)
    statuses = {r["name"]: (r["status"], r["details"]) for r in res.collect()}
    return statuses, overall.first()["overall_status"]


def test_identical(spark):
    s, o = run(spark, [(1, 10.0), (2, 20.0)], "id long, amount double", [(1, 10.0), (2, 20.0)], "id long, amount double")
    assert all(v[0] == "PASSED" for v in s.values())
    assert s["row_count_match"][1] == "2 rows in both"
    assert o == "PASSED"


def test_row_count(spark):
    s, o = run(spark, [(1, 10.0), (2, 20.0)], "id long, amount double", [(1, 10.0)], "id long, amount double")
    assert s["row_count_match"] == ("FAILED", "baseline=2 target=1")
    assert o == "FAILED"


def test_schema(spark):
    s, o = run(spark, [(1, 10.0)], "id long, amount double", [(1, "10.0")], "id long, amount string")
    assert s["schema_match"][0] == "FAILED"
    assert s["schema_match"][1] == 'missing_in_target=["amount:double"] added_in_target=["amount:string"]'
    assert o == "FAILED"


def test_within_tolerance(spark):
    s, o = run(spark, [(1, 1000.0)], "id long, amount double", [(1, 1000.01)], "id long, amount double")
    assert s["column_level_diff"][0] == "PASSED"
    assert o == "PASSED"


def test_beyond_tolerance(spark):
    s, o = run(spark, [(1, 1000.0)], "id long, amount double", [(1, 2000.0)], "id long, amount double")
    assert s["column_level_diff"] == ("WARNING", 'columns differ beyond tolerance: ["amount"]')
    assert o == "WARNING"


def test_null_counts(spark):
    s, o = run(spark, [(1, 10.0), (2, None)], "id long, amount double", [(1, 10.0), (2, 20.0)], "id long, amount double")
    assert s["null_count_diff"] == ("WARNING", 'null count differences: {"amount":{"baseline_nulls":1,"target_nulls":0}}')


def test_unknown_check_and_defaults(spark):
    checks = json.dumps([{"name": "histogram"}, {"name": "column_level_diff"}])
    s, o = run(spark, [(1, 1.0)], "id long, amount double", [(1, 1.0)], "id long, amount double", checks)
    assert s["histogram"] == ("FAILED", "Unknown check type: histogram")
    assert o == "WARNING"  # unknown check FAILED with default severity warning


def test_zero_baseline_and_no_numeric(spark):
    s, _ = run(spark, [(0.0,)], "x double", [(1.0,)], "x double")
    assert s["column_level_diff"][0] == "WARNING"  # rel = inf
    s, _ = run(spark, [("a",)], "x string", [("a",)], "x string")
    assert s["column_level_diff"] == ("PASSED", "no numeric columns to compare")


def test_nan_sums(spark):
    nan = float("nan")
    s, _ = run(spark, [(nan,)], "x double", [(nan,)], "x double")
    assert s["column_level_diff"][0] == "PASSED"
    s, _ = run(spark, [(nan,)], "x double", [(1.0,)], "x double")
    assert s["column_level_diff"][0] == "WARNING"


def test_short_columns_not_numeric(spark):
    cols = P.numeric_columns(spark.createDataFrame([(1, 2, [3])], "a short, b int, c array<long>"),
                             spark.createDataFrame([(1, 2, [3])], "a short, b int, c array<long>"))
    assert cols == ["b"]


def test_self_parity_and_shuffled_copy(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    res, overall = P.validate([P.TablePair("self", o, o), P.TablePair("shuffled", o, o.repartition(7).orderBy(F.rand(3)))])
    assert {r["overall_status"] for r in overall.collect()} == {"PASSED"}


def test_skip_rule(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    _, overall = P.validate([P.TablePair("ok", o, o), P.TablePair("skip", o, o, target_status="FAILED")])
    got = {r["pair_id"]: r["overall_status"] for r in overall.collect()}
    assert got == {"ok": "PASSED", "skip": "SKIPPED"}


def test_row_diffs(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "k long, v string")
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "x"), (4, "d")], "k long, v string")
    ex = sorted((r["k"], r["v"], r["diff_side"]) for r in P.row_diff_except(b, t).collect())
    assert ex == [(2, "b", "missing_in_target"), (3, "c", "missing_in_target"), (3, "x", "added_in_target"), (4, "d", "added_in_target")]
    kd = {r["k"]: (r["diff_kind"], r["changed_cols"]) for r in P.row_diff_keyed(b.dropDuplicates(), t, ["k"]).collect()}
    assert kd == {3: ("changed", ["v"]), 4: ("only_target", [])}


def test_single_scan_per_side(spark):
    """The profile reads each side once: 2 parquet scans for one pair."""
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    prof, _ = P.pair_profiles([P.TablePair("p", o, o.filter("o_orderkey > 0"))], materialize=False)
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


@pytest.mark.parametrize("tol,expected", [("0.5", "PASSED"), ("0.00001", "WARNING")])
def test_tolerance_from_config(spark, tol, expected):
    checks = json.dumps([{"name": "column_level_diff", "config": {"tolerance": tol}}])
    s, _ = run(spark, [(100.0,)], "x double", [(101.0,)], "x double", checks)
    assert s["column_level_diff"][0] == expected


def test_keyed_diff_repeated_keys_are_multisets(spark):
    b = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (5, "e", 5.0), (7, "x", 1.0), (7, "y", 1.0), (7, "y", 1.0)],
                              "k long, v string, x double")
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "C", 3.0), (4, "d", 4.0), (7, "y", 1.0), (7, "z", 1.0), (None, "n", 0.0)],
                              "k long, v string, x double")
    got = sorted((r["k"] if r["k"] is not None else -1, r["diff_kind"], tuple(r["changed_cols"])) for r in P.row_diff_keyed(b, t, ["k"]).collect())
    assert got == [(-1, "only_target", ()), (2, "changed", ("x",)), (3, "changed", ("v",)), (4, "only_target", ()),
                   (5, "only_baseline", ()), (7, "only_baseline", ()), (7, "only_baseline", ()), (7, "only_target", ())]


def test_keyed_diff_hot_key_has_no_pair_explosion(spark):
    """A key holding a third of the rows is diffed without pairing its rows."""
    n = 3000
    b = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    t = b.withColumn("v", F.when(F.col("v") == 6, F.lit(-6)).otherwise(F.col("v")))
    d = P.row_diff_keyed(b, t, ["k"])
    rows = sorted((r["k"], r["diff_kind"]) for r in d.collect())
    assert rows == [(-1, "only_baseline"), (-1, "only_target")]
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_validation_effects(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    res, overall = P.validate([P.TablePair("ok", o, o), P.TablePair("skip", o, o, target_status="FAILED")])
    ch = {(r["pair_id"], r["record_type"], r["field"]): r["value"] for r in P.validation_effects(res, overall).collect()}
    assert ch[("ok", "pipeline", "status")] == "PASSED" and ch[("ok", "metadata", "status")] == "PASSED"
    assert json.loads(ch[("ok", "pipeline", "validation_results")])["overall_status"] == "PASSED"
    assert ch[("skip", "event", "validation_skipped")] == "reason=target_not_succeeded"
    assert ("skip", "metadata", "status") not in ch and ch[("skip", "metadata", "phase")] == "REPORT"


def test_multiset_diff_equals_except_all(spark):
    b = spark.createDataFrame([(1, None), (1, None), (2, 0.0), (3, float("nan"))] + [(9, 1.0)] * 25, "k long, x double")
    t = spark.createDataFrame([(1, None), (2, -0.0), (3, float("nan")), (4, 4.0)] + [(9, 1.0)] * 3, "k long, x double")
    got = sorted((r["k"], str(r["x"]), r["diff_side"]) for r in P.multiset_diff(b, t, ["k", "x"]).collect())
    exp = sorted([(r["k"], str(r["x"]), "missing_in_target") for r in b.exceptAll(t).collect()]
                 + [(r["k"], str(r["x"]), "added_in_target") for r in t.exceptAll(b).collect()])
    assert got == exp and len([g for g in got if g[0] == 9]) == 22


def test_multiset_diff_chunks_large_multiplicity(spark):
    b = spark.range(25000).select(F.lit(7).alias("k"))
    t = spark.range(3).select(F.lit(7).alias("k"))
    assert P.multiset_diff(b, t, ["k"]).count() == 24997


def test_large_fleet_in_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "PROFILE_GROUP", 2)
    n = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    pairs = [P.TablePair(f"p{i}", n, n if i % 2 else n.filter("n_nationkey > 0")) for i in range(7)]
    _, overall = P.validate(pairs)
    got = {r["pair_id"]: r["overall_status"] for r in overall.collect()}
    assert got == {f"p{i}": ("PASSED" if i % 2 else "FAILED") for i in range(7)}


def test_schema_counts_nested_nullability_not_top_level(spark):
    from pyspark.sql import types as T

    a = T.StructType([T.StructField("xs", T.ArrayType(T.LongType(), True), True)])
    b = T.StructType([T.StructField("xs", T.ArrayType(T.LongType(), False), True)])
    c = T.StructType([T.StructField("xs", T.ArrayType(T.LongType(), True), False)])
    da, db, dc = (spark.createDataFrame([([1],)], s) for s in (a, b, c))
    res, _ = P.validate([P.TablePair("nested", da, db), P.TablePair("top", da, dc)], '[{"name": "schema_match"}]')
    got = {r["pair_id"]: (r["status"], r["details"]) for r in res.collect()}
    assert got["nested"] == ("FAILED", 'missing_in_target=["xs:array<bigint>"] added_in_target=["xs:array<bigint NOT NULL>"]')
    assert got["top"][0] == "PASSED"


def test_dotted_column_names(spark):
    b = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "`k.id` long, `a.b` double, `c d` string")
    t = spark.createDataFrame([(1, 3.0, "x"), (3, None, "z")], "`k.id` long, `a.b` double, `c d` string")
    res, _ = P.validate([P.TablePair("dots", b, t)])
    got = {r["name"]: r["status"] for r in res.collect()}
    assert got["column_level_diff"] == "WARNING" and got["null_count_diff"] == "PASSED"
    assert P.row_diff_except(b, t).count() == 4
    kd = sorted((r["k.id"], r["diff_kind"], tuple(r["changed_cols"])) for r in P.row_diff_keyed(b, t, ["k.id"]).collect())
    assert kd == [(1, "changed", ("a.b",)), (2, "only_baseline", ()), (3, "only_target", ())]


def test_empty_tables_and_no_shared_columns(spark):
    e = spark.createDataFrame([], "id long, amount double")
    one = spark.createDataFrame([(1, 5.0)], "id long, amount double")
    other = spark.createDataFrame([("x",)], "name string")
    res, overall = P.validate([P.TablePair("empty", e, e), P.TablePair("grow", e, one), P.TablePair("disjoint", one, other)])
    st = {(r["pair_id"], r["name"]): (r["status"], r["details"]) for r in res.collect()}
    ov = {r["pair_id"]: r["overall_status"] for r in overall.collect()}
    assert ov == {"empty": "PASSED", "grow": "FAILED", "disjoint": "FAILED"}
    assert st[("empty", "row_count_match")] == ("PASSED", "0 rows in both")
    assert st[("grow", "column_level_diff")][0] == "WARNING"
    assert st[("disjoint", "column_level_diff")] == ("PASSED", "no numeric columns to compare")
    assert st[("disjoint", "null_count_diff")] == ("PASSED", "null counts match")


def test_registered_custom_check(spark):
    @P.register_check("row_count_within")
    def _within():
        b, t = F.col("baseline_rows"), F.col("target_rows")
        ok = F.abs(t - b) <= F.col("tolerance") * b
        return F.when(ok, "PASSED").otherwise(P._soft_fail()), F.format_string("baseline=%d target=%d", b, t)

    try:
        s, o = run(spark, [(1, 1.0)] * 100, "id long, amount double", [(1, 1.0)] * 99, "id long, amount double",
                   '[{"name": "row_count_within", "config": {"tolerance": "0.05"}}, {"name": "row_count_within", "severity": "critical"}]')
        assert o == "FAILED"  # the second spec uses the default tolerance 0.0001 and is critical
    finally:
        P.CHECKS.pop("row_count_within", None)


def test_keyed_diff_sees_microseconds_maps_and_nested_values(spark):
    schema = "id int, ts timestamp, nested array<struct<t:timestamp,m:map<string,int>>>, m map<string,array<int>>, d decimal(38,10), b binary"

    def row(i, us=100, m=None, d="1.0000000001", b=b"x", inner=None):
        t = datetime(2024, 1, 1, 0, 0, 0, us)
        return (i, t, [(datetime(2024, 1, 1, 0, 0, 0, 7), inner if inner is not None else {"a": 1})], m if m is not None else {"k": [1, None]}, Decimal(d), bytearray(b))

    base = spark.createDataFrame([row(i) for i in range(8)], schema)
    tgt = spark.createDataFrame([row(0), row(1, us=101), row(2, m={"k": [None, 1]}), row(3, d="1.0000000002"), row(4, b=b"y"), row(5, inner={"a": 2}), row(6, m={}), row(9)], schema)
    got = {r["id"]: (r["diff_kind"], r["changed_cols"]) for r in P.row_diff_keyed(base, tgt, ["id"]).collect()}
    assert got == {1: ("changed", ["ts"]), 2: ("changed", ["m"]), 3: ("changed", ["d"]), 4: ("changed", ["b"]), 5: ("changed", ["nested"]),
                   6: ("changed", ["m"]), 7: ("only_baseline", []), 9: ("only_target", [])}


def test_keyed_diff_uses_hash_aggregates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    tagged = df.groupBy("id").agg(F.max(F.xxhash64("s")))
    assert "SortAggregate" not in tagged._jdf.queryExecution().executedPlan().toString()
    wide = spark.createDataFrame([(1, "a"), (3, "b")], "id long, s string")
    got = sorted((r["id"], r["diff_kind"]) for r in P.row_diff_keyed(df, wide, ["id"]).collect())
    assert got == [(2, "only_baseline"), (3, "only_target")]


def test_exact_sums_of_integers_and_decimals(spark):
    """Sums one apart fail at tolerance 0, however large; equal ones of other scale pass."""
    checks = '[{"name": "column_level_diff", "severity": "critical", "config": {"tolerance": "0"}}]'
    big = Decimal("12345678901234567890123456789012345678")

    def status(a, b, ta, tb):
        pair = P.TablePair("p", spark.createDataFrame([(a,)], f"v {ta}"), spark.createDataFrame([(b,)], f"v {tb}"))
        return P.validate([pair], checks)[0].first()["status"]

    assert status(big, big + 1, "decimal(38,0)", "decimal(38,0)") == "FAILED"
    assert status(big, big, "decimal(38,0)", "decimal(38,0)") == "PASSED"
    assert status(2**62 + 1, 2**62, "long", "long") == "FAILED"
    assert status(Decimal("5.00"), 5, "decimal(10,2)", "int") == "PASSED"
    assert status(Decimal("100"), 100, "decimal(10,0)", "long") == "PASSED"


def test_fleet_without_a_pair_to_validate(spark):
    df = spark.createDataFrame([(1,)], "v int")
    results, overall = P.validate([P.TablePair("a", df, df, "FAILED"), P.TablePair("b", df, df, "FAILED")])
    assert results.collect() == [] and {tuple(r)[:2] for r in overall.collect()} == {("a", "SKIPPED"), ("b", "SKIPPED")}
    results, overall = P.validate([])
    assert results.collect() == [] and overall.collect() == []


def test_keyed_diff_carries_only_differing_keys(spark, monkeypatch):
    """Repeated keys whose rows are the same on both sides are not written, and no whole rows are."""
    written = []

    def record(df):
        written.append((df.columns, df.count()))
        return df

    monkeypatch.setattr(P, "cut_lineage", record)
    rows = [(k, v, "x" * 50) for k in range(200) for v in range(1 + k % 3)]
    b = spark.createDataFrame([*rows, (None, 1, "n"), (None, 1, "n")], "k int, v int, text string")
    t = spark.createDataFrame([(k, 9 if (k, v) in ((3, 0), (5, 2)) else v, s) for k, v, s in rows if k != 7] + [(None, 1, "n"), (None, 2, "n")], "k int, v int, text string")
    got = sorted((r["k"] or 0, r["diff_kind"], tuple(r["changed_cols"])) for r in P.row_diff_keyed(b, t, ["k"]).collect())
    assert got == [(0, "only_baseline", ()), (0, "only_target", ()), (3, "changed", ("v",)), (5, "only_baseline", ()), (5, "only_target", ()), (7, "only_baseline", ()), (7, "only_baseline", ())]
    assert written == [(["k", "__cls"], 4)]
