"""Registered parity queries over the driver tables, with their DuckDB oracles.

The fleet is six table pairs. Each target is a deterministic perturbation
of its baseline derived in the plan itself (scaled prices, injected nulls,
dropped or re-keyed rows, changed column types), so the work grows with the
tables. ``nation`` has a failed target run and is skipped (P11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.operators import digest_tree as DT
from driftcheck.operators import parity as P
from driftcheck.session import materialize_path
from driftcheck.sources.tables import read_table

CHECKS_WITH_UNKNOWN = P.DEFAULT_CHECKS_JSON[:-1] + ', {"name": "distribution_match", "severity": "info"}]'


# --- derived targets (Spark side) -------------------------------------------------

def orders_target(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * F.lit(1.001)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


def orders_target_v2(orders: DataFrame) -> DataFrame:
    """Row-level variant: drops (5-LOW, F) rows and adds re-keyed copies of (2-HIGH, O) rows."""
    t = orders_target(orders)
    dropped = t.filter(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")))
    added = t.filter((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O")).withColumn(
        "o_orderkey", -F.col("o_orderkey")
    )
    return dropped.unionByName(added)


def lineitem_target(li: DataFrame) -> DataFrame:
    return li.filter(~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))).withColumn(
        "l_shipdate", F.col("l_shipdate").cast("date")
    )


def part_target(part: DataFrame) -> DataFrame:
    return part.withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(12,2)"))


def supplier_target(sup: DataFrame) -> DataFrame:
    return sup.withColumn("s_acctbal", F.when(F.col("s_acctbal") < 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")))


def fleet_pairs(spark: SparkSession, sf_dir: str) -> list[P.TablePair]:
    tables: dict[str, DataFrame] = {}

    def t(name: str) -> DataFrame:  # each table is read (footer, listing) once per fleet
        if name not in tables:
            tables[name] = read_table(spark, sf_dir, name)
        return tables[name]

    return [
        P.TablePair("orders", t("orders"), orders_target(t("orders"))),
        P.TablePair("lineitem", t("lineitem"), lineitem_target(t("lineitem"))),
        P.TablePair("customer", t("customer"), t("customer")),
        P.TablePair("part", t("part"), part_target(t("part"))),
        P.TablePair("supplier", t("supplier"), supplier_target(t("supplier")), checks_json=CHECKS_WITH_UNKNOWN),
        P.TablePair("nation", t("nation"), t("nation"), target_status="FAILED"),
    ]


# --- queries -------------------------------------------------------------------------

def q_parity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, _ = P.validate(fleet_pairs(spark, sf_dir))
    return results


def q_parity_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, overall = P.validate(fleet_pairs(spark, sf_dir))
    return overall


def q_parity_column_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof, _ = P.pair_profiles(fleet_pairs(spark, sf_dir))
    return P.column_sums(prof).select(
        "pair_id",
        "col",
        F.round("baseline_sum", 2).alias("baseline_sum"),
        F.round("target_sum", 2).alias("target_sum"),
        F.round("relative_diff", 9).alias("relative_diff"),
    )


def q_parity_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prof, _ = P.pair_profiles(fleet_pairs(spark, sf_dir))
    return P.null_counts(prof)


def q_parity_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    prof = P.column_profile(o, "orders", "baseline").unionByName(P.column_profile(orders_target(o), "orders", "target"))
    return prof.select(
        "pair_id", "side", "col", "n", "n_null",
        F.round("col_sum", 2).alias("col_sum"),
        F.round("col_avg", 6).alias("col_avg"),
        F.round("col_min", 4).alias("col_min"),
        F.round("col_max", 4).alias("col_max"),
    )


def q_row_diff_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    d = P.row_diff_except(o, orders_target_v2(o))
    return d.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def q_row_diff_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    d = P.row_diff_keyed(o, orders_target_v2(o), ["o_orderkey"])
    return d.select("o_orderkey", "diff_kind", F.array_join("changed_cols", ",").alias("changed_cols"))


def lineitem_target_v2(li: DataFrame) -> DataFrame:
    """Keyed variant: discounts nudged for returned items, (N, F) rows dropped.

    The (l_orderkey, l_linenumber) key of the test data repeats; repeated keys
    are compared as multisets (see ``row_diff_keyed``).
    """
    return li.filter(~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))).withColumn(
        "l_discount", F.when(F.col("l_returnflag") == "R", F.col("l_discount") + F.lit(0.01)).otherwise(F.col("l_discount"))
    )


def q_row_diff_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    d = P.row_diff_keyed(li, lineitem_target_v2(li), ["l_orderkey", "l_linenumber"])
    return d.select("l_orderkey", "l_linenumber", "diff_kind", F.array_join("changed_cols", ",").alias("changed_cols"))


def q_parity_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 with the row count of each side, from the same profile pass over the tables."""
    prof, sch = P.pair_profiles(fleet_pairs(spark, sf_dir))
    rows = prof.filter(F.col("col").isNull()).groupBy("pair_id").agg(
        F.max(F.when(F.col("side") == "baseline", F.col("n_rows"))).alias("baseline_rows"),
        F.max(F.when(F.col("side") == "target", F.col("n_rows"))).alias("target_rows"),
    )
    return P.schema_diff(sch).join(rows, "pair_id").select(
        "pair_id", F.array_join("missing_in_target", ",").alias("missing_in_target"), F.array_join("added_in_target", ",").alias("added_in_target"),
        "baseline_rows", "target_rows",
    )


def q_row_diff_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 on ``events`` whose target is late by one microsecond in some rows."""
    ev = read_table(spark, sf_dir, "events")
    late = ev.withColumn("ts", F.when(F.col("event_id") % 97 == 0, F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).otherwise(F.col("ts")))
    d = P.row_diff_keyed(ev, late, ["event_id"])
    return d.select("event_id", "diff_kind", F.array_join("changed_cols", ",").alias("changed_cols"))


def q_row_diff_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 over two stored versions of ``orders`` that differ for a few customers: only differing buckets are read again."""
    old = read_table(spark, sf_dir, "orders")
    cust = F.col("o_custkey") % 5000
    new = old.filter(F.coalesce(cust != 4, F.lit(True))).withColumn("o_totalprice", F.when(cust == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    paths = [DT.store_version(df, ["o_orderkey"], materialize_path(spark), leaf_rows=1000).path for df in (old, new)]
    d = DT.diff_versions(spark, *paths)
    return d.select("o_orderkey", "diff_kind", F.array_join("changed_cols", ",").alias("changed_cols"))


def q_fleet_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, overall = P.validate(fleet_pairs(spark, sf_dir))
    return P.fleet_report(overall)


def q_validation_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, overall = P.validate(fleet_pairs(spark, sf_dir))
    return P.validation_effects(results, overall)


QUERIES = {
    "parity_checks": q_parity_checks,
    "parity_overall": q_parity_overall,
    "parity_column_sums": q_parity_column_sums,
    "parity_null_counts": q_parity_null_counts,
    "parity_profile": q_parity_profile,
    "row_diff_except": q_row_diff_except,
    "row_diff_keyed": q_row_diff_keyed,
    "row_diff_digest": q_row_diff_digest,
    "validation_changes": q_validation_changes,
    "parity_schema": q_parity_schema,
    "row_diff_timestamps": q_row_diff_timestamps,
    "fleet_parity": q_fleet_parity,
    "row_diff_tree": q_row_diff_tree,
}


# --- DuckDB oracles --------------------------------------------------------------------

_ORDERS_T = (
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus, "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * CAST(1.001 AS DOUBLE) ELSE o_totalprice END AS o_totalprice, "
    "o_orderdate, o_orderpriority FROM orders"
)
_ORDERS_T2 = (
    f"SELECT * FROM ({_ORDERS_T}) WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F') "
    f"UNION ALL SELECT -o_orderkey AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
    f"FROM ({_ORDERS_T}) WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'"
)
_LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINEITEM_T = (
    "SELECT " + ", ".join(c if c != "l_shipdate" else "CAST(l_shipdate AS DATE) AS l_shipdate" for c in _LINEITEM_COLS)
    + " FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F')"
)

_CHECKS = [("row_count_match", "critical", None), ("schema_match", "critical", None),
           ("column_level_diff", "warning", 0.0001), ("null_count_diff", "warning", None)]

# pair_id, baseline sql, target sql, numeric cols, shared cols, schema (missing, added), checks, target status
_PAIRS = [
    ("orders", "SELECT * FROM orders", _ORDERS_T,
     ["o_orderkey", "o_custkey", "o_totalprice"],
     ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
     ([], []), _CHECKS, "SUCCEEDED"),
    ("lineitem", "SELECT * FROM lineitem", _LINEITEM_T,
     ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
     _LINEITEM_COLS, (["l_shipdate:timestamp_ntz"], ["l_shipdate:date"]), _CHECKS, "SUCCEEDED"),
    ("customer", "SELECT * FROM customer", "SELECT * FROM customer",
     ["c_custkey", "c_nationkey", "c_acctbal"],
     ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], ([], []), _CHECKS, "SUCCEEDED"),
    ("part", "SELECT * FROM part",
     "SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(12,2)) AS p_retailprice FROM part",
     ["p_partkey", "p_size", "p_retailprice"],
     ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
     (["p_retailprice:double"], ["p_retailprice:decimal(12,2)"]), _CHECKS, "SUCCEEDED"),
    ("supplier", "SELECT * FROM supplier",
     "SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier",
     ["s_suppkey", "s_nationkey", "s_acctbal"], ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
     ([], []), _CHECKS + [("distribution_match", "info", None)], "SUCCEEDED"),
    ("nation", "SELECT * FROM nation", "SELECT * FROM nation", [], [], ([], []), _CHECKS, "FAILED"),
]


def _json_list(xs: list[str]) -> str:
    return "[" + ",".join(f'"{x}"' for x in xs) + "]"


def _profile_ctes(i: int, bsql: str, tsql: str, nums: list[str], shared: list[str]) -> list[str]:
    def prof(src: str) -> str:
        cols = ["count(*) AS n"]
        cols += [f"sum(TRY_CAST({c} AS DOUBLE)) AS s_{c}" for c in nums]
        cols += [f"count(*) - count({c}) AS z_{c}" for c in shared]
        return f"SELECT {', '.join(cols)} FROM ({src})"

    sums = " UNION ALL ".join(
        f"SELECT '{c}' AS col, coalesce(b.s_{c}, 0.0) AS bs, coalesce(t.s_{c}, 0.0) AS ts FROM b{i} b, t{i} t" for c in nums
    )
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS col, b.z_{c} AS bz, t.z_{c} AS tz FROM b{i} b, t{i} t" for c in shared
    )
    return [
        f"b{i} AS ({prof(bsql)})",
        f"t{i} AS ({prof(tsql)})",
        f"r{i} AS (SELECT col, bs, ts, CASE WHEN bs = 0 THEN CASE WHEN ts = 0 THEN 0.0 ELSE CAST('inf' AS DOUBLE) END "
        f"ELSE abs(ts - bs) / abs(bs) END AS rel FROM ({sums}))",
        f"z{i} AS ({nulls})",
    ]


def _check_selects(i: int, pid: str, schema: tuple[list[str], list[str]], checks) -> list[str]:
    out = []
    for no, (name, sev, tol) in enumerate(checks, start=1):
        soft = "'FAILED'" if sev == "critical" else "'WARNING'"
        head = f"SELECT '{pid}' AS pair_id, {no} AS check_no, '{name}' AS name"
        if name == "row_count_match":
            out.append(
                f"{head}, CASE WHEN b.n = t.n THEN 'PASSED' ELSE 'FAILED' END AS status, '{sev}' AS severity, "
                f"CASE WHEN b.n = t.n THEN b.n || ' rows in both' ELSE 'baseline=' || b.n || ' target=' || t.n END AS details "
                f"FROM b{i} b, t{i} t"
            )
        elif name == "schema_match":
            miss, add = schema
            if not miss and not add:
                out.append(f"{head}, 'PASSED' AS status, '{sev}' AS severity, 'schemas identical' AS details")
            else:
                out.append(
                    f"{head}, 'FAILED' AS status, '{sev}' AS severity, "
                    f"'missing_in_target={_json_list(miss)} added_in_target={_json_list(add)}' AS details"
                )
        elif name == "column_level_diff":
            out.append(
                f"{head}, CASE WHEN count(*) FILTER (WHERE rel > {tol}) > 0 THEN {soft} ELSE 'PASSED' END AS status, "
                f"'{sev}' AS severity, CASE WHEN count(*) = 0 THEN 'no numeric columns to compare' "
                f"WHEN count(*) FILTER (WHERE rel > {tol}) > 0 THEN 'columns differ beyond tolerance: [' || "
                f"string_agg('\"' || col || '\"', ',' ORDER BY col) FILTER (WHERE rel > {tol}) || ']' "
                f"ELSE 'all numeric columns within tolerance' END AS details FROM r{i}"
            )
        elif name == "null_count_diff":
            out.append(
                f"{head}, CASE WHEN count(*) FILTER (WHERE bz <> tz) > 0 THEN {soft} ELSE 'PASSED' END AS status, "
                f"'{sev}' AS severity, CASE WHEN count(*) FILTER (WHERE bz <> tz) > 0 THEN 'null count differences: {{' || "
                f"string_agg('\"' || col || '\":{{\"baseline_nulls\":' || bz || ',\"target_nulls\":' || tz || '}}', ',' ORDER BY col) "
                f"FILTER (WHERE bz <> tz) || '}}' ELSE 'null counts match' END AS details FROM z{i}"
            )
        else:
            out.append(f"{head}, 'FAILED' AS status, '{sev}' AS severity, 'Unknown check type: {name}' AS details")
    return out


def _fleet_checks_sql() -> tuple[list[str], str]:
    ctes, selects = [], []
    for i, (pid, bsql, tsql, nums, shared, schema, checks, status) in enumerate(_PAIRS):
        if status != "SUCCEEDED":
            continue
        ctes += _profile_ctes(i, bsql, tsql, nums, shared)
        selects += _check_selects(i, pid, schema, checks)
    return ctes, " UNION ALL ".join(f"({s})" for s in selects)


def _checks_oracle() -> str:
    ctes, body = _fleet_checks_sql()
    return f"WITH {', '.join(ctes)} {body}"


def _overall_oracle() -> str:
    ctes, body = _fleet_checks_sql()
    pairs = " UNION ALL ".join(f"SELECT '{p[0]}' AS pair_id, '{p[7]}' AS target_status" for p in _PAIRS)
    return (
        f"WITH {', '.join(ctes)}, res AS ({body}), pairs AS ({pairs}), "
        "roll AS (SELECT pair_id, count(*) AS n_checks, "
        "bool_or(status = 'FAILED' AND severity = 'critical') AS crit, "
        "bool_or(status IN ('FAILED', 'WARNING')) AS soft, "
        "count(*) FILTER (WHERE status <> 'PASSED') AS n_not_passed FROM res GROUP BY pair_id) "
        "SELECT p.pair_id, CASE WHEN p.target_status <> 'SUCCEEDED' THEN 'SKIPPED' "
        "WHEN coalesce(crit, false) THEN 'FAILED' WHEN coalesce(soft, false) THEN 'WARNING' ELSE 'PASSED' END AS overall_status, "
        "coalesce(n_checks, 0) AS n_checks, coalesce(n_not_passed, 0) AS n_not_passed "
        "FROM pairs p LEFT JOIN roll r ON p.pair_id = r.pair_id"
    )


def _column_sums_oracle() -> str:
    ctes, parts = [], []
    for i, (pid, bsql, tsql, nums, shared, schema, checks, status) in enumerate(_PAIRS):
        if status != "SUCCEEDED" or not nums:
            continue
        ctes += _profile_ctes(i, bsql, tsql, nums, shared)
        parts.append(f"SELECT '{pid}' AS pair_id, col, round(bs, 2) AS baseline_sum, round(ts, 2) AS target_sum, round(rel, 9) AS relative_diff FROM r{i}")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(parts)


def _null_counts_oracle() -> str:
    ctes, parts = [], []
    for i, (pid, bsql, tsql, nums, shared, schema, checks, status) in enumerate(_PAIRS):
        if status != "SUCCEEDED" or not shared:
            continue
        ctes += _profile_ctes(i, bsql, tsql, nums, shared)
        parts.append(f"SELECT '{pid}' AS pair_id, col, bz AS baseline_nulls, tz AS target_nulls FROM z{i}")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(parts)


def _profile_oracle() -> str:
    parts = []
    for side, src in (("baseline", "SELECT * FROM orders"), ("target", _ORDERS_T)):
        for c in ("o_orderkey", "o_custkey", "o_totalprice"):
            parts.append(
                f"SELECT 'orders' AS pair_id, '{side}' AS side, '{c}' AS col, count(*) AS n, count(*) - count({c}) AS n_null, "
                f"round(sum(CAST({c} AS DOUBLE)), 2) AS col_sum, round(avg(CAST({c} AS DOUBLE)), 6) AS col_avg, "
                f"round(min(CAST({c} AS DOUBLE)), 4) AS col_min, round(max(CAST({c} AS DOUBLE)), 4) AS col_max FROM ({src})"
            )
    return " UNION ALL ".join(parts)


_ORDERS_SEL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority"

def _keyed_oracle(base: str, target_sql: str, keys: list[str], cols: list[str]) -> str:
    """Keys once per side: column compare; other keys: multiset difference (EXCEPT ALL)."""
    kl = ", ".join(keys)
    allc = ", ".join(keys + cols)
    on = " AND ".join(f"b.{k} = t.{k}" for k in keys)
    on_kc = lambda a: " AND ".join(f"{a}.{k} = kc.{k}" for k in keys)
    diff = ", ".join(f"CASE WHEN b.{c} IS DISTINCT FROM t.{c} THEN '{c}' END" for c in sorted(cols))
    return (
        f"WITH b AS (SELECT {allc} FROM {base}), t AS (SELECT {allc} FROM ({target_sql})), "
        f"kc AS (SELECT {kl}, sum(sb) AS nb, sum(1 - sb) AS nt FROM (SELECT {kl}, 1 AS sb FROM b UNION ALL SELECT {kl}, 0 FROM t) GROUP BY {kl}), "
        f"mb AS (SELECT b.* FROM b JOIN kc ON {on_kc('b')} WHERE NOT (kc.nb = 1 AND kc.nt = 1)), "
        f"mt AS (SELECT t.* FROM t JOIN kc ON {on_kc('t')} WHERE NOT (kc.nb = 1 AND kc.nt = 1)), "
        f"p AS (SELECT {', '.join('b.' + k for k in keys)}, concat_ws(',', {diff}) AS changed FROM b JOIN t ON {on} "
        f"JOIN kc ON {on_kc('b')} WHERE kc.nb = 1 AND kc.nt = 1) "
        f"SELECT {kl}, 'changed' AS diff_kind, changed AS changed_cols FROM p WHERE changed <> '' "
        f"UNION ALL SELECT {kl}, 'only_baseline', '' FROM (SELECT * FROM mb EXCEPT ALL SELECT * FROM mt) "
        f"UNION ALL SELECT {kl}, 'only_target', '' FROM (SELECT * FROM mt EXCEPT ALL SELECT * FROM mb)"
    )


_LI_DIFF_COLS = sorted(["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])
_LI_T2 = (
    "SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN l_discount + CAST(0.01 AS DOUBLE) ELSE l_discount END AS l_discount) "
    "FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F')"
)

def _validation_changes_oracle() -> str:
    ctes, body = _fleet_checks_sql()
    return (
        f"WITH {', '.join(ctes)}, res AS ({body}), o AS ({_overall_oracle()}), "
        "d AS (SELECT o.pair_id, o.overall_status, CAST(to_json({'overall_status': o.overall_status, 'checks': "
        "coalesce(list({'name': r.name, 'status': r.status, 'details': r.details, 'severity': r.severity} ORDER BY r.check_no) "
        "FILTER (WHERE r.check_no IS NOT NULL), [])}) AS VARCHAR) AS doc "
        "FROM o LEFT JOIN res r ON o.pair_id = r.pair_id GROUP BY o.pair_id, o.overall_status) "
        "SELECT pair_id, 'pipeline' AS record_type, 'validation_results' AS field, doc AS value FROM d WHERE overall_status <> 'SKIPPED' "
        "UNION ALL SELECT pair_id, 'pipeline', 'status', overall_status FROM d WHERE overall_status <> 'SKIPPED' "
        "UNION ALL SELECT pair_id, 'event', 'validation_completed', 'overall_status=' || overall_status FROM d WHERE overall_status <> 'SKIPPED' "
        "UNION ALL SELECT pair_id, 'event', 'validation_skipped', 'reason=target_not_succeeded' FROM d WHERE overall_status = 'SKIPPED' "
        "UNION ALL SELECT pair_id, 'metadata', 'phase', 'REPORT' FROM d "
        "UNION ALL SELECT pair_id, 'metadata', 'overall_status', overall_status FROM d WHERE overall_status <> 'SKIPPED' "
        "UNION ALL SELECT pair_id, 'metadata', 'status', overall_status FROM d WHERE overall_status <> 'SKIPPED'"
    )


def _rows(source: str) -> str:
    """A table name, or a query in parentheses."""
    return f"({source})" if " " in source.strip() and not source.strip().startswith("(") else source


def _schema_oracle() -> str:
    parts = []
    for pid, base, target, _n, _s, (miss, add), _c, status in _PAIRS:
        if status != "SUCCEEDED":
            continue
        parts.append(
            f"SELECT '{pid}' AS pair_id, '{','.join(sorted(miss))}' AS missing_in_target, '{','.join(sorted(add))}' AS added_in_target, "
            f"(SELECT count(*) FROM {_rows(base)}) AS baseline_rows, (SELECT count(*) FROM {_rows(target)}) AS target_rows"
        )
    return " UNION ALL ".join(parts)


ORACLE = {
    "parity_schema": _schema_oracle(),
    "row_diff_timestamps": "SELECT event_id, 'changed' AS diff_kind, 'ts' AS changed_cols FROM events WHERE event_id % 97 = 0",
    "fleet_parity": (
        f"SELECT overall_status, count(*) AS n_pairs, CAST(sum(n_not_passed) AS BIGINT) AS n_checks_not_passed, "
        f"string_agg(pair_id, ',' ORDER BY pair_id) AS pairs FROM ({_overall_oracle()}) GROUP BY overall_status"
    ),
    "validation_changes": _validation_changes_oracle(),
    "row_diff_digest": _keyed_oracle("lineitem", _LI_T2, ["l_orderkey", "l_linenumber"], _LI_DIFF_COLS),
    "parity_checks": _checks_oracle(),
    "parity_overall": _overall_oracle(),
    "parity_column_sums": _column_sums_oracle(),
    "parity_null_counts": _null_counts_oracle(),
    "parity_profile": _profile_oracle(),
    "row_diff_except": (
        f"(SELECT {_ORDERS_SEL}, 'missing_in_target' AS diff_side FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM ({_ORDERS_T2}))) "
        f"UNION ALL (SELECT {_ORDERS_SEL}, 'added_in_target' AS diff_side FROM (SELECT * FROM ({_ORDERS_T2}) EXCEPT ALL SELECT * FROM orders))"
    ),
    "row_diff_tree": _keyed_oracle(
        "orders",
        "SELECT * REPLACE (CASE WHEN o_custkey % 5000 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) "
        "FROM orders WHERE coalesce(o_custkey % 5000 <> 4, true)",
        ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    ),
    "row_diff_keyed": _keyed_oracle(
        "orders", _ORDERS_T2, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    ),
}
