"""Registered configuration queries (C1-C3, C5, C6, C8) and their DuckDB oracles.

Every customer is a pipeline: a fixed manifest map, a branch map chosen by
market segment (absent for BUILDING), a Spark version by account balance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.operators import confmap as C
from driftcheck.sources.tables import read_table

# Text edits applied in order to every document.
TEXT_CHANGES = [("spark_version", "the", "THE"), ("spark_version", "THE", "teh"), ("codec", "e", "ë")]


def pipeline_confs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    branch = (
        F.when(seg == "BUILDING", F.lit(None).cast("map<string,string>"))
        .when(seg == "AUTOMOBILE", F.create_map(F.lit("spark.sql.shuffle.partitions"), F.col("c_nationkey").cast("string")))
        .when(seg == "FURNITURE", F.create_map(F.lit("spark.sql.ansi.enabled"), F.lit("false"), F.lit("spark.executor.memory"), F.lit("4g")))
        .when(seg == "HOUSEHOLD", C.empty_conf())
        .otherwise(F.create_map(F.lit("spark.master"), F.lit("yarn"), F.lit("spark.sql.ansi.enabled"), F.lit("true")))
    )
    return c.select(
        F.col("c_custkey").alias("pipeline_id"),
        F.create_map(F.lit("spark.master"), F.lit("local[*]"), F.lit("spark.sql.shuffle.partitions"), F.lit("4")).alias("manifest_conf"),
        branch.alias("branch_conf"),
        F.when(F.col("c_acctbal") >= 0, "4.0.0").otherwise("3.5.4").alias("spark_version"),
        (F.col("c_custkey") % 3).alias("fix_kind"),
    )


def q_effective_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pipeline_confs(spark, sf_dir)
    return p.select(
        "pipeline_id",
        C.conf_text(C.overlay("manifest_conf", "branch_conf")).alias("merged_conf"),
        C.conf_text(C.effective_conf("manifest_conf", "branch_conf", "spark_version")).alias("effective_conf"),
    )


def q_conf_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pipeline_confs(spark, sf_dir)
    key = F.when(F.col("fix_kind") == 0, "spark.sql.ansi.enabled").when(F.col("fix_kind") == 1, "spark.sql.legacy.timeParserPolicy")
    val = F.when(F.col("fix_kind") == 0, "false").when(F.col("fix_kind") == 1, "LEGACY")
    fixed = F.when(key.isNotNull(), C.set_key("branch_conf", key, val)).otherwise(F.col("branch_conf"))
    return p.select("pipeline_id", F.coalesce(C.conf_text(fixed), F.lit("<none>")).alias("fixed_conf"))


def q_text_modify(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    changes = F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit(a).alias("from_value"), F.lit(b).alias("to_value")) for k, a, b in TEXT_CHANGES]
    )
    return d.select("doc_id", C.apply_changes(F.col("text"), changes).alias("text"))


def manifest_text(c_custkey, seg, nationkey, acctbal):
    owner = F.when(seg == "BUILDING", F.lit("")).otherwise(F.lit(', "owner": "data-platform"'))
    am = F.when(seg == "MACHINERY", F.lit("true")).otherwise(F.lit("false"))
    pipeline = F.when(nationkey % 5 == 0, F.lit("")).otherwise(F.lit('"pipeline": {"id": "customer-transactions", "entry_script": "pipeline/spark_job.py"}, '))
    action = F.when(acctbal < 0, F.lit('"auto"')).otherwise(F.lit('"escalate"'))
    sev = F.when(nationkey % 7 == 1, F.lit('"fatal"')).otherwise(F.lit('"critical"'))
    return F.concat(
        F.lit('{"test": {"name": "t'), c_custkey.cast("string"), F.lit('", "description": "upgrade"'), owner, F.lit("}, "),
        F.lit('"source_control": {"owner": "o", "repo": "r", "baseline": {"branch": "main"}, "target": {"branch_prefix": "auto/upgrade-test"}, "pr": {"auto_merge": '),
        am, F.lit("}}, "), pipeline,
        F.lit('"execution": {"output_base": "output", "baseline_spark_version": "3.5.4", "target_spark_version": "4.0.0", "timeouts": {"single_pipeline_seconds": 300}}, '),
        F.lit('"log_analysis": {"known_failure_patterns": [{"pattern": "a", "diagnosis": "b", "action": "config_fix", "auto_fix": true}, '),
        F.lit('{"pattern": "c", "diagnosis": "d", "action": '), action, F.lit(', "auto_fix": false}], "retry": {"max_retries": 2, "backoff_seconds": 5}}, '),
        F.lit('"validation": {"checks": [{"name": "row_count_match", "type": "exact", "severity": '), sev, F.lit("}]}, "),
        F.lit('"reporting": {"output_dir": "reports"}, "upgrade_strategy": {"type": "spark_version_bump", "version_mapping": {"baseline": {"spark": "3.5.4"}, "target": {"spark": "4.0.0"}}}}'),
    )


def q_manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    # few bytes a row and much work: a small file is one task, so the rows are dealt to all cores before their texts are made
    c = c.repartition(4 * spark.sparkContext.defaultParallelism)
    txt = manifest_text(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal"))
    parsed = C.parse_manifests(c.select(F.col("c_custkey").alias("manifest_id"), txt.alias("manifest_text")), "manifest_text")
    return parsed.select("manifest_id", F.col("errors").isNull().alias("valid"), "errors")


QUERIES = {
    "effective_conf": q_effective_conf,
    "conf_fix": q_conf_fix,
    "text_modify": q_text_modify,
    "manifest_check": q_manifest_check,
}


# --- oracles ----------------------------------------------------------------------------

_ENTRIES_SQL = (
    "SELECT c_custkey AS pid, 0 AS src, k, v FROM customer, (VALUES ('spark.master', 'local[*]'), ('spark.sql.shuffle.partitions', '4')) AS m(k, v) "
    "UNION ALL SELECT c_custkey, 1, 'spark.sql.shuffle.partitions', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'AUTOMOBILE' "
    "UNION ALL SELECT c_custkey, 1, k, v FROM customer, (VALUES ('spark.sql.ansi.enabled', 'false'), ('spark.executor.memory', '4g')) AS b(k, v) WHERE c_mktsegment = 'FURNITURE' "
    "UNION ALL SELECT c_custkey, 1, k, v FROM customer, (VALUES ('spark.master', 'yarn'), ('spark.sql.ansi.enabled', 'true')) AS b(k, v) "
    "WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')"
)
_MERGED_SQL = f"SELECT pid, k, arg_max(v, src) AS v FROM ({_ENTRIES_SQL}) GROUP BY pid, k"
_EFFECTIVE_SQL = (
    f"SELECT pid, k, v FROM ({_MERGED_SQL}) WHERE k <> 'spark.master' "
    "UNION ALL SELECT c_custkey, 'spark.sql.ansi.enabled', 'true' FROM customer WHERE c_acctbal >= 0 AND c_custkey NOT IN "
    f"(SELECT pid FROM ({_MERGED_SQL}) WHERE k = 'spark.sql.ansi.enabled')"
)
_BRANCH_SQL = (
    "SELECT c_custkey AS pid, 0 AS src, 'spark.sql.shuffle.partitions' AS k, CAST(c_nationkey AS VARCHAR) AS v FROM customer WHERE c_mktsegment = 'AUTOMOBILE' "
    "UNION ALL SELECT c_custkey, 0, k, v FROM customer, (VALUES ('spark.sql.ansi.enabled', 'false'), ('spark.executor.memory', '4g')) AS b(k, v) WHERE c_mktsegment = 'FURNITURE' "
    "UNION ALL SELECT c_custkey, 0, k, v FROM customer, (VALUES ('spark.master', 'yarn'), ('spark.sql.ansi.enabled', 'true')) AS b(k, v) "
    "WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD') "
    "UNION ALL SELECT c_custkey, 1, 'spark.sql.ansi.enabled', 'false' FROM customer WHERE c_custkey % 3 = 0 "
    "UNION ALL SELECT c_custkey, 1, 'spark.sql.legacy.timeParserPolicy', 'LEGACY' FROM customer WHERE c_custkey % 3 = 1"
)


def _agg_text(entries: str) -> str:
    return f"SELECT pid, string_agg(k || '=' || v, ';' ORDER BY k || '=' || v) AS t FROM ({entries}) GROUP BY pid"


def _replace_chain() -> str:
    e = "text"
    for _, a, b in TEXT_CHANGES:
        e = f"replace({e}, '{a}', '{b}')"
    return e


_MANIFEST_SQL = (
    "'{\"test\": {\"name\": \"t' || c_custkey || '\", \"description\": \"upgrade\"' || "
    "CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE ', \"owner\": \"data-platform\"' END || '}, ' || "
    "'\"source_control\": {\"owner\": \"o\", \"repo\": \"r\", \"baseline\": {\"branch\": \"main\"}, \"target\": {\"branch_prefix\": \"auto/upgrade-test\"}, \"pr\": {\"auto_merge\": ' || "
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'true' ELSE 'false' END || '}}, ' || "
    "CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE '\"pipeline\": {\"id\": \"customer-transactions\", \"entry_script\": \"pipeline/spark_job.py\"}, ' END || "
    "'\"execution\": {\"output_base\": \"output\", \"baseline_spark_version\": \"3.5.4\", \"target_spark_version\": \"4.0.0\", \"timeouts\": {\"single_pipeline_seconds\": 300}}, ' || "
    "'\"log_analysis\": {\"known_failure_patterns\": [{\"pattern\": \"a\", \"diagnosis\": \"b\", \"action\": \"config_fix\", \"auto_fix\": true}, ' || "
    "'{\"pattern\": \"c\", \"diagnosis\": \"d\", \"action\": ' || CASE WHEN c_acctbal < 0 THEN '\"auto\"' ELSE '\"escalate\"' END || "
    "', \"auto_fix\": false}], \"retry\": {\"max_retries\": 2, \"backoff_seconds\": 5}}, ' || "
    "'\"validation\": {\"checks\": [{\"name\": \"row_count_match\", \"type\": \"exact\", \"severity\": ' || "
    "CASE WHEN c_nationkey % 7 = 1 THEN '\"fatal\"' ELSE '\"critical\"' END || '}]}, ' || "
    "'\"reporting\": {\"output_dir\": \"reports\"}, \"upgrade_strategy\": {\"type\": \"spark_version_bump\", \"version_mapping\": {\"baseline\": {\"spark\": \"3.5.4\"}, \"target\": {\"spark\": \"4.0.0\"}}}}'"
)


def _manifest_oracle() -> str:
    j = "m"
    checks = [
        f"CASE WHEN json_extract({j}, '$.test.owner') IS NULL THEN 'test.owner: {C.MSG_REQUIRED}' END",
        f"CASE WHEN json_extract_string({j}, '$.source_control.pr.auto_merge') <> 'false' THEN 'source_control.pr.auto_merge: {C.MSG_FALSE}' END",
        f"CASE WHEN json_extract({j}, '$.pipeline') IS NULL THEN 'pipeline: {C.MSG_REQUIRED}' END",
        f"CASE WHEN json_extract_string({j}, '$.log_analysis.known_failure_patterns[1].action') NOT IN ('config_fix', 'code_change', 'escalate') "
        f"THEN 'log_analysis.known_failure_patterns.1.action: {C.MSG_ACTION.replace(chr(39), chr(39) * 2)}' END",
        f"CASE WHEN json_extract_string({j}, '$.validation.checks[0].severity') NOT IN ('critical', 'warning', 'info') "
        f"THEN 'validation.checks.0.severity: {C.MSG_SEVERITY.replace(chr(39), chr(39) * 2)}' END",
    ]
    # only the five paths the derivation varies can fail; the other sections are constant and valid
    return (
        f"SELECT manifest_id, errors IS NULL AS valid, errors FROM (SELECT c_custkey AS manifest_id, "
        f"nullif(concat_ws('; ', {', '.join(checks)}), '') AS errors FROM (SELECT c_custkey, {_MANIFEST_SQL} AS m FROM customer))"
    )


ORACLE = {
    "effective_conf": (
        "SELECT c.c_custkey AS pipeline_id, coalesce(m.t, '') AS merged_conf, coalesce(e.t, '') AS effective_conf FROM customer c "
        f"LEFT JOIN ({_agg_text(_MERGED_SQL)}) m ON c.c_custkey = m.pid LEFT JOIN ({_agg_text(_EFFECTIVE_SQL)}) e ON c.c_custkey = e.pid"
    ),
    "conf_fix": (
        "SELECT c.c_custkey AS pipeline_id, CASE WHEN c.c_mktsegment = 'BUILDING' AND c.c_custkey % 3 = 2 THEN '<none>' ELSE coalesce(f.t, '') END AS fixed_conf "
        f"FROM customer c LEFT JOIN ({_agg_text(f'SELECT pid, k, arg_max(v, src) AS v FROM ({_BRANCH_SQL}) GROUP BY pid, k')}) f ON c.c_custkey = f.pid"
    ),
    "text_modify": f"SELECT doc_id, {_replace_chain()} AS text FROM documents",
    "manifest_check": _manifest_oracle(),
}
