"""Registered run-state queries (R1-R22) and their DuckDB oracles.

Each user of ``events`` is a run; each event row becomes one audit event
(the event name is chosen by event type and the ``k`` of its props) and two
change-log rows (one field of the run's metadata or pipeline record, plus
``updated_at``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.operators import runstate as R
from driftcheck.session import cut_lineage
from driftcheck.sources.tables import read_table

PIPELINE_ID = "customer-transactions"
TOOLS = ["grep_log", "read_file", "get_run_history", "search_web"]
META_FIELDS = ["status", "phase", "created_at", "updated_at", "overall_status", "pending_approval_task_token"]
PIPE_FIELDS = ["pipeline_id", "status", "baseline_status", "target_status", "retry_count", "diagnosis", "validation_results", "updated_at"]
VERSIONS = ("3.5.4", "4.0.0")


# --- derivations (Spark) ---------------------------------------------------------------------

def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _two(k: Column) -> Column:
    return F.concat(F.lit("0."), F.lpad(k.cast("string"), 2, "0"))


def _event_name(et: Column, k: Column) -> Column:
    return (
        F.when(et == "signup", "failure_analyzed")
        .when(et == "purchase", F.when(k % 3 == 0, "auto_fix_applied").when(k % 3 == 1, "approval_approved").otherwise("retry_with_human_fix"))
        .when(et == "error", F.when(k % 2 == 0, "escalated").otherwise("awaiting_approval"))
        .when(et == "view", F.when(k % 5 == 0, "react_loop_started").when(k % 5 == 1, "react_loop_finished").otherwise("tool_call"))
        .otherwise("llm_call")
    )


def _m(*kv) -> Column:
    return F.create_map(*[x if isinstance(x, Column) else F.lit(x) for x in kv])


def _details(ev: Column, k: Column) -> Column:
    cost_n = (F.lit(400) + k) * 150 + (F.lit(50) + k % 13) * 600
    return (
        F.when(ev == "failure_analyzed", _m("source", "pattern_matcher", "diagnosis",
                                            F.when(k % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("diagnosis "), k.cast("string")))))
        .when(ev == "auto_fix_applied", _m("fix_key", "spark.sql.ansi.enabled", "fix_value", "false", "retry_count", (k % 3).cast("string")))
        .when(ev == "approval_approved", _m("fix_key", "spark.sql.legacy.timeParserPolicy", "fix_value", "LEGACY"))
        .when(ev == "retry_with_human_fix", _m("retry_count", (k % 4).cast("string")))
        .when(ev == "escalated", _m("reason", F.when(k % 4 == 0, "not_auto_fixable").otherwise("max_retries_exhausted")))
        .when(ev == "awaiting_approval", _m("confidence", _two(k)))
        .when(ev == "tool_call", _m(
            "tool", F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (k % 4 + 1).cast("int")),
            "args", F.concat(F.lit("{'pattern': 'k"), k.cast("string"), F.lit("'}")),
            "result_summary", F.concat(F.lit("found "), (k % 7).cast("string"), F.lit(" lines"))))
        .when(ev == "react_loop_started", _m("trigger_confidence", _two(k)))
        .when(ev == "react_loop_finished", _m("tools_used", "['grep_log', 'read_file']", "final_confidence", "0.80"))
        .otherwise(_m(
            "model", "gpt-4o-mini", "prompt_tokens", (F.lit(400) + k).cast("string"),
            "completion_tokens", (F.lit(50) + k % 13).cast("string"),
            "estimated_cost_usd", F.concat(F.lit("0."), F.lpad(cost_n.cast("string"), 9, "0"))))
    )


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, record_type, ts, timestamp, phase, event, details, seq)."""
    ev = read_table(spark, sf_dir, "events")
    k = _k()
    name = _event_name(F.col("event_type"), k)
    iso = R.iso_utc(F.col("ts"))
    return ev.select(
        F.col("user_id").alias("run_id"),
        F.concat(F.lit(R.EVENT_RECORD_PREFIX), iso, F.lit("#"), F.lpad(F.lower(F.hex("event_id")), 8, "0")).alias("record_type"),
        "ts",
        iso.alias("timestamp"),
        F.lit("ANALYZE").alias("phase"),
        name.alias("event"),
        _details(name, k).alias("details"),
        F.col("event_id").alias("seq"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    first = ev.groupBy(F.col("user_id").alias("run_id")).agg(F.min("ts").alias("created_ts"))
    return first.withColumn("config", F.format_string('{"run":%d}', F.col("run_id")))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 init rows plus two change rows per event; a click writes an explicit null."""
    ev = read_table(spark, sf_dir, "events")
    k = _k()
    et = F.col("event_type")
    rec = F.when(et.isin("signup", "click"), F.lit(R.METADATA_RECORD_TYPE)).otherwise(F.lit(PIPELINE_ID))
    field = (
        F.when(et == "signup", "phase").when(et == "purchase", "retry_count").when(et == "error", "status")
        .when(et == "view", "diagnosis").otherwise("pending_approval_task_token")
    )
    value = (
        F.when(et == "signup", F.lit("ANALYZE")).when(et == "purchase", (k % 3).cast("string"))
        .when(et == "error", F.lit("FAILED")).when(et == "view", F.concat(F.lit("diag-"), k.cast("string")))
    ).cast("string")
    result = F.when(k % 3 == 0, "PASSED").when(k % 3 == 1, "WARNING").otherwise("FAILED")
    checks = F.concat(F.lit('{"overall_status":"'), result, F.lit('","checks":["row_count_match"]}'))

    def row(record, name, v):
        return F.struct(record.alias("record_type"), name.alias("field"), v.cast("string").alias("value"))

    written = F.array(
        row(rec, field, value),
        row(rec, F.lit("updated_at"), R.iso_utc(F.col("ts"))),
        # a purchase also stores a validation: its document on the pipeline, its status on the run
        F.when(et == "purchase", row(F.lit(PIPELINE_ID), F.lit("validation_results"), checks)),
        F.when(et == "purchase", row(F.lit(R.METADATA_RECORD_TYPE), F.lit("overall_status"), result)),
    )
    changes = ev.select(F.col("user_id").alias("run_id"), F.inline(F.array_compact(written)), "ts", F.col("event_id").alias("seq"))
    init = R.init_changes(runs(spark, sf_dir), F.lit(PIPELINE_ID), "created_ts", config="config")
    return init.unionByName(changes)


def folded_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Current metadata and pipeline records.

    The change log is folded once into one wide row per record and
    materialized (a row per record, far smaller than the log); metadata and
    pipeline views are filters of that table, so no reader re-folds the log.
    """
    folded = R.fold_changes(change_log(spark, sf_dir))
    fields = list(dict.fromkeys(META_FIELDS + PIPE_FIELDS))
    wide = cut_lineage(R.pivot_fields(folded, fields))
    meta = wide.filter(F.col("record_type") == R.METADATA_RECORD_TYPE).select("run_id", "record_type", *META_FIELDS)
    pipe = wide.filter(F.col("record_type") != R.METADATA_RECORD_TYPE).select("run_id", "record_type", *PIPE_FIELDS)
    return meta, pipe


def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the store: metadata, pipeline and event rows, in one shape."""
    meta, pipe = folded_records(spark, sf_dir)
    ev = audit_events(spark, sf_dir)
    cols = ["run_id", "record_type", "status", "retry_count", "diagnosis", "updated_at"]
    m = meta.select("run_id", "record_type", "status", F.lit(None).cast("string").alias("retry_count"),
                    F.lit(None).cast("string").alias("diagnosis"), "updated_at")
    p = pipe.select(*cols)
    e = ev.select("run_id", "record_type", F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("retry_count"),
                  F.col("details")["diagnosis"].alias("diagnosis"), F.col("timestamp").alias("updated_at"))
    return m.unionByName(p).unionByName(e)


# --- queries -----------------------------------------------------------------------------------

def q_run_init(spark, sf_dir):
    return R.init_changes(runs(spark, sf_dir), F.lit(PIPELINE_ID), "created_ts", config="config").select("run_id", "record_type", "field", "value")


def q_state_fold(spark, sf_dir):
    return R.fold_changes(change_log(spark, sf_dir)).select("run_id", "record_type", "field", "value")


def q_run_events(spark, sf_dir):
    return R.events_in_order(audit_events(spark, sf_dir)).select("run_id", "record_type", "timestamp", "event", "seq")


def q_pipelines_only(spark, sf_dir):
    return R.pipeline_records(state_table(spark, sf_dir))


def q_point_lookup(spark, sf_dir):
    r = runs(spark, sf_dir).select("run_id")
    req = r.select("run_id", F.explode(F.array(F.lit(R.METADATA_RECORD_TYPE), F.lit(PIPELINE_ID), F.lit("missing-pipeline"))).alias("record_type"))
    st = state_table(spark, sf_dir).filter(~F.col("record_type").startswith(R.EVENT_RECORD_PREFIX)).select("run_id", "record_type", "status")
    return R.lookup(st, req).select("run_id", "record_type", "found", "status")


def q_recent_runs(spark, sf_dir):
    meta, _ = folded_records(spark, sf_dir)
    return R.recent_runs(meta).select("run_id", "created_at", "status", "phase")


def q_snapshot(spark, sf_dir):
    meta, pipe = folded_records(spark, sf_dir)
    s = R.snapshot(meta.select("run_id", *META_FIELDS), pipe.select("run_id", *PIPE_FIELDS), audit_events(spark, sf_dir))
    opts = {"ignoreNullFields": "false"}
    return s.select("run_id", F.to_json("metadata", opts).alias("metadata_json"), F.to_json("pipelines", opts).alias("pipelines_json"), "n_events")


def q_run_history(spark, sf_dir):
    r = runs(spark, sf_dir).select("run_id", F.lit(PIPELINE_ID).alias("pipeline_id"))
    return R.run_history(audit_events(spark, sf_dir), r)


def q_timeline(spark, sf_dir):
    t = R.timeline(audit_events(spark, sf_dir), R.timeline_labels(spark))
    return t.select("run_id", "seq", "label", "timestamp", "detail")


def q_duration_text(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    span = ev.groupBy(F.col("user_id").alias("run_id")).agg(
        F.min("ts").alias("s"), F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("e")
    )
    created, updated = R.iso_utc(F.col("s")), R.iso_utc(F.col("e"))
    return span.select("run_id", created.alias("created_at"), updated.alias("updated_at"), R.duration_text(created, updated).alias("duration"))


def q_report_row(spark, sf_dir):
    ev = audit_events(spark, sf_dir)
    e = F.col("event")
    agg = ev.groupBy("run_id").agg(
        F.count_if(e == "awaiting_approval").alias("n_wait"),
        F.count_if(e == "escalated").alias("n_esc"),
        F.count_if(e.isin(*R.RETRY_EVENTS)).alias("retry_count"),
        F.count_if(e == "failure_analyzed").alias("n_analyzed"),
        F.max_by(F.when(e == "failure_analyzed", F.col("details")["diagnosis"]), F.when(e == "failure_analyzed", F.col("seq"))).alias("diagnosis"),
    )
    _, pipe = folded_records(spark, sf_dir)
    status = (
        F.when(F.col("n_wait") > 0, "AWAITING_APPROVAL").when(F.col("n_esc") > F.col("retry_count"), "FAILED")
        .when(F.col("retry_count") > 0, "PASSED").otherwise("WARNING")
    )
    analysis = F.when(F.col("n_analyzed") > 0, F.to_json(F.struct("diagnosis"), {"ignoreNullFields": "false"}))
    rows = agg.select(
        "run_id", status.alias("overall_status"), "retry_count", F.lit(VERSIONS[0]).alias("baseline_spark_version"), F.lit(VERSIONS[1]).alias("target_spark_version"),
        F.lit("main").alias("baseline_branch"), F.concat(F.lit("auto/upgrade-test-"), F.col("run_id").cast("string")).alias("target_branch"),
        analysis.alias("analysis_result"), (F.col("n_analyzed") > 0).alias("has_analysis"), (F.col("retry_count") > 0).alias("auto_fix"), "diagnosis",
    )
    return R.report_rows(rows, ev, pipe)


def q_presence_check(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    r = runs(spark, sf_dir).select("run_id")
    expected = r.select(
        "run_id",
        F.inline(F.array(
            F.struct(F.lit(0).alias("branch_rank"), F.lit("main").alias("branch")),
            F.struct(F.lit(1).alias("branch_rank"), F.concat(F.lit("auto/upgrade-test-"), F.col("run_id").cast("string")).alias("branch")),
        )),
        F.lit("pipeline/spark_job.py").alias("file"),
    )
    listing = ev.filter(F.col("event_type").isin("signup", "purchase")).select(
        F.col("user_id").alias("run_id"),
        F.when(F.col("event_type") == "signup", F.lit("main"))
        .otherwise(F.concat(F.lit("auto/upgrade-test-"), F.col("user_id").cast("string"))).alias("branch"),
        F.lit("pipeline/spark_job.py").alias("file"),
    ).distinct()
    return R.presence_check(expected, listing)


def q_work_list(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    first = ev.groupBy(F.col("user_id").alias("run_id")).agg(F.min_by("event_type", "event_id").alias("first_type"))
    bs = F.when(F.col("first_type") != "error", F.lit("SUCCEEDED")).otherwise(F.lit("FAILED"))
    return R.work_list(first, bs)


def q_retry_count(spark, sf_dir):
    return R.retry_counts(audit_events(spark, sf_dir))


def q_pipeline_status(spark, sf_dir):
    _, pipe = folded_records(spark, sf_dir)
    return R.pipeline_status_table(pipe)


def q_run_summary(spark, sf_dir):
    meta, _ = folded_records(spark, sf_dir)
    return R.run_summary(meta)


QUERIES = {
    "run_init": q_run_init,
    "state_fold": q_state_fold,
    "run_events": q_run_events,
    "pipelines_only": q_pipelines_only,
    "point_lookup": q_point_lookup,
    "recent_runs": q_recent_runs,
    "snapshot": q_snapshot,
    "run_history": q_run_history,
    "timeline": q_timeline,
    "duration_text": q_duration_text,
    "report_row": q_report_row,
    "presence_check": q_presence_check,
    "work_list": q_work_list,
    "retry_count": q_retry_count,
    "pipeline_status": q_pipeline_status,
    "run_summary": q_run_summary,
}


# --- oracles ----------------------------------------------------------------------------------

def _iso_sql(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({ts}, '%f') = '000000' THEN '' "
        f"ELSE '.' || strftime({ts}, '%f') END || '+00:00'"
    )


_K = "CAST(json_extract_string(props, '$.k') AS INT)"
_NAME = (
    "CASE event_type WHEN 'signup' THEN 'failure_analyzed' "
    "WHEN 'purchase' THEN (CASE k % 3 WHEN 0 THEN 'auto_fix_applied' WHEN 1 THEN 'approval_approved' ELSE 'retry_with_human_fix' END) "
    "WHEN 'error' THEN (CASE k % 2 WHEN 0 THEN 'escalated' ELSE 'awaiting_approval' END) "
    "WHEN 'view' THEN (CASE k % 5 WHEN 0 THEN 'react_loop_started' WHEN 1 THEN 'react_loop_finished' ELSE 'tool_call' END) "
    "ELSE 'llm_call' END"
)
EV_SQL = (
    f"SELECT user_id AS run_id, event_id AS seq, ts, k, value, event_type, {_NAME} AS event, {_iso_sql('ts')} AS timestamp, "
    f"'event#' || {_iso_sql('ts')} || '#' || lpad(lower(hex(event_id)), 8, '0') AS record_type, 'ANALYZE' AS phase "
    f"FROM (SELECT *, {_K} AS k FROM events)"
)
_DIAG = "CASE WHEN event = 'failure_analyzed' THEN (CASE WHEN k % 10 = 0 THEN '' ELSE 'diagnosis ' || k END) END"
_REASON = "CASE WHEN event = 'escalated' THEN (CASE WHEN k % 4 = 0 THEN 'not_auto_fixable' ELSE 'max_retries_exhausted' END) END"

_RESULT = "(CASE k % 3 WHEN 0 THEN 'PASSED' WHEN 1 THEN 'WARNING' ELSE 'FAILED' END)"
_CHANGES_SQL = (
    f"WITH r AS (SELECT user_id AS run_id, min(ts) AS cts FROM events GROUP BY user_id), "
    f"e AS (SELECT *, {_K} AS k FROM events) "
    f"SELECT run_id, '_metadata' AS record_type, f AS field, v AS value, cts AS ts, -1 AS seq FROM r, "
    f"LATERAL (VALUES ('status', 'RUNNING'), ('phase', 'BRANCH'), ('config', '{{\"run\":' || run_id || '}}'), ('created_at', {_iso_sql('cts')}), ('updated_at', {_iso_sql('cts')}), ('overall_status', 'RUNNING')) AS x(f, v) "
    f"UNION ALL SELECT run_id, '{PIPELINE_ID}', f, v, cts, -1 FROM r, LATERAL (VALUES ('pipeline_id', '{PIPELINE_ID}'), ('status', 'PENDING'), "
    f"('phase', 'BRANCH'), ('baseline_status', 'PENDING'), ('target_status', 'PENDING'), ('retry_count', '0'), ('started_at', {_iso_sql('cts')}), ('updated_at', {_iso_sql('cts')}), "
    "('metrics', '{}'), ('validation_results', '{}'), ('variant', NULL), ('completed_at', NULL), ('baseline_log_path', NULL), ('target_log_path', NULL), "
    "('baseline_output_path', NULL), ('target_output_path', NULL), ('error_message', NULL), ('diagnosis', NULL), ('corrective_action', NULL)) AS x(f, v) "
    "UNION ALL SELECT user_id, CASE WHEN event_type IN ('signup', 'click') THEN '_metadata' ELSE 'customer-transactions' END, "
    "CASE event_type WHEN 'signup' THEN 'phase' WHEN 'purchase' THEN 'retry_count' WHEN 'error' THEN 'status' WHEN 'view' THEN 'diagnosis' "
    "ELSE 'pending_approval_task_token' END, "
    "CASE event_type WHEN 'signup' THEN 'ANALYZE' WHEN 'purchase' THEN CAST(k % 3 AS VARCHAR) WHEN 'error' THEN 'FAILED' "
    "WHEN 'view' THEN 'diag-' || k END, ts, event_id FROM e "
    "UNION ALL SELECT user_id, CASE WHEN event_type IN ('signup', 'click') THEN '_metadata' ELSE 'customer-transactions' END, "
    f"'updated_at', {_iso_sql('ts')}, ts, event_id FROM e "
    f"UNION ALL SELECT user_id, '{PIPELINE_ID}', 'validation_results', '{{\"overall_status\":\"' || {_RESULT} || '\",\"checks\":[\"row_count_match\"]}}', ts, event_id FROM e WHERE event_type = 'purchase' "
    f"UNION ALL SELECT user_id, '_metadata', 'overall_status', {_RESULT}, ts, event_id FROM e WHERE event_type = 'purchase'"
)
FOLD_SQL = (
    f"SELECT run_id, record_type, field, value FROM (SELECT *, row_number() OVER (PARTITION BY run_id, record_type, field "
    f"ORDER BY ts DESC, seq DESC) AS rn FROM ({_CHANGES_SQL})) WHERE rn = 1"
)


def _wide(fields: list[str], cond: str) -> str:
    cols = ", ".join(f"max(CASE WHEN field = '{f}' THEN value END) AS {f}" for f in fields)
    return f"SELECT run_id, record_type, {cols} FROM ({FOLD_SQL}) WHERE {cond} GROUP BY run_id, record_type"


META_SQL = _wide(META_FIELDS, "record_type = '_metadata'")
PIPE_SQL = _wide(PIPE_FIELDS, "record_type <> '_metadata'")
STATE_SQL = (
    f"SELECT run_id, record_type, status, NULL AS retry_count, NULL AS diagnosis, updated_at FROM ({META_SQL}) "
    f"UNION ALL SELECT run_id, record_type, status, retry_count, diagnosis, updated_at FROM ({PIPE_SQL}) "
    f"UNION ALL SELECT run_id, record_type, NULL, NULL, {_DIAG}, timestamp FROM ({EV_SQL})"
)


def _py(x: str) -> str:
    return f"coalesce({x}, 'None')"


_TOOL = f"[{', '.join(repr(t) for t in TOOLS)}][k % 4 + 1]"
_COST = "'0.' || lpad(CAST((400 + k) * 150 + (50 + k % 13) * 600 AS VARCHAR), 9, '0')"
_DETAIL = (
    f"CASE event WHEN 'tool_call' THEN '`' || {_TOOL} || '(' || '{{''pattern'': ''k' || k || '''}}' || ')` → found ' || (k % 7) || ' lines' "
    f"WHEN 'llm_call' THEN 'model=gpt-4o-mini · prompt_tokens=' || (400 + k) || ' · completion_tokens=' || (50 + k % 13) || "
    f"' · cost=$' || CAST(CAST(CAST({_COST} AS DECIMAL(30, 9)) AS DECIMAL(30, 6)) AS VARCHAR) "
    "WHEN 'react_loop_started' THEN 'trigger confidence: 0.' || lpad(CAST(k AS VARCHAR), 2, '0') "
    "WHEN 'react_loop_finished' THEN 'tools used: [''grep_log'', ''read_file''] · final confidence: 0.80' "
    "WHEN 'auto_fix_applied' THEN 'set `spark.sql.ansi.enabled = false`' "
    "WHEN 'approval_approved' THEN 'applied `spark.sql.legacy.timeParserPolicy = LEGACY`' "
    "WHEN 'retry_with_human_fix' THEN 'retry_count: ' || (k % 4) "
    f"WHEN 'failure_analyzed' THEN nullif({_DIAG}, '') "
    f"WHEN 'escalated' THEN {_REASON} "
    "WHEN 'awaiting_approval' THEN 'confidence: 0.' || lpad(CAST(k AS VARCHAR), 2, '0') END"
)
_LABELS = ", ".join(f"('{e}', '{lab}')" for e, lab in R.TIMELINE_LABELS)


def _s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_REPORT_SQL = (
    f"WITH e AS ({EV_SQL}), a AS (SELECT run_id, count(*) FILTER (WHERE event = 'awaiting_approval') AS n_wait, "
    "count(*) FILTER (WHERE event = 'escalated') AS n_esc, "
    "count(*) FILTER (WHERE event IN ('auto_fix_applied', 'approval_approved', 'retry_with_human_fix')) AS retry_count, "
    "count(*) FILTER (WHERE event = 'failure_analyzed') AS n_analyzed, nullif(count(*) FILTER (WHERE event = 'llm_call'), 0) AS n_llm, "
    "CAST(sum(400 + k) FILTER (WHERE event = 'llm_call') AS BIGINT) AS n_prompt, CAST(sum(50 + k % 13) FILTER (WHERE event = 'llm_call') AS BIGINT) AS n_completion, "
    f"sum(CAST({_COST} AS DECIMAL(20, 9))) FILTER (WHERE event = 'llm_call') AS cost, "
    f"arg_max({_DIAG}, seq) FILTER (WHERE event = 'failure_analyzed') AS diagnosis FROM e GROUP BY run_id), "
    "s AS (SELECT *, CASE WHEN n_wait > 0 THEN 'AWAITING_APPROVAL' WHEN n_esc > retry_count THEN 'FAILED' "
    "WHEN retry_count > 0 THEN 'PASSED' ELSE 'WARNING' END AS st FROM a) "
    "SELECT s.run_id, st AS overall_status, s.retry_count, coalesce(p.baseline_status, 'UNKNOWN') AS baseline_status, "
    "coalesce(p.status, 'UNKNOWN') AS target_status, "
    f"CASE WHEN st IN ('PASSED', 'SUCCEEDED') AND s.retry_count > 0 THEN {_s(R.SUMMARY_PASSED_RETRY.split('{n}')[0])} || s.retry_count || {_s(R.SUMMARY_PASSED_RETRY.split('{n}')[1])} "
    f"WHEN st IN ('PASSED', 'SUCCEEDED') THEN {_s(R.SUMMARY_PASSED)} WHEN st = 'WARNING' THEN {_s(R.SUMMARY_WARNING)} "
    f"WHEN st = 'AWAITING_APPROVAL' THEN {_s(R.SUMMARY_AWAITING)} ELSE {_s(R.SUMMARY_FAILED)} END AS executive_summary, "
    "CASE WHEN st IN ('PASSED', 'SUCCEEDED') THEN '' "
    f"WHEN n_analyzed > 0 AND NOT s.retry_count > 0 THEN {_s(R.RECOMMEND_MANUAL)} || ' | Diagnosis: ' || coalesce(s.diagnosis, 'unknown') "
    f"ELSE {_s(R.RECOMMEND_RETRY)} END AS recommendations, n_llm AS llm_calls, n_prompt AS total_prompt_tokens, n_completion AS total_completion_tokens, "
    "CAST(cost AS VARCHAR) AS total_estimated_cost_usd, p.pipeline_id, "
    f"'{VERSIONS[0]}' AS baseline_spark_version, '{VERSIONS[1]}' AS target_spark_version, 'main' AS baseline_branch, 'auto/upgrade-test-' || s.run_id AS target_branch, "
    "coalesce(CAST(json_extract(p.validation_results, '$.checks') AS VARCHAR), '[]') AS validation_checks, "
    "CASE WHEN n_analyzed > 0 THEN CAST(to_json(struct_pack(diagnosis := s.diagnosis)) AS VARCHAR) END AS analysis_result "
    f"FROM s LEFT JOIN ({PIPE_SQL}) p ON s.run_id = p.run_id"
)

def _duration_sql(a: str, b: str) -> str:
    """``str(b - a)`` without the fraction, from ISO texts; '-' when either is missing or invalid."""
    us = f"(epoch_us(TRY_CAST({b} AS TIMESTAMPTZ)) - epoch_us(TRY_CAST({a} AS TIMESTAMPTZ)))"
    days = f"CAST(floor({us} / 86400000000) AS BIGINT)"
    rem = f"CAST(floor(({us} - {days} * 86400000000) / 1000000) AS BIGINT)"
    return (
        f"CASE WHEN coalesce({a}, '') = '' OR coalesce({b}, '') = '' OR {us} IS NULL THEN '-' ELSE "
        f"(CASE WHEN {days} = 0 THEN '' ELSE {days} || CASE WHEN abs({days}) = 1 THEN ' day, ' ELSE ' days, ' END END) || "
        f"({rem} // 3600) || ':' || lpad(CAST(({rem} % 3600) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({rem} % 60 AS VARCHAR), 2, '0') END"
    )


ORACLE = {
    "pipeline_status": (
        "SELECT run_id, coalesce(pipeline_id, '-') AS pipeline, coalesce(baseline_status, 'PENDING') AS baseline, "
        "coalesce(target_status, 'PENDING') AS target, coalesce(retry_count, '0') AS retries, coalesce(json_extract_string(validation_results, '$.overall_status'), '-') AS validation, "
        f"coalesce(status, 'PENDING') AS status FROM ({PIPE_SQL})"
    ),
    "run_summary": (
        "SELECT run_id, coalesce(overall_status, 'UNKNOWN') AS overall_status, coalesce(phase, 'UNKNOWN') AS phase, coalesce(created_at, '-') AS started, "
        f"{_duration_sql('created_at', 'updated_at')} AS duration FROM ({META_SQL})"
    ),
    "run_init": f"SELECT run_id, record_type, field, value FROM ({_CHANGES_SQL}) WHERE seq = -1",
    "state_fold": FOLD_SQL,
    "run_events": f"SELECT run_id, record_type, timestamp, event, seq FROM ({EV_SQL})",
    "pipelines_only": f"SELECT * FROM ({STATE_SQL}) WHERE record_type <> '_metadata' AND NOT starts_with(record_type, 'event#')",
    "point_lookup": (
        f"WITH s AS (SELECT run_id, record_type, status FROM ({STATE_SQL}) WHERE NOT starts_with(record_type, 'event#')) "
        "SELECT q.run_id, q.record_type, s.run_id IS NOT NULL AS found, s.status FROM "
        "(SELECT DISTINCT user_id AS run_id FROM events) r, LATERAL (SELECT r.run_id, x.rt AS record_type FROM "
        f"(VALUES ('_metadata'), ('{PIPELINE_ID}'), ('missing-pipeline')) AS x(rt)) q "
        "LEFT JOIN s ON q.run_id = s.run_id AND q.record_type = s.record_type"
    ),
    "recent_runs": f"SELECT run_id, created_at, status, phase FROM ({META_SQL}) ORDER BY created_at DESC NULLS LAST, run_id LIMIT 20",
    "snapshot": (
        "SELECT m.run_id, CAST(to_json(struct_pack(" + ", ".join(f"{f} := m.{f}" for f in META_FIELDS) + ")) AS VARCHAR) AS metadata_json, "
        "CAST(to_json(p.ps) AS VARCHAR) AS pipelines_json, e.n AS n_events FROM (" + META_SQL + ") m "
        "LEFT JOIN (SELECT run_id, list(struct_pack(" + ", ".join(f"{f} := {f}" for f in PIPE_FIELDS) + ") ORDER BY "
        + ", ".join(PIPE_FIELDS) + ") AS ps FROM (" + PIPE_SQL + ") GROUP BY run_id) p ON m.run_id = p.run_id "
        f"LEFT JOIN (SELECT run_id, count(*) AS n FROM ({EV_SQL}) GROUP BY run_id) e ON m.run_id = e.run_id"
    ),
    "run_history": (
        f"WITH e AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) AS rn FROM ({EV_SQL}) "
        "WHERE event IN ('failure_analyzed', 'auto_fix_applied', 'escalated', 'awaiting_approval')), "
        f"h AS (SELECT run_id, string_agg(phase || '/' || event || ': ' || coalesce(nullif({_DIAG}, ''), nullif({_REASON}, ''), ''), chr(10) ORDER BY ts, seq) AS t "
        "FROM e WHERE rn <= 20 GROUP BY run_id) "
        "SELECT r.run_id, coalesce(h.t, 'No prior failure/fix events found for run ' || r.run_id || ' (pipeline customer-transactions).') AS history "
        "FROM (SELECT DISTINCT user_id AS run_id FROM events) r LEFT JOIN h ON r.run_id = h.run_id"
    ),
    "timeline": (
        f"SELECT e.run_id, e.seq, l.label, e.timestamp, {_DETAIL} AS detail FROM ({EV_SQL}) e "
        f"JOIN (VALUES {_LABELS}) AS l(ev, label) ON e.event = l.ev"
    ),
    "duration_text": (
        "WITH s AS (SELECT user_id AS run_id, min(ts) AS s, max(ts) FILTER (WHERE event_type = 'purchase') AS e FROM events GROUP BY user_id), "
        f"t AS (SELECT run_id, {_iso_sql('s')} AS created_at, {_iso_sql('e')} AS updated_at, epoch_us(e) - epoch_us(s) AS us FROM s), "
        "d AS (SELECT *, CAST(floor(us / 86400000000) AS BIGINT) AS days FROM t), "
        "x AS (SELECT *, CAST(floor((us - days * 86400000000) / 1000000) AS BIGINT) AS rem FROM d) "
        "SELECT run_id, created_at, updated_at, CASE WHEN updated_at IS NULL THEN '-' ELSE "
        "(CASE WHEN days = 0 THEN '' ELSE days || CASE WHEN abs(days) = 1 THEN ' day, ' ELSE ' days, ' END END) || "
        "(rem // 3600) || ':' || lpad(CAST((rem % 3600) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(rem % 60 AS VARCHAR), 2, '0') END AS duration FROM x"
    ),
    "report_row": _REPORT_SQL,
    "presence_check": (
        "WITH r AS (SELECT DISTINCT user_id AS run_id FROM events), "
        "have AS (SELECT DISTINCT user_id AS run_id, event_type FROM events WHERE event_type IN ('signup', 'purchase')) "
        "SELECT r.run_id, (bm.run_id IS NOT NULL AND tm.run_id IS NOT NULL) AS ok, "
        "CASE WHEN bm.run_id IS NULL THEN 'main' WHEN tm.run_id IS NULL THEN 'auto/upgrade-test-' || r.run_id END AS missing_branch "
        "FROM r LEFT JOIN (SELECT run_id FROM have WHERE event_type = 'signup') bm ON r.run_id = bm.run_id "
        "LEFT JOIN (SELECT run_id FROM have WHERE event_type = 'purchase') tm ON r.run_id = tm.run_id"
    ),
    "work_list": (
        "WITH f AS (SELECT user_id AS run_id, arg_min(event_type, event_id) AS ft FROM events GROUP BY user_id) "
        "SELECT run_id, 'target' AS variant FROM f UNION ALL SELECT run_id, 'baseline' FROM f WHERE ft = 'error'"
    ),
    "retry_count": (
        f"SELECT run_id, count(*) FILTER (WHERE event IN ('auto_fix_applied', 'approval_approved', 'retry_with_human_fix')) AS retry_count "
        f"FROM ({EV_SQL}) GROUP BY run_id"
    ),
}
