"""Registered streaming queries (T1-T5) and their DuckDB oracles.

Every query streams ``events`` from its parquet file with
``Trigger.AvailableNow`` into a parquet sink and reads the sink back. The
oracles cover all rows: windows and executions come out in update mode, open
ones included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.plans import derive as D
from driftcheck.streaming import streams as S

# Fixed subscription table: (subscriber, pattern).
SUBSCRIPTIONS = [("audit-log", "*"), ("pager", "error"), ("billing", "purchase"), ("bus-mirror", "app.events"), ("growth", "signup")]


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a glob selects the one file (file streams list folders or globs, not a file path)
    path = f"{sf_dir.rstrip('/')}/events.parque[t]"
    return S.with_event_time(S.file_stream(spark, path))


def _fmt(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def q_status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_stream(spark, sf_dir)
    st = ev.select(
        D.job_id_col(F.col("user_id"), F.col("ts")).alias("execution_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCEEDED").otherwise("RUNNING").alias("status"),
        F.concat(F.lit("/logs/"), D.job_id_col(F.col("user_id"), F.col("ts")).cast("string"), F.lit(".log")).alias("log_path"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("exit_code"),
    )
    return S.run_available_now(st, "status_stream")


def q_alarm_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.run_partials_available_now(_events_stream(spark, sf_dir), "alarm_windows", S.failure_counts, S.merged_alarms)
    return out.select(_fmt("window_start").alias("window_start"), _fmt("window_end").alias("window_end"), "failures", "alarm")


def q_subscription_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    subs = spark.createDataFrame(SUBSCRIPTIONS, "subscriber string, pattern string")
    routed = S.route_subscriptions(_events_stream(spark, sf_dir), subs).select("event_id", "subscriber")
    return S.run_available_now(routed, "subscription_route")


def q_stream_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_stream(spark, sf_dir)
    et = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    changes = ev.select(
        F.col("user_id").alias("run_id"),
        F.when(et.isin("signup", "click"), "_metadata").otherwise("customer-transactions").alias("record_type"),
        F.when(et == "signup", "phase").when(et == "purchase", "retry_count").when(et == "error", "status")
        .when(et == "view", "diagnosis").otherwise("pending_approval_task_token").alias("field"),
        F.when(et == "signup", F.lit("ANALYZE")).when(et == "purchase", (k % 3).cast("string"))
        .when(et == "error", F.lit("FAILED")).when(et == "view", F.concat(F.lit("diag-"), k.cast("string"))).cast("string").alias("value"),
        "ts",
        F.col("event_id").alias("seq"),
    )
    keys = ["run_id", "record_type", "field"]
    latest = lambda df: S.fold_latest(df, keys)  # noqa: E731  the latest of parts is the latest of all
    cur = S.run_partials_available_now(changes, "stream_state_fold", latest, latest)
    return cur.select(*keys, "value")


def q_completion_watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_stream(spark, sf_dir)
    st = ev.select(
        D.job_id_col(F.col("user_id"), F.col("ts")).alias("execution_id"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCEEDED").otherwise("RUNNING").alias("status"),
        "ts",
        F.col("event_id").alias("seq"),
    )
    first = S.first_final_status  # the first of parts is the first of all
    out = S.run_partials_available_now(st, "completion_watch", first, first)
    return out.select("execution_id", "status", "seq")


QUERIES = {
    "status_stream": q_status_stream,
    "alarm_windows": q_alarm_windows,
    "subscription_route": q_subscription_route,
    "stream_state_fold": q_stream_state_fold,
    "completion_watch": q_completion_watch,
}

_SUBS = ", ".join(f"('{s}', '{p}')" for s, p in SUBSCRIPTIONS)

ORACLE = {
    "status_stream": (
        f"SELECT {D.JOB_ID_SQL} AS execution_id, event_id AS seq, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCEEDED' "
        f"ELSE 'RUNNING' END AS status, '/logs/' || ({D.JOB_ID_SQL}) || '.log' AS log_path, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS exit_code FROM events"
    ),
    "alarm_windows": (
        "SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, "
        "count(*) AS failures, count(*) >= 1 AS alarm FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w FROM events WHERE event_type = 'error') "
        "GROUP BY w"
    ),
    "subscription_route": (
        f"SELECT e.event_id, s.subscriber FROM events e JOIN (VALUES {_SUBS}) AS s(subscriber, pattern) "
        "ON s.pattern = '*' OR s.pattern = 'app.events' OR s.pattern = e.event_type"
    ),
    "stream_state_fold": (
        "WITH c AS (SELECT user_id AS run_id, CASE WHEN event_type IN ('signup', 'click') THEN '_metadata' ELSE 'customer-transactions' END AS record_type, "
        "CASE event_type WHEN 'signup' THEN 'phase' WHEN 'purchase' THEN 'retry_count' WHEN 'error' THEN 'status' WHEN 'view' THEN 'diagnosis' "
        "ELSE 'pending_approval_task_token' END AS field, "
        "CASE event_type WHEN 'signup' THEN 'ANALYZE' WHEN 'purchase' THEN CAST(CAST(json_extract_string(props, '$.k') AS INT) % 3 AS VARCHAR) "
        "WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'diag-' || CAST(json_extract_string(props, '$.k') AS INT) END AS value, ts, event_id AS seq FROM events) "
        "SELECT run_id, record_type, field, value FROM (SELECT *, row_number() OVER (PARTITION BY run_id, record_type, field ORDER BY ts DESC, seq DESC) AS rn FROM c) WHERE rn = 1"
    ),
    "completion_watch": (
        f"WITH s AS (SELECT {D.JOB_ID_SQL} AS execution_id, "
        "CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, ts, event_id AS seq FROM events WHERE event_type IN ('error', 'purchase')) "
        "SELECT execution_id, arg_min(status, (ts, seq)) AS status, arg_min(seq, (ts, seq)) AS seq FROM s GROUP BY execution_id"
    ),
}
