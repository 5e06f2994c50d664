"""Inputs derived from the driver tables, in a Spark form and an equal SQL form.

``events`` rows become log lines, jobs and run-state records; ``documents``
become multi-line logs. Each derivation is a projection of whole tables, so
the work of every query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.sources.logs import split_lines
from driftcheck.sources.tables import read_table

# Rendered error lines, one family per user_id % 5.
ERROR_LINES = [
    "org.apache.spark.SparkArithmeticException: [DIVIDE_BY_ZERO] Division by zero. Use `try_divide` to tolerate divisor being 0 and return NULL instead. SQLSTATE: 22012",
    "org.apache.spark.SparkUpgradeException: [INCONSISTENT_BEHAVIOR_CROSS_VERSION.DATETIME_PATTERN_RECOGNITION] You may get a different result due to the upgrading to Spark >= 3.0",
    'org.apache.spark.sql.AnalysisException: [DATATYPE_MISMATCH.CAST_WITHOUT_SUGGESTION] cannot resolve "CAST(amount AS INT)" due to data type mismatch',
    "java.lang.NoClassDefFoundError: javax/servlet/Filter Caused by: java.lang.ClassNotFoundException: javax.servlet.Filter",
    "java.lang.IllegalArgumentException: Codec [lz4raw] is not available. Available codecs are uncompressed, snappy, gzip, lzo, brotli, lz4, lz4_raw, zstd.",
]
FRAME_LINE = "\tat org.apache.spark.sql.execution.SparkPlan.execute(SparkPlan.scala:"
SIGNUP_LINE = "INFO SparkContext: Running Spark version 4.0.0 (user "
CLICK_LINE = "WARN TaskSetManager: Lost task "
BLANK_LINE = "   "


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- event log lines -------------------------------------------------------------------

def event_line(ev_type: Column, user_id: Column, event_id: Column, value: Column) -> Column:
    err = F.coalesce(*[F.when(user_id % 5 == i, F.lit(t)) for i, t in enumerate(ERROR_LINES)])
    return (
        F.when(ev_type == "error", F.concat(err, F.lit(" (event "), event_id.cast("string"), F.lit(")")))
        .when(ev_type == "purchase", F.concat(F.lit(FRAME_LINE), user_id.cast("string"), F.lit(")")))
        .when(ev_type == "view", F.lit(BLANK_LINE))
        .when(ev_type == "signup", F.concat(F.lit(SIGNUP_LINE), user_id.cast("string"), F.lit(")")))
        .otherwise(F.concat(F.lit(CLICK_LINE), event_id.cast("string"), F.lit(" value="), F.format_string("%.2f", value)))
    )


EVENT_LINE_SQL = (
    "CASE WHEN event_type = 'error' THEN (CASE user_id % 5 "
    + " ".join(f"WHEN {i} THEN {_sql_str(t)}" for i, t in enumerate(ERROR_LINES))
    + " END) || ' (event ' || event_id || ')' "
    f"WHEN event_type = 'purchase' THEN chr(9) || {_sql_str(FRAME_LINE[1:])} || user_id || ')' "
    f"WHEN event_type = 'view' THEN {_sql_str(BLANK_LINE)} "
    f"WHEN event_type = 'signup' THEN {_sql_str(SIGNUP_LINE)} || user_id || ')' "
    f"ELSE {_sql_str(CLICK_LINE)} || event_id || ' value=' || printf('%.2f', value) END"
)


def user_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per user: (log_id = user_id, line_no = event_id, line)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("log_id"),
        F.col("event_id").alias("line_no"),
        event_line(F.col("event_type"), F.col("user_id"), F.col("event_id"), F.col("value")).alias("line"),
    )


USER_LOG_LINES_SQL = f"SELECT user_id AS log_id, event_id AS line_no, {EVENT_LINE_SQL} AS line FROM events"


def job_id_col(user_id: Column, ts: Column) -> Column:
    """A job is one user-day: user_id * 100 + day of month."""
    return user_id * 100 + F.dayofmonth(ts)


JOB_ID_SQL = "user_id * 100 + day(ts)"


def job_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per job (user-day), with its stream: errors on stderr, the rest on stdout."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        job_id_col(F.col("user_id"), F.col("ts")).alias("log_id"),
        F.when(F.col("event_type") == "error", "stderr").otherwise("stdout").alias("stream"),
        F.col("event_id").alias("line_no"),
        event_line(F.col("event_type"), F.col("user_id"), F.col("event_id"), F.col("value")).alias("line"),
    )


JOB_LOG_LINES_SQL = (
    f"SELECT {JOB_ID_SQL} AS log_id, CASE WHEN event_type = 'error' THEN 'stderr' ELSE 'stdout' END AS stream, "
    f"event_id AS line_no, {EVENT_LINE_SQL} AS line FROM events"
)


# --- documents as logs -----------------------------------------------------------------

def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return split_lines(docs.select(F.col("doc_id").alias("log_id"), "text"))


DOCUMENT_LINES_SQL = (
    "SELECT doc_id AS log_id, CAST(generate_subscripts(parts, 1) AS BIGINT) AS line_no, unnest(parts) AS line "
    "FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '(\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}])$', ''), "
    "'\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}]') AS parts FROM documents)"
)


# --- jobs (user-days) --------------------------------------------------------------------

JOB_TIMEOUT_SECONDS = 12 * 3600


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, user_id, n_events, n_errors, n_purchases, n_clicks, started_at, ended_at, exit_code, emr_status, job_run_id).

    exit code 1 when the day had an error event, else 0; the EMR-style
    status is SUCCESS/FAILED; a job without purchase events never got a job
    run id (an infrastructure failure when it did not succeed).
    """
    ev = read_table(spark, sf_dir, "events")
    g = ev.groupBy(job_id_col(F.col("user_id"), F.col("ts")).alias("job_id"), "user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.count_if(F.col("event_type") == "purchase").alias("n_purchases"),
        F.count_if(F.col("event_type") == "click").alias("n_clicks"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
        F.min("event_id").alias("first_event_id"),
    )
    return g.select(
        "*",
        F.when(F.col("n_errors") > 0, 1).otherwise(0).alias("exit_code"),
        F.when(F.col("n_errors") > 0, "FAILED").otherwise("SUCCESS").alias("emr_status"),
        F.when(F.col("n_purchases") > 0, F.concat(F.lit("jr-"), F.col("job_id").cast("string"))).alias("job_run_id"),
    )


JOBS_SQL = (
    f"SELECT *, CASE WHEN n_errors > 0 THEN 1 ELSE 0 END AS exit_code, "
    f"CASE WHEN n_errors > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS emr_status, "
    f"CASE WHEN n_purchases > 0 THEN 'jr-' || job_id END AS job_run_id FROM ("
    f"SELECT {JOB_ID_SQL} AS job_id, user_id, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'error') AS n_errors, "
    f"count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases, count(*) FILTER (WHERE event_type = 'click') AS n_clicks, "
    f"min(ts) AS started_at, max(ts) AS ended_at, min(event_id) AS first_event_id FROM events GROUP BY ALL)"
)


# --- stored model responses --------------------------------------------------------------

def response_text(kind: Column, conf: Column) -> Column:
    """A stored model response per job, by n_clicks % 4; ``conf`` is a text number."""
    return (
        F.when(
            kind == 0,
            F.concat(
                F.lit('{"root_cause": "Codec name changed in Spark 4.0", "classification": "config_fix", "confidence": '),
                conf,
                F.lit(', "fix_key": "spark.sql.parquet.compression.codec", "fix_value": "lz4_raw", "is_mitigation": false}'),
            ),
        )
        .when(kind == 1, F.concat(F.lit('{"root_cause": "not enough evidence", "classification": "escalate", "confidence": '), conf, F.lit("}")))
        .when(kind == 2, F.concat(F.lit('{"classification": "code_change", "confidence": '), conf, F.lit(', "fix_key": "", "fix_value": "x"}')))
        .otherwise(F.lit("model output was not JSON"))
    )


def response_text_sql(kind: str, conf: str) -> str:
    return (
        f"CASE WHEN {kind} = 0 THEN '{{\"root_cause\": \"Codec name changed in Spark 4.0\", \"classification\": \"config_fix\", \"confidence\": ' || {conf} || "
        "', \"fix_key\": \"spark.sql.parquet.compression.codec\", \"fix_value\": \"lz4_raw\", \"is_mitigation\": false}' "
        f"WHEN {kind} = 1 THEN '{{\"root_cause\": \"not enough evidence\", \"classification\": \"escalate\", \"confidence\": ' || {conf} || '}}' "
        f"WHEN {kind} = 2 THEN '{{\"classification\": \"code_change\", \"confidence\": ' || {conf} || ', \"fix_key\": \"\", \"fix_value\": \"x\"}}' "
        "ELSE 'model output was not JSON' END"
    )
