"""Registered log queries (L1-L10) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.operators import logs as L
from driftcheck.operators import triage as TR
from driftcheck.plans import derive as D
from driftcheck.sources import io as IO
from driftcheck.sources.logs import read_driver_logs, read_log_files, write_driver_logs
from driftcheck.sources.specs import DEFAULT_RULES, rules_table
from driftcheck.sources.tables import read_table

# Parameters of the registered reductions (the user logs are a few KB each,
# so the reference's 500 KB default would keep every log whole).
USER_LOG_MAX_BYTES, USER_LOG_HEAD, USER_LOG_TAIL = 2000, 5, 10
DOC_MAX_BYTES, DOC_HEAD, DOC_TAIL = 4000, 3, 5
GREP_PATTERN = "The"
JOB_TIMEOUT_SECONDS = D.JOB_TIMEOUT_SECONDS


def q_log_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reduce_log(D.user_log_lines(spark, sf_dir), USER_LOG_MAX_BYTES, USER_LOG_HEAD, USER_LOG_TAIL)


def q_log_reduce_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # split_lines numbers lines 1..n, so the head/tail thresholds come from the line count
    return L.reduce_log(D.document_lines(spark, sf_dir), DOC_MAX_BYTES, DOC_HEAD, DOC_TAIL, contiguous=True)


def q_log_exception_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.exception_block(D.user_log_lines(spark, sf_dir))


def q_rule_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First matching rule of every whole log, searched line by line."""
    m = TR.match_rules_lines(D.user_log_lines(spark, sf_dir), rules_table(spark))
    return m.select(
        "log_id", "rule_no", "diagnosis", "action", "auto_fix",
        F.col("fix_config.key").alias("fix_key"), F.col("fix_config.value").alias("fix_value"),
    )


def q_log_grep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.grep(D.document_lines(spark, sf_dir), GREP_PATTERN)


def q_log_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.merge_streams(D.job_log_lines(spark, sf_dir))


def q_log_merge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 on whole stream texts: every line of each (job, stream), merged under the headers."""
    return L.merge_stream_texts(L.stream_texts(D.job_log_lines(spark, sf_dir)))


def q_log_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        L.excerpt("text", 300).alias("excerpt_300"),
        L.excerpt("text", 3000).alias("excerpt_3000"),
        F.length(L.excerpt("text", 8000)).alias("len_8000"),
    )


def q_job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = D.jobs(spark, sf_dir)
    code, status = L.job_status(F.col("exit_code"), F.col("started_at"), F.col("ended_at"), F.lit(JOB_TIMEOUT_SECONDS))
    return j.select(
        "job_id",
        code.alias("exit_code"),
        status.alias("status"),
        L.translate_status(F.col("emr_status")).alias("translated_status"),
    )


def execution_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One execution record per event: id present for purchases, a JSON or junk cause for others."""
    ev = read_table(spark, sf_dir, "events")
    jr = F.concat(F.lit("jr-"), F.col("event_id").cast("string"))
    cause = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"JobRunId": "'), jr, F.lit('", "State": "FAILED"}')))
        .when(F.col("event_type") == "click", F.lit("EMRServerless.ValidationException: invalid sparkSubmitParameters"))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"JobRunId": "'), jr, F.lit('"}')))
        .when(F.col("event_type") == "signup", F.lit('["not", "an", "object"]'))
    )
    return ev.select(
        F.col("event_id").alias("execution_id"),
        F.when(F.col("event_type") == "purchase", jr).alias("job_run_id"),
        F.lit("FAILED").alias("status"),
        cause.alias("cause"),
    )


def q_job_id_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = L.recover_job_run_id(execution_records(spark, sf_dir))
    return r.select(
        "execution_id", "job_run_id", "status",
        L.is_infrastructure_failure(F.col("status"), F.col("job_run_id")).alias("infrastructure"),
    )


MERGE_LINES = 20
DRIVER_JOBS, LOG_FILES = 97, 13


def q_log_merge_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 in chunks: no row holds a whole log."""
    return L.merge_chunks(D.job_log_lines(spark, sf_dir), MERGE_LINES)


def q_driver_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event lines written as gzip driver logs, then read by the layout."""
    job = (F.col("log_id") % DRIVER_JOBS).cast("string")
    lines = D.job_log_lines(spark, sf_dir).select(job.alias("log_id"), (F.col("log_id") % 8).cast("string").alias("application_id"), "stream", "line_no", "line")
    root = IO.scratch_path(spark, "driver_logs")
    write_driver_logs(lines, root)
    return read_driver_logs(spark, root)


def q_log_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: all event lines written as plain text files, then read in splits and numbered."""
    lines = D.user_log_lines(spark, sf_dir).select((F.col("log_id") % LOG_FILES).alias("log"), "line_no", "line")
    root = IO.scratch_path(spark, "log_files")
    lines.repartition("log").sortWithinPartitions("log", "line_no").select("log", F.col("line").alias("value")).write.partitionBy("log").text(root)
    read = read_log_files(spark, f"{root}/*")
    return read.select(F.regexp_extract("log_id", r"log=(\d+)/", 1).cast("long").alias("log"), "line_no", "line")


QUERIES = {
    "log_merge_chunks": q_log_merge_chunks,
    "driver_log_scan": q_driver_log_scan,
    "log_file_scan": q_log_file_scan,
    "log_reduce": q_log_reduce,
    "log_reduce_docs": q_log_reduce_docs,
    "log_exception_block": q_log_exception_block,
    "rule_match": q_rule_match,
    "log_grep": q_log_grep,
    "log_merge": q_log_merge,
    "log_merge_text": q_log_merge_text,
    "log_excerpt": q_log_excerpt,
    "job_status": q_job_status,
    "job_id_recovery": q_job_id_recovery,
}


# --- oracles ----------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def bounds_sql(lines: str) -> str:
    return (
        f"(SELECT st.log_id, st.bs, en.be FROM (SELECT log_id, min(line_no) AS bs FROM ({lines}) "
        "WHERE line LIKE '%Traceback%' OR line LIKE '%Exception%' GROUP BY log_id) st "
        f"LEFT JOIN (SELECT x.log_id, min(x.line_no) AS be FROM ({lines}) x JOIN (SELECT log_id, min(line_no) AS bs FROM ({lines}) "
        "WHERE line LIKE '%Traceback%' OR line LIKE '%Exception%' GROUP BY log_id) s2 ON x.log_id = s2.log_id "
        "WHERE x.line_no > s2.bs AND regexp_full_match(x.line, '\\s*') GROUP BY x.log_id) en ON st.log_id = en.log_id)"
    )


def block_sql(lines: str) -> str:
    return (
        f"SELECT l.log_id, l.line_no, l.line FROM ({lines}) l JOIN {bounds_sql(lines)} b ON l.log_id = b.log_id "
        "WHERE l.line_no >= b.bs AND (b.be IS NULL OR l.line_no < b.be)"
    )


def reduce_sql(lines: str, max_bytes: int, head: int, tail: int, marker: str = L.TRUNCATION_MARKER) -> str:
    sizes = f"(SELECT log_id, sum(strlen(line)) + count(*) - 1 AS nb FROM ({lines}) GROUP BY log_id)"
    big = f"SELECT l.* FROM ({lines}) l JOIN {sizes} s ON l.log_id = s.log_id WHERE s.nb > {max_bytes}"
    sep = f"(VALUES (CAST(1 AS BIGINT), ''), (CAST(2 AS BIGINT), {_sql_str(marker)}), (CAST(3 AS BIGINT), '')) AS sep(line_no, line)"
    return (
        f"SELECT l.log_id, 0 AS section, CAST(l.line_no AS BIGINT) AS line_no, l.line FROM ({lines}) l JOIN {sizes} s ON l.log_id = s.log_id WHERE s.nb <= {max_bytes} "
        f"UNION ALL SELECT log_id, 1, line_no, line FROM (SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY line_no) AS rn FROM ({big})) WHERE rn <= {head} "
        f"UNION ALL SELECT b.log_id, 2, sep.line_no, sep.line FROM (SELECT DISTINCT log_id FROM ({big})) b, {sep} "
        f"UNION ALL SELECT log_id, 3, line_no, line FROM ({block_sql(big)}) "
        f"UNION ALL SELECT b.log_id, 4, sep.line_no, sep.line FROM {bounds_sql(big)} b, {sep} "
        f"UNION ALL SELECT log_id, 5, line_no, line FROM (SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY line_no DESC) AS rn FROM ({big})) WHERE rn <= {tail}"
    )


def rules_sql() -> str:
    rows = []
    for i, r in enumerate(DEFAULT_RULES, start=1):
        fk = _sql_str(r["fix_config"]["key"]) if r.get("fix_config") else "NULL"
        fv = _sql_str(r["fix_config"]["value"]) if r.get("fix_config") else "NULL"
        rows.append(f"({i}, {_sql_str(r['pattern'])}, {_sql_str(r['diagnosis'])}, {_sql_str(r['action'])}, {str(r['auto_fix']).upper()}, {fk}, {fv})")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS r(rule_no, pattern, diagnosis, action, auto_fix, fix_key, fix_value))"


def rule_match_sql(lines: str) -> str:
    """(log_id, rule_no, diagnosis, action, auto_fix, fix_key, fix_value) over whole texts."""
    texts = f"(SELECT log_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({lines}) GROUP BY log_id)"
    return (
        f"SELECT t.log_id, m.rule_no, r.diagnosis, r.action, r.auto_fix, r.fix_key, r.fix_value FROM {texts} t "
        f"LEFT JOIN (SELECT t2.log_id, min(r2.rule_no) AS rule_no FROM {texts} t2, {rules_sql()} r2 "
        "WHERE regexp_matches(t2.text, r2.pattern, 'i') GROUP BY t2.log_id) m ON t.log_id = m.log_id "
        f"LEFT JOIN {rules_sql()} r ON m.rule_no = r.rule_no"
    )


_GREP_MSG = f"No lines in the log matched {GREP_PATTERN!r}."

ORACLE = {
    "log_merge_chunks": (
        f"WITH l AS ({D.JOB_LOG_LINES_SQL}), m AS (SELECT log_id, CASE stream WHEN 'stdout' THEN 0 ELSE 1 END AS s, 0 AS part, 0 AS line_no, "
        "'===== SPARK_DRIVER ' || stream || ' =====' AS line FROM (SELECT DISTINCT log_id, stream FROM l) "
        "UNION ALL SELECT log_id, CASE stream WHEN 'stdout' THEN 0 ELSE 1 END, 1, line_no, line FROM l), "
        "p AS (SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY s, part, line_no) - 1 AS pos FROM m) "
        f"SELECT log_id, pos // {MERGE_LINES} AS chunk_no, string_agg(line || chr(10), '' ORDER BY pos) AS text FROM p GROUP BY ALL"
    ),
    "driver_log_scan": (
        f"WITH l AS ({D.JOB_LOG_LINES_SQL}) SELECT CAST(log_id % {DRIVER_JOBS} AS VARCHAR) AS log_id, CAST(log_id % 8 AS VARCHAR) AS application_id, stream, "
        f"row_number() OVER (PARTITION BY log_id % {DRIVER_JOBS}, log_id % 8, stream ORDER BY line_no) AS line_no, line FROM l"
    ),
    "log_file_scan": f"SELECT log_id % {LOG_FILES} AS log, row_number() OVER (PARTITION BY log_id % {LOG_FILES} ORDER BY line_no) AS line_no, line FROM ({D.USER_LOG_LINES_SQL})",
    "log_reduce": reduce_sql(D.USER_LOG_LINES_SQL, USER_LOG_MAX_BYTES, USER_LOG_HEAD, USER_LOG_TAIL),
    "log_reduce_docs": reduce_sql(D.DOCUMENT_LINES_SQL, DOC_MAX_BYTES, DOC_HEAD, DOC_TAIL),
    "log_exception_block": block_sql(D.USER_LOG_LINES_SQL),
    "rule_match": rule_match_sql(D.USER_LOG_LINES_SQL),
    "log_grep": (
        f"WITH l AS ({D.DOCUMENT_LINES_SQL}), h AS (SELECT * FROM l WHERE contains(lower(line), {_sql_str(GREP_PATTERN.lower())})), "
        "c AS (SELECT log_id, count(*) AS n FROM h GROUP BY log_id), "
        "f AS (SELECT log_id, string_agg(line, chr(10) ORDER BY line_no) AS t FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY log_id ORDER BY line_no) AS rn FROM h) WHERE rn <= {L.GREP_MAX_HITS} GROUP BY log_id) "
        f"SELECT a.log_id, coalesce(c.n, 0) AS n_hits, coalesce(f.t, {_sql_str(_GREP_MSG)}) AS result "
        "FROM (SELECT DISTINCT log_id FROM l) a LEFT JOIN c ON a.log_id = c.log_id LEFT JOIN f ON a.log_id = f.log_id"
    ),
    "log_merge": (
        f"WITH l AS ({D.JOB_LOG_LINES_SQL}) "
        "SELECT log_id, CASE stream WHEN 'stdout' THEN 0 ELSE 1 END AS stream_rank, 0 AS part, CAST(0 AS BIGINT) AS line_no, "
        "'===== SPARK_DRIVER ' || stream || ' =====' AS line FROM (SELECT DISTINCT log_id, stream FROM l) "
        "UNION ALL SELECT log_id, CASE stream WHEN 'stdout' THEN 0 ELSE 1 END, 1, line_no, line FROM l"
    ),
    "log_merge_text": (
        f"WITH s AS (SELECT log_id, stream, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({D.JOB_LOG_LINES_SQL}) GROUP BY log_id, stream) "
        "SELECT log_id, string_agg('===== SPARK_DRIVER ' || stream || ' =====' || chr(10) || text || chr(10), '' "
        "ORDER BY CASE stream WHEN 'stdout' THEN 0 ELSE 1 END) AS text FROM s GROUP BY log_id"
    ),
    "log_excerpt": (
        "SELECT doc_id, substring(text, 1, 300) AS excerpt_300, substring(text, 1, 3000) AS excerpt_3000, "
        "CAST(length(substring(text, 1, 8000)) AS INTEGER) AS len_8000 FROM documents"
    ),
    "job_status": (
        f"SELECT job_id, CASE WHEN floor(epoch(ended_at)) - floor(epoch(started_at)) > {JOB_TIMEOUT_SECONDS} THEN -1 ELSE exit_code END AS exit_code, "
        f"CASE WHEN (CASE WHEN floor(epoch(ended_at)) - floor(epoch(started_at)) > {JOB_TIMEOUT_SECONDS} THEN -1 ELSE exit_code END) = 0 "
        "THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, "
        f"CASE WHEN emr_status = 'SUCCESS' THEN 'SUCCEEDED' ELSE emr_status END AS translated_status FROM ({D.JOBS_SQL})"
    ),
    "job_id_recovery": (
        "WITH r AS (SELECT event_id AS execution_id, CASE WHEN event_type = 'purchase' THEN 'jr-' || event_id END AS job_run_id, "
        "'FAILED' AS status, CASE WHEN event_type = 'error' THEN '{\"JobRunId\": \"jr-' || event_id || '\", \"State\": \"FAILED\"}' "
        "WHEN event_type = 'click' THEN 'EMRServerless.ValidationException: invalid sparkSubmitParameters' "
        "WHEN event_type = 'view' THEN '{\"JobRunId\": \"jr-' || event_id || '\"}' "
        "WHEN event_type = 'signup' THEN '[\"not\", \"an\", \"object\"]' END AS cause FROM events), "
        "p AS (SELECT *, CASE WHEN json_valid(cause) THEN json_extract_string(cause, '$.JobRunId') END AS jid, "
        "CASE WHEN json_valid(cause) THEN json_extract_string(cause, '$.State') END AS st FROM r), "
        "u AS (SELECT execution_id, CASE WHEN job_run_id IS NULL AND jid IS NOT NULL AND st IS NOT NULL THEN jid ELSE job_run_id END AS job_run_id, "
        "CASE WHEN job_run_id IS NULL AND jid IS NOT NULL AND st IS NOT NULL THEN st ELSE status END AS status FROM p) "
        "SELECT execution_id, job_run_id, status, NOT coalesce(status = 'SUCCESS', false) AND job_run_id IS NULL AS infrastructure FROM u"
    ),
}
