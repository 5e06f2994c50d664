"""Registered triage queries (L11-L20) and their DuckDB oracles.

A job is one user-day of ``events``; its log is the rendered event lines of
that day, its stored model responses and golden cases are derived from the
job's event counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftcheck.operators import logs as L
from driftcheck.operators import triage as TR
from driftcheck.operators import vectors as V
from driftcheck.plans import derive as D
from driftcheck.plans.log_plans import _sql_str, reduce_sql, rules_sql
from driftcheck.sources.specs import DEFAULT_MAX_RETRIES, rules_table
from driftcheck.functions.joins import broadcast_if_small
from driftcheck.session import cut_lineage
from driftcheck.sources.tables import read_table

TOOLS = ["grep_log", "read_file", "get_run_history", "search_web"]
TOPK = 10
LOG_EXCERPT_CHARS = 3000


def _conf(n: str, shift: float = 0.0):
    return F.format_string("%.2f", F.least(F.lit(1.0), F.lit(0.05 + shift) + F.lit(0.3) * F.col(n)))


def _conf_sql(n: str, shift: float = 0.0) -> str:
    return f"printf('%.2f', least(1.0, {0.05 + shift} + 0.3 * {n}))"


def job_diagnoses(spark: SparkSession, sf_dir: str, jobs: DataFrame | None = None) -> DataFrame:
    """First and second model pass per job, parsed (L11) and combined."""
    j = jobs if jobs is not None else D.jobs(spark, sf_dir)
    texts = j.select(
        "job_id",
        D.response_text(F.col("n_clicks") % 4, _conf("n_purchases")).alias("r1"),
        D.response_text((F.col("n_clicks") + 1) % 4, _conf("n_purchases", 0.3)).alias("r2"),
    )
    parsed = TR.parse_responses(TR.parse_responses(texts, "r1", "first"), "r2", "second")
    return parsed.select("job_id", "first", TR.final_diagnosis(F.col("first"), F.col("second")).alias("diag"))


def q_diagnosis_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = job_diagnoses(spark, sf_dir)
    return d.select("job_id", "first.*")


def q_diagnosis_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second pass replaces an inconclusive first pass."""
    d = job_diagnoses(spark, sf_dir)
    return d.select(
        "job_id",
        TR.is_inconclusive(F.col("first")).alias("second_pass"),
        F.col("diag.root_cause").alias("root_cause"),
        F.col("diag.classification").alias("classification"),
        F.col("diag.confidence").alias("confidence"),
        F.col("diag.fix_key").alias("fix_key"),
        F.col("diag.fix_value").alias("fix_value"),
    )


def routed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing of every job with the columns the routing writes need."""
    all_jobs = cut_lineage(D.jobs(spark, sf_dir))  # one row per job, read by every branch below
    jobs = all_jobs.select(
        "job_id",
        L.translate_status(F.col("emr_status")).alias("target_status"),
        L.is_infrastructure_failure(F.col("emr_status"), F.col("job_run_id")).alias("infrastructure"),
        F.col("n_purchases").alias("retry_count"),
        "n_clicks",
    )
    # Only failed jobs with a job run have a log to analyse.
    to_analyse = jobs.filter((F.col("target_status") != "SUCCEEDED") & ~F.col("infrastructure")).select(
        F.col("job_id").alias("log_id")
    )
    lines = D.job_log_lines(spark, sf_dir).select("log_id", "line_no", "line").join(to_analyse, "log_id", "left_semi")
    # rules see every line of a log; the reviewer's excerpt is of the reduced text that the model sees
    excerpts = L.reduced_text(L.reduce_log(lines)).select("log_id", L.excerpt("text", LOG_EXCERPT_CHARS).alias("log_excerpt"))
    matched = TR.match_rules_lines(lines, rules_table(spark)).join(excerpts, "log_id", "left").withColumnRenamed("log_id", "job_id")
    jd = job_diagnoses(spark, sf_dir, all_jobs)
    diags = jd.select("job_id", "diag")
    passes = jd.select(
        "job_id",
        TR.is_inconclusive(F.col("first")).alias("second_pass"),
        F.col("first.confidence").alias("trigger_confidence"),
    )
    analysis = TR.analysis_result(matched, diags, ["job_id"], carry=["log_excerpt"])
    j = jobs.join(analysis, "job_id", "left").join(passes, "job_id", "left")
    ok, infra = F.col("target_status") == "SUCCEEDED", F.col("infrastructure")
    j = j.select(
        "job_id", "target_status", "infrastructure", "retry_count",
        F.when(ok, None).when(infra, "infrastructure").otherwise(F.col("source")).alias("source"),
        F.when(ok, None).when(infra, TR.INFRA_DIAGNOSIS).otherwise(F.col("diagnosis")).alias("diagnosis"),
        F.when(ok, None).when(infra, "escalate").otherwise(F.col("action")).alias("action"),
        F.when(ok, None).when(infra, False).otherwise(F.col("auto_fix")).alias("auto_fix"),
        F.when(ok | infra, None).otherwise(F.col("fix_config.key")).alias("fix_key"),
        F.when(ok | infra, None).otherwise(F.col("fix_config.value")).alias("fix_value"),
        # the reviewer's excerpt of what the model saw (model diagnoses only)
        F.when(F.col("source") == "llm", F.col("log_excerpt")).alias("log_excerpt"),
        "confidence", "second_pass", "trigger_confidence",
        # the model call: a second pass reads more and uses tools; cost is exact decimal text
        F.lit("gpt-4o-mini").alias("model"),
        (F.lit(400) + F.col("n_clicks") + F.when(F.col("second_pass"), 300).otherwise(0)).alias("prompt_tokens"),
        (F.lit(50) + F.col("n_clicks") % 7).alias("completion_tokens"),
        F.when(F.col("second_pass"), F.lit("['grep_log', 'read_file']")).alias("tools_used"),
    ).withColumn(
        "estimated_cost_usd",
        F.concat(F.lit("0."), F.lpad((F.col("prompt_tokens") * 150 + F.col("completion_tokens") * 600).cast("string"), 9, "0")),
    )
    return TR.route(j, DEFAULT_MAX_RETRIES)


def q_triage_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_jobs(spark, sf_dir).select(
        "job_id", "source", "diagnosis", "action", "auto_fix", "fix_key", "fix_value",
        "phase", "status", "reason", "new_retry_count", "log_excerpt",
    )


def _map_text(m):
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


def q_diagnosis_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L14 on its own: the analysis of every analysed job (rule first, model otherwise)."""
    r = routed_jobs(spark, sf_dir)
    return r.filter(F.col("source").isin("pattern_matcher", "llm")).select(
        "job_id", "source", "diagnosis", "action", "auto_fix", "fix_key", "fix_value", "confidence"
    )


def q_triage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, _ = TR.triage_effects(routed_jobs(spark, sf_dir))
    return ev.select("job_id", "event_no", "event", _map_text(F.col("details")).alias("details"))


def q_triage_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ch = TR.triage_effects(routed_jobs(spark, sf_dir))
    return ch


def approval_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A human decision for every job awaiting approval, chosen by its first-pass confidence."""
    r = routed_jobs(spark, sf_dir).filter(F.col("phase") == "AWAIT_APPROVAL")
    tc = F.col("trigger_confidence")
    return r.select(
        "job_id",
        F.when(tc < 0.3, "reject").when(tc < 0.6, "retry_with_human_fix").otherwise("approve").alias("decision"),
        "fix_key", "fix_value", F.col("new_retry_count").alias("retry_count"), "diagnosis",
    )


def q_approval_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ev, ch = TR.approval_effects(approval_decisions(spark, sf_dir), key="job_id")
    return out


def q_approval_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the decisions (jobs awaiting approval) feed two branches: materialize them once
    out, ev, ch = TR.approval_effects(cut_lineage(approval_decisions(spark, sf_dir)), key="job_id")
    evs = ev.select("job_id", F.lit("event").alias("record_type"), F.col("event").alias("field"), _map_text(F.col("details")).alias("value"))
    return ch.unionByName(evs)


def llm_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls: one per click event; every third k uses a model without a price."""
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        F.col("event_id").alias("call_id"),
        F.col("user_id").alias("run_id"),
        F.when(k % 3 == 0, "gpt-4o").otherwise("gpt-4o-mini").alias("model"),
        (F.lit(400) + k * 10).alias("prompt_tokens"),
        (F.lit(50) + F.round("value").cast("int")).alias("completion_tokens"),
    )


def q_token_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = TR.token_cost(llm_calls(spark, sf_dir), TR.price_table(spark))
    return c.withColumn("estimated_cost_usd", F.round("estimated_cost_usd", 12))


def q_usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = TR.token_cost(llm_calls(spark, sf_dir), TR.price_table(spark))
    runs = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id")).distinct()
    u = TR.usage_rollup(calls, runs)
    return u.withColumn("total_estimated_cost_usd", F.round("total_estimated_cost_usd", 10))


def _tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    k = F.get_json_object("props", "$.k").cast("int")
    tool = F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (k % 4 + 1).cast("int"))
    return ev.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        tool.alias("tool"),
        (F.lit(300) + k).alias("prompt_tokens"),
        F.round("value").cast("int").alias("completion_tokens"),
    )


def q_investigation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TR.investigation_totals(_tool_calls(spark, sf_dir))
    return t.select(
        "run_id", "n_tool_calls", "total_prompt_tokens", "total_completion_tokens",
        F.array_join("tools_used", ",").alias("tools_used"),
    )


def q_investigation_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = TR.investigation_calls(_tool_calls(spark, sf_dir), size=5)
    return calls.select("run_id", "chunk_no", F.array_join("tools", ",").alias("tools"))


def _growth_diagnosis(user_id):
    return F.concat(
        F.lit("Codec name changed in Spark 4.0 ["), (user_id % 7).cast("string"),
        F.lit("] (lz4raw -> lz4_raw) costs $1.50+tax? see a|b {x} ^y~ #z & \\q"),
    )


def q_rule_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = D.jobs(spark, sf_dir)
    approved = j.select(
        L.translate_status(F.col("emr_status")).alias("status"),
        (F.col("n_clicks") > 0).alias("approved_llm_fix"),
        F.lit("spark.sql.parquet.compression.codec").alias("fix_key"),
        F.lit("lz4_raw").alias("fix_value"),
        _growth_diagnosis(F.col("user_id")).alias("diagnosis"),
        F.col("first_event_id").alias("first_seen"),
    )
    rules = TR.append_rules(rules_table(spark), TR.proposed_rules(approved))
    return rules.select(
        "rule_no", "pattern", "diagnosis", "action", "auto_fix",
        F.col("fix_config.key").alias("fix_key"), F.col("fix_config.value").alias("fix_value"),
    )


def q_diagnosis_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = D.jobs(spark, sf_dir)
    g = F.col("user_id") % 3
    cases = j.select(
        F.col("job_id").alias("case_id"),
        "user_id",
        F.when(g == 0, F.array(F.lit("config_fix")))
        .when(g == 1, F.array(F.lit("escalate"), F.lit("code_change")))
        .otherwise(F.array(F.lit("escalate"), F.lit("dependency_fix"))).alias("acceptable_classifications"),
        F.when(g == 0, F.lit(0.3)).alias("min_confidence"),
        F.when(g == 1, F.lit(0.9)).alias("max_confidence"),
        (g == 0).alias("expect_fix_config"),
    )
    diags = job_diagnoses(spark, sf_dir).select(F.col("job_id").alias("case_id"), "first.*")
    scored = TR.score_diagnoses(cases, diags)
    return scored.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.count_if("passed").alias("n_passed"),
        F.round(F.avg(F.col("passed").cast("double")), 6).alias("pass_rate"),
    )


def mean_vectors(emb: DataFrame, by) -> DataFrame:
    """(query_id, embedding): the mean vector of each group, from one aggregate per (group, dimension)."""
    dims = emb.select(by.alias("query_id"), F.posexplode("embedding").alias("pos", "x")).groupBy("query_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("cx"))
    return dims.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cx"))), lambda s: s["cx"]).alias("embedding"))


def q_vector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L20 for a table of queries: the mean vector of every hundred vectors (by id) against all vectors."""
    emb = read_table(spark, sf_dir, "embeddings")
    found = V.topk(mean_vectors(emb, F.floor(F.col("vec_id") / 100).cast("long")), emb, TOPK)
    return found.select("query_id", "rank", "vec_id", F.round("score", 6).alias("score"))


def q_embedding_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per label, the k vectors most similar (cosine) to the label centroid.

    Centroids come from one aggregate per (label, dimension); each vector is
    compared with its own label's centroid by an equi-join on label (no
    cross product); the top-k is a WindowGroupLimit.
    """
    emb = read_table(spark, sf_dir, "embeddings")
    dims = emb.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos").agg(
        F.avg(F.col("x").cast("double")).alias("cx")
    )
    cent = dims.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "cx"))), lambda s: s["cx"]).alias("centroid")
    )
    v = F.transform("embedding", lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(v, "centroid", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    vv = F.aggregate(F.transform(v, lambda a: a * a), F.lit(0.0), lambda acc, x: acc + x)
    cc = F.aggregate(F.transform("centroid", lambda a: a * a), F.lit(0.0), lambda acc, x: acc + x)
    # few labels: a shuffle join on label would run on as many tasks as there are
    # labels, so the (labels x dims) centroid table is broadcast behind a size check
    scored = emb.join(broadcast_if_small(cent), "label").select(
        "label", "vec_id", F.try_divide(dot, F.sqrt(vv) * F.sqrt(cc)).alias("score")
    )
    w = Window.partitionBy("label").orderBy(F.col("score").desc_nulls_last(), F.col("vec_id"))
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= TOPK)
    return top.select("label", "rank", "vec_id", F.round("score", 6).alias("score"))


QUERIES = {
    "diagnosis_parse": q_diagnosis_parse,
    "diagnosis_final": q_diagnosis_final,
    "triage_route": q_triage_route,
    "diagnosis_source": q_diagnosis_source,
    "triage_events": q_triage_events,
    "triage_changes": q_triage_changes,
    "approval_outcomes": q_approval_outcomes,
    "approval_changes": q_approval_changes,
    "token_cost": q_token_cost,
    "usage_rollup": q_usage_rollup,
    "investigation_totals": q_investigation_totals,
    "investigation_calls": q_investigation_calls,
    "rule_growth": q_rule_growth,
    "diagnosis_score": q_diagnosis_score,
    "embedding_topk": q_embedding_topk,
    "vector_lookup": q_vector_lookup,
}


# --- oracles ----------------------------------------------------------------------------

def _parse_sql(resp: str, p: str) -> str:
    """Columns of a parsed response (with defaults), prefixed by ``p``."""
    ok = f"json_valid({resp})"
    f = lambda k: f"CASE WHEN {ok} THEN json_extract_string({resp}, '$.{k}') END"
    return (
        f"CASE WHEN {ok} AND json_exists({resp}, '$.root_cause') THEN {f('root_cause')} ELSE '' END AS {p}root_cause, "
        f"CASE WHEN {ok} AND json_exists({resp}, '$.classification') THEN {f('classification')} ELSE 'escalate' END AS {p}classification, "
        f"{f('fix_suggestion')} AS {p}fix_suggestion, coalesce(TRY_CAST({f('confidence')} AS DOUBLE), 0.0) AS {p}confidence, "
        f"{f('fix_key')} AS {p}fix_key, {f('fix_value')} AS {p}fix_value, "
        f"coalesce(NOT lower(trim({f('is_mitigation')})) IN ('false', '0', '0.0', '', 'null'), false) AS {p}is_mitigation"
    )


_DIAG_SQL = (
    f"SELECT job_id, user_id, {_parse_sql(D.response_text_sql('n_clicks % 4', _conf_sql('n_purchases')), 'f_')}, "
    f"{_parse_sql(D.response_text_sql('(n_clicks + 1) % 4', _conf_sql('n_purchases', 0.3)), 's_')} FROM ({D.JOBS_SQL})"
)
_PASSES_SQL = (
    "SELECT job_id, (f_classification = 'escalate' OR f_confidence < 0.5) AS second_pass, f_confidence AS trigger_confidence "
    f"FROM ({_DIAG_SQL})"
)
_FINAL_SQL = (
    "SELECT job_id, CASE WHEN f_classification = 'escalate' OR f_confidence < 0.5 THEN s_root_cause ELSE f_root_cause END AS root_cause, "
    "CASE WHEN f_classification = 'escalate' OR f_confidence < 0.5 THEN s_classification ELSE f_classification END AS classification, "
    "CASE WHEN f_classification = 'escalate' OR f_confidence < 0.5 THEN s_confidence ELSE f_confidence END AS confidence, "
    "CASE WHEN f_classification = 'escalate' OR f_confidence < 0.5 THEN s_fix_key ELSE f_fix_key END AS fix_key, "
    f"CASE WHEN f_classification = 'escalate' OR f_confidence < 0.5 THEN s_fix_value ELSE f_fix_value END AS fix_value FROM ({_DIAG_SQL})"
)


def _triage_sql() -> str:
    lines = (
        f"SELECT l.log_id, l.line_no, l.line FROM ({D.JOB_LOG_LINES_SQL}) l JOIN ({D.JOBS_SQL}) j ON l.log_id = j.job_id "
        "WHERE j.emr_status <> 'SUCCESS' AND j.job_run_id IS NOT NULL"
    )
    texts = f"(SELECT log_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({lines}) GROUP BY log_id)"
    match = (
        f"(SELECT t.log_id, min(r.rule_no) AS rule_no FROM {texts} t, {rules_sql()} r "
        "WHERE regexp_matches(t.text, r.pattern, 'i') GROUP BY t.log_id)"
    )
    reduced = f"(SELECT log_id, string_agg(line, chr(10) ORDER BY section, line_no) AS text FROM ({reduce_sql(lines, L.DEFAULT_MAX_BYTES, L.FIRST_LINES_COUNT, L.LAST_LINES_COUNT)}) GROUP BY log_id)"
    excerpts = f"(SELECT log_id, substring(text, 1, {LOG_EXCERPT_CHARS}) AS log_excerpt FROM {reduced})"
    infra = "(j.emr_status <> 'SUCCESS' AND j.job_run_id IS NULL)"
    ok = "(j.emr_status = 'SUCCESS')"
    base = (
        f"SELECT j.job_id, j.n_clicks, j.n_purchases AS retry_count, {ok} AS ok, {infra} AS infra, "
        "CASE WHEN m.rule_no IS NOT NULL THEN 'pattern_matcher' ELSE 'llm' END AS a_source, "
        "CASE WHEN m.rule_no IS NOT NULL THEN r.diagnosis ELSE d.root_cause END AS a_diagnosis, "
        "CASE WHEN m.rule_no IS NOT NULL THEN r.action ELSE d.classification END AS a_action, "
        "CASE WHEN m.rule_no IS NOT NULL THEN r.auto_fix ELSE false END AS a_auto_fix, "
        "CASE WHEN m.rule_no IS NOT NULL THEN r.fix_key WHEN length(d.fix_key) > 0 AND length(d.fix_value) > 0 THEN d.fix_key END AS a_fix_key, "
        "CASE WHEN m.rule_no IS NOT NULL THEN r.fix_value WHEN length(d.fix_key) > 0 AND length(d.fix_value) > 0 THEN d.fix_value END AS a_fix_value "
        ", CASE WHEN m.rule_no IS NULL AND NOT " + ok + " AND NOT " + infra + " THEN d.confidence END AS confidence, "
        "ps.second_pass, ps.trigger_confidence, CASE WHEN m.rule_no IS NULL THEN x.log_excerpt END AS a_excerpt "
        f"FROM ({D.JOBS_SQL}) j LEFT JOIN {match} m ON j.job_id = m.log_id LEFT JOIN {rules_sql()} r ON m.rule_no = r.rule_no "
        f"LEFT JOIN {excerpts} x ON j.job_id = x.log_id "
        f"LEFT JOIN ({_FINAL_SQL}) d ON j.job_id = d.job_id LEFT JOIN ({_PASSES_SQL}) ps ON j.job_id = ps.job_id"
    )
    sel = (
        "SELECT job_id, n_clicks, retry_count, ok, infra, "
        "CASE WHEN ok THEN NULL WHEN infra THEN 'infrastructure' ELSE a_source END AS source, "
        f"CASE WHEN ok THEN NULL WHEN infra THEN {_sql_str(TR.INFRA_DIAGNOSIS)} ELSE a_diagnosis END AS diagnosis, "
        "CASE WHEN ok THEN NULL WHEN infra THEN 'escalate' ELSE a_action END AS action, "
        "CASE WHEN ok THEN NULL WHEN infra THEN false ELSE a_auto_fix END AS auto_fix, "
        "CASE WHEN ok OR infra THEN NULL ELSE a_fix_key END AS fix_key, "
        "CASE WHEN ok OR infra THEN NULL ELSE a_fix_value END AS fix_value, confidence, second_pass, trigger_confidence, "
        "CASE WHEN ok OR infra THEN NULL ELSE a_excerpt END AS log_excerpt "
        f"FROM ({base})"
    )
    retry = f"(coalesce(auto_fix, false) AND retry_count < {DEFAULT_MAX_RETRIES})"
    return (
        "SELECT job_id, source, diagnosis, action, auto_fix, fix_key, fix_value, confidence, second_pass, trigger_confidence, log_excerpt, "
        "400 + n_clicks + CASE WHEN second_pass THEN 300 ELSE 0 END AS prompt_tokens, 50 + n_clicks % 7 AS completion_tokens, "
        f"CASE WHEN ok THEN 'VALIDATE' WHEN infra THEN 'REPORT' WHEN {retry} THEN 'RETRY' WHEN source = 'llm' THEN 'AWAIT_APPROVAL' ELSE 'REPORT' END AS phase, "
        f"CASE WHEN ok THEN 'RUNNING' WHEN infra THEN 'FAILED' WHEN {retry} THEN 'RUNNING' WHEN source = 'llm' THEN 'AWAITING_APPROVAL' ELSE 'FAILED' END AS status, "
        f"CASE WHEN ok THEN NULL WHEN infra THEN 'emr_task_failure' WHEN {retry} THEN NULL WHEN source = 'llm' THEN NULL "
        "WHEN coalesce(auto_fix, false) THEN 'max_retries_exhausted' ELSE 'not_auto_fixable' END AS reason, "
        f"CASE WHEN NOT ok AND NOT infra AND {retry} THEN retry_count + 1 ELSE retry_count END AS new_retry_count FROM ({sel})"
    )


_ROUTE_COLS = "job_id, source, diagnosis, action, auto_fix, fix_key, fix_value, phase, status, reason, new_retry_count, log_excerpt"


def _events_sql() -> str:
    r = _triage_sql()
    kinds = [
        ("react_loop_started", "phase <> 'VALIDATE' AND source = 'llm' AND coalesce(second_pass, false)", "'trigger_confidence=' || CAST(trigger_confidence AS VARCHAR)"),
        ("react_loop_finished", "phase <> 'VALIDATE' AND source = 'llm' AND coalesce(second_pass, false)",
         "'final_confidence=' || CAST(confidence AS VARCHAR) || ';tools_used=[''grep_log'', ''read_file'']'"),
        ("llm_call", "phase <> 'VALIDATE' AND source = 'llm'",
         "'completion_tokens=' || completion_tokens || ';estimated_cost_usd=0.' || lpad(CAST(prompt_tokens * 150 + completion_tokens * 600 AS VARCHAR), 9, '0') || ';model=gpt-4o-mini;prompt_tokens=' || prompt_tokens"),
        ("failure_analyzed", "phase <> 'VALIDATE' AND source <> 'infrastructure'", "'diagnosis=' || diagnosis || ';source=' || source"),
        ("auto_fix_applied", "phase = 'RETRY'", "'fix_key=' || fix_key || ';fix_value=' || fix_value || ';retry_count=' || CAST(new_retry_count AS VARCHAR)"),
        ("awaiting_approval", "phase = 'AWAIT_APPROVAL'", "'confidence=' || CAST(confidence AS VARCHAR)"),
        ("escalated", "phase = 'REPORT'", "'reason=' || reason"),
    ]
    parts = " UNION ALL ".join(f"SELECT job_id, {i} AS k, '{name}' AS event, {details} AS details FROM r WHERE {cond}" for i, (name, cond, details) in enumerate(kinds))
    return (
        f"WITH r AS ({r}), e AS ({parts}) "
        "SELECT job_id, CAST(row_number() OVER (PARTITION BY job_id ORDER BY k) AS INTEGER) AS event_no, event, details FROM e"
    )


def _changes_sql() -> str:
    r = _triage_sql()
    kinds = [
        ("pipeline", "target_status", "true", "CASE WHEN phase = 'VALIDATE' THEN 'SUCCEEDED' ELSE 'FAILED' END"),
        ("pipeline", "retry_count", "phase = 'RETRY'", "CAST(new_retry_count AS VARCHAR)"),
        ("pipeline", "status", "phase = 'AWAIT_APPROVAL'", "'AWAITING_APPROVAL'"),
        ("pipeline", "status", "phase = 'REPORT'", "'FAILED'"),
        ("pipeline", "diagnosis", "phase <> 'VALIDATE'", "diagnosis"),
        ("pipeline", "corrective_action", "phase = 'RETRY'", "'set ' || fix_key || '=' || fix_value"),
        ("pipeline", "corrective_action", "phase = 'AWAIT_APPROVAL'",
         f"CASE WHEN fix_key IS NOT NULL AND fix_value IS NOT NULL THEN 'proposed: set ' || fix_key || '=' || fix_value ELSE {_sql_str(TR.PROPOSED_NO_FIX)} END"),
        ("pipeline", "error_message", "phase = 'REPORT'", "diagnosis"),
        ("metadata", "phase", "true", "CASE WHEN phase = 'RETRY' THEN 'EXECUTE' ELSE phase END"),
        ("metadata", "status", "phase IN ('AWAIT_APPROVAL', 'REPORT')", "status"),
    ]
    parts = " UNION ALL ".join(f"SELECT job_id, '{rec}' AS record_type, '{field}' AS field, {val} AS value FROM r WHERE {cond}" for rec, field, cond, val in kinds)
    return f"WITH r AS ({r}) {parts}"


def _approvals_sql() -> str:
    return (
        "SELECT job_id, CASE WHEN trigger_confidence < 0.3 THEN 'reject' WHEN trigger_confidence < 0.6 THEN 'retry_with_human_fix' "
        "ELSE 'approve' END AS decision, fix_key, fix_value, new_retry_count AS retry_count, diagnosis "
        f"FROM ({_triage_sql()}) WHERE phase = 'AWAIT_APPROVAL'"
    )


def _approval_changes_sql() -> str:
    approve = "(decision = 'approve' AND fix_key IS NOT NULL AND fix_value IS NOT NULL)"
    human, reject = "(decision = 'retry_with_human_fix')", "(decision = 'reject')"
    resume = f"({approve} OR {human})"
    rows = [
        ("pipeline", "status", resume, "'RUNNING'"),
        ("pipeline", "retry_count", resume, "CAST(retry_count + 1 AS VARCHAR)"),
        ("pipeline", "corrective_action", approve, "'approved: set ' || fix_key || '=' || fix_value"),
        ("pipeline", "corrective_action", human, _sql_str(TR.HUMAN_FIX_ACTION)),
        ("pipeline", "status", reject, "'FAILED'"),
        ("pipeline", "diagnosis", reject, f"coalesce(diagnosis, {_sql_str(TR.APPROVAL_DEFAULT_DIAGNOSIS)})"),
        ("pipeline", "error_message", reject, _sql_str(TR.APPROVAL_REJECTED_MESSAGE)),
        ("metadata", "phase", resume, "'EXECUTE'"),
        ("metadata", "phase", reject, "'REPORT'"),
        ("metadata", "status", resume, "'RUNNING'"),
        ("metadata", "status", reject, "'FAILED'"),
        ("metadata", "pending_approval_task_token", f"({resume} OR {reject})", "NULL"),
        ("metadata", "pending_approval_state", f"({resume} OR {reject})", "NULL"),
        ("metadata", "approved_llm_fix", approve, "'true'"),
        ("event", "approval_approved", approve, "'fix_key=' || fix_key || ';fix_value=' || fix_value"),
        ("event", "retry_with_human_fix", human, "'retry_count=' || CAST(retry_count + 1 AS VARCHAR)"),
        ("event", "approval_rejected", reject, "''"),
    ]
    parts = " UNION ALL ".join(f"SELECT job_id, '{rec}' AS record_type, '{field}' AS field, CAST({val} AS VARCHAR) AS value FROM a WHERE {cond}" for rec, field, cond, val in rows)
    return f"WITH a AS ({_approvals_sql()}) {parts}"


_CALLS_SQL = (
    "SELECT event_id AS call_id, user_id AS run_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) % 3 = 0 THEN 'gpt-4o' ELSE 'gpt-4o-mini' END AS model, "
    "400 + CAST(json_extract_string(props, '$.k') AS INT) * 10 AS prompt_tokens, 50 + CAST(round(value) AS INT) AS completion_tokens "
    "FROM events WHERE event_type = 'click'"
)
_COST_SQL = (
    "SELECT c.*, coalesce((c.prompt_tokens * p.pp + c.completion_tokens * p.cp) / 1000000.0, 0.0) AS estimated_cost_usd "
    f"FROM ({_CALLS_SQL}) c LEFT JOIN (VALUES ('gpt-4o-mini', 0.150, 0.600)) AS p(model, pp, cp) ON c.model = p.model"
)
_GROWTH_DIAG_SQL = (
    "'Codec name changed in Spark 4.0 [' || (user_id % 7) || '] (lz4raw -> lz4_raw) costs $1.50+tax? see a|b {x} ^y~ #z & \\q'"
)

ORACLE = {
    "diagnosis_parse": (
        "SELECT job_id, f_root_cause AS root_cause, f_classification AS classification, f_fix_suggestion AS fix_suggestion, "
        "f_confidence AS confidence, f_fix_key AS fix_key, f_fix_value AS fix_value, f_is_mitigation AS is_mitigation "
        f"FROM ({_DIAG_SQL})"
    ),
    "diagnosis_final": (
        "SELECT job_id, (f_classification = 'escalate' OR f_confidence < 0.5) AS second_pass, "
        "root_cause, classification, confidence, fix_key, fix_value FROM (" + _FINAL_SQL.replace("SELECT job_id,", "SELECT job_id, f_classification, f_confidence,", 1) + ")"
    ),
    "triage_route": f"SELECT {_ROUTE_COLS} FROM ({_triage_sql()})",
    "diagnosis_source": (
        f"SELECT job_id, source, diagnosis, action, auto_fix, fix_key, fix_value, confidence FROM ({_triage_sql()}) "
        "WHERE source IN ('pattern_matcher', 'llm')"
    ),
    "triage_events": _events_sql(),
    "approval_outcomes": (
        f"WITH a AS ({_approvals_sql()}) SELECT job_id, CASE WHEN decision = 'approve' AND fix_key IS NOT NULL AND fix_value IS NOT NULL THEN 'approved' "
        "WHEN decision = 'approve' THEN 'no_structured_fix' WHEN decision = 'retry_with_human_fix' THEN 'retrying_with_human_fix' "
        "WHEN decision = 'reject' THEN 'rejected' ELSE 'invalid_decision' END AS outcome FROM a"
    ),
    "approval_changes": _approval_changes_sql(),
    "triage_changes": _changes_sql(),
    "token_cost": f"SELECT call_id, run_id, model, prompt_tokens, completion_tokens, round(estimated_cost_usd, 12) AS estimated_cost_usd FROM ({_COST_SQL})",
    "usage_rollup": (
        "SELECT r.run_id, a.count, CAST(a.total_prompt_tokens AS BIGINT) AS total_prompt_tokens, CAST(a.total_completion_tokens AS BIGINT) AS total_completion_tokens, round(a.total_estimated_cost_usd, 10) AS total_estimated_cost_usd "
        "FROM (SELECT DISTINCT user_id AS run_id FROM events) r LEFT JOIN (SELECT run_id, count(*) AS count, sum(prompt_tokens) AS total_prompt_tokens, "
        f"sum(completion_tokens) AS total_completion_tokens, sum(estimated_cost_usd) AS total_estimated_cost_usd FROM ({_COST_SQL}) GROUP BY run_id) a ON r.run_id = a.run_id"
    ),
    "investigation_totals": (
        "WITH c AS (SELECT user_id AS run_id, event_id AS seq, "
        f"[{', '.join(_sql_str(t) for t in TOOLS)}][CAST(json_extract_string(props, '$.k') AS INT) % 4 + 1] AS tool, "
        "300 + CAST(json_extract_string(props, '$.k') AS INT) AS prompt_tokens, CAST(round(value) AS INT) AS completion_tokens "
        "FROM events WHERE event_type = 'view'), "
        "f AS (SELECT run_id, tool, min(seq) AS fs FROM c GROUP BY run_id, tool) "
        "SELECT t.run_id, t.n_tool_calls, CAST(t.total_prompt_tokens AS BIGINT) AS total_prompt_tokens, CAST(t.total_completion_tokens AS BIGINT) AS total_completion_tokens, u.tools_used FROM "
        "(SELECT run_id, count(*) AS n_tool_calls, sum(prompt_tokens) AS total_prompt_tokens, sum(completion_tokens) AS total_completion_tokens FROM c GROUP BY run_id) t "
        "JOIN (SELECT run_id, string_agg(tool, ',' ORDER BY fs) AS tools_used FROM f GROUP BY run_id) u ON t.run_id = u.run_id"
    ),
    "investigation_calls": (
        "WITH c AS (SELECT user_id AS run_id, event_id AS seq, "
        f"[{', '.join(_sql_str(t) for t in TOOLS)}][CAST(json_extract_string(props, '$.k') AS INT) % 4 + 1] AS tool, "
        "(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS chunk_no FROM events WHERE event_type = 'view') "
        "SELECT run_id, chunk_no, string_agg(tool, ',' ORDER BY seq) AS tools FROM c GROUP BY run_id, chunk_no"
    ),
    "rule_growth": (
        f"WITH a AS (SELECT {_GROWTH_DIAG_SQL} AS diagnosis, first_event_id AS first_seen FROM ({D.JOBS_SQL}) "
        "WHERE emr_status = 'SUCCESS' AND n_clicks > 0), "
        "p AS (SELECT substring(regexp_replace(diagnosis, '([\\t\\n\\r\\x0B\\f #$&()*+\\-.?\\[\\\\\\]^{|}~])', '\\\\\\1', 'g'), 1, 300) AS pattern, "
        "diagnosis, first_seen FROM a), "
        "g AS (SELECT pattern, arg_min(diagnosis, first_seen) AS diagnosis, min(first_seen) AS first_seen FROM p GROUP BY pattern), "
        f"b AS (SELECT * FROM {rules_sql()}) "
        "SELECT rule_no, pattern, diagnosis, action, auto_fix, fix_key, fix_value FROM b "
        "UNION ALL SELECT CAST((SELECT max(rule_no) FROM b) + row_number() OVER (ORDER BY first_seen, pattern) AS INT), pattern, diagnosis, "
        "'config_fix', true, 'spark.sql.parquet.compression.codec', 'lz4_raw' FROM g WHERE pattern NOT IN (SELECT pattern FROM b)"
    ),
    "diagnosis_score": (
        "WITH d AS (" + _DIAG_SQL + "), s AS (SELECT user_id, "
        "(CASE user_id % 3 WHEN 0 THEN f_classification IN ('config_fix') WHEN 1 THEN f_classification IN ('escalate', 'code_change') "
        "ELSE f_classification IN ('escalate', 'dependency_fix') END) "
        "AND (user_id % 3 <> 0 OR f_confidence >= 0.3) AND (user_id % 3 <> 1 OR f_confidence <= 0.9) "
        "AND (CASE WHEN user_id % 3 = 0 THEN f_fix_key IS NOT NULL AND f_fix_value IS NOT NULL "
        "ELSE f_classification <> 'config_fix' OR f_fix_key IS NULL END) AS passed FROM d) "
        "SELECT user_id, count(*) AS n_cases, count(*) FILTER (WHERE passed) AS n_passed, round(avg(CAST(passed AS DOUBLE)), 6) AS pass_rate "
        "FROM s GROUP BY user_id"
    ),
    "vector_lookup": (
        "WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), "
        "q AS (SELECT vec_id // 100 AS query_id, pos, avg(x) AS cx FROM e GROUP BY ALL), n AS (SELECT query_id, sqrt(sum(cx * cx)) AS nq FROM q GROUP BY ALL), "
        "m AS (SELECT vec_id, sqrt(sum(x * x)) AS nv FROM e GROUP BY ALL), "
        "s AS (SELECT q.query_id, e.vec_id, sum(e.x * q.cx) AS dot FROM e JOIN q USING (pos) GROUP BY ALL), "
        "r AS (SELECT query_id, vec_id, dot / (nq * nv) AS score FROM s JOIN n USING (query_id) JOIN m USING (vec_id)), "
        "k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM r) "
        f"SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM k WHERE rank <= {TOPK}"
    ),
    "embedding_topk": (
        "WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings), "
        "c AS (SELECT label, pos, avg(x) AS cx FROM e GROUP BY label, pos), "
        "s AS (SELECT e.vec_id, e.label, sum(e.x * c.cx) AS dot, sum(e.x * e.x) AS vv, sum(c.cx * c.cx) AS cc "
        "FROM e JOIN c ON e.label = c.label AND e.pos = c.pos GROUP BY e.vec_id, e.label), "
        "r AS (SELECT label, vec_id, dot / (sqrt(vv) * sqrt(cc)) AS score FROM s), "
        f"k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC NULLS LAST, vec_id) AS rank FROM r) "
        f"SELECT label, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM k WHERE rank <= {TOPK}"
    ),
}
