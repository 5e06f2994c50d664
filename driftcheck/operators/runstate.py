"""Run state as an append-only change log plus an event log.

The key-value store of the original becomes two tables:

* a change log ``(run_id, record_type, field, value, ts, seq)``: every
  partial update writes one row per named field; the current state is the
  fold "latest value per (run, record, field)" by ``(ts, seq)``, which keeps
  explicit nulls and lets concurrent updates of different fields all survive;
* an event log ``(run_id, record_type, timestamp, phase, event, details, seq)``
  that is only appended to.

Folds and rollups are grouped aggregates (partial aggregation before the
shuffle); listings are ``TakeOrderedAndProject`` top-k; per-run histories
keep at most k rows per run through a WindowGroupLimit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftcheck.functions.sequence import chunked

from driftcheck.functions.joins import broadcast_if_small

# Fixed values of the state store and views.
METADATA_RECORD_TYPE = "_metadata"
EVENT_RECORD_PREFIX = "event#"
LIST_RUNS_LIMIT = 20
HISTORY_EVENTS = ["failure_analyzed", "auto_fix_applied", "escalated", "awaiting_approval"]
HISTORY_LIMIT = 20
RETRY_EVENTS = ["auto_fix_applied", "approval_approved", "retry_with_human_fix"]
TIMELINE_LABELS = [
    ("failure_analyzed", "🔎 Failure analyzed"),
    ("llm_call", "🤖 LLM call"),
    ("react_loop_started", "🔁 Investigation started (single-shot was inconclusive)"),
    ("tool_call", "🛠️ Tool call"),
    ("react_loop_finished", "✅ Investigation finished"),
    ("auto_fix_applied", "⚡ Auto-fix applied (pattern matcher)"),
    ("awaiting_approval", "🟠 Awaiting human approval"),
    ("approval_approved", "✅ Human approved"),
    ("retry_with_human_fix", "🧑‍💻 Human pushed their own fix"),
    ("approval_rejected", "❌ Human rejected"),
    ("escalated", "🚨 Escalated (no fix applied)"),
]
SUMMARY_PASSED_RETRY = (
    "The upgrade test PASSED after {n} automatic retry. A known Spark 4.0 breaking change was detected and "
    "corrected automatically; baseline and target outputs match."
)
SUMMARY_PASSED = "The upgrade test PASSED on the first attempt with no corrective action needed."
SUMMARY_WARNING = "The upgrade test completed with warnings - review the validation results below."
SUMMARY_AWAITING = (
    "The pattern matcher didn't recognize this failure, so the LLM proposed a fix - see the failure analysis "
    "below. This requires human review before it can be applied."
)
SUMMARY_FAILED = (
    "The upgrade test FAILED. See the failure analysis below for the root cause and why it could not be "
    "automatically corrected."
)
RECOMMEND_MANUAL = "This failure requires manual investigation before the upgrade can proceed."
RECOMMEND_RETRY = "Review the target job's logs and retry once the root cause is addressed."


# Fields of a new pipeline record that have no value yet.
INIT_EMPTY_FIELDS = [
    "variant", "completed_at", "baseline_log_path", "target_log_path", "baseline_output_path", "target_output_path",
    "error_message", "diagnosis", "corrective_action",
]


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with +00:00 like ``datetime.isoformat`` (no fraction when it is zero)."""
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac == "000000", F.lit("")).otherwise(F.concat(F.lit("."), frac)),
        F.lit("+00:00"),
    )


# --- R1 / R2: records and the fold ---------------------------------------------------------

def init_changes(runs: DataFrame, pipeline_id: Column | str, created_at: Column | str, config: Column | str | None = None) -> DataFrame:
    """R1 as change-log rows, stamped at ``created_at``: the metadata record (RUNNING, BRANCH,
    the run's ``config`` as JSON text) and one pipeline record with all its fields.

    Fields that a new pipeline record holds without a value are explicit nulls.
    """
    pid = F.col(pipeline_id) if isinstance(pipeline_id, str) else pipeline_id
    cat = F.col(created_at) if isinstance(created_at, str) else created_at
    conf = F.col(config) if isinstance(config, str) else config if config is not None else F.lit(None)
    now = iso_utc(cat)
    meta = [
        ("status", F.lit("RUNNING")), ("phase", F.lit("BRANCH")), ("config", conf), ("created_at", now),
        ("updated_at", now), ("overall_status", F.lit("RUNNING")),
    ]
    pipe = [
        ("pipeline_id", pid), ("status", F.lit("PENDING")), ("phase", F.lit("BRANCH")), ("baseline_status", F.lit("PENDING")),
        ("target_status", F.lit("PENDING")), ("started_at", now), ("updated_at", now), ("retry_count", F.lit("0")),
        ("metrics", F.lit("{}")), ("validation_results", F.lit("{}")),
    ]
    pipe += [(name, F.lit(None)) for name in INIT_EMPTY_FIELDS]
    entries = [F.struct(F.lit(METADATA_RECORD_TYPE).alias("record_type"), F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in meta]
    entries += [F.struct(pid.cast("string").alias("record_type"), F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in pipe]
    return runs.select("run_id", F.inline(F.array(*entries)), cat.alias("ts"), F.lit(-1).cast("long").alias("seq"))


def fold_changes(changes: DataFrame) -> DataFrame:
    """R2: latest value per (run_id, record_type, field) by (ts, seq); explicit nulls survive."""
    return changes.groupBy("run_id", "record_type", "field").agg(
        F.max_by(F.struct("value"), F.struct("ts", "seq")).getField("value").alias("value"),
        F.max("ts").alias("ts"),
    )


def pivot_fields(folded: DataFrame, fields: list[str]) -> DataFrame:
    """Folded long rows to one wide row per record (known field list, no pivot discovery job)."""
    return folded.groupBy("run_id", "record_type").agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    )


# --- R4-R8: reads ---------------------------------------------------------------------------

def events_in_order(events: DataFrame) -> DataFrame:
    """Events ordered by (run_id, timestamp, seq): a range-partitioned global sort,
    so even a run holding a third of all events is split across tasks."""
    return events.orderBy("run_id", "ts", "seq")


def pipeline_records(state: DataFrame) -> DataFrame:
    """Pipeline records only (neither metadata nor events)."""
    rt = F.col("record_type")
    return state.filter((rt != METADATA_RECORD_TYPE) & ~rt.startswith(EVENT_RECORD_PREFIX))


def lookup(state: DataFrame, requests: DataFrame, strict: bool = False) -> DataFrame:
    """Point lookups by (run_id, record_type); ``found`` is false for a missing key.

    ``strict=True`` keeps the original contract that a missing key is an
    error: it raises ``KeyError`` naming up to ten missing keys (one small
    action that reads only the missing requests).
    """
    hit = state.withColumn("__found", F.lit(True))
    out = requests.join(hit, ["run_id", "record_type"], "left").withColumn(
        "found", F.coalesce("__found", F.lit(False))
    ).drop("__found")
    if strict:
        missing = out.filter(~F.col("found")).select("run_id", "record_type").limit(10).collect()
        if missing:
            raise KeyError("No record for " + ", ".join(f"run_id={m['run_id']!r} record_type={m['record_type']!r}" for m in missing))
    return out


def recent_runs(metadata: DataFrame, limit: int = LIST_RUNS_LIMIT) -> DataFrame:
    """Newest runs first by created_at (missing last); a top-k, not a full sort."""
    return metadata.orderBy(F.col("created_at").desc_nulls_last(), F.col("run_id")).limit(limit)


def snapshot(metadata: DataFrame, pipelines: DataFrame, events: DataFrame) -> DataFrame:
    """One row per run with the metadata and its pipeline records nested.

    Events stay a child relation keyed by run_id (their count is reported),
    so no run's unbounded event list is gathered into one row.
    """
    pcols = [c for c in pipelines.columns if c != "run_id"]
    mcols = [c for c in metadata.columns if c != "run_id"]
    p = pipelines.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct(*pcols))).alias("pipelines")
    )
    e = events.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_events"))
    return (
        metadata.select("run_id", F.struct(*mcols).alias("metadata"))
        .join(p, "run_id", "left")
        .join(e, "run_id", "left")
        .select("run_id", "metadata", F.coalesce("pipelines", F.array()).alias("pipelines"), F.coalesce("n_events", F.lit(0)).alias("n_events"))
    )


SNAPSHOT_ITEMS = 500


def snapshot_rows(metadata: DataFrame, pipelines: DataFrame, events: DataFrame, event_order: tuple[str, ...] = ("ts", "seq"), items: int = SNAPSHOT_ITEMS) -> DataFrame:
    """R8 whole: (run_id, kind, chunk_no, items), every record of every run as JSON text.

    ``kind`` is metadata, pipelines or events; a run's records of one kind come
    in order, at most ``items`` to a row, so a run with a third of all events
    is many rows in many tasks and no row or group holds a run.
    """
    def text(df: DataFrame):
        return F.to_json(F.struct(*[c for c in df.columns if c != "run_id"]), {"ignoreNullFields": "false"})

    run = metadata.select("run_id", F.lit("metadata").alias("kind"), F.lit(0).cast("long").alias("chunk_no"), F.array(text(metadata)).alias("items"))
    for kind, df, order in (("pipelines", pipelines, [c for c in pipelines.columns if c != "run_id"]), ("events", events, list(event_order))):
        part = chunked(df, "run_id", order, text(df), items)
        run = run.unionByName(part.select("run_id", F.lit(kind).alias("kind"), "chunk_no", "items"))
    return run


def snapshot_items(rows: DataFrame, items: int = SNAPSHOT_ITEMS) -> DataFrame:
    """(run_id, kind, pos, item): the records of :func:`snapshot_rows` one by one, ``pos`` from 0 in their order."""
    one = rows.select("run_id", "kind", "chunk_no", F.posexplode("items").alias("k", "item"))
    return one.select("run_id", "kind", (F.col("chunk_no") * items + F.col("k")).alias("pos"), "item")


# --- R10-R12: views -----------------------------------------------------------------------

def run_history(events: DataFrame, runs: DataFrame, limit: int = HISTORY_LIMIT) -> DataFrame:
    """The last ``limit`` failure/fix events of each run, oldest first, one text per run.

    Each line is ``phase/event: diagnosis-or-reason-or-empty``; a run without
    such events gets a message.
    """
    rel = events.filter(F.col("event").isin(*HISTORY_EVENTS))
    w = Window.partitionBy("run_id").orderBy(F.col("ts").desc(), F.col("seq").desc())
    last = rel.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= limit)
    detail = F.coalesce(
        F.when(F.length(F.col("details")["diagnosis"]) > 0, F.col("details")["diagnosis"]),
        F.when(F.length(F.col("details")["reason"]) > 0, F.col("details")["reason"]),
        F.lit(""),
    )
    line = F.concat(F.col("phase"), F.lit("/"), F.col("event"), F.lit(": "), detail)
    hist = last.groupBy("run_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "seq", line.alias("l")))), lambda x: x["l"]), "\n").alias("history")
    )
    msg = F.format_string("No prior failure/fix events found for run %s (pipeline %s).", F.col("run_id").cast("string"), F.col("pipeline_id"))
    return runs.join(hist, "run_id", "left").select("run_id", F.coalesce("history", msg).alias("history"))


def _py(v: Column) -> Column:
    """f-string of an optional text: None prints as 'None'."""
    return F.coalesce(v, F.lit("None"))


def timeline(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Decision-timeline rows (run_id, ts, seq, label, timestamp, detail) for the labelled events."""
    d = F.col("details")
    ev = F.col("event")
    # cost to six decimals, rounded half up on the decimal text (no binary float rounding)
    cost = F.coalesce(d["estimated_cost_usd"].try_cast("decimal(30,9)"), F.lit(0).cast("decimal(30,9)")).cast("decimal(30,6)").cast("string")
    diag_or_reason = F.coalesce(
        F.when(F.length(d["diagnosis"]) > 0, d["diagnosis"]), F.when(F.length(d["reason"]) > 0, d["reason"])
    )
    detail = (
        F.when(ev == "tool_call", F.concat(F.lit("`"), _py(d["tool"]), F.lit("("), _py(d["args"]), F.lit(")` → "), _py(d["result_summary"])))
        .when(ev == "llm_call", F.concat(
            F.lit("model="), _py(d["model"]), F.lit(" · prompt_tokens="), _py(d["prompt_tokens"]),
            F.lit(" · completion_tokens="), _py(d["completion_tokens"]), F.lit(" · cost=$"), cost))
        .when(ev == "react_loop_started", F.concat(F.lit("trigger confidence: "), _py(d["trigger_confidence"])))
        .when(ev == "react_loop_finished", F.concat(F.lit("tools used: "), _py(d["tools_used"]), F.lit(" · final confidence: "), _py(d["final_confidence"])))
        .when(ev == "auto_fix_applied", F.concat(F.lit("set `"), _py(d["fix_key"]), F.lit(" = "), _py(d["fix_value"]), F.lit("`")))
        .when(ev == "approval_approved", F.concat(F.lit("applied `"), _py(d["fix_key"]), F.lit(" = "), _py(d["fix_value"]), F.lit("`")))
        .when(ev == "retry_with_human_fix", F.concat(F.lit("retry_count: "), _py(d["retry_count"])))
        .when(ev.isin("failure_analyzed", "escalated"), diag_or_reason)
        .when(ev == "awaiting_approval", F.concat(F.lit("confidence: "), _py(d["confidence"])))
    )
    return events.join(broadcast_if_small(labels), "event").select(
        "run_id", "ts", "seq", "label", F.col("timestamp"), detail.alias("detail")
    )


def timeline_labels(spark) -> DataFrame:
    return spark.createDataFrame(TIMELINE_LABELS, "event string, label string")


def duration_text(start_iso: Column, end_iso: Column) -> Column:
    """``str(end - start)`` without the fraction: ``H:MM:SS`` or ``N day(s), H:MM:SS``; '-' if missing/invalid."""
    s = F.try_to_timestamp(start_iso)
    e = F.try_to_timestamp(end_iso)
    us = F.unix_micros(e) - F.unix_micros(s)
    day_us = F.lit(86_400_000_000)
    days = F.floor(us / day_us).cast("long")
    rem = F.floor((us - days * day_us) / F.lit(1_000_000)).cast("long")
    hms = F.format_string("%d:%02d:%02d", (rem / 3600).cast("long"), ((rem % 3600) / 60).cast("long"), rem % 60)
    day_txt = F.when(days == 0, F.lit("")).otherwise(
        F.concat(days.cast("string"), F.when(F.abs(days) == 1, F.lit(" day, ")).otherwise(F.lit(" days, ")))
    )
    txt = F.concat(day_txt, hms)
    return F.when((F.length(start_iso) > 0) & (F.length(end_iso) > 0) & s.isNotNull() & e.isNotNull(), txt).otherwise(F.lit("-"))


def pipeline_status_table(pipelines: DataFrame) -> DataFrame:
    """One display row per pipeline record with the view's defaults."""
    cols = set(pipelines.columns)

    def c(name: str, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in cols else F.lit(default)

    validation = F.get_json_object("validation_results", "$.overall_status") if "validation_results" in cols else F.lit(None).cast("string")
    return pipelines.select(
        "run_id",
        c("pipeline_id", "-").alias("pipeline"),
        c("baseline_status", "PENDING").alias("baseline"),
        c("target_status", "PENDING").alias("target"),
        c("retry_count", "0").alias("retries"),
        F.coalesce(validation, F.lit("-")).alias("validation"),
        c("status", "PENDING").alias("status"),
    )


def run_summary(metadata: DataFrame) -> DataFrame:
    """R14 header: overall status, phase, start and duration with the view's defaults."""
    cols = set(metadata.columns)

    def c(name: str):
        return F.col(name) if name in cols else F.lit(None).cast("string")

    return metadata.select(
        "run_id",
        F.coalesce(c("overall_status"), F.lit("UNKNOWN")).alias("overall_status"),
        F.coalesce(c("phase"), F.lit("UNKNOWN")).alias("phase"),
        F.coalesce(c("created_at"), F.lit("-")).alias("started"),
        duration_text(F.coalesce(c("created_at"), F.lit("")), F.coalesce(c("updated_at"), F.lit(""))).alias("duration"),
    )


# --- R15-R17: report rows ---------------------------------------------------------------

def executive_summary(status: Column, retry_count: Column) -> Column:
    """R15."""
    return (
        F.when(status.isin("PASSED", "SUCCEEDED") & (retry_count > 0),
               F.format_string(SUMMARY_PASSED_RETRY.replace("{n}", "%d"), retry_count))
        .when(status.isin("PASSED", "SUCCEEDED"), F.lit(SUMMARY_PASSED))
        .when(status == "WARNING", F.lit(SUMMARY_WARNING))
        .when(status == "AWAITING_APPROVAL", F.lit(SUMMARY_AWAITING))
        .otherwise(F.lit(SUMMARY_FAILED))
    )


def recommendations(status: Column, has_analysis: Column, auto_fix: Column, diagnosis: Column) -> Column:
    """List of recommendation texts."""
    return (
        F.when(status.isin("PASSED", "SUCCEEDED"), F.array().cast("array<string>"))
        .when(has_analysis & ~F.coalesce(auto_fix, F.lit(False)),
              F.array(F.lit(RECOMMEND_MANUAL), F.concat(F.lit("Diagnosis: "), F.coalesce(diagnosis, F.lit("unknown")))))
        .otherwise(F.array(F.lit(RECOMMEND_RETRY)))
    )


def usage_totals(events: DataFrame) -> DataFrame:
    """R17 model usage of each run from its ``llm_call`` events: calls, tokens and cost (exact decimals)."""
    d = F.col("details")
    return events.filter(F.col("event") == "llm_call").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("llm_calls"),
        F.sum(F.coalesce(d["prompt_tokens"].try_cast("long"), F.lit(0))).alias("total_prompt_tokens"),
        F.sum(F.coalesce(d["completion_tokens"].try_cast("long"), F.lit(0))).alias("total_completion_tokens"),
        F.sum(F.coalesce(d["estimated_cost_usd"].try_cast("decimal(20,9)"), F.lit(0).cast("decimal(20,9)"))).alias("total_estimated_cost_usd"),
    )


def report_rows(runs: DataFrame, events: DataFrame, pipelines: DataFrame) -> DataFrame:
    """The report row of each run.

    ``runs`` holds run_id, overall_status, retry_count, baseline_spark_version,
    target_spark_version, baseline_branch, target_branch, analysis_result (JSON
    text or null), has_analysis, auto_fix and diagnosis; ``pipelines`` the
    folded pipeline records. Usage columns are null for a run that never
    called the model.
    """
    status = F.col("overall_status")
    cols = pipelines.select(
        "run_id", "pipeline_id", F.col("baseline_status").alias("__b"), F.col("status").alias("__t"),
        F.coalesce(F.get_json_object("validation_results", "$.checks"), F.lit("[]")).alias("validation_checks"),
    )
    j = runs.join(cols, "run_id", "left").join(usage_totals(events), "run_id", "left")
    rec = recommendations(status, F.col("has_analysis"), F.col("auto_fix"), F.col("diagnosis"))
    return j.select(
        "run_id", "overall_status", executive_summary(status, F.col("retry_count")).alias("executive_summary"), "pipeline_id",
        "baseline_spark_version", "target_spark_version",
        F.coalesce("baseline_branch", F.lit("")).alias("baseline_branch"), F.coalesce("target_branch", F.lit("")).alias("target_branch"),
        F.coalesce("__b", F.lit("UNKNOWN")).alias("baseline_status"), F.coalesce("__t", F.lit("UNKNOWN")).alias("target_status"),
        "retry_count", F.coalesce("validation_checks", F.lit("[]")).alias("validation_checks"), "analysis_result",
        F.array_join(rec, " | ").alias("recommendations"),
        "llm_calls", "total_prompt_tokens", "total_completion_tokens", F.col("total_estimated_cost_usd").cast("string").alias("total_estimated_cost_usd"),
    )


# --- R20-R22 ----------------------------------------------------------------------------

def presence_check(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Every expected (run, branch_rank, branch, file) must be listed; the first missing branch is reported."""
    present = listing.select("run_id", "branch", "file", F.lit(True).alias("__present")).dropDuplicates(["run_id", "branch", "file"])
    j = expected.join(present, ["run_id", "branch", "file"], "left")
    miss = F.col("__present").isNull()
    per_run = j.groupBy("run_id").agg(
        F.min_by(F.when(miss, F.col("branch")), F.when(miss, F.col("branch_rank"))).alias("missing_branch")
    )
    return per_run.select("run_id", F.col("missing_branch").isNull().alias("ok"), "missing_branch")


def work_list(runs: DataFrame, baseline_status: Column | str) -> DataFrame:
    """(run, variant) still to run: both variants, minus baselines that already SUCCEEDED."""
    bs = F.col(baseline_status) if isinstance(baseline_status, str) else baseline_status
    pairs = runs.select("run_id", bs.alias("__bs"), F.explode(F.array(F.lit("baseline"), F.lit("target"))).alias("variant"))
    return pairs.filter(~((F.col("variant") == "baseline") & F.coalesce(F.col("__bs") == "SUCCEEDED", F.lit(False)))).drop("__bs")


def retry_counts(events: DataFrame) -> DataFrame:
    """Retries per run = auto fixes + approvals + human fixes."""
    return events.groupBy("run_id").agg(F.count_if(F.col("event").isin(*RETRY_EVENTS)).alias("retry_count"))
