"""Rule matching, diagnosis parsing, routing, cost and scoring.

The model call itself is not built; diagnoses are a table of stored
responses. Everything else is joins, aggregates and ``when`` chains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcheck.functions.joins import broadcast_if_small
from driftcheck.functions.patterns import shape
from driftcheck.functions.sequence import chunked, dense_number
from driftcheck.functions.text import (
    PY_SEARCH_FLAGS,
    drop_dangling_backslash,
    py_re_escape,
    py_to_java_regex,
    py_truthy,
)
from driftcheck.operators.rule_search import first_rules, first_rules_in_lines

# Fixed values from the analyzer and router.
INCONCLUSIVE_CONFIDENCE = 0.5
DEFAULT_CLASSIFICATION = "escalate"
PRICES_PER_MILLION_USD = [("gpt-4o-mini", 0.150, 0.600)]
INFRA_DIAGNOSIS = "Target EMR job never started (Step Functions task failure, not a Spark job failure)"
PATTERN_CUT = 300

DIAGNOSIS_FIELDS = T.StructType(
    [
        T.StructField("root_cause", T.StringType()),
        T.StructField("classification", T.StringType()),
        T.StructField("fix_suggestion", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("fix_key", T.StringType()),
        T.StructField("fix_value", T.StringType()),
        T.StructField("is_mitigation", T.StringType()),
    ]
)


#: Up to so many rules are literals of one JVM expression; more go through the literal automaton.
FEW_RULES = 64


def first_rule(text: Column, rules: Sequence) -> Column:
    """The lowest rule_no whose pattern is found in ``text``; rules are (rule_no, pattern) rows."""
    found = [F.when(text.rlike(PY_SEARCH_FLAGS + py_to_java_regex(r["pattern"])), F.lit(r["rule_no"])) for r in sorted(rules, key=lambda r: r["rule_no"])]
    return F.coalesce(*found, F.lit(None).cast("int"))


def match_rules(
    texts: DataFrame, rules: DataFrame, keys: Sequence[str], text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """L3: the first rule (lowest ``rule_no``) whose pattern is found in the text.

    Case-insensitive search with Python-like ``.`` (stops at "\\n" only).
    Returns keys + ``carry`` columns + rule columns (null when no rule matched).
    The rule list is configuration. Up to ``FEW_RULES`` patterns become
    literals of one expression; more are searched behind an automaton over the
    literals that their matches must hold, in blocks of bounded size.
    """
    keys = list(keys) + list(carry)
    rule_cols = [c for c in rules.columns if c != "rule_no"]
    few = rules.select("rule_no", "pattern").limit(FEW_RULES + 1).collect()
    if len(few) <= FEW_RULES:
        hit = texts.select(*keys, first_rule(F.col(text_col), few).alias("rule_no"))
    else:
        hit = first_rules(texts.select(*keys, F.col(text_col).alias("text")), rules)
    return hit.join(rules, "rule_no", "left").select(*keys, F.col("rule_no").cast(rules.schema["rule_no"].dataType).alias("rule_no"), *rule_cols)


def match_rules_lines(lines: DataFrame, rules: DataFrame, key: str = "log_id") -> DataFrame:
    """L3 over whole logs given as lines (log_id, line_no, line): the first rule found anywhere in a log.

    Same result as :func:`match_rules` on the lines joined by line breaks, and
    no group holds a whole log. Few rules that match within a line are one
    expression per line, and the smallest rule number of a log is one partial
    aggregate; more rules, and rules whose matches may cross lines, go through
    :mod:`~driftcheck.operators.rule_search`.
    """
    few = rules.select("rule_no", "pattern").limit(FEW_RULES + 1).collect()
    rule_cols = [c for c in rules.columns if c != "rule_no"]
    none = F.lit(None).cast("long")
    if len(few) <= FEW_RULES:
        shapes = {r["rule_no"]: shape(r["pattern"]) for r in few}
        within = [r for r in few if not shapes[r["rule_no"]].breaks and not shapes[r["rule_no"]].special]
        parts = F.transform(F.split(F.coalesce("line", F.lit("")), "\n"), lambda x: first_rule(x, within))
        best = lines.select(key, F.array_min(parts).cast("long").alias("rule_no"))
        rest = rules.where(~F.col("rule_no").isin([r["rule_no"] for r in within])) if len(within) < len(few) else None
    else:
        best, rest = lines.select(key, none.alias("rule_no")), rules
    if rest is not None:
        best = best.groupBy(key).agg(F.min("rule_no").alias("rule_no")).unionByName(first_rules_in_lines(lines, rest, key))
    best = best.groupBy(key).agg(F.min("rule_no").alias("rule_no"))
    return best.join(rules, "rule_no", "left").select(key, F.col("rule_no").cast(rules.schema["rule_no"].dataType).alias("rule_no"), *rule_cols)


def parse_diagnosis(response: Column) -> Column:
    """A stored model response (JSON text) to a diagnosis struct with defaults.

    root_cause "", classification escalate, confidence 0.0, is_mitigation
    false, other fields null. Malformed JSON gives all defaults.
    """
    return diagnosis_from_json(F.from_json(response, DIAGNOSIS_FIELDS), F.json_object_keys(response))


def parse_responses(df: DataFrame, response_col: str, out_col: str) -> DataFrame:
    """L11 over a table: the JSON text is parsed once in its own projection, then defaulted."""
    r = F.col(response_col)
    return (
        df.withColumn("__d", F.from_json(r, DIAGNOSIS_FIELDS))
        .withColumn("__k", F.json_object_keys(r))
        .withColumn(out_col, diagnosis_from_json(F.col("__d"), F.col("__k")))
        .drop("__d", "__k")
    )


def diagnosis_from_json(d: Column, keys: Column | None = None) -> Column:
    """Defaults applied to an already parsed response struct (see ``parse_diagnosis``).

    A missing key takes its default; with ``keys`` (the response's top-level
    keys) an explicit JSON null for root_cause or classification stays null,
    as ``dict.get(key, default)`` does.
    """

    def default(field: str, value: Column) -> Column:
        if keys is None:
            return F.coalesce(d[field], value)
        return F.when(F.coalesce(F.array_contains(keys, field), F.lit(False)), d[field]).otherwise(value)

    return F.struct(
        default("root_cause", F.lit("")).alias("root_cause"),
        default("classification", F.lit(DEFAULT_CLASSIFICATION)).alias("classification"),
        d["fix_suggestion"].alias("fix_suggestion"),
        F.coalesce(d["confidence"].try_cast("double"), F.lit(0.0)).alias("confidence"),
        d["fix_key"].alias("fix_key"),
        d["fix_value"].alias("fix_value"),
        py_truthy(d["is_mitigation"]).alias("is_mitigation"),
    )


def is_inconclusive(diag: Column) -> Column:
    """Escalate, or confidence below 0.5, goes to a second pass."""
    return (diag["classification"] == DEFAULT_CLASSIFICATION) | (diag["confidence"] < INCONCLUSIVE_CONFIDENCE)


def final_diagnosis(first: Column, second: Column) -> Column:
    """The second pass replaces an inconclusive first one (when it exists)."""
    return F.when(is_inconclusive(first) & second.isNotNull(), second).otherwise(first)


def analysis_result(rule_match: DataFrame, diagnoses: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Rule match first; the model diagnosis only where no rule matched.

    ``rule_match``: keys + rule columns (rule_no null = no match).
    ``diagnoses``: keys + ``diag`` struct (from parse_diagnosis / final_diagnosis).
    A model fix is never auto-applied; its fix exists only when key and value
    are both non-empty. ``carry`` columns of ``rule_match`` are passed through.
    """
    keys = list(keys)
    j = rule_match.join(diagnoses, keys, "left")
    matched = F.col("rule_no").isNotNull()
    fk, fv = F.col("diag.fix_key"), F.col("diag.fix_value")
    llm_fix = F.when((F.length(fk) > 0) & (F.length(fv) > 0), F.struct(fk.alias("key"), fv.alias("value")))
    return j.select(
        *keys,
        *carry,
        F.when(matched, "pattern_matcher").otherwise("llm").alias("source"),
        F.when(matched, F.col("diagnosis")).otherwise(F.col("diag.root_cause")).alias("diagnosis"),
        F.when(matched, F.col("action")).otherwise(F.col("diag.classification")).alias("action"),
        F.when(matched, F.col("auto_fix")).otherwise(F.lit(False)).alias("auto_fix"),
        F.when(matched, F.col("fix_config")).otherwise(llm_fix).alias("fix_config"),
        F.when(matched, F.lit(None).cast("double")).otherwise(F.col("diag.confidence")).alias("confidence"),
        F.when(~matched, F.col("diag.is_mitigation")).alias("is_mitigation"),
    )


def route(df: DataFrame, max_retries: Column | int) -> DataFrame:
    """Triage routing, first rule wins.

    Needs columns target_status, infrastructure (bool), source, auto_fix,
    retry_count. Adds phase, status, reason, new_retry_count.
    """
    mr = max_retries if isinstance(max_retries, Column) else F.lit(max_retries)
    ok = F.col("target_status") == "SUCCEEDED"
    infra = F.coalesce(F.col("infrastructure"), F.lit(False))
    fixable = F.coalesce(F.col("auto_fix"), F.lit(False))
    retry = fixable & (F.col("retry_count") < mr)
    llm = F.col("source") == "llm"
    phase = (
        F.when(ok, "VALIDATE").when(infra, "REPORT").when(retry, "RETRY").when(llm, "AWAIT_APPROVAL").otherwise("REPORT")
    )
    status = (
        F.when(ok, "RUNNING").when(infra, "FAILED").when(retry, "RUNNING").when(llm, "AWAITING_APPROVAL").otherwise("FAILED")
    )
    reason = (
        F.when(ok, F.lit(None))
        .when(infra, "emr_task_failure")
        .when(retry, F.lit(None))
        .when(llm, F.lit(None))
        .when(fixable, "max_retries_exhausted")
        .otherwise("not_auto_fixable")
    ).cast("string")
    new_retry = F.when(~ok & ~infra & retry, F.col("retry_count") + 1).otherwise(F.col("retry_count"))
    return df.withColumn("phase", phase).withColumn("status", status).withColumn("reason", reason).withColumn(
        "new_retry_count", new_retry
    )


# Corrective-action texts written with a routing decision.
PROPOSED_NO_FIX = "proposed: no structured fix available - review required"


def _kv(*pairs) -> Column:
    """map<string,string> of the given (key, value column) pairs whose value is not null."""
    if not pairs:
        return F.create_map().cast("map<string,string>")
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def triage_effects(routed: DataFrame, key: str = "job_id") -> tuple[DataFrame, DataFrame]:
    """L13 + R2/R3: the audit events and record updates a routing decision writes.

    ``routed`` is the output of :func:`route` with source, diagnosis,
    fix_key, fix_value, confidence (model diagnoses), second_pass and the
    first-pass confidence (``trigger_confidence``), and optionally the
    translated ``target_status``, which is recorded whatever the route. The
    model call's columns (model, prompt_tokens, completion_tokens,
    estimated_cost_usd, tools_used) go into its events where they are given. Returns
    (events: key, event_no, event, details map) and
    (changes: key, record_type in {metadata, pipeline}, field, value).
    """
    phase, src = F.col("phase"), F.col("source")
    analysed = phase != "VALIDATE"
    infra = src == "infrastructure"
    llm = src == "llm"
    fix_text = F.concat(F.col("fix_key"), F.lit("="), F.col("fix_value"))
    has_fix = F.col("fix_key").isNotNull() & F.col("fix_value").isNotNull()
    given = lambda c: F.col(c) if c in routed.columns else F.lit(None).cast("string")
    E = lambda name, cond, details: F.when(cond, F.struct(F.lit(name).alias("event"), details.alias("details")))
    events = F.array_compact(F.array(
        E("react_loop_started", analysed & llm & F.coalesce(F.col("second_pass"), F.lit(False)), _kv(("trigger_confidence", F.col("trigger_confidence")))),
        E("react_loop_finished", analysed & llm & F.coalesce(F.col("second_pass"), F.lit(False)), _kv(("tools_used", given("tools_used")), ("final_confidence", F.col("confidence")))),
        E("llm_call", analysed & llm, _kv(*[(c, given(c)) for c in ("model", "prompt_tokens", "completion_tokens", "estimated_cost_usd")])),
        E("failure_analyzed", analysed & ~infra, _kv(("source", src), ("diagnosis", F.col("diagnosis")))),
        E("auto_fix_applied", phase == "RETRY", _kv(("fix_key", F.col("fix_key")), ("fix_value", F.col("fix_value")), ("retry_count", F.col("new_retry_count")))),
        E("awaiting_approval", phase == "AWAIT_APPROVAL", _kv(("confidence", F.col("confidence")))),
        E("escalated", phase == "REPORT", _kv(("reason", F.col("reason")))),
    ))
    ev = routed.select(key, F.posexplode(events).alias("event_no", "e")).select(
        key, (F.col("event_no") + 1).alias("event_no"), F.col("e.event").alias("event"), F.col("e.details").alias("details")
    )
    C = lambda rec, field, cond, value: F.when(cond, F.struct(F.lit(rec).alias("record_type"), F.lit(field).alias("field"), value.cast("string").alias("value")))
    retry, wait, report = phase == "RETRY", phase == "AWAIT_APPROVAL", phase == "REPORT"
    # the (translated) target status is recorded first, whatever the route
    target = F.col("target_status") if "target_status" in routed.columns else F.lit(None).cast("string")
    changes = F.array_compact(F.array(
        C("pipeline", "target_status", target.isNotNull(), target),
        C("pipeline", "retry_count", retry, F.col("new_retry_count")),
        C("pipeline", "status", wait, F.lit("AWAITING_APPROVAL")),
        C("pipeline", "status", report, F.lit("FAILED")),
        C("pipeline", "diagnosis", analysed, F.col("diagnosis")),
        C("pipeline", "corrective_action", retry, F.concat(F.lit("set "), fix_text)),
        C("pipeline", "corrective_action", wait, F.when(has_fix, F.concat(F.lit("proposed: set "), fix_text)).otherwise(F.lit(PROPOSED_NO_FIX))),
        C("pipeline", "error_message", report, F.col("diagnosis")),
        C("metadata", "phase", F.lit(True), F.when(retry, F.lit("EXECUTE")).otherwise(phase)),
        C("metadata", "status", wait | report, F.col("status")),
    ))
    ch = routed.select(key, F.explode(changes).alias("c")).select(key, "c.record_type", "c.field", "c.value")
    return ev, ch


# Fixed values written by the approval decisions.
APPROVAL_REJECTED_MESSAGE = "Approval rejected by human"
APPROVAL_DEFAULT_DIAGNOSIS = "Human rejected the proposed LLM fix"
HUMAN_FIX_ACTION = "human-provided fix pushed directly to the target branch"


def approval_effects(decisions: DataFrame, key: str = "run_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Record updates and events written by a human decision on a pending fix.

    ``decisions``: key, decision (approve | retry_with_human_fix | reject),
    fix_key, fix_value, retry_count, diagnosis. Returns (outcomes: key,
    outcome), (events: key, event, details) and (changes: key, record_type,
    field, value). Approving a diagnosis without a structured fix is refused
    (outcome ``no_structured_fix``, nothing written); an unknown decision is
    ``invalid_decision``. Clearing the pending-approval fields writes
    explicit nulls, which the change-log fold keeps.
    """
    d = F.col("decision")
    has_fix = F.col("fix_key").isNotNull() & F.col("fix_value").isNotNull()
    approve = (d == "approve") & has_fix
    human = d == "retry_with_human_fix"
    reject = d == "reject"
    outcome = (
        F.when(approve, "approved").when((d == "approve") & ~has_fix, "no_structured_fix")
        .when(human, "retrying_with_human_fix").when(reject, "rejected").otherwise("invalid_decision")
    )
    new_retry = (F.col("retry_count") + 1).cast("string")
    fix_text = F.concat(F.col("fix_key"), F.lit("="), F.col("fix_value"))
    E = lambda name, cond, details: F.when(cond, F.struct(F.lit(name).alias("event"), details.alias("details")))
    events = F.array_compact(F.array(
        E("approval_approved", approve, _kv(("fix_key", F.col("fix_key")), ("fix_value", F.col("fix_value")))),
        E("retry_with_human_fix", human, _kv(("retry_count", new_retry))),
        E("approval_rejected", reject, _kv()),
    ))
    C = lambda rec, field, cond, value: F.when(cond, F.struct(F.lit(rec).alias("record_type"), F.lit(field).alias("field"), value.cast("string").alias("value")))
    resume = approve | human
    null = F.lit(None).cast("string")
    changes = F.array_compact(F.array(
        C("pipeline", "status", resume, F.lit("RUNNING")),
        C("pipeline", "retry_count", resume, new_retry),
        C("pipeline", "corrective_action", approve, F.concat(F.lit("approved: set "), fix_text)),
        C("pipeline", "corrective_action", human, F.lit(HUMAN_FIX_ACTION)),
        C("pipeline", "status", reject, F.lit("FAILED")),
        C("pipeline", "diagnosis", reject, F.coalesce(F.col("diagnosis"), F.lit(APPROVAL_DEFAULT_DIAGNOSIS))),
        C("pipeline", "error_message", reject, F.lit(APPROVAL_REJECTED_MESSAGE)),
        C("metadata", "phase", resume, F.lit("EXECUTE")),
        C("metadata", "phase", reject, F.lit("REPORT")),
        C("metadata", "status", resume, F.lit("RUNNING")),
        C("metadata", "status", reject, F.lit("FAILED")),
        C("metadata", "pending_approval_task_token", resume | reject, null),
        C("metadata", "pending_approval_state", resume | reject, null),
        C("metadata", "approved_llm_fix", approve, F.lit("true")),
    ))
    out = decisions.select(key, outcome.alias("outcome"))
    ev = decisions.select(key, F.explode(events).alias("e")).select(key, "e.event", "e.details")
    ch = decisions.select(key, F.explode(changes).alias("c")).select(key, "c.record_type", "c.field", "c.value")
    return out, ev, ch


def price_table(spark) -> DataFrame:
    return spark.createDataFrame(PRICES_PER_MILLION_USD, "model string, prompt_usd_per_m double, completion_usd_per_m double")


def token_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """(prompt x prompt price + completion x completion price) / 1e6; 0 for an unknown model.

    The price list is a fixed handful of models, broadcast.
    """
    j = calls.join(broadcast_if_small(prices), "model", "left")
    cost = (
        F.col("prompt_tokens") * F.col("prompt_usd_per_m") + F.col("completion_tokens") * F.col("completion_usd_per_m")
    ) / F.lit(1_000_000.0)
    return j.withColumn("estimated_cost_usd", F.coalesce(cost, F.lit(0.0))).drop("prompt_usd_per_m", "completion_usd_per_m")


def usage_rollup(calls: DataFrame, runs: DataFrame, key: str = "run_id") -> DataFrame:
    """Per run count and sums of the model calls; null totals for runs without calls.

    The per-call list stays a relation (the calls table keyed by run), so no
    run's calls are gathered into one row.
    """
    agg = calls.groupBy(key).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("prompt_tokens").alias("total_prompt_tokens"),
        F.sum("completion_tokens").alias("total_completion_tokens"),
        F.sum("estimated_cost_usd").alias("total_estimated_cost_usd"),
    )
    return runs.select(key).join(agg, key, "left")


def investigation_totals(tool_calls: DataFrame, key: str = "run_id") -> DataFrame:
    """Per run tool-call count, token sums and the tools used by first use.

    ``tools_used`` lists each distinct tool once, ordered by its first call
    (bounded by the tool vocabulary); the full call sequence is
    :func:`investigation_calls`.
    """
    per_tool = tool_calls.groupBy(key, "tool").agg(
        F.min("seq").alias("first_seq"),
        F.count(F.lit(1)).alias("n"),
        F.sum("prompt_tokens").alias("p"),
        F.sum("completion_tokens").alias("c"),
    )
    # one pass over the calls; the second aggregate reads the (run, tool) rows only
    return per_tool.groupBy(key).agg(
        F.sum("n").alias("n_tool_calls"),
        F.sum("p").alias("total_prompt_tokens"),
        F.sum("c").alias("total_completion_tokens"),
        F.transform(F.array_sort(F.collect_list(F.struct("first_seq", "tool"))), lambda x: x["tool"]).alias("tools_used"),
    )


#: Calls in one row of a run's call sequence.
CALLS_CHUNK = 1000


def investigation_calls(tool_calls: DataFrame, key: str = "run_id", size: int = CALLS_CHUNK) -> DataFrame:
    """The tools of each run in the order of their calls, repeats included: (run_id, chunk_no, tools).

    ``size`` calls to a row, chunks from 0; equal ``seq`` go by tool name. Calls are numbered
    within their run without a task for a run (``functions/sequence.py``), so a run with a third
    of all calls is many rows in many tasks.
    """
    return chunked(tool_calls.select(key, "seq", "tool"), key, ["seq", "tool"], F.col("tool"), size).withColumnRenamed("items", "tools")


def proposed_rules(
    approved: DataFrame, cut: int = PATTERN_CUT, drop_dangling: bool = False, pattern_from: str = "diagnosis"
) -> DataFrame:
    """Rules proposed from approved model fixes.

    ``approved`` holds runs whose status is PASSED/SUCCEEDED with an approved
    fix (fix_key, fix_value) and a diagnosis. The pattern is the escaped
    diagnosis cut to ``cut`` characters; action config_fix, auto_fix true.

    The original escapes the diagnosis although rules are searched in log
    text, so such a rule only fires when a log repeats the diagnosis.
    ``pattern_from`` may name another text column instead (for example the
    first exception line of the run's log, from ``exception_block``), and
    ``drop_dangling`` removes a backslash left dangling by the cut.
    """
    ok = (
        F.col("status").isin("PASSED", "SUCCEEDED")
        & F.coalesce(F.col("approved_llm_fix"), F.lit(False))
        & F.col("fix_key").isNotNull()
        & F.col("fix_value").isNotNull()
        & (F.length("diagnosis") > 0)
    )
    pat = F.substring(py_re_escape(F.col(pattern_from)), 1, cut)
    if drop_dangling:
        pat = drop_dangling_backslash(pat)
    return approved.filter(ok).select(
        pat.alias("pattern"),
        F.col("diagnosis"),
        F.lit("config_fix").alias("action"),
        F.lit(True).alias("auto_fix"),
        F.struct(F.col("fix_key").alias("key"), F.col("fix_value").alias("value")).alias("fix_config"),
        F.col("first_seen"),
    )


def append_rules(rules: DataFrame, proposals: DataFrame) -> DataFrame:
    """Append distinct new patterns after the existing rules, numbered by first proposal.

    Proposals whose pattern already exists are dropped. New rules are
    numbered densely after the current maximum by (first proposal, pattern)
    with a distributed numbering (no single-partition window).
    """
    fresh = (
        proposals.groupBy("pattern")
        .agg(F.min_by(F.struct("diagnosis", "action", "auto_fix", "fix_config"), F.col("first_seen")).alias("r"), F.min("first_seen").alias("first_seen"))
        .join(rules.select("pattern"), "pattern", "left_anti")
    )
    base = rules.agg(F.max("rule_no")).first()[0] or 0  # one number from the rule table
    numbered = dense_number(fresh, ["first_seen", "pattern"], start=base + 1, name="rule_no")
    new = numbered.select(
        F.col("rule_no").cast("int").alias("rule_no"),
        "pattern",
        F.col("r.diagnosis").alias("diagnosis"),
        F.col("r.action").alias("action"),
        F.col("r.auto_fix").alias("auto_fix"),
        F.col("r.fix_config").alias("fix_config"),
    )
    return rules.unionByName(new)


def score_diagnoses(cases: DataFrame, diagnoses: DataFrame, key: str = "case_id") -> DataFrame:
    """Per case pass/fail against the golden expectation.

    Pass when the classification is accepted, confidence within the optional
    bounds; when a fix is expected both fix key and value are present,
    otherwise a config_fix must not carry a fix key.
    """
    j = cases.join(diagnoses, key)
    fix_check = F.when(
        F.col("expect_fix_config"), F.col("fix_key").isNotNull() & F.col("fix_value").isNotNull()
    ).otherwise((F.col("classification") != "config_fix") | F.col("fix_key").isNull())
    ok = (
        F.array_contains("acceptable_classifications", F.col("classification"))
        & (F.col("min_confidence").isNull() | (F.col("confidence") >= F.col("min_confidence")))
        & (F.col("max_confidence").isNull() | (F.col("confidence") <= F.col("max_confidence")))
        & fix_check
    )
    return j.withColumn("passed", F.coalesce(ok, F.lit(False)))
