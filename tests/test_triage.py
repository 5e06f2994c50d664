"""Rule matching, diagnosis parsing, routing, cost, rule growth and scoring."""

import re

import pytest
from pyspark.sql import functions as F

from driftcheck.functions.text import py_re_escape
from driftcheck.operators import triage as TR
from driftcheck.sources.specs import rules_table

ANSI_LOG = (
    "INFO SparkContext: Running Spark version 4.0.0\n"
    "org.apache.spark.SparkArithmeticException: [DIVIDE_BY_ZERO] Division by zero. SQLSTATE: 22012\n"
    "\tat org.apache.spark.sql.errors.QueryExecutionErrors$.divideByZeroError"
)


def match(spark, texts, rules=None):
    df = spark.createDataFrame(list(enumerate(texts)), "log_id int, text string")
    r = rules if rules is not None else rules_table(spark)
    return {x["log_id"]: x["rule_no"] for x in TR.match_rules(df, r, ["log_id"]).collect()}


def test_first_rule_on_ansi_log_and_no_match(spark):
    got = match(spark, [ANSI_LOG, "Codec [lz4raw] is not available", "java.lang.ClassNotFoundException: javax.servlet.ServletException not found"])
    assert got == {0: 1, 1: None, 2: 4}


def test_rule_order_beats_line_order(spark):
    text = "ClassNotFoundException: javax.servlet.Filter\nArithmeticException: DIVIDE_BY_ZERO"
    assert match(spark, [text]) == {0: 1}


def test_case_insensitive_and_dot_stops_at_newline(spark):
    rules = spark.createDataFrame([(1, "alpha.*beta", "d", "escalate", False, None)], "rule_no int, pattern string, diagnosis string, action string, auto_fix boolean, fix_config struct<key:string,value:string>")
    texts = ["ALPHA and BETA", "alpha\nbeta", "alpha\rbeta"]
    got = match(spark, texts, rules)
    expected = {i: (1 if re.search("alpha.*beta", t, re.IGNORECASE) else None) for i, t in enumerate(texts)}
    assert got == expected


def test_large_rule_sets_use_chunked_joins(spark):
    many = [(i, rf"\bneedle{i}\b", "d", "escalate", False, None) for i in range(1, 200)]
    rules = spark.createDataFrame(many, "rule_no int, pattern string, diagnosis string, action string, auto_fix boolean, fix_config struct<key:string,value:string>")
    got = match(spark, ["xx needle150 and needle17 yy", "nothing"], rules)
    assert got == {0: 17, 1: None}


def test_parse_defaults(spark):
    df = spark.createDataFrame([('{"classification": "config_fix", "confidence": 0.8, "fix_key": "k", "fix_value": "v", "is_mitigation": true}',), ("{}",), ("not json",)], "r string")
    rows = df.select(TR.parse_diagnosis(F.col("r")).alias("d")).select("d.*").collect()
    assert (rows[0]["classification"], rows[0]["confidence"], rows[0]["is_mitigation"]) == ("config_fix", 0.8, True)
    for r in rows[1:]:
        assert (r["root_cause"], r["classification"], r["confidence"], r["is_mitigation"], r["fix_key"]) == ("", "escalate", 0.0, False, None)
    nul = spark.createDataFrame([('{"root_cause": null, "classification": null}',)], "r string")
    r = TR.parse_responses(nul, "r", "d").select("d.*").first()
    assert (r["root_cause"], r["classification"]) == (None, None)  # dict.get keeps an explicit null


def test_cost(spark):
    calls = spark.createDataFrame([("gpt-4o-mini", 1000, 500), ("other", 1000, 500)], "model string, prompt_tokens int, completion_tokens int")
    got = [r["estimated_cost_usd"] for r in TR.token_cost(calls, TR.price_table(spark)).orderBy("model").collect()]
    assert abs(got[0] - 0.00045) < 1e-12 and got[1] == 0.0


def test_usage_rollup_null_without_calls(spark):
    calls = spark.createDataFrame([("r1", 10, 5, 0.1), ("r1", 1, 1, 0.2)], "run_id string, prompt_tokens int, completion_tokens int, estimated_cost_usd double")
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string")
    got = {r["run_id"]: (r["count"], r["total_prompt_tokens"]) for r in TR.usage_rollup(calls, runs).collect()}
    assert got == {"r1": (2, 11), "r2": (None, None)}


def route(spark, rows):
    schema = "id int, target_status string, infrastructure boolean, source string, auto_fix boolean, retry_count int"
    out = TR.route(spark.createDataFrame(rows, schema), 2)
    return {r["id"]: (r["phase"], r["status"], r["reason"], r["new_retry_count"]) for r in out.collect()}


def test_routing(spark):
    got = route(spark, [
        (1, "SUCCEEDED", False, None, None, 0),
        (2, "FAILED", True, "infrastructure", False, 0),
        (3, "FAILED", False, "pattern_matcher", True, 0),
        (4, "FAILED", False, "pattern_matcher", True, 2),
        (5, "FAILED", False, "pattern_matcher", False, 0),
        (6, "FAILED", False, "llm", False, 0),
    ])
    assert got == {
        1: ("VALIDATE", "RUNNING", None, 0),
        2: ("REPORT", "FAILED", "emr_task_failure", 0),
        3: ("RETRY", "RUNNING", None, 1),
        4: ("REPORT", "FAILED", "max_retries_exhausted", 2),
        5: ("REPORT", "FAILED", "not_auto_fixable", 0),
        6: ("AWAIT_APPROVAL", "AWAITING_APPROVAL", None, 0),
    }


def test_model_fix_never_auto_applied(spark):
    m = spark.createDataFrame([(1, None, None, None, None, None)], "id int, rule_no int, diagnosis string, action string, auto_fix boolean, fix_config struct<key:string,value:string>")
    d = spark.createDataFrame([(1, "cause", "config_fix", 0.9, "k", "", True)], "id int, root_cause string, classification string, confidence double, fix_key string, fix_value string, is_mitigation boolean")
    d = d.select("id", F.struct("root_cause", "classification", "confidence", "fix_key", "fix_value", "is_mitigation").alias("diag"))
    r = TR.analysis_result(m, d, ["id"]).first()
    assert (r["source"], r["auto_fix"], r["fix_config"], r["is_mitigation"]) == ("llm", False, None, True)


def test_escape_equals_python(spark):
    s = "a.b*c (x) [y] {z} ^$ |?+ -&~# \t\n\r\x0b\f \\ end"
    got = spark.createDataFrame([(s,)], "d string").select(py_re_escape(F.col("d"))).first()[0]
    assert got == re.escape(s)


def test_rule_growth(spark):
    approved = spark.createDataFrame(
        [("PASSED", True, "k", "v", "Codec (lz4raw) changed", 2), ("SUCCEEDED", True, "k", "v", "Codec (lz4raw) changed", 1),
         ("FAILED", True, "k", "v", "other", 0), ("PASSED", False, "k", "v", "not approved", 0)],
        "status string, approved_llm_fix boolean, fix_key string, fix_value string, diagnosis string, first_seen long",
    )
    rules = TR.append_rules(rules_table(spark), TR.proposed_rules(approved))
    new = rules.filter("rule_no > 4").collect()
    assert [(r["rule_no"], r["pattern"], r["action"], r["auto_fix"]) for r in new] == [(5, re.escape("Codec (lz4raw) changed"), "config_fix", True)]


def test_scoring(spark):
    cases = spark.createDataFrame(
        [("a", ["config_fix"], 0.7, None, True), ("b", ["escalate"], None, 0.3, False), ("c", ["code_change"], None, None, False)],
        "case_id string, acceptable_classifications array<string>, min_confidence double, max_confidence double, expect_fix_config boolean",
    )
    diags = spark.createDataFrame(
        [("a", "config_fix", 0.9, "k", "v"), ("b", "escalate", 0.5, None, None), ("c", "code_change", 0.2, None, None)],
        "case_id string, classification string, confidence double, fix_key string, fix_value string",
    )
    got = {r["case_id"]: r["passed"] for r in TR.score_diagnoses(cases, diags).collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_dense_number_matches_row_number(spark):
    from driftcheck.functions.sequence import dense_number

    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("v"), F.col("id"))
    got = sorted((r["v"], r["id"], r["seq_no"]) for r in dense_number(df, ["v", "id"], start=10).collect())
    expected = [(v, i, 10 + n) for n, (v, i) in enumerate(sorted((r["v"], r["id"]) for r in df.collect()))]
    assert got == expected


def test_rule_growth_from_exception_line_and_dangling_backslash(spark):
    from driftcheck.functions.text import drop_dangling_backslash

    approved = spark.createDataFrame(
        [("PASSED", True, "k", "v", "diag", "java.lang.IllegalArgumentException: Codec [lz4raw] is not available", 1)],
        "status string, approved_llm_fix boolean, fix_key string, fix_value string, diagnosis string, first_line string, first_seen long",
    )
    r = TR.proposed_rules(approved, pattern_from="first_line").first()
    assert r["pattern"] == re.escape("java.lang.IllegalArgumentException: Codec [lz4raw] is not available")
    assert re.search(r["pattern"], "xx java.lang.IllegalArgumentException: Codec [lz4raw] is not available yy")
    cut = spark.createDataFrame([("ab\\\\c",), ("ab\\",), ("ab\\\\",)], "p string").select(drop_dangling_backslash(F.col("p"))).collect()
    assert [c[0] for c in cut] == ["ab\\\\c", "ab", "ab\\\\"]


def test_triage_effects(spark):
    schema = ("job_id int, source string, diagnosis string, action string, fix_key string, fix_value string, confidence double, "
              "second_pass boolean, trigger_confidence double, phase string, status string, reason string, new_retry_count int")
    rows = [(1, None, None, None, None, None, None, None, None, "VALIDATE", "RUNNING", None, 0),
            (2, "pattern_matcher", "ansi", "config_fix", "k", "v", None, False, 0.9, "RETRY", "RUNNING", None, 1),
            (3, "llm", "codec", "config_fix", None, None, 0.8, True, 0.2, "AWAIT_APPROVAL", "AWAITING_APPROVAL", None, 0),
            (4, "infrastructure", "never started", "escalate", None, None, None, None, None, "REPORT", "FAILED", "emr_task_failure", 0)]
    ev, ch = TR.triage_effects(spark.createDataFrame(rows, schema))
    events = {}
    for r in ev.orderBy("job_id", "event_no").collect():
        events.setdefault(r["job_id"], []).append(r["event"])
    assert events == {2: ["failure_analyzed", "auto_fix_applied"], 3: ["react_loop_started", "react_loop_finished", "llm_call", "failure_analyzed", "awaiting_approval"], 4: ["escalated"]}
    changes = {(r["job_id"], r["record_type"], r["field"]): r["value"] for r in ch.collect()}
    assert changes[(1, "metadata", "phase")] == "VALIDATE"
    assert changes[(2, "pipeline", "corrective_action")] == "set k=v" and changes[(2, "metadata", "phase")] == "EXECUTE"
    assert changes[(3, "pipeline", "corrective_action")] == TR.PROPOSED_NO_FIX
    assert changes[(4, "pipeline", "error_message")] == "never started" and changes[(4, "metadata", "status")] == "FAILED"


def test_approval_effects(spark):
    rows = [("a", "approve", "k", "v", 1, "d"), ("b", "approve", None, None, 0, "d"), ("c", "retry_with_human_fix", None, None, 2, "d"),
            ("d", "reject", None, None, 0, None), ("e", "snooze", None, None, 0, None)]
    out, ev, ch = TR.approval_effects(spark.createDataFrame(rows, "run_id string, decision string, fix_key string, fix_value string, retry_count int, diagnosis string"))
    assert {r["run_id"]: r["outcome"] for r in out.collect()} == {
        "a": "approved", "b": "no_structured_fix", "c": "retrying_with_human_fix", "d": "rejected", "e": "invalid_decision"}
    assert sorted((r["run_id"], r["event"]) for r in ev.collect()) == [("a", "approval_approved"), ("c", "retry_with_human_fix"), ("d", "approval_rejected")]
    chg = {(r["run_id"], r["record_type"], r["field"]): r["value"] for r in ch.collect()}
    assert chg[("a", "pipeline", "retry_count")] == "2" and chg[("a", "metadata", "approved_llm_fix")] == "true"
    assert ("a", "metadata", "pending_approval_task_token") in chg and chg[("a", "metadata", "pending_approval_task_token")] is None
    assert chg[("d", "pipeline", "diagnosis")] == TR.APPROVAL_DEFAULT_DIAGNOSIS and chg[("d", "metadata", "phase")] == "REPORT"
    assert not any(k[0] in ("b", "e") for k in chg)


def test_python_named_groups(spark):
    from driftcheck.functions.text import py_to_java_regex

    p = r"(?P<w>ab)c(?P=w)"
    assert py_to_java_regex(p) == r"(?<w>ab)c\k<w>"
    schema = "rule_no int, pattern string, diagnosis string, action string, auto_fix boolean, fix_config struct<key:string,value:string>"
    few = spark.createDataFrame([(1, p, "d", "escalate", False, None)], schema)
    many = spark.createDataFrame([(i, p if i == 100 else rf"\bzz{i}\b", "d", "escalate", False, None) for i in range(1, 101)], schema)
    texts = ["xx ABCab yy", "abcx"]
    expected = {i: (1 if re.search(p, t, re.IGNORECASE) else None) for i, t in enumerate(texts)}
    assert match(spark, texts, few) == expected
    assert match(spark, texts, many) == {i: (100 if v else None) for i, v in expected.items()}


def test_large_sparse_rule_numbers(spark):
    schema = "rule_no int, pattern string, diagnosis string, action string, auto_fix boolean, fix_config struct<key:string,value:string>"
    many = [(i * 1000003, rf"\bzz{i}\b", "d", "escalate", False, None) for i in range(1, 120)]
    rules = spark.createDataFrame(many, schema)
    got = match(spark, ["a zz7 b zz100", "none"], rules)
    assert got == {0: 7 * 1000003, 1: None}


def _numbered(n, last="needle.*here"):
    return [{"pattern": f"absent{i}", "diagnosis": "d", "action": "escalate", "auto_fix": False, "fix_config": None} for i in range(n - 1)] + [
        {"pattern": last, "diagnosis": "found", "action": "config_fix", "auto_fix": True, "fix_config": {"key": "k", "value": "v"}}]


@pytest.mark.parametrize("n", [4, 64, 65, 150])
def test_any_number_of_rules_with_null_keys(spark, n):
    """One path for every rule count; a null key or carried column keeps its rule."""
    texts = spark.createDataFrame([(None, "a needle is here", None), (1, "NEEDLE here", "c"), (2, "nothing", None)], "log_id long, text string, extra string")
    got = {(r["log_id"], r["extra"]): (r["rule_no"], r["diagnosis"]) for r in TR.match_rules(texts, rules_table(spark, _numbered(n)), ["log_id"], carry=["extra"]).collect()}
    assert got == {(None, None): (n, "found"), (1, "c"): (n, "found"), (2, None): (None, None)}


def test_rule_in_the_middle_of_a_large_log(spark):
    lines = [(7, i, "x" * 2000) for i in range(800)]
    lines[400] = (7, 400, "y ArithmeticException: divide by zero")
    lines.append((8, 0, "quiet"))
    lines.append((None, 0, "a needle or two here"))
    df = spark.createDataFrame(lines, "log_id long, line_no long, line string")
    rules = rules_table(spark, [{"pattern": "needle.*here", "diagnosis": "n", "action": "escalate"}, {"pattern": "ArithmeticException.*divide by zero", "diagnosis": "a", "action": "escalate"}])
    got = {r["log_id"]: r["rule_no"] for r in TR.match_rules_lines(df, rules).collect()}
    assert got == {7: 2, 8: None, None: 1}


def test_rules_across_lines_see_the_text(spark):
    """A pattern that can match a line break is searched in the joined text; dots never cross lines."""
    df = spark.createDataFrame([(1, 0, "first"), (1, 1, "second"), (2, 0, "first second")], "log_id long, line_no long, line string")
    rules = rules_table(spark, [{"pattern": r"first\nsecond", "diagnosis": "x", "action": "escalate"}, {"pattern": "first.second", "diagnosis": "y", "action": "escalate"}])
    got = {r["log_id"]: r["rule_no"] for r in TR.match_rules_lines(df, rules).collect()}
    assert got == {1: 1, 2: 2}


def test_investigation_calls_keep_order_and_repeats(spark):
    names = ["read_log", "read_log", "get_state", "propose_fix", None]
    rows = [("hot", i, names[i * 7 % 5]) for i in range(2500)] + [("one", 9, "grep"), (None, 2, "b"), (None, 1, "a")]
    calls = spark.createDataFrame(rows, "run_id string, seq long, tool string").repartition(4)
    got = {(r["run_id"], r["chunk_no"]): r["tools"] for r in TR.investigation_calls(calls).collect()}
    hot = [t for k, _, t in rows if k == "hot"]
    assert got == {("hot", 0): hot[:1000], ("hot", 1): hot[1000:2000], ("hot", 2): hot[2000:], ("one", 0): ["grep"], (None, 0): ["a", "b"]}
