"""Configuration maps and run-state operators."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from driftcheck.operators import confmap as C
from driftcheck.operators import runstate as R

MAPS = "m map<string,string>, b map<string,string>, v string"


def test_effective_conf(spark):
    df = spark.createDataFrame(
        [({"spark.master": "local[*]", "a": "1"}, {"a": "2", "c": "3"}, "4.0.0"),
         ({"spark.master": "local[*]", "a": "1"}, None, "3.5.4"),
         ({"a": "1"}, {"spark.sql.ansi.enabled": "false"}, "4.0.1")],
        MAPS,
    )
    got = [r[0] for r in df.select(C.conf_text(C.effective_conf("m", "b", "v"))).collect()]
    assert got == ["a=2;c=3;spark.sql.ansi.enabled=true", "a=1", "a=1;spark.sql.ansi.enabled=false"]


def test_set_key_creates_map(spark):
    df = spark.createDataFrame([(None,), ({"x": "1", "k": "old"},)], "m map<string,string>")
    got = [r[0] for r in df.select(C.conf_text(C.set_key("m", F.lit("k"), F.lit("new")))).collect()]
    assert got == ["k=new", "k=new;x=1"]


def test_text_changes_in_order(spark):
    changes = F.array(F.struct(F.lit("k").alias("key"), F.lit("3.5.4").alias("from_value"), F.lit("4.0.0").alias("to_value")),
                      F.struct(F.lit("k").alias("key"), F.lit("4.0").alias("from_value"), F.lit("X").alias("to_value")))
    got = spark.createDataFrame([("spark_version: 3.5.4 # 3.5.4",)], "t string").select(C.apply_changes(F.col("t"), changes)).first()[0]
    assert got == "spark_version: 3.5.4 # 3.5.4".replace("3.5.4", "4.0.0").replace("4.0", "X")


def test_manifest_errors(spark):
    good = ('{"test": {"name": "n", "description": "d", "owner": "o"}, "source_control": {"owner": "o", "repo": "r", '
            '"baseline": {"branch": "main"}, "target": {"branch_prefix": "p"}, "pr": {"auto_merge": false}}, '
            '"pipeline": {"id": "p", "entry_script": "s"}, "execution": {"output_base": "o", "baseline_spark_version": "3", '
            '"target_spark_version": "4", "timeouts": {"single_pipeline_seconds": 1}}, "log_analysis": {"known_failure_patterns": '
            '[{"pattern": "p", "diagnosis": "d", "action": "config_fix", "auto_fix": true}], "retry": {"max_retries": 1, "backoff_seconds": 1}}, '
            '"validation": {"checks": [{"name": "x", "type": "exact", "severity": "critical"}]}, "reporting": {"output_dir": "r"}, '
            '"upgrade_strategy": {"type": "t", "version_mapping": {"baseline": {}, "target": {}}}}')
    bad = good.replace('"auto_merge": false', '"auto_merge": true').replace('"owner": "o"}, "source', '"x": 1}, "source').replace('"action": "config_fix"', '"action": "nope"')
    gitlab = good.replace('"source_control": {', '"source_control": {"provider": "gitlab", ')
    df = spark.createDataFrame([(good,), (bad,), ("{}",), (gitlab,)], "t string")
    got = [r[0] for r in df.select(C.manifest_errors(F.from_json("t", C.MANIFEST_SCHEMA))).collect()]
    assert got[0] is None
    assert got[3] == "source_control.provider: Input should be 'github'"
    assert got[1] == ("test.owner: Field required; source_control.pr.auto_merge: Input should be False; "
                      "log_analysis.known_failure_patterns.0.action: Input should be 'config_fix', 'code_change' or 'escalate'")
    assert got[2].startswith("test: Field required; source_control: Field required")


CHG = "run_id string, record_type string, field string, value string, ts timestamp, seq long"


def t(s):
    return datetime(2024, 1, 1) + timedelta(seconds=s)


def test_partial_updates_and_explicit_null(spark):
    rows = [("r", "p", "status", "RUNNING", t(0), 1), ("r", "p", "diagnosis", "x", t(1), 2),
            ("r", "p", "status", "FAILED", t(2), 3), ("r", "p", "diagnosis", None, t(3), 4)]
    got = {r["field"]: r["value"] for r in R.fold_changes(spark.createDataFrame(rows, CHG)).collect()}
    assert got == {"status": "FAILED", "diagnosis": None}


def test_concurrent_field_writes_survive(spark):
    rows = [("r", "p", f"f{i}", str(i), t(0), i) for i in range(10)]
    folded = R.fold_changes(spark.createDataFrame(rows, CHG).repartition(5))
    assert {r["field"]: r["value"] for r in folded.collect()} == {f"f{i}": str(i) for i in range(10)}


def test_fold_independent_of_partitioning(spark):
    rows = [("r", "p", "s", str(i), t(i % 7), i) for i in range(50)]
    df = spark.createDataFrame(rows, CHG)
    a = R.fold_changes(df.repartition(1)).collect()
    b = R.fold_changes(df.repartition(9, "seq")).collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]


def test_recent_runs_limit_and_missing_last(spark):
    rows = [(f"r{i}", f"2024-01-{i + 1:02d}T00:00:00+00:00") for i in range(25)] + [("rx", None)]
    got = R.recent_runs(spark.createDataFrame(rows, "run_id string, created_at string")).collect()
    assert len(got) == 20 and got[0]["run_id"] == "r24" and "rx" not in [r["run_id"] for r in got]


def test_pipeline_records_only(spark):
    df = spark.createDataFrame([("r", "_metadata"), ("r", "pipe"), ("r", "event#2024#ab")], "run_id string, record_type string")
    assert [r["record_type"] for r in R.pipeline_records(df).collect()] == ["pipe"]


def test_duration_text(spark):
    cases = [("2024-01-01T00:00:00+00:00", "2024-01-01T01:02:03.9+00:00"), ("2024-01-01T00:00:00+00:00", "2024-01-02T00:00:05+00:00"),
             ("2024-01-01T00:00:00+00:00", "2024-01-04T00:00:00+00:00"), ("2024-01-01T00:00:10+00:00", "2024-01-01T00:00:00+00:00"),
             ("", "2024-01-01T00:00:00+00:00"), ("not a date", "2024-01-01T00:00:00+00:00")]
    got = [r[0] for r in spark.createDataFrame(cases, "a string, b string").select(R.duration_text(F.col("a"), F.col("b"))).collect()]
    assert got == ["1:02:03", "1 day, 0:00:05", "3 days, 0:00:00", "-1 day, 23:59:50", "-", "-"]


def test_timeline_and_history(spark):
    ev = spark.createDataFrame(
        [("r", t(1), 1, "2024", "ANALYZE", "failure_analyzed", {"diagnosis": "ansi"}),
         ("r", t(2), 2, "2024", "ANALYZE", "llm_call", {"model": "m", "prompt_tokens": "1", "completion_tokens": "2", "estimated_cost_usd": "0.0000125"}),
         ("r", t(3), 3, "2024", "ANALYZE", "escalated", {"reason": "not_auto_fixable"}),
         ("r", t(4), 4, "2024", "ANALYZE", "generic", {})],
        "run_id string, ts timestamp, seq long, timestamp string, phase string, event string, details map<string,string>",
    )
    tl = [(r["label"], r["detail"]) for r in R.timeline(ev, R.timeline_labels(spark)).orderBy("seq").collect()]
    assert tl == [("🔎 Failure analyzed", "ansi"), ("🤖 LLM call", "model=m · prompt_tokens=1 · completion_tokens=2 · cost=$0.000013"),
                  ("🚨 Escalated (no fix applied)", "not_auto_fixable")]
    runs = spark.createDataFrame([("r", "p"), ("s", "p")], "run_id string, pipeline_id string")
    h = {r["run_id"]: r["history"] for r in R.run_history(ev, runs).collect()}
    assert h["r"] == "ANALYZE/failure_analyzed: ansi\nANALYZE/escalated: not_auto_fixable"
    assert h["s"] == "No prior failure/fix events found for run s (pipeline p)."


def test_work_list_and_presence(spark):
    runs = spark.createDataFrame([("a", "SUCCEEDED"), ("b", "FAILED")], "run_id string, bs string")
    wl = sorted(tuple(r) for r in R.work_list(runs, "bs").select("run_id", "variant").collect())
    assert wl == [("a", "target"), ("b", "baseline"), ("b", "target")]
    exp = spark.createDataFrame([("a", 0, "main", "f"), ("a", 1, "t", "f"), ("b", 0, "main", "f"), ("b", 1, "t", "f")], "run_id string, branch_rank int, branch string, file string")
    lst = spark.createDataFrame([("a", "main", "f"), ("a", "t", "f"), ("b", "t", "f")], "run_id string, branch string, file string")
    got = {r["run_id"]: (r["ok"], r["missing_branch"]) for r in R.presence_check(exp, lst).collect()}
    assert got == {"a": (True, None), "b": (False, "main")}


def test_strict_lookup(spark):
    import pytest

    state = spark.createDataFrame([("r", "_metadata", "RUNNING")], "run_id string, record_type string, status string")
    ok = spark.createDataFrame([("r", "_metadata")], "run_id string, record_type string")
    assert R.lookup(state, ok, strict=True).first()["status"] == "RUNNING"
    bad = spark.createDataFrame([("r", "_metadata"), ("x", "p")], "run_id string, record_type string")
    with pytest.raises(KeyError, match="run_id='x' record_type='p'"):
        R.lookup(state, bad, strict=True)


# --- cases replayed from the original handler and report tests --------------------------

MANIFEST_CONF = {"spark.master": "local[*]", "spark.sql.shuffle.partitions": "4"}


def test_effective_conf_original_cases(spark):
    df = spark.createDataFrame(
        [(1, MANIFEST_CONF, {"spark.sql.ansi.enabled": "false"}, "4.0.0"),
         (2, MANIFEST_CONF, {}, "3.5.4"),
         (3, MANIFEST_CONF, {}, "4.0.0")],
        "i int, m map<string,string>, b map<string,string>, v string",
    )
    got = {r["i"]: r["e"] for r in df.select("i", C.effective_conf("m", "b", "v").alias("e")).collect()}
    assert got[1]["spark.sql.ansi.enabled"] == "false"  # branch wins
    assert "spark.master" not in got[2]  # stripped
    assert got[3]["spark.sql.ansi.enabled"] == "true"  # injected for 4.x
    assert "spark.sql.ansi.enabled" not in got[2]  # not for 3.5


def test_report_rows_original_cases(spark):
    rows = [(1, "PASSED", 1, None, None, None), (2, "FAILED", 0, True, False, "Spark 4.0 migrated from javax.servlet to jakarta.servlet")]
    df = spark.createDataFrame(rows, "i int, status string, retry_count int, has_analysis boolean, auto_fix boolean, diagnosis string")
    got = {
        r["i"]: (r["s"], r["rec"])
        for r in df.select(
            "i",
            R.executive_summary(F.col("status"), F.col("retry_count")).alias("s"),
            R.recommendations(F.col("status"), F.coalesce("has_analysis", F.lit(False)), F.col("auto_fix"), F.col("diagnosis")).alias("rec"),
        ).collect()
    }
    assert got[1][0] == R.SUMMARY_PASSED_RETRY.replace("{n}", "1") and got[1][1] == []
    assert got[2][0] == R.SUMMARY_FAILED
    assert got[2][1] == [R.RECOMMEND_MANUAL, "Diagnosis: Spark 4.0 migrated from javax.servlet to jakarta.servlet"]


def test_rule_table_shape(spark):
    from driftcheck.sources.specs import rules_table

    rules = rules_table(spark).orderBy("rule_no").collect()
    assert len(rules) == 4 and sum(r["auto_fix"] for r in rules) == 3
    assert rules[0]["fix_config"]["key"] == "spark.sql.ansi.enabled" and rules[3]["fix_config"] is None


def test_events_in_order_and_snapshot_and_defaults(spark):
    ev = spark.createDataFrame(
        [("r", t(5), 2, "b"), ("r", t(5), 1, "a"), ("r", t(1), 9, "first"), ("s", t(0), 3, "other")],
        "run_id string, ts timestamp, seq long, event string",
    )
    assert [r["event"] for r in R.events_in_order(ev).filter("run_id = 'r'").collect()] == ["first", "a", "b"]
    meta = spark.createDataFrame([("r", "RUNNING", "BRANCH", None), ("s", None, None, None)], "run_id string, status string, phase string, created_at string")
    pipes = spark.createDataFrame([("r", "p2", None), ("r", "p1", "FAILED")], "run_id string, pipeline_id string, status string")
    snap = {x["run_id"]: x for x in R.snapshot(meta, pipes, ev).collect()}
    assert [p["pipeline_id"] for p in snap["r"]["pipelines"]] == ["p1", "p2"] and snap["r"]["n_events"] == 3
    assert snap["s"]["pipelines"] == [] and snap["s"]["n_events"] == 1
    table = {x["pipeline"]: x for x in R.pipeline_status_table(pipes).collect()}
    assert (table["p2"]["baseline"], table["p2"]["retries"], table["p2"]["validation"], table["p2"]["status"]) == ("PENDING", "0", "-", "PENDING")
    summ = {x["run_id"]: x for x in R.run_summary(meta).collect()}
    assert (summ["s"]["overall_status"], summ["s"]["phase"], summ["s"]["started"], summ["s"]["duration"]) == ("UNKNOWN", "UNKNOWN", "-", "-")


def test_manifest_type_errors(spark):
    import json as _json

    good = {
        "test": {"name": "n", "description": "d", "owner": "o"},
        "source_control": {"owner": "o", "repo": "r", "baseline": {"branch": "main"}, "target": {"branch_prefix": "p"}, "pr": {"auto_merge": False}},
        "pipeline": {"id": "p", "entry_script": "s"},
        "execution": {"output_base": "o", "baseline_spark_version": "3", "target_spark_version": "4", "timeouts": {"single_pipeline_seconds": 300}},
        "log_analysis": {"known_failure_patterns": [{"pattern": "p", "diagnosis": "d", "action": "config_fix", "auto_fix": True}],
                         "retry": {"max_retries": 2, "backoff_seconds": 5}},
        "validation": {"checks": [{"name": "x", "type": "exact", "severity": "critical"}]},
        "reporting": {"output_dir": "r"},
        "upgrade_strategy": {"type": "t", "version_mapping": {"baseline": {}, "target": {}}},
    }

    def variant(path, value):
        m = _json.loads(_json.dumps(good))
        node = m
        keys = path.split(".")
        for k in keys[:-1]:
            node = node[int(k)] if k.isdigit() else node[k]
        node[keys[-1]] = value
        return _json.dumps(m)

    cases = [
        (_json.dumps(good), None),
        (variant("execution.timeouts.single_pipeline_seconds", "abc"), "execution.timeouts.single_pipeline_seconds: " + C.MSG_INT_PARSE),
        (variant("execution.timeouts.single_pipeline_seconds", " 30 "), None),
        (variant("log_analysis.retry.max_retries", 1.5), "log_analysis.retry.max_retries: " + C.MSG_INT_FRACTION),
        (variant("log_analysis.retry.backoff_seconds", True), None),
        (variant("log_analysis.retry.backoff_seconds", [1]), "log_analysis.retry.backoff_seconds: " + C.MSG_INT),
        (variant("test.owner", 7), "test.owner: " + C.MSG_STR),
        (variant("test.name", None), "test.name: " + C.MSG_STR),
        (variant("log_analysis.known_failure_patterns.0.auto_fix", "maybe"), "log_analysis.known_failure_patterns.0.auto_fix: " + C.MSG_BOOL_PARSE),
        (variant("log_analysis.known_failure_patterns.0.auto_fix", "YES"), None),
        (variant("log_analysis.known_failure_patterns.0.auto_fix", 0.5), "log_analysis.known_failure_patterns.0.auto_fix: " + C.MSG_BOOL),
        (variant("validation.checks.0.name", 3), "validation.checks.0.name: " + C.MSG_STR),
        (variant("source_control.pr.auto_create", "nope"), "source_control.pr.auto_create: " + C.MSG_BOOL_PARSE),
        (variant("log_analysis.known_failure_patterns.0.action", 1), "log_analysis.known_failure_patterns.0.action: " + C.MSG_ACTION),
        # sections, nested objects, lists and their elements of another type; nothing below them is reported
        (variant("test", "text"), "test: " + C.MSG_MODEL.format("TestInfo")),
        (variant("test", None), "test: " + C.MSG_MODEL.format("TestInfo")),
        (variant("validation", [1, 2]), "validation: " + C.MSG_MODEL.format("ValidationConfig")),
        (variant("execution.timeouts", 300), "execution.timeouts: " + C.MSG_MODEL.format("TimeoutConfig")),
        (variant("validation.checks", {"name": "x"}), "validation.checks: " + C.MSG_LIST),
        (variant("validation.checks", ["row_count"]), "validation.checks.0: " + C.MSG_MODEL.format("ValidationCheck")),
        (variant("validation.checks.0.config", 1), "validation.checks.0.config: " + C.MSG_OBJECT),
        (variant("validation.checks.0.config", {"tolerance": [1, {}]}), None),
        (variant("upgrade_strategy.version_mapping.target", "4.0.0"), "upgrade_strategy.version_mapping.target: " + C.MSG_OBJECT),
        (variant("upgrade_strategy.version_mapping.target", {"spark": "4", "java": 17}), "upgrade_strategy.version_mapping.target.java: " + C.MSG_STR),
        (variant("pipeline.spark_config", {"a": None, "b": "x"}), "pipeline.spark_config.a: " + C.MSG_STR),
        (variant("source_control.pr.reviewers", ["x", 2, None]), f"source_control.pr.reviewers.1: {C.MSG_STR}; source_control.pr.reviewers.2: {C.MSG_STR}"),
        (variant("source_control.target.modifications", [{"file": "f", "changes": [{"key": "k", "from_value": 3}]}]),
         f"source_control.target.modifications.0.changes.0.from_value: {C.MSG_STR}; source_control.target.modifications.0.changes.0.to_value: {C.MSG_REQUIRED}"),
        (variant("log_analysis.known_failure_patterns.0.fix_config", None), None),
        (variant("log_analysis.known_failure_patterns.0.fix_config", {"key": "k"}), f"log_analysis.known_failure_patterns.0.fix_config.value: {C.MSG_REQUIRED}"),
        (variant("source_control.pr.auto_merge", "false"), "source_control.pr.auto_merge: " + C.MSG_FALSE),
        ("[1]", ": " + C.MSG_MODEL.format("TestManifest")),
        ("no json", "; ".join(f"{s}: {C.MSG_REQUIRED}" for s in good)),
        (None, "; ".join(f"{s}: {C.MSG_REQUIRED}" for s in good)),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["errors"] for r in C.parse_manifests(df, "t").collect()}
    assert got == {i: e for i, (_, e) in enumerate(cases)}


def test_manifests_of_a_small_file_are_walked_by_many_tasks(spark, tmp_path):
    """One file of few bytes is many manifests: they are dealt to all cores, and no field is searched from the root."""
    import io
    from contextlib import redirect_stdout

    from driftcheck.plans import conf_plans

    rows = [(i, "BUILDING" if i % 2 else "MACHINERY", i % 25, float(i - 20)) for i in range(40)]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string, c_nationkey int, c_acctbal double").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    checked = conf_plans.q_manifest_check(spark, str(tmp_path))
    got = {r["manifest_id"]: r["errors"] for r in checked.collect()}
    assert len(got) == 40 and got[1] == "; ".join([f"test.owner: {C.MSG_REQUIRED}", f"log_analysis.known_failure_patterns.1.action: {C.MSG_ACTION}", f"validation.checks.0.severity: {C.MSG_SEVERITY}"])
    assert checked.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    out = io.StringIO()
    with redirect_stdout(out):
        checked.explain("extended")
    assert "$.test" not in out.getvalue()
