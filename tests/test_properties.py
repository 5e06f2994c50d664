"""Property tests: operators against small pure-Python models on random inputs."""

import re
from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftcheck.functions.text import py_re_escape
from driftcheck.operators import logs as L
from driftcheck.operators import parity as P
from driftcheck.operators import runstate as R
from driftcheck.operators import triage as TR
from driftcheck.sources.logs import split_lines

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

WORDS = ["INFO", "Exception", "Traceback", "java.lang", "ok", "é", "  ", "", "\t", "x" * 7, "DIVIDE_BY_ZERO", "ArithmeticException"]
line_st = st.lists(st.sampled_from(WORDS), min_size=0, max_size=4).map(" ".join)
log_st = st.lists(line_st, min_size=1, max_size=30)


def kept_lines(df):
    """The reduced lines of each log, in order."""
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["log_id"], r["section"], r["line_no"])):
        got.setdefault(r["log_id"], []).append((r["section"], r["line_no"], r["line"]))
    return got


@settings(**SETTINGS)
@given(logs=st.lists(log_st, min_size=1, max_size=4), max_bytes=st.integers(0, 120), head=st.integers(1, 5), tail=st.integers(1, 5))
@example(logs=[["", ""]], max_bytes=0, head=1, tail=3)
def test_reduction_properties(spark, logs, max_bytes, head, tail):
    """Small logs stay whole; of others the first and last lines stay, every kept line is a line of the log, in order."""
    rows = [(i, n + 1, s) for i, lines in enumerate(logs) for n, s in enumerate(lines)]
    df = spark.createDataFrame(rows, "log_id int, line_no long, line string")
    got = kept_lines(L.reduce_log(df, max_bytes, head, tail))
    for i, lines in enumerate(logs):
        whole = len("\n".join(lines).encode()) <= max_bytes
        text = [x for _, _, x in got[i]]
        if whole:
            assert text == lines
            continue
        ends = min(head, len(lines)), min(tail, len(lines))  # a log of fewer lines has them all at both ends
        assert text[: ends[0]] == lines[: ends[0]] and text[-ends[1] :] == lines[-ends[1] :]
        assert L.TRUNCATION_MARKER in text
        body = [(sec, n, x) for sec, n, x in got[i] if sec not in (L.SECTION_SEP1, L.SECTION_SEP2)]
        assert all(lines[n - 1] == x for _, n, x in body)
        assert body == sorted(body, key=lambda r: r[:2])


@settings(**SETTINGS)
@given(logs=st.lists(log_st, min_size=1, max_size=4), max_bytes=st.integers(0, 120), head=st.integers(1, 5), tail=st.integers(1, 5))
def test_contiguous_reduction_is_the_same(spark, logs, max_bytes, head, tail):
    rows = [(i, n + 1, s) for i, lines in enumerate(logs) for n, s in enumerate(lines)]
    df = spark.createDataFrame(rows, "log_id int, line_no long, line string")
    assert kept_lines(L.reduce_log(df, max_bytes, head, tail, contiguous=True)) == kept_lines(L.reduce_log(df, max_bytes, head, tail))


@settings(**SETTINGS)
@given(texts=st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_escape_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["e"] for r in df.select("i", py_re_escape(F.col("t")).alias("e")).collect()}
    assert got == {i: re.escape(t) for i, t in enumerate(texts)}


@settings(**SETTINGS)
@given(pairs=st.lists(st.tuples(st.integers(0, 10**12), st.integers(-(10**13), 10**13)), min_size=1, max_size=20))
def test_duration_matches_python(spark, pairs):
    base = datetime(2020, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i, (a, d) in enumerate(pairs):
        s = base + timedelta(microseconds=a)
        e = s + timedelta(microseconds=d)
        rows.append((i, s.isoformat(), e.isoformat()))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    got = {r["i"]: r["d"] for r in df.select("i", R.duration_text(F.col("a"), F.col("b")).alias("d")).collect()}
    assert got == {i: str(datetime.fromisoformat(b) - datetime.fromisoformat(a)).split(".")[0] for i, a, b in rows}


@settings(**SETTINGS)
@given(lines=log_st, pattern=st.sampled_from(["exception", "INFO", "é", "x", "zz"]), k=st.integers(1, 6))
def test_grep_matches_python(spark, lines, pattern, k):
    df = spark.createDataFrame([(1, n, s) for n, s in enumerate(lines)], "log_id int, line_no long, line string")
    r = L.grep(df, pattern, k).first()
    hits = [s for s in lines if pattern.lower() in s.lower()]
    assert r["n_hits"] == len(hits)
    assert r["result"] == ("\n".join(hits[:k]) if hits else f"No lines in the log matched {pattern!r}.")


change_st = st.lists(
    st.tuples(st.sampled_from(["r1", "r2"]), st.sampled_from(["status", "phase", "diag"]), st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
              st.integers(0, 5)),
    min_size=1, max_size=30,
)


@settings(**SETTINGS)
@given(changes=change_st)
def test_fold_matches_model(spark, changes):
    rows = [(run, "p", field, value, datetime(2024, 1, 1) + timedelta(seconds=ts), seq) for seq, (run, field, value, ts) in enumerate(changes)]
    df = spark.createDataFrame(rows, "run_id string, record_type string, field string, value string, ts timestamp, seq long")
    got = {(r["run_id"], r["field"]): r["value"] for r in R.fold_changes(df).collect()}
    model = {}
    for run, rt, field, value, ts, seq in sorted(rows, key=lambda x: (x[4], x[5])):
        model[(run, field)] = value
    assert got == model


pattern_st = st.lists(st.sampled_from(["abc", "a.c", "(x|y)", "é", "DIV.*ZERO", "[0-9]+", "q?z"]), min_size=1, max_size=3).map("".join)
text_st = st.lists(st.sampled_from(["abc", "ABC", "aXc", "X", "y", "É", "div by zero", "DIV\nZERO", "123", "z", "\r"]), max_size=6).map("".join)


@settings(**SETTINGS)
@given(patterns=st.lists(pattern_st, min_size=1, max_size=4), texts=st.lists(text_st, min_size=1, max_size=8))
def test_first_rule_matches_python(spark, patterns, texts):
    rules = spark.createDataFrame(
        [(i + 1, p, "d", "escalate", False, None) for i, p in enumerate(patterns)],
        "rule_no int, pattern string, diagnosis string, action string, auto_fix boolean, fix_config struct<key:string,value:string>",
    )
    df = spark.createDataFrame(list(enumerate(texts)), "log_id int, text string")
    got = {r["log_id"]: r["rule_no"] for r in TR.match_rules(df, rules, ["log_id"]).collect()}
    model = {i: next((n + 1 for n, p in enumerate(patterns) if re.search(p, t, re.IGNORECASE)), None) for i, t in enumerate(texts)}
    assert got == model


# --- parity suite: literal cases, and properties that hold whatever the rows are ---------

PARITY_SCHEMA = "id long, x double, s string"
PARITY_CHECKS = '[{"name": "row_count_match", "severity": "critical"}, {"name": "column_level_diff", "config": {"tolerance": "%s"}}, {"name": "null_count_diff"}]'
ONE = (1, 2.0, "a")
#: (baseline rows, target rows, tolerance, row count, sums, null counts, overall)
PARITY_CASES = [
    ([], [], "0.0001", "PASSED", "PASSED", "PASSED", "PASSED"),
    ([ONE], [ONE], "0.0001", "PASSED", "PASSED", "PASSED", "PASSED"),
    ([ONE], [ONE, ONE], "0.0001", "FAILED", "WARNING", "PASSED", "FAILED"),
    ([], [ONE], "0.0001", "FAILED", "WARNING", "PASSED", "FAILED"),
    ([ONE], [], "0.0001", "FAILED", "WARNING", "PASSED", "FAILED"),
    ([(0, 0.0, "a")], [(0, 0.0, "a"), (0, None, "b")], "0.0001", "FAILED", "PASSED", "WARNING", "FAILED"),
    ([ONE], [(1, 2.0, None)], "0.0001", "PASSED", "PASSED", "WARNING", "WARNING"),
    ([ONE], [(1, None, "a")], "0.0001", "PASSED", "WARNING", "WARNING", "WARNING"),
    ([(1, 0.0, "a")], [(1, None, "a")], "0.0001", "PASSED", "PASSED", "WARNING", "WARNING"),
    ([(1, 0.0, "a")], [(1, 0.5, "a")], "1000000", "PASSED", "WARNING", "PASSED", "WARNING"),
    ([(1, 4.0, "a")], [(1, 5.0, "a")], "0.24", "PASSED", "WARNING", "PASSED", "WARNING"),
    ([(1, 4.0, "a")], [(1, 5.0, "a")], "0.25", "PASSED", "PASSED", "PASSED", "PASSED"),
    ([(1, -4.0, "a")], [(1, -5.0, "a")], "0.25", "PASSED", "PASSED", "PASSED", "PASSED"),
    ([(2, 1.0, "a"), (1, 3.0, None)], [(1, 3.0, "b"), (2, 1.0, None)], "0", "PASSED", "PASSED", "PASSED", "PASSED"),
]


def parity(spark, sides):
    """Statuses of (baseline, target, tolerance) triples, in order: (row count, sums, null counts, overall)."""
    pairs = [
        P.TablePair(str(i), spark.createDataFrame(b, PARITY_SCHEMA), spark.createDataFrame(t, PARITY_SCHEMA), checks_json=PARITY_CHECKS % tol)
        for i, (b, t, tol) in enumerate(sides)
    ]
    results, overall = P.validate(pairs)
    found = {(r["pair_id"], r["name"]): r["status"] for r in results.collect()}
    whole = {r["pair_id"]: r["overall_status"] for r in overall.collect()}
    names = ("row_count_match", "column_level_diff", "null_count_diff")
    return [(*(found[p.pair_id, n] for n in names), whole[p.pair_id]) for p in pairs]


def test_parity_cases(spark):
    assert parity(spark, [c[:3] for c in PARITY_CASES]) == [c[3:] for c in PARITY_CASES]


num_st = st.one_of(st.none(), st.integers(-5, 5).map(float))
rows_st = st.lists(st.tuples(st.integers(0, 3), num_st, st.sampled_from(["a", "b", None])), max_size=6)


@settings(**SETTINGS | dict(max_examples=3))
@given(base=rows_st, tgt=rows_st, scale=st.sampled_from([2, 8, 1024]))
def test_parity_properties(spark, base, tgt, scale):
    """A table equals itself in any order; scaled numbers judge alike; swapped sides keep counts; more tolerance never adds a warning."""
    scaled = [[(i * scale, None if x is None else x * scale, s) for i, x, s in rows] for rows in (base, tgt)]
    loose, tight = "0.5", "0.001"
    same, plain, large, swapped, wide = parity(
        spark, [(base, base[::-1], tight), (base, tgt, tight), (*scaled, tight), (tgt, base, tight), (base, tgt, loose)])
    assert same == ("PASSED",) * 4
    assert large == plain
    assert (swapped[0], swapped[2]) == (plain[0], plain[2])
    assert not (wide[1] == "WARNING" and plain[1] == "PASSED")
    assert plain[3] == ("FAILED" if plain[0] == "FAILED" else "WARNING" if "WARNING" in plain[1:3] else "PASSED")


sep_st = st.sampled_from(["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", " "])


@settings(**SETTINGS)
@given(docs=st.lists(st.lists(st.tuples(line_st, sep_st), min_size=1, max_size=20), min_size=1, max_size=4),
       max_bytes=st.integers(0, 150), head=st.integers(1, 4), tail=st.integers(1, 4))
def test_reduced_texts_follow_the_lines(spark, docs, max_bytes, head, tail):
    """A text under the limit is untouched; another is what the reduction of its split lines gives."""
    texts = ["".join(line + sep for line, sep in parts) for parts in docs]
    df = spark.createDataFrame(list(enumerate(texts)), "log_id int, text string")
    got = {r["log_id"]: r["text"] for r in L.reduce_texts(df, max_bytes, head, tail).collect()}
    cut = {i: "\n".join(x for _, _, x in rows) for i, rows in kept_lines(L.reduce_log(split_lines(df), -1, head, tail)).items()}
    assert got == {i: t if len(t.encode()) <= max_bytes else cut[i] for i, t in enumerate(texts)}


# --- row diffs, config maps and text edits vs Python models -----------------------------

from collections import Counter  # noqa: E402

from driftcheck.operators import confmap as C  # noqa: E402

small_rows = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["a", "b"]))), max_size=8)


@settings(**SETTINGS)
@given(b=small_rows, t=small_rows)
def test_multiset_diff_matches_counter(spark, b, t):
    schema = "k int, v string"
    got = Counter((r["k"], r["v"], r["diff_side"]) for r in P.multiset_diff(spark.createDataFrame(b, schema), spark.createDataFrame(t, schema), ["k", "v"]).collect())
    cb, ct = Counter(b), Counter(t)
    exp = Counter()
    for row, n in (cb - ct).items():
        exp[(row[0], row[1], "missing_in_target")] += n
    for row, n in (ct - cb).items():
        exp[(row[0], row[1], "added_in_target")] += n
    assert got == exp


@settings(**SETTINGS)
@given(b=small_rows, t=small_rows)
def test_keyed_diff_matches_model(spark, b, t):
    schema = "k int, v string"
    got = Counter((r["k"], r["diff_kind"], tuple(r["changed_cols"])) for r in P.row_diff_keyed(spark.createDataFrame(b, schema), spark.createDataFrame(t, schema), ["k"]).collect())
    exp = Counter()
    for k in {r[0] for r in b} | {r[0] for r in t}:
        rb, rt = [r for r in b if r[0] == k], [r for r in t if r[0] == k]
        if len(rb) == 1 and len(rt) == 1:
            if rb[0][1] != rt[0][1]:
                exp[(k, "changed", ("v",))] += 1
        else:
            for row, n in (Counter(rb) - Counter(rt)).items():
                exp[(k, "only_baseline", ())] += n
            for row, n in (Counter(rt) - Counter(rb)).items():
                exp[(k, "only_target", ())] += n
    assert got == exp


conf_st = st.dictionaries(st.sampled_from(["spark.master", "spark.sql.ansi.enabled", "a", "b"]), st.sampled_from(["1", "2", "true", "false"]), max_size=4)


@settings(**SETTINGS)
@given(confs=st.lists(st.tuples(conf_st, st.one_of(st.none(), conf_st), st.sampled_from(["4.0.0", "3.5.4"])), min_size=1, max_size=6))
def test_effective_conf_matches_dict_model(spark, confs):
    df = spark.createDataFrame([(i, m, b, v) for i, (m, b, v) in enumerate(confs)], "i int, m map<string,string>, b map<string,string>, v string")
    got = {r["i"]: dict(r["e"]) for r in df.select("i", C.effective_conf("m", "b", "v").alias("e")).collect()}
    exp = {}
    for i, (m, b, v) in enumerate(confs):
        e = {**m, **(b or {})}
        e.pop("spark.master", None)
        if v.startswith("4.") and "spark.sql.ansi.enabled" not in e:
            e["spark.sql.ansi.enabled"] = "true"
        exp[i] = e
    assert got == exp


@settings(**SETTINGS)
@given(texts=st.lists(st.text(alphabet="abc -", max_size=20), min_size=1, max_size=5),
       changes=st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=2), st.text(alphabet="abcX", max_size=3)), max_size=3))
def test_apply_changes_matches_replace_chain(spark, texts, changes):
    arr = F.array(*[F.struct(F.lit("k").alias("key"), F.lit(a).alias("from_value"), F.lit(b).alias("to_value")) for a, b in changes]) if changes else F.array().cast("array<struct<key:string,from_value:string,to_value:string>>")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["o"] for r in df.select("i", C.apply_changes(F.col("t"), arr).alias("o")).collect()}
    exp = {}
    for i, t in enumerate(texts):
        for a, b in changes:
            t = t.replace(a, b)
        exp[i] = t
    assert got == exp


@settings(**SETTINGS)
@given(jobs=st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="ab\n", max_size=6)), st.one_of(st.none(), st.text(alphabet="cd\n", max_size=6))), min_size=1, max_size=5))
def test_merge_stream_texts_matches_file_layout(spark, jobs):
    rows = [(i, s, t) for i, (o, e) in enumerate(jobs) for s, t in (("stdout", o), ("stderr", e)) if t is not None]
    if not rows:
        return
    df = spark.createDataFrame(rows, "log_id int, stream string, text string")
    got = {r["log_id"]: r["text"] for r in L.merge_stream_texts(df).collect()}
    exp = {}
    for i, (o, e) in enumerate(jobs):
        parts = [f"===== SPARK_DRIVER {s} =====\n{t}\n" for s, t in (("stdout", o), ("stderr", e)) if t is not None]
        if parts:
            exp[i] = "".join(parts)
    assert got == exp


@settings(**SETTINGS)
@given(values=st.lists(st.integers(-50, 50), min_size=0, max_size=60), parts=st.integers(1, 6))
def test_dense_number_matches_sorted_enumerate(spark, values, parts):
    from driftcheck.functions.sequence import dense_number

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int").repartition(parts)
    got = sorted((r["v"], r["i"], r["seq_no"]) for r in dense_number(df, ["v", "i"], start=1).collect())
    exp = [(v, i, n + 1) for n, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))]
    assert got == exp


hist_ev = st.lists(st.tuples(st.sampled_from(["failure_analyzed", "auto_fix_applied", "escalated", "awaiting_approval", "tool_call"]),
                             st.sampled_from(["", "d1", "d2"]), st.sampled_from(["", "r1"])), max_size=30)


@settings(**SETTINGS)
@given(events=hist_ev)
def test_run_history_matches_model(spark, events):
    from datetime import datetime, timedelta

    rows = [("r", datetime(2024, 1, 1) + timedelta(seconds=i), i, "ANALYZE", e, {"diagnosis": d, "reason": rr}) for i, (e, d, rr) in enumerate(events)]
    ev = spark.createDataFrame(rows, "run_id string, ts timestamp, seq long, phase string, event string, details map<string,string>")
    runs = spark.createDataFrame([("r", "p")], "run_id string, pipeline_id string")
    got = R.run_history(ev, runs).first()["history"]
    rel = [f"ANALYZE/{e}: {d or rr or ''}" for e, d, rr in events if e in R.HISTORY_EVENTS]
    assert got == ("\n".join(rel[-20:]) if rel else "No prior failure/fix events found for run r (pipeline p).")


#: (target status, infrastructure, source, auto fix, retries, allowed retries) -> (phase, status, reason, retries after)
ROUTE_CASES = [
    (("SUCCEEDED", False, "pattern_matcher", True, 1, 2), ("VALIDATE", "RUNNING", None, 1)),
    (("SUCCEEDED", True, "infrastructure", False, 0, 2), ("VALIDATE", "RUNNING", None, 0)),
    (("FAILED", True, "infrastructure", True, 0, 2), ("REPORT", "FAILED", "emr_task_failure", 0)),
    (("FAILED", False, "pattern_matcher", True, 0, 2), ("RETRY", "RUNNING", None, 1)),
    (("FAILED", False, "pattern_matcher", True, 1, 2), ("RETRY", "RUNNING", None, 2)),
    (("FAILED", False, "pattern_matcher", True, 2, 2), ("REPORT", "FAILED", "max_retries_exhausted", 2)),
    (("FAILED", False, "pattern_matcher", True, 0, 0), ("REPORT", "FAILED", "max_retries_exhausted", 0)),
    (("FAILED", False, "pattern_matcher", False, 0, 2), ("REPORT", "FAILED", "not_auto_fixable", 0)),
    (("FAILED", False, "pattern_matcher", False, 4, 2), ("REPORT", "FAILED", "not_auto_fixable", 4)),
    (("FAILED", False, "llm", False, 0, 2), ("AWAIT_APPROVAL", "AWAITING_APPROVAL", None, 0)),
    (("FAILED", False, "llm", False, 4, 2), ("AWAIT_APPROVAL", "AWAITING_APPROVAL", None, 4)),
]


def test_route_cases(spark):
    for allowed in {c[0][5] for c in ROUTE_CASES}:
        data = [(i, *c[0][:5]) for i, c in enumerate(ROUTE_CASES) if c[0][5] == allowed]
        df = spark.createDataFrame(data, "id int, target_status string, infrastructure boolean, source string, auto_fix boolean, retry_count int")
        got = {r["id"]: (r["phase"], r["status"], r["reason"], r["new_retry_count"]) for r in TR.route(df, allowed).collect()}
        assert got == {d[0]: ROUTE_CASES[d[0]][1] for d in data}


#: (job id given, cause) -> (job id, status); the status before is always FAILED.
RECOVERY_CASES = [
    ((None, '{"JobRunId": "j", "State": "CANCELLED"}'), ("j", "CANCELLED")),
    ((None, '{"JobRunId": "k", "State": "RUNNING", "x": 1}'), ("k", "RUNNING")),
    (("given", '{"JobRunId": "j", "State": "CANCELLED"}'), ("given", "FAILED")),
    ((None, '{"JobRunId": "j"}'), (None, "FAILED")),
    ((None, '{"State": "X"}'), (None, "FAILED")),
    ((None, "{}"), (None, "FAILED")),
    ((None, "not json"), (None, "FAILED")),
    ((None, "[1, 2]"), (None, "FAILED")),
    ((None, '"s"'), (None, "FAILED")),
    ((None, None), (None, "FAILED")),
    (("given", None), ("given", "FAILED")),
    (("given", "not json"), ("given", "FAILED")),
]


def test_job_id_recovery_cases(spark):
    df = spark.createDataFrame([(i, j, "FAILED", c) for i, ((j, c), _) in enumerate(RECOVERY_CASES)], "i int, job_run_id string, status string, cause string")
    got = {r["i"]: (r["job_run_id"], r["status"]) for r in L.recover_job_run_id(df).collect()}
    assert got == {i: out for i, (_, out) in enumerate(RECOVERY_CASES)}


dec_st = st.lists(st.tuples(st.sampled_from(["approve", "retry_with_human_fix", "reject", "other"]),
                            st.one_of(st.none(), st.just("k")), st.one_of(st.none(), st.just("v")), st.integers(0, 3),
                            st.one_of(st.none(), st.just("diag"))), min_size=1, max_size=10)


@settings(**SETTINGS)
@given(rows=dec_st)
def test_approval_effects_match_model(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "run_id int, decision string, fix_key string, fix_value string, retry_count int, diagnosis string")
    out, ev, ch = TR.approval_effects(df)
    got_out = {r["run_id"]: r["outcome"] for r in out.collect()}
    got_ev = sorted((r["run_id"], r["event"], tuple(sorted(r["details"].items()))) for r in ev.collect())
    got_ch = sorted((r["run_id"], r["record_type"], r["field"], r["value"]) for r in ch.collect())
    exp_out, exp_ev, exp_ch = {}, [], []
    for i, (d, k, v, rc, diag) in enumerate(rows):
        has_fix = k is not None and v is not None
        if d == "approve" and has_fix:
            exp_out[i] = "approved"
            exp_ev.append((i, "approval_approved", (("fix_key", k), ("fix_value", v))))
            exp_ch += [(i, "pipeline", "status", "RUNNING"), (i, "pipeline", "retry_count", str(rc + 1)),
                       (i, "pipeline", "corrective_action", f"approved: set {k}={v}"), (i, "metadata", "phase", "EXECUTE"),
                       (i, "metadata", "status", "RUNNING"), (i, "metadata", "pending_approval_task_token", None),
                       (i, "metadata", "pending_approval_state", None), (i, "metadata", "approved_llm_fix", "true")]
        elif d == "approve":
            exp_out[i] = "no_structured_fix"
        elif d == "retry_with_human_fix":
            exp_out[i] = "retrying_with_human_fix"
            exp_ev.append((i, "retry_with_human_fix", (("retry_count", str(rc + 1)),)))
            exp_ch += [(i, "pipeline", "status", "RUNNING"), (i, "pipeline", "retry_count", str(rc + 1)),
                       (i, "pipeline", "corrective_action", TR.HUMAN_FIX_ACTION), (i, "metadata", "phase", "EXECUTE"),
                       (i, "metadata", "status", "RUNNING"), (i, "metadata", "pending_approval_task_token", None),
                       (i, "metadata", "pending_approval_state", None)]
        elif d == "reject":
            exp_out[i] = "rejected"
            exp_ev.append((i, "approval_rejected", ()))
            exp_ch += [(i, "pipeline", "status", "FAILED"), (i, "pipeline", "diagnosis", diag or TR.APPROVAL_DEFAULT_DIAGNOSIS),
                       (i, "pipeline", "error_message", TR.APPROVAL_REJECTED_MESSAGE), (i, "metadata", "phase", "REPORT"),
                       (i, "metadata", "status", "FAILED"), (i, "metadata", "pending_approval_task_token", None),
                       (i, "metadata", "pending_approval_state", None)]
        else:
            exp_out[i] = "invalid_decision"
    assert got_out == exp_out
    assert got_ev == sorted(exp_ev)
    assert got_ch == sorted(exp_ch, key=lambda x: (x[0], x[1], x[2], x[3] or ""))


json_scalar = st.one_of(
    st.none(), st.booleans(), st.integers(-3, 3), st.sampled_from([0.0, 1.0, 1.5, -2.0, 0.5]),
    st.sampled_from(["", "7", " 7 ", "7.0", "7.5", "1e3", "-2", "+4", "abc", "yes", "YES", "on", "t", "no", "off", "0", "1", " yes", "maybe", "true"]),
    st.just([1]), st.just({"a": 1}),
)


@settings(**SETTINGS)
@given(values=st.lists(json_scalar, min_size=1, max_size=12))
def test_type_error_matches_pydantic(spark, values):
    import json

    pydantic = __import__("pytest").importorskip("pydantic")

    class M(pydantic.BaseModel):
        s: str
        i: int
        b: bool

    texts = [json.dumps({"s": v, "i": v, "b": v}) for v in values]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    v = F.try_parse_json("t")
    got = {
        r["n"]: (r["s"], r["i"], r["b"])
        for r in df.select(
            "n",
            *[C.type_error(F.variant_get(v, f"$.{f}", "variant"), k).alias(f) for f, k in (("s", "str"), ("i", "int"), ("b", "bool"))],
        ).collect()
    }
    for n, val in enumerate(values):
        try:
            M.model_validate({"s": val, "i": val, "b": val})
            exp = {}
        except pydantic.ValidationError as e:
            exp = {x["loc"][0]: x["msg"] for x in e.errors()}
        assert got[n] == (exp.get("s"), exp.get("i"), exp.get("b")), (val, got[n], exp)


@settings(**SETTINGS)
@given(calls=st.lists(st.tuples(st.sampled_from(["r1", "r2"]), st.sampled_from(["gpt-4o-mini", "other"]), st.integers(0, 5000), st.integers(0, 2000)), max_size=10))
def test_cost_and_usage_match_model(spark, calls):
    df = spark.createDataFrame(calls, "run_id string, model string, prompt_tokens int, completion_tokens int")
    priced = TR.token_cost(df, TR.price_table(spark))
    runs = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "run_id string")
    got = {r["run_id"]: (r["count"], r["total_prompt_tokens"], r["total_completion_tokens"], r["total_estimated_cost_usd"]) for r in TR.usage_rollup(priced, runs).collect()}
    exp = {}
    for run in ("r1", "r2", "r3"):
        mine = [c for c in calls if c[0] == run]
        if not mine:
            exp[run] = (None, None, None, None)
            continue
        cost = sum((p * 0.150 + c * 0.600) / 1_000_000 if m == "gpt-4o-mini" else 0.0 for _, m, p, c in mine)
        exp[run] = (len(mine), sum(p for _, _, p, _ in mine), sum(c for *_, c in mine), cost)
    for run in exp:
        g, e = got[run], exp[run]
        assert g[:3] == e[:3]
        assert (g[3] is None and e[3] is None) or abs(g[3] - e[3]) < 1e-12
