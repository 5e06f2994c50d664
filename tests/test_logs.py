"""Log reduction, exception blocks, grep, merge and job-status operators."""

from pyspark.sql import functions as F

from driftcheck.operators import logs as L
from driftcheck.sources.logs import split_lines


def lines_df(spark, lines, log_id="a"):
    return spark.createDataFrame([(log_id, i + 1, s) for i, s in enumerate(lines)], "log_id string, line_no long, line string")


def reduced(df):
    return [r["line"] for r in df.orderBy("section", "line_no").collect()]


MARK = ["", L.TRUNCATION_MARKER, ""]


def test_truncation_of_long_log(spark):
    lines = [f"INFO line {i}" for i in range(10000)]
    lines[5000] = "Traceback (most recent call last):"
    lines[5001] = '  File "job.py", line 3'
    lines[5002] = "ZeroDivisionError: division by zero"
    lines[5003] = "   "
    got = reduced(L.reduce_log(lines_df(spark, lines), max_bytes=1000))
    block = ["Traceback (most recent call last):", '  File "job.py", line 3', "ZeroDivisionError: division by zero"]
    assert got == [f"INFO line {i}" for i in range(50)] + MARK + block + MARK + [f"INFO line {i}" for i in range(9800, 10000)]
    assert got[50:53] == ["", L.TRUNCATION_MARKER, ""]
    assert got[53] == "Traceback (most recent call last):"
    assert len(got) == 50 + 3 + 3 + 3 + 200


def test_small_log_unchanged(spark):
    lines = ["a", "b", "Exception here", "c"]
    assert reduced(L.reduce_log(lines_df(spark, lines))) == lines


def test_block_to_end_and_no_block(spark):
    lines = ["x" * 30] * 5 + ["java.lang.RuntimeException: boom", "\tat a", "\tat b"]
    assert reduced(L.reduce_log(lines_df(spark, lines), max_bytes=10, head=2, tail=2)) == [
        "x" * 30, "x" * 30, *MARK, "java.lang.RuntimeException: boom", "\tat a", "\tat b", *MARK, "\tat a", "\tat b"]
    plain = ["y" * 40] * 6
    assert reduced(L.reduce_log(lines_df(spark, plain), max_bytes=10, head=2, tail=2)) == ["y" * 40] * 2 + MARK + ["y" * 40] * 2


def test_short_log_tail_overlaps_head(spark):
    lines = [f"l{i}" * 20 for i in range(5)]
    assert reduced(L.reduce_log(lines_df(spark, lines), max_bytes=10, head=3, tail=4)) == lines[:3] + MARK + lines[1:]


def test_exception_block_whitespace_rule(spark):
    lines = ["start", "Traceback x", "detail", " \t", "after"]
    got = [r["line"] for r in L.exception_block(lines_df(spark, lines)).orderBy("line_no").collect()]
    assert got == ["Traceback x", "detail"]


def test_head_tail_use_window_group_limit(spark):
    df = L.first_k(lines_df(spark, ["a"] * 100), 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_grep(spark):
    lines = [f"row {i} ERROR" if i % 2 == 0 else f"row {i}" for i in range(200)]
    g = L.grep(lines_df(spark, lines), "error").first()
    expected = [s for s in lines if "error" in s.lower()]
    assert g["n_hits"] == 100
    assert g["result"] == "\n".join(expected[:50])
    none = L.grep(lines_df(spark, ["x"]), "zzz").first()
    assert none["result"] == "No lines in the log matched 'zzz'."


def test_merge_streams(spark):
    rows = [("j", "stderr", 1, "err1"), ("j", "stdout", 0, "out1"), ("j", "stdout", 2, "out2"), ("k", "stderr", 1, "only err")]
    df = spark.createDataFrame(rows, "log_id string, stream string, line_no long, line string")
    m = L.merge_streams(df)
    j = [r["line"] for r in m.filter("log_id = 'j'").orderBy("stream_rank", "part", "line_no").collect()]
    assert j == ["===== SPARK_DRIVER stdout =====", "out1", "out2", "===== SPARK_DRIVER stderr =====", "err1"]
    k = [r["line"] for r in m.filter("log_id = 'k'").orderBy("stream_rank", "part", "line_no").collect()]
    assert k == ["===== SPARK_DRIVER stderr =====", "only err"]


def test_split_lines_like_splitlines(spark):
    texts = ["a\r\nb\rc\n\nd\n", "x\x0by\x0cz\x1cw\x85v\u2028u\u2029t", "end\r\n", "", "\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "log_id int, text string")
    got = {}
    for r in split_lines(df).orderBy("log_id", "line_no").collect():
        got.setdefault(r["log_id"], []).append(r["line"])
    for i, t in enumerate(texts):
        assert got.get(i, [""] if not t.splitlines() else None) == (t.splitlines() or [""]), (i, t)


def test_reduce_texts_keeps_small_texts_raw(spark):
    small = "INFO a\r\nException x\r\n\r\nend"
    big_lines = [f"line {i}" for i in range(40)]
    big_lines[20] = "Traceback (most recent call last):"
    big = "\n".join(big_lines)
    df = spark.createDataFrame([(1, small), (2, big)], "log_id int, text string")
    got = {r["log_id"]: r["text"] for r in L.reduce_texts(df, max_bytes=100, head=3, tail=2).collect()}
    assert got[1] == small
    assert got[2] == "\n".join(big_lines[:3] + ["", L.TRUNCATION_MARKER, ""] + big_lines[20:] + ["", L.TRUNCATION_MARKER, ""] + big_lines[-2:])


def test_job_status_and_recovery(spark):
    df = spark.createDataFrame(
        [(1, None, "FAILED", '{"JobRunId": "j1", "State": "FAILED"}'),
         (2, None, "FAILED", "ValidationException: bad"),
         (3, None, "FAILED", '{"JobRunId": "j3"}'),
         (4, "j4", "SUCCESS", '{"JobRunId": "other", "State": "X"}'),
         (5, None, "FAILED", None)],
        "id int, job_run_id string, status string, cause string",
    )
    r = {x["id"]: (x["job_run_id"], x["status"]) for x in L.recover_job_run_id(df).collect()}
    assert r == {1: ("j1", "FAILED"), 2: (None, "FAILED"), 3: (None, "FAILED"), 4: ("j4", "SUCCESS"), 5: (None, "FAILED")}
    infra = {x["id"]: x["i"] for x in L.recover_job_run_id(df).select("id", L.is_infrastructure_failure(F.col("status"), F.col("job_run_id")).alias("i")).collect()}
    assert infra == {1: False, 2: True, 3: True, 4: False, 5: True}
    codes = spark.createDataFrame([(0, 10), (1, 10), (0, 400)], "exit_code int, took long").select(
        *L.job_status(F.col("exit_code"), F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.col("took")), F.lit(300))
    ).collect()
    assert [tuple(c) for c in codes] == [(0, "SUCCEEDED"), (1, "FAILED"), (-1, "FAILED")]
    tr = spark.createDataFrame([("SUCCESS",), ("FAILED",), ("RUNNING",)], "s string").select(L.translate_status(F.col("s"))).collect()
    assert [t[0] for t in tr] == ["SUCCEEDED", "FAILED", "RUNNING"]


def test_stream_texts_keep_every_byte(spark):
    lines = [f"line {i} " + "x" * 2000 for i in range(800)]
    df = spark.createDataFrame([("j", "stderr", i, x) for i, x in enumerate(lines)] + [("j", "stdout", 0, "out")], "log_id string, stream string, line_no long, line string")
    got = L.merge_stream_texts(L.stream_texts(df)).first()["text"]
    assert got == "===== SPARK_DRIVER stdout =====\nout\n===== SPARK_DRIVER stderr =====\n" + "\n".join(lines) + "\n"
