"""A key holding a third of all rows: results stay whole and plans stay partial/top-k."""

from pyspark.sql import functions as F

from driftcheck.operators import logs as L
from driftcheck.operators import runstate as R


def skewed_lines(spark, n_small=200, small_len=10):
    hot = n_small * small_len // 2  # the hot log holds a third of all lines
    df = spark.range(hot + n_small * small_len).select(
        F.when(F.col("id") < hot, F.lit(0)).otherwise(1 + (F.col("id") - hot) % n_small).alias("log_id"),
        F.col("id").alias("line_no"),
        F.when(F.col("id") == 500, F.lit("java.lang.IllegalStateException: hot"))
        .when(F.col("id") == 506, F.lit(" "))
        .otherwise(F.concat(F.lit("line "), F.col("id").cast("string"))).alias("line"),
    )
    return df, hot


def test_hot_log_reduction(spark):
    df, hot = skewed_lines(spark)
    red = L.reduce_log(df, max_bytes=5000, head=5, tail=7)
    hot_rows = [(r["section"], r["line_no"]) for r in red.filter("log_id = 0").orderBy("section", "line_no").collect()]
    expected = [(1, i) for i in range(5)] + [(2, 1), (2, 2), (2, 3)] + [(3, i) for i in range(500, 506)] + [(4, 1), (4, 2), (4, 3)] + [(5, i) for i in range(hot - 7, hot)]
    assert hot_rows == expected
    # the head/tail thresholds run inside the checkpointed per-log table; their top-k is partial + final
    top = L.first_k(df.select("log_id", "line_no"), 5)
    top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_log_grep_keeps_count_whole(spark):
    df, hot = skewed_lines(spark)
    g = L.grep(df, "line", 50).filter("log_id = 0").first()
    assert g["n_hits"] == hot - 2  # every hot line but the exception and the blank line
    assert len(g["result"].split("\n")) == 50


def test_hot_run_fold_is_partial_aggregate(spark):
    n = 30000
    ch = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id").cast("string"))).alias("run_id"),
        F.lit("p").alias("record_type"),
        F.lit("status").alias("field"),
        F.col("id").cast("string").alias("value"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        F.col("id").alias("seq"),
    )
    folded = R.fold_changes(ch)
    assert folded.filter("run_id = 'hot'").first()["value"] == str(max(i for i in range(n) if i % 3 == 0))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_hot_run_history_is_last_twenty(spark):
    n = 30000
    ev = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), (F.col("id") % 97).cast("string"))).alias("run_id"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        F.col("id").alias("seq"),
        F.lit("ANALYZE").alias("phase"),
        F.lit("escalated").alias("event"),
        F.create_map(F.lit("reason"), F.col("id").cast("string")).alias("details"),
    )
    runs = spark.createDataFrame([("hot", "p")], "run_id string, pipeline_id string")
    h = R.run_history(ev, runs).first()["history"].split("\n")
    hot_ids = [i for i in range(n) if i % 3 == 0][-20:]
    assert h == [f"ANALYZE/escalated: {i}" for i in hot_ids]
