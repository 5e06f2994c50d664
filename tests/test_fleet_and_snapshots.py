"""Concurrent, resumable fleets; whole snapshots; appends that a retry repeats."""

import json
import os
import threading
import time

from pyspark.sql import functions as F

from driftcheck import jobs
from driftcheck.operators import parity as P
from driftcheck.operators import runstate as R
from driftcheck.sources import io as IO


def _fleet(spark, root, n):
    pairs = []
    for i in range(n):
        spark.range(0, 20 + i, 1, 1).selectExpr("id", "id * 1.5D AS amount").write.parquet(f"{root}/a{i}")
        spark.range(0, 20 + i + (i % 3 == 0), 1, 1).selectExpr("id", "id * 1.5D AS amount").write.parquet(f"{root}/b{i}")
        pairs.append({"pair_id": f"p{i}", "baseline": f"{root}/a{i}", "target": f"{root}/b{i}", "target_status": "FAILED" if i == 4 else "SUCCEEDED"})
    return pairs


def _statuses(overall):
    return {r["pair_id"]: r["overall_status"] for r in overall.collect()}


def test_fleet_runs_jobs_side_by_side_and_resumes(spark, tmp_path):
    pairs = _fleet(spark, tmp_path, 12)
    want = {f"p{i}": "SKIPPED" if i == 4 else "FAILED" if i % 3 == 0 else "PASSED" for i in range(12)}
    most, stop = [0], threading.Event()

    def watch():
        while not stop.is_set():
            most[0] = max(most[0], len(spark.sparkContext.statusTracker().getActiveJobsIds()))
            time.sleep(0.002)

    watcher = threading.Thread(target=watch)
    watcher.start()
    state = f"{tmp_path}/state"
    try:
        _, overall = jobs.validate_fleet(spark, json.dumps(pairs), in_flight=4, state_dir=state)
    finally:
        stop.set()
        watcher.join()
    assert _statuses(overall) == want
    assert most[0] >= 2
    done = {f: os.stat(f"{state}/{f}/_SUCCESS").st_mtime_ns for f in os.listdir(state)}
    assert len(done) == 11
    # one pair did not finish, one table changed: only these two are profiled again
    lost = next(f for f in done if spark.read.parquet(f"{state}/{f}").first()["pair_id"] == "p2")
    os.unlink(f"{state}/{lost}/_SUCCESS")
    spark.range(0, 99, 1, 1).selectExpr("id", "id * 1.5D AS amount").write.mode("overwrite").parquet(f"{tmp_path}/b1")
    _, overall = jobs.validate_fleet(spark, json.dumps(pairs), state_dir=state)
    assert _statuses(overall) == want | {"p1": "FAILED"}
    now = {f: os.stat(f"{state}/{f}/_SUCCESS").st_mtime_ns for f in os.listdir(state)}
    assert len(now) == 12 and now[lost] != done[lost] and sum(now[f] != done.get(f) for f in now) == 2


def test_groups_give_the_same_as_one_plan(spark, monkeypatch):
    monkeypatch.setattr(P, "PROFILE_GROUP", 3)
    pairs = [P.TablePair(f"p{i}", spark.range(i).selectExpr("id"), spark.range(i + i % 2).selectExpr("id")) for i in range(10)]
    prof, _ = P.pair_profiles(pairs, in_flight=3)
    plain, _ = P.pair_profiles(pairs, materialize=False)
    assert sorted(map(str, prof.collect())) == sorted(map(str, plain.select(prof.columns).collect()))


def test_an_error_in_one_pair_is_not_lost(spark):
    import pytest

    bad = spark.range(3).selectExpr("id", "raise_error('broken pair') AS c").selectExpr("id", "CAST(c AS INT) AS c")
    with pytest.raises(Exception, match="broken pair"):
        P.pair_profiles([P.TablePair("a", spark.range(3), spark.range(3)), P.TablePair("b", bad, bad)], in_flight=2)


def test_whole_snapshots_of_a_hot_run(spark, tmp_path):
    """Every record comes back in its order; the run with most events is many rows written by several tasks."""
    meta = spark.createDataFrame([(1, "RUNNING", None), (2, "DONE", "x"), (3, "NONE", None)], "run_id long, status string, phase string")
    pipes = spark.createDataFrame([(1, "b", 1), (1, "a", None), (2, "z", 0)], "run_id long, pipeline_id string, retries int")
    events = spark.range(0, 5000, numPartitions=6).select(
        F.when(F.col("id") % 50 == 0, 2).otherwise(1).cast("long").alias("run_id"), F.timestamp_seconds(F.col("id") % 977).alias("ts"), F.col("id").alias("seq"), F.concat(F.lit("é "), F.col("id")).alias("event")
    )
    rows = R.snapshot_rows(meta, pipes, events, items=100)
    assert rows.agg(F.max(F.size("items"))).first()[0] == 100
    path = f"{tmp_path}/snap"
    IO.export_snapshots(rows, path)
    with open(f"{path}/run_bucket=0-broken.json", "w") as f:
        f.write("{ not json\n")
    got = {}
    for r in R.snapshot_items(IO.read_snapshot_rows(spark, path), 100).collect():
        got.setdefault((r["run_id"], r["kind"]), []).append((r["pos"], json.loads(r["item"])))
    got = {k: [x for _, x in sorted(v, key=lambda x: x[0])] for k, v in got.items()}
    assert got[(1, "metadata")] == [{"status": "RUNNING", "phase": None}] and (3, "metadata") in got and (3, "events") not in got
    assert got[(1, "pipelines")] == [{"pipeline_id": "a", "retries": None}, {"pipeline_id": "b", "retries": 1}]
    for run in (1, 2):
        want = sorted((i % 977, i) for i in range(5000) if (i % 50 == 0) == (run == 2))
        assert [e["seq"] for e in got[(run, "events")]] == [i for _, i in want]
    assert rows.where("run_id = 1 AND kind = 'events'").count() == 49


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    ev = spark.createDataFrame([(1, "2024-01-01 10:00:00", 1), (1, "2024-01-02 10:00:00", 2), (2, None, 3)], "run_id long, ts string, seq long").withColumn("ts", F.col("ts").cast("timestamp"))
    path = f"{tmp_path}/log"
    read = lambda: sorted((r["run_id"], r["seq"], str(r["event_date"])) for r in spark.read.parquet(path).collect())
    IO.append_events(ev.where("seq < 3"), path, batch="b1")
    IO.append_events(ev.where("seq = 3"), path, batch="b2")
    first = read()
    assert first == [(1, 1, "2024-01-01"), (1, 2, "2024-01-02"), (2, 3, "None")]
    for batch, cond in (("b1", "seq < 3"), ("b2", "seq = 3"), ("b1", "seq < 3")):
        IO.append_events(ev.where(cond), path, batch=batch)
    assert read() == first


def test_a_point_lookup_skips_row_groups(spark, tmp_path):
    """Runs interleave in every file; the sort and the Bloom filter leave one run's row groups."""
    path = f"{tmp_path}/log"
    ev = spark.range(0, 60_000, numPartitions=3).select((F.col("id") % 6000 * 2).alias("run_id"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"), F.col("id").alias("seq"))
    spark.conf.set("parquet.block.size", "20000")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "20000")
    try:
        IO.append_events(ev, path, batch="b")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        spark.conf.unset("parquet.block.size")
    import glob

    import pyarrow.parquet as pq

    groups = [g for f in glob.glob(f"{path}/*/*/*.parquet") for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(i) for i in range(m.num_row_groups))]
    assert len(groups) >= 9
    holding = [g for g in groups if g.column(0).statistics.min <= 1000 <= g.column(0).statistics.max]
    assert sum(g.num_rows for g in holding) < 20_000
    assert spark.read.parquet(path).where("run_id = 1000").count() == 10
