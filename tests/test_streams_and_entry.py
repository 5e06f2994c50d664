"""Streaming results equal the batch results; every registered query runs and matches its oracle."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from driftcheck.sources.tables import TABLES
from driftcheck.streaming import streams as S

SF = "/root/testdata/sf0.001"


def test_alarm_stream_equals_batch(spark):
    """Every period comes out, those that the watermark has not closed too."""
    path = f"{SF}/events.parque[t]"
    out = S.run_upserts_available_now(S.failure_alarm(S.with_event_time(S.file_stream(spark, path))), "t_alarm", ["window_start", "window_end"])
    batch = S.failure_alarm(S.with_event_time(spark.read.parquet(f"{SF}/events.parquet")))
    assert sorted(map(tuple, out.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_one_row_for_each_execution(spark, tmp_path):
    """The first final status across midnight; the last day and running executions included or left out as they must."""
    rows = [("e1", "FAILED", "2024-01-01 23:59:00", 1), ("e1", "SUCCEEDED", "2024-01-02 00:05:00", 2), ("e2", "RUNNING", "2024-01-02 00:06:00", 3), ("e3", "SUCCEEDED", "2024-01-09 12:00:00", 4)]
    df = spark.createDataFrame(rows, "execution_id string, status string, ts string, seq long").withColumn("ts", F.col("ts").cast("timestamp"))
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = S.file_stream(spark, str(tmp_path / "in"))
    out = S.run_upserts_available_now(S.first_final_status(stream), "t_completion", ["execution_id"])
    assert sorted((r["execution_id"], r["status"], r["seq"]) for r in out.collect()) == [("e1", "FAILED", 1), ("e3", "SUCCEEDED", 4)]


def test_subscription_routing(spark):
    ev = spark.createDataFrame([(1, "error"), (2, "view")], "event_id int, event_type string")
    subs = spark.createDataFrame([("all", "*"), ("pager", "error"), ("bus", "app.events"), ("none", "click")], "subscriber string, pattern string")
    got = sorted((r["event_id"], r["subscriber"]) for r in S.route_subscriptions(ev, subs).collect())
    assert got == [(1, "all"), (1, "bus"), (1, "pager"), (2, "all"), (2, "bus")]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["pair_id", "check_no", "name", "status", "severity", "details"]


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    cur = duck.execute(sql)
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted((tuple(_norm(r[i]) for i in order_s) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in order_d) for r in drows), key=repr)
    assert a == b


def test_stream_restart_resumes_exactly_once(spark):
    import tempfile
    import uuid

    src = tempfile.mkdtemp(prefix="stream-in-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.filter("event_id % 2 = 0").write.parquet(f"{src}/part1")
    name = f"restart-{uuid.uuid4().hex[:8]}"
    schema = ev.schema

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        return S.run_available_now(stream.select("event_id", "event_type"), name, stable=True)

    first = run().count()
    ev.filter("event_id % 2 = 1").write.parquet(f"{src}/part2")
    out = run()
    assert first == ev.filter("event_id % 2 = 0").count()
    assert out.count() == ev.count() and out.select("event_id").distinct().count() == ev.count()


def test_compact_upserts(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="upserts-")
    spark.createDataFrame([("a", "1", 0), ("b", "1", 0)], "k string, v string, batch_id long").write.mode("append").parquet(f"{root}/log")
    spark.createDataFrame([("a", "2", 1)], "k string, v string, batch_id long").write.mode("append").parquet(f"{root}/log")
    cur = S.compact_upserts(spark, f"{root}/log", ["k"], f"{root}/current")
    assert sorted((r["k"], r["v"], r["batch_id"]) for r in cur.collect()) == [("a", "2", 1), ("b", "1", 0)]


def test_files_out_of_time_order_lose_nothing(spark, tmp_path):
    """One micro-batch a file, newest file first: late failures count, and a restart neither loses nor doubles any."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    schema = ev.schema
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())[::-1]
    src = str(tmp_path / "in")

    def put(some):
        for d in some:
            ev.where(F.to_date("ts") == F.lit(d)).coalesce(1).write.parquet(f"{src}/{d}")

    def drain():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(src)
        return S.run_partials_available_now(S.with_event_time(stream), f"late-{tmp_path.name}", S.failure_counts, S.merged_alarms, stable=True)

    put(days[:3])
    part = drain().count()
    put(days[3:9])
    got = drain()
    timed = S.with_event_time(ev).where(F.to_date("ts").isin(days[:9]))
    want = S.failure_alarm(timed)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert 0 < part < got.count()


def test_latest_of_parts(spark, tmp_path):
    """The fold keeps nothing between batches; parts compact to parts."""
    rows = [("a", 1, 3, "new"), ("b", 1, 1, "b1"), ("a", 2, 1, "old"), ("b", 2, 5, None), ("c", 3, 1, "c")]
    df = spark.createDataFrame(rows, "k string, file int, seq long, value string").withColumn("ts", F.timestamp_seconds("seq"))
    for f in (1, 2, 3):
        df.where(F.col("file") == f).coalesce(1).write.parquet(f"{tmp_path}/in/{f}")
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    latest = lambda d: S.fold_latest(d, ["k"])
    out = S.run_partials_available_now(stream, "latest-parts", latest, latest)
    want = [("a", "new"), ("b", None), ("c", "c")]
    assert sorted((r["k"], r["value"]) for r in out.collect()) == want
    out.write.parquet(f"{tmp_path}/log/batch_id=0")
    assert sorted((r["k"], r["value"]) for r in S.compact_partials(spark, f"{tmp_path}/log", latest, f"{tmp_path}/now").collect()) == want


def test_a_stream_without_files_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    stream = S.with_event_time(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    assert S.run_partials_available_now(stream, "none-yet", S.failure_counts, S.merged_alarms).collect() == []
