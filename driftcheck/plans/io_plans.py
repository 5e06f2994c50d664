"""Registered source/sink round trips (S2, S5, S8-S11) and their DuckDB oracles.

Each query writes data Spark derives from the driver tables into a fresh
folder under the shared checkpoint folder, reads it back through the
matching reader and summarises it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.operators import parity as P
from driftcheck.plans import parity_plans as PP
from driftcheck.plans import runstate_plans as RP
from driftcheck.sources import io as IO
from driftcheck.sources.tables import read_table


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    tx = o.select(
        F.concat(F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_orderpriority").alias("product"),
        (F.col("o_totalprice") / 10000).cast("int").alias("quantity"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("category"),
    )
    path = IO.scratch_path(spark, "transactions_csv")
    IO.write_transactions_csv(tx, path)
    back = IO.read_transactions_csv(spark, path)
    return back.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("customer_id").alias("n_customers"),
        F.sum("quantity").alias("quantity"),
        F.round(F.sum("total_amount"), 2).alias("total_amount"),
        F.min("transaction_date").cast("string").alias("first_date"),
    )


def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, overall = P.validate(PP.fleet_pairs(spark, sf_dir))
    path = IO.scratch_path(spark, "validation_json")
    IO.write_validation_results(IO.validation_documents(results, overall), path)
    back = IO.read_validation_results(spark, path)
    return back.select("pair_id", "overall_status", F.explode_outer("checks").alias("c")).select(
        "pair_id", "overall_status", F.col("c.check_no").alias("check_no"), F.col("c.name").alias("name"),
        F.col("c.status").alias("status"), F.col("c.details").alias("details"),
    )


SNAPSHOT_SCHEMA = "run_id bigint, metadata struct<status:string,phase:string,created_at:string>, n_events bigint"


def q_snapshot_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, pipe = RP.folded_records(spark, sf_dir)
    from driftcheck.operators import runstate as R

    snap = R.snapshot(meta.select("run_id", "status", "phase", "created_at"), pipe.select("run_id", "status"), RP.audit_events(spark, sf_dir))
    path = IO.scratch_path(spark, "snapshots")
    IO.export_snapshots(snap.select("run_id", "metadata", "n_events"), path)
    # a malformed document next to the good ones must be skipped
    spark.createDataFrame([("{ this is not json",)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/run_bucket=-1")
    back = IO.read_snapshots(spark, path, SNAPSHOT_SCHEMA)
    return back.filter(F.col("metadata").isNotNull()).select(
        "run_id", F.col("metadata.status").alias("status"), F.col("metadata.created_at").alias("created_at"), "n_events"
    )


def q_snapshot_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 whole: metadata, pipelines and every event of every run, exported and read back."""
    from driftcheck.operators import runstate as R

    meta, pipe = RP.folded_records(spark, sf_dir)
    events = RP.audit_events(spark, sf_dir)
    rows = R.snapshot_rows(meta.select("run_id", "record_type", *RP.META_FIELDS), pipe.select("run_id", "record_type", *RP.PIPE_FIELDS), events, items=SNAPSHOT_ITEMS)
    path = IO.scratch_path(spark, "snapshots_full")
    IO.export_snapshots(rows, path)
    back = R.snapshot_items(IO.read_snapshot_rows(spark, path), SNAPSHOT_ITEMS)
    field = lambda k: F.get_json_object("item", f"$.{k}")
    return back.select(
        "run_id", "kind", "pos", field("record_type").alias("record_type"), field("status").alias("status"), field("event").alias("event"),
        F.coalesce(field("timestamp"), field("updated_at")).alias("written_at"), field("seq").cast("long").alias("seq"), F.coalesce(field("details.diagnosis"), field("diagnosis")).alias("diagnosis"),
    )


SNAPSHOT_ITEMS = 16


def q_event_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = RP.audit_events(spark, sf_dir).drop("details")
    path = IO.scratch_path(spark, "event_log")
    # two batches (first half of the month, then the rest, rows without a time too); the second is written
    # twice, as a retry would: nothing is overwritten and nothing doubled
    early = F.coalesce(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(False))
    IO.append_events(ev.filter(early), path, batch="first")
    for _ in range(2):
        IO.append_events(ev.filter(~early), path, batch="second")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("run_id").alias("n_runs"), F.max("seq").alias("last_seq")
    )


def q_report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = RP.q_report_row(spark, sf_dir)
    path = IO.scratch_path(spark, "reports")
    IO.write_reports(rows, path)
    return spark.read.schema(rows.schema).json(path).select(*rows.columns)  # run_bucket folders are dropped


QUERIES = {
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "snapshot_scan": q_snapshot_scan,
    "snapshot_full": q_snapshot_full,
    "event_sink": q_event_sink,
    "report_sink": q_report_sink,
}

ORACLE = {
    "csv_roundtrip": (
        "SELECT o_orderstatus AS category, count(*) AS n, count(DISTINCT o_custkey) AS n_customers, "
        "CAST(sum(CAST(trunc(o_totalprice / 10000) AS INT)) AS BIGINT) AS quantity, round(sum(o_totalprice), 2) AS total_amount, "
        "CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_date FROM orders GROUP BY o_orderstatus"
    ),
    "json_roundtrip": (
        f"SELECT o.pair_id, o.overall_status, c.check_no, c.name, c.status, c.details FROM ({PP.ORACLE['parity_overall']}) o "
        f"LEFT JOIN ({PP.ORACLE['parity_checks']}) c ON o.pair_id = c.pair_id"
    ),
    "snapshot_scan": (
        f"SELECT m.run_id, m.status, m.created_at, e.n AS n_events FROM ({RP.META_SQL}) m "
        "JOIN (SELECT user_id AS run_id, count(*) AS n FROM events GROUP BY user_id) e ON m.run_id = e.run_id"
    ),
    "snapshot_full": (
        f"SELECT run_id, 'metadata' AS kind, CAST(0 AS BIGINT) AS pos, '_metadata' AS record_type, status, NULL AS event, updated_at AS written_at, CAST(NULL AS BIGINT) AS seq, NULL AS diagnosis FROM ({RP.META_SQL}) "
        "UNION ALL SELECT run_id, 'pipelines', row_number() OVER (PARTITION BY run_id ORDER BY record_type) - 1, record_type, status, NULL, updated_at, NULL, diagnosis FROM "
        f"(SELECT *, pipeline_id AS record_type FROM ({RP.PIPE_SQL})) "
        f"UNION ALL SELECT run_id, 'events', row_number() OVER (PARTITION BY run_id ORDER BY ts, seq) - 1, record_type, NULL, event, timestamp, seq, {RP._DIAG} FROM ({RP.EV_SQL})"
    ),
    "event_sink": (
        "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n_events, count(DISTINCT user_id) AS n_runs, "
        "max(event_id) AS last_seq FROM events GROUP BY ALL"
    ),
    "report_sink": RP.ORACLE["report_row"],
}
