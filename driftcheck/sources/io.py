"""File sources and sinks.

Writers take DataFrames and write in parallel (one file per task); readers
always pass an explicit schema, so no inference job scans the data first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.session import shared_dir

TRANSACTIONS_SCHEMA = (
    "customer_id string, transaction_date date, product string, quantity int, total_amount double, category string"
)
CHECK_RESULT_SCHEMA = "check_no int, name string, status string, details string, severity string"
VALIDATION_SCHEMA = f"pair_id string, overall_status string, checks array<struct<{CHECK_RESULT_SCHEMA.replace(' string', ':string').replace(' int', ':int')}>>"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex[:12]}"


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the transactions schema; malformed fields become null (PERMISSIVE)."""
    return (
        spark.read.schema(TRANSACTIONS_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def write_transactions_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def validation_documents(results: DataFrame, overall: DataFrame) -> DataFrame:
    """S8 shape: one document per pair with its checks nested in spec order.

    The nested list is bounded by the number of check specs of the pair.
    """
    checks = results.groupBy("pair_id").agg(
        F.array_sort(F.collect_list(F.struct("check_no", "name", "status", "details", "severity"))).alias("checks")
    )
    return overall.select("pair_id", "overall_status").join(checks, "pair_id", "left")


def write_validation_results(docs: DataFrame, path: str) -> None:
    """S8 sink: JSON lines, overwritten per validation."""
    docs.write.mode("overwrite").json(path)


def read_validation_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VALIDATION_SCHEMA).json(path)


REPORT_BUCKETS = 64


def run_bucket(run_id_col: str = "run_id", buckets: int = REPORT_BUCKETS):
    """Stable bucket of a run id (the folder a run's documents live in)."""
    return F.pmod(F.xxhash64(F.col(run_id_col)), F.lit(buckets)).cast("int")


def write_reports(reports: DataFrame, path: str, buckets: int = REPORT_BUCKETS) -> None:
    """S9 sink: one JSON report document (line) per run.

    Runs are spread over ``buckets`` folders by a hash of run_id rather than a
    folder per run, so millions of runs do not become millions of tiny files;
    a reader of one run filters on its bucket (partition pruning) and run_id.
    """
    b = reports.withColumn("run_bucket", run_bucket(buckets=buckets))
    # writers follow the size: small buckets share a task, a large one is split
    b.hint("rebalance", "run_bucket").write.mode("overwrite").partitionBy("run_bucket").json(path)


def append_events(events: DataFrame, path: str, ts_col: str = "ts", cluster_by: str | None = "run_id", batch: str | None = None) -> None:
    """S10 sink: append-only parquet partitioned by event date (never overwritten by another batch).

    No shuffle before the write: Spark's partitioned writer sorts each task's
    rows by date, so each task writes about one file per date it holds and a
    hot date is still written by many tasks. Rows are also sorted by
    ``cluster_by`` (and time) inside each task, and its column has a Bloom
    filter, so a run_id filter (point lookups, per-run listings) skips most
    row groups. With a ``batch`` name the rows go into that batch's own
    folders, which a repeated append of the batch replaces: a retry leaves no
    duplicates. Rows without a time go into the null date.
    """
    e = events.withColumn("event_date", F.to_date(F.col(ts_col)))
    order = ["event_date"] + ([cluster_by] if cluster_by and cluster_by in e.columns else []) + [ts_col]
    parts = ["event_date"]
    if batch is not None:
        e, parts = e.withColumn("batch", F.lit(batch)), ["event_date", "batch"]
    writer = e.sortWithinPartitions(*order).write.partitionBy(*parts)
    if len(order) > 2:
        writer = writer.option(f"parquet.bloom.filter.enabled#{cluster_by}", "true")
    if batch is not None:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    else:
        writer.mode("append").parquet(path)


def export_snapshots(snapshots: DataFrame, path: str, buckets: int = REPORT_BUCKETS) -> None:
    """One JSON snapshot document (line) per run, in run-id hash buckets."""
    b = snapshots.withColumn("run_bucket", run_bucket(buckets=buckets))
    b.hint("rebalance", "run_bucket").write.mode("overwrite").partitionBy("run_bucket").json(path)


SNAPSHOT_ROW_SCHEMA = "run_id {key}, kind string, chunk_no bigint, items array<string>"


def read_snapshot_rows(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    """S5 for whole snapshots (``snapshot_rows``): one line a chunk; malformed lines are dropped."""
    rows = spark.read.schema(SNAPSHOT_ROW_SCHEMA.format(key=key_type)).option("mode", "DROPMALFORMED").json(path)
    return rows.where("kind IS NOT NULL").select("run_id", "kind", "chunk_no", "items")


def read_snapshots(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Snapshot JSON, malformed documents dropped, newest file first.

    ``multi_line=True`` reads one pretty-printed document per file (files
    written by other tools); the default reads this package's JSON-lines
    exports.
    """
    df = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "DROPMALFORMED")
        .json(path)
        .withColumn("file_modified", F.col("_metadata.file_modification_time"))
    )
    return df.orderBy(F.col("file_modified").desc())
