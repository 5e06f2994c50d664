"""Structured Streaming over run events.

Sources are file streams (no server). Sinks are parquet folders under the
shared checkpoint folder; every query has its own checkpoint location there,
so a restarted driver resumes where it stopped. ``run_available_now`` drains
what is there (``Trigger.AvailableNow``) and returns the sink as a batch
DataFrame, which is how the registered queries and tests read results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcheck.functions.joins import broadcast_if_small
from driftcheck.session import path_exists, shared_dir

WATERMARK_DELAY = "10 minutes"
ALARM_PERIOD = "5 minutes"
ALARM_THRESHOLD = 1
SOURCE_NAME = "app.events"


def file_stream(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """T1 source: new files under ``path`` (a folder or glob) as a stream.

    The schema is read once from the existing files' footers unless given.
    """
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", 64).load(path)


def with_event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need ``timestamp`` (not ``timestamp_ntz``): cast in the session zone."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def failure_alarm(events: DataFrame, period: str = ALARM_PERIOD, threshold: int = ALARM_THRESHOLD) -> DataFrame:
    """Failed executions per period; a period fires at ``threshold`` or more.

    A period without failures has no row (missing data does not fire). Run it
    in update mode (:func:`run_upserts_available_now`, keys window_start and
    window_end): every period comes out with its count so far, the open ones
    too, and the watermark only drops the state of closed periods. Failures
    later than the watermark are not counted.
    """
    w = events.filter(F.col("event_type") == "error").withWatermark("ts", WATERMARK_DELAY)
    agg = w.groupBy(F.window("ts", period)).agg(F.count(F.lit(1)).alias("failures"))
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "failures",
        (F.col("failures") >= threshold).alias("alarm"),
    )


def route_subscriptions(events: DataFrame, subscriptions: DataFrame, source: Column | None = None) -> DataFrame:
    """An event goes to every subscriber whose pattern is ``*``, its source or its detail type.

    Each event carries its distinct match keys; the join is an equi-join of
    the stream with the (broadcast, configuration-sized) subscription table,
    so the hot ``*`` key costs no shuffle.
    """
    src = source if source is not None else F.lit(SOURCE_NAME)
    keyed = events.select("*", F.explode(F.array_distinct(F.array(F.col("event_type"), src, F.lit("*")))).alias("__key"))
    return keyed.join(broadcast_if_small(subscriptions), F.col("__key") == F.col("pattern")).drop("__key")


def fold_latest(changes: DataFrame, keys: list[str]) -> DataFrame:
    """T4 (stateful part): latest value per key by (ts, seq), as a streaming aggregate."""
    return changes.groupBy(*keys).agg(
        F.max_by(F.struct("value", "ts", "seq"), F.struct("ts", "seq")).alias("latest")
    ).select(*keys, "latest.value", "latest.ts", "latest.seq")


def first_final_status(status: DataFrame, key: str = "execution_id") -> DataFrame:
    """T5: the first record of each execution whose status is not RUNNING, one row per execution.

    A running ``min_by`` over the stream for update mode
    (:func:`run_upserts_available_now`, key ``execution_id``): state is one
    small row per execution, and a late earlier record still replaces the row.
    """
    done = status.filter(F.col("status") != "RUNNING")
    agg = done.groupBy(key).agg(F.min_by(F.struct("status", "ts", "seq"), F.struct("ts", "seq")).alias("first"))
    return agg.select(key, F.col("first.status").alias("status"), F.col("first.ts").alias("ts"), F.col("first.seq").alias("seq"))


def _paths(spark: SparkSession, name: str, stable: bool = False) -> tuple[str, str]:
    """Sink and checkpoint folders under the shared folder.

    ``stable=True`` gives the same folders for the same name, so a restarted
    query resumes from its checkpoint (production); otherwise every call gets
    fresh folders (one-shot runs and tests).
    """
    root = shared_dir(spark).rstrip("/")
    tag = name if stable else f"{name}-{uuid.uuid4().hex[:12]}"
    return f"{root}/streams/{tag}/out", f"{root}/streams/{tag}/checkpoint"


def _drain(query, name: str, timeout_s: int | None) -> None:
    """Wait until the query has read all there is; without ``timeout_s`` for as long as it takes."""
    query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_available_now(df: DataFrame, name: str, output_mode: str = "append", timeout_s: int | None = None, stable: bool = False) -> DataFrame:
    """Drain the stream into a parquet sink and return the sink as a batch DataFrame."""
    spark = df.sparkSession
    out, ckpt = _paths(spark, name, stable)
    q = (
        df.writeStream.format("parquet").outputMode(output_mode)
        .option("path", out).option("checkpointLocation", ckpt)
        .trigger(availableNow=True).start()
    )
    _drain(q, name, timeout_s)
    return spark.read.schema(df.schema).parquet(out)


def current_from_upserts(log: DataFrame, keys: list[str]) -> DataFrame:
    """The current table of an upsert log: per key the row of its highest batch id."""
    vals = [c for c in log.columns if c not in keys and c != "batch_id"]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*vals, "batch_id"), F.col("batch_id")).alias("r")).select(
        *keys, *[F.col(f"r.{c}").alias(c) for c in vals + ["batch_id"]]
    )


def compact_upserts(spark: SparkSession, log_path: str, keys: list[str], out_path: str) -> DataFrame:
    """Rewrite an upsert log as its current table (one row per key, batch id kept).

    Readers of ``out_path`` then scan one row per key instead of every batch
    ever written; later batches can be appended next to it and the same
    max-by-batch read applies.
    """
    current_from_upserts(spark.read.parquet(log_path), keys).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def run_upserts_available_now(df: DataFrame, name: str, keys: list[str], timeout_s: int | None = None, stable: bool = False) -> DataFrame:
    """Drain an update-mode aggregate: each micro-batch's changed keys are appended with
    their batch id; the current table is the row of the highest batch per key."""
    spark = df.sparkSession
    out, ckpt = _paths(spark, name, stable)

    def write(batch: DataFrame, batch_id: int) -> None:
        # a replayed batch appends the same rows under the same batch id again: harmless for the max_by read
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(out)

    q = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    _drain(q, name, timeout_s)
    sink = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(out)
    return current_from_upserts(sink, keys).drop("batch_id")


def run_partials_available_now(
    rows: DataFrame, name: str, partial: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], timeout_s: int | None = None, stable: bool = False
) -> DataFrame:
    """Drain a stream whose result merges from parts: sums, counts, latest or first values.

    Every micro-batch is aggregated by ``partial`` (an ordinary aggregate of
    that batch) and written into a folder of its own, which a replay of the
    batch overwrites; ``merge`` turns all parts into the result. Nothing is
    kept between batches, so state neither grows nor expires, and rows count
    however late or out of order they come.
    """
    spark = rows.sparkSession
    out, ckpt = _paths(spark, name, stable)
    shape = []

    def write(batch: DataFrame, batch_id: int) -> None:
        part = partial(batch)
        shape[:] = [part.schema]
        part.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = rows.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    _drain(q, name, timeout_s)
    if not path_exists(spark, out):  # no batch yet
        return merge(partial(spark.createDataFrame([], rows.schema)))
    reader = spark.read.schema(shape[0]) if shape else spark.read
    return merge(reader.parquet(out).drop("batch_id"))


def compact_partials(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], out_path: str) -> DataFrame:
    """Merge the parts under ``path`` into one under ``out_path``; its rows are parts again."""
    merge(spark.read.parquet(path).drop("batch_id")).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def failure_counts(events: DataFrame, period: str = ALARM_PERIOD) -> DataFrame:
    """T3 as a part: failed executions per period of these events."""
    failed = events.filter(F.col("event_type") == "error").groupBy(F.window("ts", period).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
    return failed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "failures")


def merged_alarms(parts: DataFrame, threshold: int = ALARM_THRESHOLD) -> DataFrame:
    """T3 from parts: every period with its failures, late ones included; it fires at ``threshold`` or more."""
    total = parts.groupBy("window_start", "window_end").agg(F.sum("failures").alias("failures"))
    return total.withColumn("alarm", F.col("failures") >= threshold)
