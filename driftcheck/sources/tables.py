"""Readers for the driver's parquet tables and a few schema constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one driver table (pruning/pushdown left to Catalyst)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as a session-zone ``timestamp``.

    The parquet column reads as ``timestamp_ntz``; watermarks and time
    windows on streams need ``timestamp`` (the session zone is UTC).
    """
    from pyspark.sql import functions as F

    ev = read_table(spark, sf_dir, "events")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))
