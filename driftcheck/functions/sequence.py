"""Dense, gap-free numbering of a DataFrame in a global order, without one task.

``row_number()`` over an unpartitioned window moves every row into a single
partition. Instead the rows are range-sorted (distributed), materialized so
the partition layout is fixed, counted per partition (one tiny aggregate
collected to the driver: one number per partition), and numbered as the
partition's offset plus the position inside it, which
``monotonically_increasing_id`` encodes in its low 33 bits.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftcheck.session import cut_lineage

_LOW33 = (1 << 33) - 1


def dense_number(df: DataFrame, order: list[Column | str], start: int = 1, name: str = "seq_no") -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` (ties broken as the sort leaves them)."""
    ordered = cut_lineage(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("__pid", F.shiftright(F.col("__mid"), 33)).withColumn(
        "__pos", F.col("__mid").bitwiseAND(F.lit(_LOW33))
    )
    counts = sorted((r["__pid"], r["n"]) for r in ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = [0] + list(accumulate(n for _, n in counts))[:-1]
    spark = df.sparkSession
    offsets = spark.createDataFrame([(p, o) for (p, _), o in zip(counts, starts)], "__pid long, __off long")
    # one row per partition: a bounded broadcast
    return (
        ordered.join(F.broadcast(offsets), "__pid", "left")
        .withColumn(name, F.lit(start).cast("long") + F.coalesce("__off", F.lit(0).cast("long")) + F.col("__pos"))
        .drop("__mid", "__pid", "__pos", "__off")
    )


def number_within(df: DataFrame, key: str, order: list[Column | str], start: int = 0, name: str = "pos") -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order`` within each ``key``, without one task for a hot key.

    Rows are range-partitioned by (key, order) and written as they lie; a key's
    rows in one range number themselves, and the ranges of a key are added up
    (as many rows as ranges, however many rows the key has).
    """
    lying = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    held = cut_lineage(lying.withColumn("__mid", F.monotonically_increasing_id()))
    return numbered_runs(held, [key], F.shiftright("__mid", 33), start, name)


def numbered_runs(held: DataFrame, key: list[str], run: Column, start: int = 0, name: str = "pos") -> DataFrame:
    """Number the rows of each ``key`` by the order of its runs, then by ``__mid``, which counts a run's rows one by one."""
    spans = held.groupBy(*key, run.alias("__run")).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*key).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    # small: a row for each run of a key
    shifts = cut_lineage(spans.select(*(F.col(k).alias(f"__{k}") for k in key), F.col("__run").alias("__at"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift")))
    same = run == F.col("__at")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return held.join(shifts, same).withColumn(name, F.col("__mid") + F.col("__shift") + F.lit(start)).drop("__mid", "__at", "__shift", *(f"__{k}" for k in key))


def chunked(df: DataFrame, key: str, order: list[Column | str], item: Column, size: int) -> DataFrame:
    """(key, chunk_no, items): each key's items in ``order``, ``size`` to a row; a hot key is many rows in many tasks."""
    placed = number_within(df, key, order).select(key, F.floor(F.col("pos") / size).cast("long").alias("chunk_no"), F.struct("pos", item.alias("item")).alias("__i"))
    gathered = placed.groupBy(key, "chunk_no").agg(F.array_sort(F.collect_list("__i")).alias("__all"))
    return gathered.select(key, "chunk_no", F.transform("__all", lambda x: x["item"]).alias("items"))
