"""Skew stress: the same operators on uniform vs skewed keys (one key = 1/3 of rows).

Usage: python scripts/skew_stress.py [sf_dir] [copies]

The events table is replicated ``copies`` times inside Spark (new event ids),
written once to a scratch folder in two layouts: uniform users, and one user
holding a third of all rows. Log reduction, grep, the change-log fold and the
keyed row diff then run on both; skew-resistant plans take about the same
time on both layouts. This is a local stress check, not a registered query.
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from driftcheck.operators import logs as L  # noqa: E402
from driftcheck.operators import parity as P  # noqa: E402
from driftcheck.operators import runstate as R  # noqa: E402
from driftcheck.plans.derive import event_line  # noqa: E402
from driftcheck.session import get_spark, materialize_path  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = get_spark()
    ev = spark.read.parquet(f"{sf}/events.parquet")
    n = ev.count()
    big = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c")).select(
        (F.col("event_id") + F.col("c") * n).alias("event_id"), "ts", "user_id", "event_type", "value", "props"
    )
    layouts = {}
    for name, uid in (("uniform", F.col("user_id")), ("skewed", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))):
        path = materialize_path(spark)
        big.withColumn("user_id", uid).repartition(64).write.parquet(path)
        layouts[name] = spark.read.parquet(path)
    out = {"rows": n * copies, "copies": copies}
    for name, df in layouts.items():
        lines = df.select(F.col("user_id").alias("log_id"), F.col("event_id").alias("line_no"),
                          event_line(F.col("event_type"), F.col("user_id"), F.col("event_id"), F.col("value")).alias("line"))
        changes = df.select(F.col("user_id").cast("string").alias("run_id"), F.lit("p").alias("record_type"),
                            "event_type", F.col("event_type").alias("field"), F.col("value").cast("string").alias("value"),
                            F.col("ts").alias("ts"), F.col("event_id").alias("seq")).drop("event_type")
        keyed_b = df.select(F.col("user_id").alias("k"), "event_type", "value")
        keyed_t = keyed_b.withColumn("value", F.when(F.col("event_type") == "error", F.col("value") + 1).otherwise(F.col("value")))
        jobs = {
            "reduce_log": lambda: L.reduce_log(lines, max_bytes=20000, head=50, tail=200),
            "grep": lambda: L.grep(lines, "exception"),
            "fold": lambda: R.fold_changes(changes),
            "keyed_diff": lambda: P.row_diff_keyed(keyed_b, keyed_t, ["k"]),
        }
        for job, build in jobs.items():
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            out[f"{name}.{job}"] = round(time.perf_counter() - t0, 2)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
