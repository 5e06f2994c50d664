"""spark-submit entry points (the Spark jobs the orchestration would launch).

    spark-submit -m driftcheck.jobs validate --baseline s3://.../baseline --target s3://.../target \\
        --checks-json '[{"name": "row_count_match", "severity": "critical"}]' --output s3://.../results

``validate`` reads the two parquet folders (S1), or a whole fleet of pairs
given as JSON (P14), runs the parity suite (P10) and writes one JSON document
per pair (S8). ``triage`` reads driver logs
(S4), merges the streams (L5) and writes the first matching rule per job (L3).
Both delete their intermediate tables at the end.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from driftcheck.operators import logs as L
from driftcheck.operators import parity as P
from driftcheck.operators import triage as TR
from driftcheck.session import apply_cluster_conf, remove_materialized
from driftcheck.sources import io as IO
from driftcheck.sources.logs import read_driver_log_texts, read_driver_records
from driftcheck.sources.specs import rules_from_json, rules_table


def validate_paths(
    spark: SparkSession, baseline_path: str, target_path: str, checks_json: str = P.DEFAULT_CHECKS_JSON, pair_id: str = "pair"
) -> tuple[DataFrame, DataFrame]:
    """S1 + P10: parity of two parquet folders; returns (check results, overall)."""
    pair = P.TablePair(pair_id, spark.read.parquet(baseline_path), spark.read.parquet(target_path))
    return P.validate([pair], checks_json)


def validate_fleet(
    spark: SparkSession, pairs_json: str, checks_json: str = P.DEFAULT_CHECKS_JSON, in_flight: int = P.IN_FLIGHT, state_dir: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """P14 from a pair list: ``[{"pair_id", "baseline", "target", "target_status"?, "checks"?}]``.

    The list is configuration (one entry per table pair) and is read on the
    driver; every pair's tables are scanned by Spark, ``in_flight`` jobs at a
    time. With ``state_dir`` a restart skips the pairs that are finished.
    """
    pairs = [
        P.TablePair(
            str(p["pair_id"]),
            spark.read.parquet(p["baseline"]),
            spark.read.parquet(p["target"]),
            p.get("target_status", "SUCCEEDED"),
            json.dumps(p["checks"]) if p.get("checks") is not None else None,
        )
        for p in json.loads(pairs_json)
    ]
    return P.validate(pairs, checks_json, in_flight, state_dir)


def validate_job(spark: SparkSession, baseline_path: str, target_path: str, checks_json: str, output_path: str) -> DataFrame:
    results, overall = validate_paths(spark, baseline_path, target_path, checks_json)
    docs = IO.validation_documents(results, overall)
    IO.write_validation_results(docs, output_path)
    return IO.read_validation_results(spark, output_path)


def merged_driver_texts(spark: SparkSession, logs_root: str) -> DataFrame:
    """S4 + L5: one text per job, stdout section before stderr, each under its header."""
    return L.merge_stream_texts(read_driver_log_texts(spark, logs_root).select("log_id", "stream", "text"))


def triage_job(spark: SparkSession, logs_root: str, output_path: str, rules_path: str | None = None) -> DataFrame:
    rules = rules_from_json(spark, rules_path) if rules_path else rules_table(spark)
    # whole logs, line by line: a rule may match anywhere, and no log is put together
    matched = TR.match_rules_lines(L.merged_lines(read_driver_records(spark, logs_root)), rules)
    matched.write.mode("overwrite").json(output_path)
    return spark.read.schema(matched.schema).json(output_path)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="driftcheck.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    v = sub.add_parser("validate")
    v.add_argument("--baseline")
    v.add_argument("--target")
    v.add_argument("--pairs-json", help="fleet mode: JSON list of {pair_id, baseline, target[, target_status, checks]}")
    v.add_argument("--checks-json", default=P.DEFAULT_CHECKS_JSON)
    v.add_argument("--in-flight", type=int, default=P.IN_FLIGHT, help="fleet mode: jobs at the same time")
    v.add_argument("--state-dir", help="fleet mode: shared folder with the profiles of finished pairs; a restart skips them")
    v.add_argument("--output", required=True)
    t = sub.add_parser("triage")
    t.add_argument("--logs-root", required=True)
    t.add_argument("--rules", default=None)
    t.add_argument("--output", required=True)
    for p in (v, t):
        p.add_argument("--checkpoint-dir", help="folder that all executors share; else spark.checkpoint.dir of the session")
    args = ap.parse_args(argv)
    # a running session keeps its settings; one that is started here gets those for a cluster
    spark = SparkSession.getActiveSession() or apply_cluster_conf(SparkSession.builder.appName(f"driftcheck-{args.cmd}")).getOrCreate()
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    try:
        run(spark, args, ap)
    finally:
        remove_materialized(spark)


def run(spark: SparkSession, args: argparse.Namespace, ap: argparse.ArgumentParser) -> None:
    if args.cmd == "validate":
        json.loads(args.checks_json)  # fail fast on malformed specs
        if args.pairs_json:
            results, overall = validate_fleet(spark, args.pairs_json, args.checks_json, args.in_flight, args.state_dir)
            IO.write_validation_results(IO.validation_documents(results, overall), args.output)
        else:
            if not (args.baseline and args.target):
                ap.error("validate needs --baseline and --target, or --pairs-json")
            validate_job(spark, args.baseline, args.target, args.checks_json, args.output)
    else:
        triage_job(spark, args.logs_root, args.output, args.rules)


if __name__ == "__main__":
    main()
