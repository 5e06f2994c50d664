"""File sources against brute force on small fixtures written to a temp folder."""

import gzip
import json
import os
import tempfile

from driftcheck.sources import io as IO
from driftcheck.sources.logs import read_driver_logs, read_log_files, read_log_records, read_records, write_driver_logs
from driftcheck.sources.specs import checks_table, rules_from_json, rules_json


def test_text_log_files(spark):
    root = tempfile.mkdtemp(prefix="logs-")
    texts = {"a.log": "one\ntwo\r\nthree\n", "b.log": "solo", "c.log.gz": "x\n\ny\n"}
    for name, t in texts.items():
        p = os.path.join(root, name)
        if name.endswith(".gz"):
            with gzip.open(p, "wt") as f:
                f.write(t)
        else:
            with open(p, "w") as f:
                f.write(t)
    got = {}
    for r in read_log_files(spark, root).collect():
        got.setdefault(os.path.basename(r["log_id"]), []).append((r["line_no"], r["line"]))
    for name, t in texts.items():
        assert [l for _, l in sorted(got[name])] == t.splitlines()


def test_driver_log_layout_missing_stream(spark):
    root = tempfile.mkdtemp(prefix="emr-")
    for app, job, stream, text in [("app1", "j1", "stdout", "out a\nout b\n"), ("app1", "j1", "stderr", "err\n"), ("app1", "j2", "stderr", "only err\n")]:
        d = os.path.join(root, "applications", app, "jobs", job, "SPARK_DRIVER")
        os.makedirs(d, exist_ok=True)
        with gzip.open(os.path.join(d, f"{stream}.gz"), "wt") as f:
            f.write(text)
    rows = read_driver_logs(spark, root).collect()
    got = sorted((r["log_id"], r["application_id"], r["stream"], r["line_no"], r["line"]) for r in rows)
    assert got == [("j1", "app1", "stderr", 1, "err"), ("j1", "app1", "stdout", 1, "out a"), ("j1", "app1", "stdout", 2, "out b"),
                   ("j2", "app1", "stderr", 1, "only err")]


def test_rules_from_json_keep_order(spark):
    path = tempfile.mkdtemp(prefix="rules-")
    rules = json.loads(rules_json())
    with open(os.path.join(path, "rules.json"), "w") as f:
        for i, r in enumerate(rules, start=1):
            f.write(json.dumps({"rule_no": i, **r}) + "\n")
    got = rules_from_json(spark, path).orderBy("rule_no").collect()
    assert [r["pattern"] for r in got] == [r["pattern"] for r in rules]
    assert got[3]["fix_config"] is None and got[0]["fix_config"]["key"] == "spark.sql.ansi.enabled"


def test_check_specs_defaults(spark):
    rows = checks_table(spark, '[{"name": "row_count_match"}, {"name": "column_level_diff", "severity": "critical", "config": {"tolerance": "0.5"}}]').collect()
    assert [(r["check_no"], r["name"], r["severity"], r["tolerance"]) for r in rows] == [(1, "row_count_match", "warning", 0.0001), (2, "column_level_diff", "critical", 0.5)]


def test_transactions_csv_permissive(spark):
    path = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(path, "t.csv"), "w") as f:
        f.write("customer_id,transaction_date,product,quantity,total_amount,category\n")
        f.write("C001,2024-01-01,Widget,2,20.0,Electronics\nC001,2024-01-02,Gadget,0,50.0,Electronics\nC002,2024-01-03,Gizmo,5,100.0,Books\n")
        f.write("C003,not-a-date,Thing,x,1.0,Books\n")
    rows = {r["product"]: r for r in IO.read_transactions_csv(spark, path).collect()}
    assert len(rows) == 4 and rows["Gadget"]["quantity"] == 0 and str(rows["Widget"]["transaction_date"]) == "2024-01-01"
    assert rows["Thing"]["quantity"] is None and rows["Thing"]["transaction_date"] is None


def test_snapshot_reader_drops_malformed(spark):
    path = tempfile.mkdtemp(prefix="snap-")
    with open(os.path.join(path, "a.json"), "w") as f:
        json.dump({"run_id": 1, "n_events": 3, "metadata": {"status": "RUNNING", "phase": "BRANCH", "created_at": "x"}}, f, indent=2)
    with open(os.path.join(path, "b.json"), "w") as f:
        f.write("{ broken")
    rows = IO.read_snapshots(spark, path, "metadata struct<status:string,phase:string,created_at:string>, n_events bigint, run_id bigint", multi_line=True).collect()
    assert [(r["run_id"], r["metadata"]["status"]) for r in rows if r["metadata"] is not None] == [(1, "RUNNING")]


def _lines_of(spark, root):
    got = {}
    for r in read_log_files(spark, root).collect():
        got.setdefault(os.path.basename(r["log_id"]), []).append((r["line_no"], r["line"]))
    assert all([n for n, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())
    return {k: [line for _, line in sorted(v)] for k, v in got.items()}


def test_a_file_in_many_splits(spark, tmp_path):
    """Small splits: lines come from many tasks and are numbered as ``splitlines`` of the whole file has them."""
    import random

    rng = random.Random(4)
    parts = ["plain", "two\r", "a\rb", "", "x\x0by", "é ü", "p\x1cq\x85", "日本\x0c", "\r\r", "word " * 30]
    texts = {f"{i}.log": "\n".join(rng.choices(parts, k=rng.randint(1, 300))) + rng.choice(["", "\n", "\r\n", "\x0c", " ", "\r", "\x0c\n"]) for i in range(12)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert read_records(spark, str(tmp_path)).select("path", "start").distinct().count() > 60
        got = _lines_of(spark, str(tmp_path))
        records = {}
        for r in read_log_records(spark, str(tmp_path)).collect():
            records.setdefault(os.path.basename(r["log_id"]), []).append((r["line_no"], r["line"]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {name: t.splitlines() for name, t in texts.items()}
    for name, t in texts.items():
        assert [line for _, line in sorted(records[name])] == t.removesuffix("\n").split("\n")


def test_driver_logs_written_and_read(spark, tmp_path):
    rows = [("app1", "j1", "stdout", i, f"out {i}") for i in range(500)] + [("app1", "j1", "stderr", 3, "err"), ("app2", "j2", "stderr", 1, None), ("app2", "j2", "stderr", 2, "Zeile ü")]
    df = spark.createDataFrame(rows, "application_id string, log_id string, stream string, line_no long, line string").repartition(5)
    for compress in (True, False):
        root = f"file://{tmp_path}/{compress}"
        assert write_driver_logs(df, root, compress).count() == 3
        got = {(r["application_id"], r["log_id"], r["stream"], r["line_no"]): r["line"] for r in read_driver_logs(spark, root).collect()}
        want = {("app1", "j1", "stdout", i + 1): f"out {i}" for i in range(500)}
        assert got == want | {("app1", "j1", "stderr", 1): "err", ("app2", "j2", "stderr", 1): "", ("app2", "j2", "stderr", 2): "Zeile ü"}


def test_numbering_of_a_hot_key(spark):
    """Dense numbers within each key, the null key and equal rows included, and chunks that never exceed their size."""
    from pyspark.sql import functions as F

    from driftcheck.functions.sequence import chunked, number_within

    df = spark.range(0, 6000, numPartitions=6).select(F.when(F.col("id") % 10 < 8, 1).when(F.col("id") % 10 == 8, 2).alias("k"), (F.col("id") * 7919 % 997).alias("v"))
    got = {}
    for r in number_within(df, "k", ["v"]).collect():
        got.setdefault(r["k"], []).append((r["pos"], r["v"]))
    for k, n in ((1, 4800), (2, 600), (None, 600)):
        assert [p for p, _ in sorted(got[k])] == list(range(n)) and [v for _, v in sorted(got[k])] == sorted(v for _, v in got[k])
    chunks = chunked(df, "k", ["v"], F.col("v"), 100).collect()
    assert all(len(r["items"]) == 100 for r in chunks) and len(chunks) == 60
    assert sum((r["items"] for r in sorted((r for r in chunks if r["k"] == 1), key=lambda r: r["chunk_no"])), []) == sorted(v for _, v in got[1])
