"""spark-submit entry points on small fixtures."""

import gzip
import os
import tempfile

from driftcheck import jobs


def test_validate_job(spark):
    root = tempfile.mkdtemp(prefix="pair-")
    spark.createDataFrame([(1, 10.0), (2, 20.0)], "id long, amount double").write.parquet(f"{root}/baseline")
    spark.createDataFrame([(1, 10.0), (2, 20.5)], "id long, amount double").write.parquet(f"{root}/target")
    out = jobs.validate_job(spark, f"{root}/baseline", f"{root}/target", '[{"name": "row_count_match", "severity": "critical"}, {"name": "column_level_diff"}]', f"{root}/results")
    doc = out.first()
    assert doc["overall_status"] == "WARNING"
    assert [(c["name"], c["status"]) for c in doc["checks"]] == [("row_count_match", "PASSED"), ("column_level_diff", "WARNING")]


def test_triage_job_merges_streams_and_matches(spark):
    root = tempfile.mkdtemp(prefix="emr-")
    files = {("j1", "stdout"): "Traceback (most recent call last):\nSparkUpgradeException: DATETIME_PATTERN_RECOGNITION\n",
             ("j1", "stderr"): "org.apache.spark.SparkArithmeticException: [DIVIDE_BY_ZERO] Division by zero\n",
             ("j2", "stderr"): "clean shutdown, exitCode 0\n"}
    for (job, stream), text in files.items():
        d = os.path.join(root, "applications", "app", "jobs", job, "SPARK_DRIVER")
        os.makedirs(d, exist_ok=True)
        with gzip.open(os.path.join(d, f"{stream}.gz"), "wt") as f:
            f.write(text)
    texts = {r["log_id"]: r["text"] for r in jobs.merged_driver_texts(spark, root).collect()}
    assert texts["j1"] == ("===== SPARK_DRIVER stdout =====\n" + files[("j1", "stdout")] + "\n"
                           + "===== SPARK_DRIVER stderr =====\n" + files[("j1", "stderr")] + "\n")
    assert texts["j2"] == "===== SPARK_DRIVER stderr =====\n" + files[("j2", "stderr")] + "\n"
    out = {r["log_id"]: r["rule_no"] for r in jobs.triage_job(spark, root, f"{root}/out").collect()}
    assert out == {"j1": 1, "j2": None}


def test_main_validate_cli(spark):
    root = tempfile.mkdtemp(prefix="cli-")
    spark.createDataFrame([(1, 1.0)], "id long, amount double").write.parquet(f"{root}/b")
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, amount double").write.parquet(f"{root}/t")
    jobs.main(["validate", "--baseline", f"{root}/b", "--target", f"{root}/t", "--output", f"{root}/out"])
    doc = spark.read.json(f"{root}/out").first()
    assert doc["overall_status"] == "FAILED"


def test_main_validate_fleet_cli(spark):
    import json as _json

    root = tempfile.mkdtemp(prefix="fleet-")
    spark.createDataFrame([(1, 1.0)], "id long, amount double").write.parquet(f"{root}/a")
    spark.createDataFrame([(1, 5.0)], "id long, amount double").write.parquet(f"{root}/b")
    pairs = [{"pair_id": "same", "baseline": f"{root}/a", "target": f"{root}/a"},
             {"pair_id": "moved", "baseline": f"{root}/a", "target": f"{root}/b"},
             {"pair_id": "skipped", "baseline": f"{root}/a", "target": f"{root}/b", "target_status": "FAILED"}]
    jobs.main(["validate", "--pairs-json", _json.dumps(pairs), "--output", f"{root}/out"])
    got = {r["pair_id"]: r["overall_status"] for r in spark.read.json(f"{root}/out").collect()}
    assert got == {"same": "PASSED", "moved": "WARNING", "skipped": "SKIPPED"}


def test_shared_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from driftcheck.session import shared_dir

    def session(master, folder=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"


def test_materialized_tables_are_removed(spark):
    import os

    from driftcheck.session import cut_lineage, remove_materialized, shared_dir

    assert cut_lineage(spark.range(3)).count() == 3
    folder = shared_dir(spark).removeprefix("file:") + "/tables"
    assert os.listdir(folder)
    remove_materialized(spark)
    assert not os.path.exists(folder)


def test_a_job_leaves_the_settings_of_a_running_session(spark, tmp_path):
    """Settings for a cluster (thousands of shuffle partitions) would end later queries with state in this process."""
    from driftcheck.session import CLUSTER_CONF

    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    spark.range(3).write.parquet(f"{tmp_path}/t")
    jobs.main(["validate", "--baseline", f"{tmp_path}/t", "--target", f"{tmp_path}/t", "--output", f"{tmp_path}/out"])
    assert {k: spark.conf.get(k, None) for k in CLUSTER_CONF} == before
