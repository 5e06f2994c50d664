"""SparkSession helpers and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster (about 1000 executors, 100 TB inputs). Shuffle
# partitions start high and AQE coalesces them to ~256 MB; skewed join
# partitions are split; the broadcast threshold stays modest because every
# explicit broadcast in this package is of a size-bounded configuration table.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where the split costs a further shuffle (a join followed by an aggregate on the same key)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
    # jobs of a fleet run side by side, each in its pool
    "spark.scheduler.mode": "FAIR",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_cluster_conf(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add :data:`CLUSTER_CONF` to a session builder."""
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    return builder


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "driftcheck") -> SparkSession:
    """Session with AQE on and UTC time; used by tests and the bench."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DRIFTCHECK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local master may leave it unset (tests):
    then a fresh folder under the system temp dir is registered. On a cluster
    an unset folder is an error, since executors would write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="driftcheck-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it (harmless where it comes with ``--py-files``)."""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def materialize_path(spark: SparkSession) -> str:
    """A fresh folder for a materialized table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system Spark reads it from."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_materialized(spark: SparkSession) -> None:
    """Delete the tables that :func:`cut_lineage` wrote in this session's shared folder (call it when a job is done)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/tables")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared folder and read it back.

    One job computes the data once (a reliable RDD checkpoint would compute
    it twice unless cached); the files live in the cluster's shared
    checkpoint folder, so they survive executor loss, and the read-back
    relation carries real size statistics for the planner (broadcast
    decisions on small results).
    """
    spark = df.sparkSession
    path = materialize_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
