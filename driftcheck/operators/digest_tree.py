"""P13 over stored versions: a tree of digests tells which parts of a table differ.

A version is a folder of three Parquet tables:

* ``rows``: (leaf, row) in folders ``top=``; a leaf is a prefix of the hash of
  the key, a top is a shorter prefix of the same hash (4096 at most);
* ``nodes``: (node, n, s1, s2) in folders ``level=``; the row count of each
  prefix and the sums of two 64-bit row digests. Sums do not depend on the order of
  rows, count repeated rows, and those of a parent are the sums of its children;
* ``meta``: keys, columns with their types, depth; written last, so a version
  without it was never finished.

Two versions are compared from the root down: only children of differing
nodes are read, then only the rows of differing leaves, which
:func:`driftcheck.operators.parity.row_diff_keyed` compares. Nodes are
prefixes, so trees of different depth meet at the smaller one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcheck.operators.parity import _q, lossless, row_diff_keyed
from driftcheck.session import cut_lineage, path_exists

#: Bits of the key hash for each level: a node has 64 children.
BITS = 6
MAX_DEPTH = 4
LEAF_ROWS = 100_000
#: Sums of 64-bit digests stay exact for 10^19 rows.
_SUM = "decimal(38,0)"
META = "keys array<string>, schema string, depth int"
NODES = f"node long, n long, s1 {_SUM}, s2 {_SUM}"


@dataclass(frozen=True)
class Version:
    """A stored version: its folder and what its ``meta`` says."""

    path: str
    keys: list[str]
    schema: T.StructType
    depth: int

    @property
    def columns(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.schema.fields}

    def nodes(self, spark: SparkSession, level: int) -> DataFrame:
        return spark.read.schema(NODES).parquet(f"{self.path}/nodes/level={level}")


def depth_for(n_rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Levels below the root so that a leaf holds about ``leaf_rows`` keys' rows (1 to 4)."""
    depth = 1
    while depth < MAX_DEPTH and n_rows > leaf_rows << (BITS * depth):
        depth += 1
    return depth


def top_level(depth: int) -> int:
    """The level of the row folders: above the leaves, so a folder holds many of them; 64 or 4096 folders."""
    return min(max(depth - 1, 1), 2)


def _prefix(node: Column, levels: int) -> Column:
    """The ancestor ``levels`` above ``node``."""
    return F.shiftright(node, BITS * levels)


def store_version(df: DataFrame, keys: Sequence[str], path: str, leaf_rows: int = LEAF_ROWS) -> Version:
    """Store ``df`` with its digest tree under ``path`` (use a fresh folder for each version).

    Any column type that Parquet holds; keys may be null or repeated. The rows are
    written once, dealt by top folder in tasks of the advised size (AQE splits a
    folder that is too large for one task, so a key with a third of all rows is many
    tasks), and sorted by leaf, so a reader of few leaves skips row groups. The
    digests come from the written rows.
    """
    spark = df.sparkSession
    version = Version(path, list(keys), df.schema, depth_for(df.count(), leaf_rows))
    keys, columns, depth = version.keys, version.columns, version.depth
    types = {f.name: f.dataType for f in df.schema.fields}
    hashed = F.xxhash64(*[lossless(_q(k), types[k]) for k in keys])
    placed = df.select(F.shiftrightunsigned(hashed, 64 - BITS * depth).alias("leaf"), F.struct(*[_q(c) for c in columns]).alias("row"))
    placed = placed.withColumn("top", _prefix(F.col("leaf"), depth - top_level(depth)))
    placed.hint("rebalance", "top").sortWithinPartitions("top", "leaf").write.mode("overwrite").partitionBy("top").parquet(f"{path}/rows")

    rows = spark.read.schema(placed.schema).parquet(f"{path}/rows")
    # by name: the order of the columns does not count
    values = [lossless(F.col("row").getField(c), types[c]) for c in sorted(columns)]
    digest = lambda salt: F.sum(F.xxhash64(F.lit(salt), *values).cast(_SUM)).cast(_SUM)
    nodes = rows.groupBy(F.col("leaf").alias("node")).agg(F.count(F.lit(1)).alias("n"), digest(1).alias("s1"), digest(2).alias("s2"))
    for level in range(depth, -1, -1):
        folder = f"{path}/nodes/level={level}"
        nodes.orderBy("node").write.mode("overwrite").parquet(folder)
        nodes = version.nodes(spark, level).groupBy(_prefix(F.col("node"), 1).alias("node")).agg(
            F.sum("n").alias("n"), *[F.sum(s).cast(_SUM).alias(s) for s in ("s1", "s2")]
        )
    meta = spark.createDataFrame([(keys, df.schema.json(), depth)], META)
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return version


def open_version(spark: SparkSession, path: str) -> Version:
    """The version stored under ``path``; an unfinished or absent one is a ``FileNotFoundError``."""
    if not path_exists(spark, f"{path}/meta/_SUCCESS"):
        raise FileNotFoundError(f"No finished version in {path}")
    m = spark.read.schema(META).parquet(f"{path}/meta").first()
    return Version(path, list(m["keys"]), T.StructType.fromJson(json.loads(m["schema"])), m["depth"])


def version_rows(spark: SparkSession, version: Version, leaves: DataFrame | None = None, level: int = 0) -> DataFrame:
    """The rows of a version: all, or those under the nodes ``leaves`` of ``level`` (a column ``node``)."""
    layout = T.StructType().add("leaf", "long").add("row", version.schema).add("top", "long")
    rows = spark.read.schema(layout).parquet(f"{version.path}/rows")
    if leaves is not None:
        above = top_level(version.depth)
        if level >= above:
            tops = leaves.select(_prefix(F.col("node"), level - above).alias("top")).distinct()
            rows = rows.filter(F.col("top").isin([r["top"] for r in tops.collect()]))  # 4096 numbers at most
        rows = rows.withColumn("node", _prefix(F.col("leaf"), version.depth - level)).join(leaves, "node", "left_semi")
    return rows.select("row.*")


def differing_nodes(spark: SparkSession, left: Version, right: Version) -> tuple[DataFrame, int]:
    """(nodes whose digests differ, their level): read level by level, only under nodes that differ above."""
    depth = min(left.depth, right.depth)
    at = None
    for level in range(depth + 1):
        signed = []
        for version, sign in ((left, 1), (right, -1)):
            nodes = version.nodes(spark, level)
            if at is not None:
                nodes = nodes.withColumn("above", _prefix(F.col("node"), 1)).join(at.withColumnRenamed("node", "above"), "above", "left_semi")
            signed.append(nodes.select("node", *[(F.col(c) * sign).cast(_SUM).alias(c) for c in ("n", "s1", "s2")]))
        sums = signed[0].unionByName(signed[1]).groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2")])
        at = cut_lineage(sums.filter((F.col("n") != 0) | (F.col("s1") != 0) | (F.col("s2") != 0)).select("node"))
    return at, depth


def diff_versions(spark: SparkSession, left_path: str, right_path: str) -> DataFrame:
    """The rows of :func:`row_diff_keyed` for two stored versions, reading only what differs.

    Versions with the same keys, columns and types descend the trees. Digests over
    other columns or types say nothing about each other: such versions are
    compared whole. Empty versions are fine; other keys are a ``ValueError``.
    """
    left, right = open_version(spark, left_path), open_version(spark, right_path)
    if left.keys != right.keys:
        raise ValueError(f"versions are keyed by {left.keys} and {right.keys}")
    if left.columns != right.columns:
        return row_diff_keyed(version_rows(spark, left), version_rows(spark, right), left.keys)
    nodes, level = differing_nodes(spark, left, right)
    return row_diff_keyed(version_rows(spark, left, nodes, level), version_rows(spark, right, nodes, level), left.keys)
