"""Documents dealt into groups of bounded size, and packed rows that travel between groups and shards.

Operators that compare all documents work in the same rounds: every group
sends a packed row to each shard of a key space, each shard answers every
group, and the group's texts meet the answers again (a cogroup on the same
exchange of texts, which Spark reuses inside one plan).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, prepare

GROUP_BYTES = 8 << 20
LEAST_GROUPS = 64


def dealt(docs: DataFrame, group_bytes: int = GROUP_BYTES, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(grp, doc_id, text) and the number of groups: about ``group_bytes`` of text each, 64 at least.

    The group follows from the id (from the text where it is null). Columns in
    ``carry`` travel along in a struct ``row``.
    """
    prepare(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(LEAST_GROUPS, -(-total // group_bytes))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), F.lit(77))
    return docs.select(F.pmod(key, F.lit(n)).cast("int").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.struct(*carry).alias("row")] if carry else [])), n


def read_group(t: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and UTF-8 texts of a group in a fixed order (id, then text; null ids last); null texts are empty."""
    ids, docs, _ = ordered_group(t)
    return ids, docs


def ordered_group(t: pa.Table) -> tuple[list, list[bytes], list[int]]:
    """The same, with the place of each row in ``t``."""
    rows = sorted(zip(t.column("doc_id").to_pylist(), ((x or "").encode() for x in t.column("text").to_pylist()), range(t.num_rows)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return start, np.r_[start[1:], len(sorted_keys)]


def packed(columns: dict[str, np.ndarray | list], by: np.ndarray) -> tuple[np.ndarray, dict[str, list[bytes]]]:
    """One row for each value of ``by``: that value, and the bytes of each column's part."""
    order = np.argsort(by, kind="stable")
    start, end = runs(by[order])
    out = {name: [] for name in columns}
    for name, values in columns.items():
        values = values[order]
        out[name] = [values[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist())]
    return by[order][start], out


def unpacked(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of packed rows, and the length of each row."""
    parts = [np.frombuffer(x, dtype) for x in column.to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, dtype)), np.array([len(p) for p in parts], np.int64)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternating large-star and small-star rounds; each round is an aggregate
    and a join on the node, written to the shared folder, until no edge changes.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = keep(both)
    while True:
        # large-star: every larger neighbour of a node is tied to the smallest node around it
        turned = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = turned.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = turned.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = keep(large)
        # small-star: the smaller neighbours of a node are tied to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        small = keep(small.where("a <> b").distinct())
        if small.exceptAll(now).isEmpty() and now.exceptAll(small).isEmpty():
            roots = small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        now = small
