"""Shared helpers: table access, the shared folder, ragged arrays, typed Arrow output."""

from __future__ import annotations

import ctypes
import os
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.session import shared_dir

ROOT = str(Path(__file__).resolve().parents[2])
ARROW_ROWS = "1000"


_HELD: dict[object, object] = {}


def hold(key, make):
    """What ``make`` gives, kept in this worker while one operator uses it; another operator's is dropped first."""
    if key not in _HELD:
        drop()
        _HELD[key] = make()
    return _HELD[key]


def drop() -> None:
    """Forget what the operator before kept in this worker."""
    if _HELD:
        _HELD.clear()
        release()


class Recent(dict):
    """What was looked up lately, in two halves: when the newer one is full, the older one is forgotten.

    Bounded in bytes: an entry counts as its word's characters and ``OVERHEAD``;
    words longer than ``LONGEST`` characters are not to be stored.
    """

    OVERHEAD, LONGEST = 160, 256

    def __init__(self, most_bytes: int):
        super().__init__()
        self.half, self.size, self.older = most_bytes // 2, 0, {}

    def find(self, words):
        """Puts those of ``words`` that the older half knows into the newer one; returns the unknown ones."""
        older, unknown = self.older, []
        for w in words:
            if w not in self:
                if (found := older.get(w)) is not None:
                    self.put(w, found)
                else:
                    unknown.append(w)
        return unknown

    def put(self, word: str, value) -> None:
        self[word] = value
        self.size += len(word) + self.OVERHEAD

    def trim(self) -> None:
        """To be called when the words of a batch are no longer needed."""
        if self.size > self.half:
            self.older, self.size = dict(self), 0
            self.clear()


def release() -> None:
    """Give freed memory back to the system: workers live on and share the executor with the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def releasing(work):
    """A group function that gives its memory back when it is done."""

    def one(t: pa.Table) -> pa.Table:
        drop()
        try:
            return work(t)
        finally:
            release()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        drop()
        try:
            return work(left, right)
        finally:
            release()

    return two if work.__code__.co_argcount == 2 else one


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, and send them 1000 rows a batch.

    The first is harmless where the package is shipped with ``--py-files``.
    Rows hold whole texts, so Spark's default of 10,000 rows a batch would be
    tens of megabytes; another setting of the session stays as it is.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back with its own schema.

    Cuts lineage; the files are in the folder that ``spark.checkpoint.dir``
    names, so they outlive any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(col: str, n: int):
    """crc32 of an id as text, modulo ``n``; a null id gives null."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def slices(batch: pa.RecordBatch, rows: int):
    """Pieces of at most ``rows`` rows, so Python holds few texts at once."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def take_ragged(values: np.ndarray, starts: np.ndarray, lens: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the runs ``idx`` of a ragged array; also the offsets of the result."""
    n = lens[idx]
    off = np.zeros(len(idx) + 1, np.int64)
    np.cumsum(n, out=off[1:])
    pos = np.arange(off[-1], dtype=np.int64) - np.repeat(off[:-1] - starts[idx], n)
    return values[pos], off


def splitmix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (public splitmix64), element-wise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
