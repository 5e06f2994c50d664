"""Operator 8: document fingerprints by one-permutation MinHash.

A text's 5-word shingles are hashed once; the top bits of a hash choose one of
``BINS`` bins, each bin keeps its smallest hash. Empty bins are filled by
optimal densification: every bin has its own fixed random order in which it
asks other bins until a filled one answers; it takes the answer's hash anew
with its own number, so bins filled from one hash agree with another text's
by chance alone as often as any others. ``BITS`` low bits of each bin are
packed; the likeness of two fingerprints corrects for chance matches.

Defined cases: a null text counts as empty; a text without a word has the
empty fingerprint, like (1.0) only another empty one; equal texts have equal
fingerprints; repeated rows are fingerprinted one by one; an empty table gives
an empty result. In the order of documents a null id comes last, equal ids go
by text (larger first); a single document is its own next.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftcheck.llm.common import prepare, slices, splitmix, table, texts
from driftcheck.llm.shingles import shingle_sets

BINS = 512
BITS = 4
ODD = np.uint64(0x9E3779B97F4A7C15)
_ORDER: dict[int, np.ndarray] = {}


def probe_order(bins: int) -> np.ndarray:
    """For each bin a fixed random order of all bins."""
    if bins not in _ORDER:
        rng = np.random.default_rng(8)
        _ORDER[bins] = np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int64)
    return _ORDER[bins]


def sketch(docs: list[bytes], bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Low-order bits of each bin (one row a text) and whether the text has any shingle."""
    h, off = shingle_sets(docs)
    row = np.repeat(np.arange(len(docs)), np.diff(off))
    at = (h >> np.uint64(64 - (bins.bit_length() - 1))).astype(np.int64)
    least = np.ones(len(h), bool)
    least[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])  # hashes are sorted in each text
    mask = np.uint64((1 << bits) - 1)
    low = np.zeros((len(docs), bins), np.uint8)
    full = np.zeros((len(docs), bins), bool)
    held = np.zeros((len(docs), bins), np.uint64)
    low[row[least], at[least]] = (h[least] & mask).astype(np.uint8)
    full[row[least], at[least]] = True
    held[row[least], at[least]] = h[least]
    some = np.diff(off) > 0
    r, b = np.nonzero(~full & some[:, None])
    order, t = probe_order(bins), 0
    while len(r):
        asked = order[b, t]
        found = full[r, asked]
        own = (b[found] + 1).astype(np.uint64) * ODD
        low[r[found], b[found]] = (splitmix(held[r[found], asked[found]] ^ own) & mask).astype(np.uint8)
        r, b, t = r[~found], b[~found], t + 1
    return low, some


def pack(low: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """Hex of the packed bits; the empty string for a text without shingles."""
    cells = np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - bits :]
    packed = np.packbits(cells.reshape(len(low), -1), axis=1)
    return [p.tobytes().hex() if s else "" for p, s in zip(packed, some)]


def unpack(prints: list[str], bins: int = BINS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    raw = np.zeros((len(prints), bins * bits // 8), np.uint8)
    some = np.array([bool(p) for p in prints])
    for k, p in enumerate(prints):
        if p:
            raw[k] = np.frombuffer(bytes.fromhex(p), np.uint8)
    cells = np.unpackbits(raw, axis=1).reshape(len(prints), bins, bits)
    return cells @ (1 << np.arange(bits - 1, -1, -1)), some


def likeness(a: list[str], b: list[str], bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard of the shingle sets, corrected for 2^-bits chance matches, within 0 to 1."""
    if not a:
        return np.zeros(0)
    x, sx = unpack(a, bins, bits)
    y, sy = unpack(b, bins, bits)
    chance = 2.0**-bits
    j = np.clip(((x == y).mean(axis=1) - chance) / (1 - chance), 0, 1)
    return np.where(sx & sy, j, np.where(sx == sy, 1.0, 0.0))


def fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``docs`` with its fingerprint column (one of that name is replaced)."""
    prepare(docs.sparkSession)

    @F.arrow_udf("string")
    def stamp(column: pa.Array) -> pa.Array:
        out = []
        for lo in range(0, len(column), 256):
            out += pack(*sketch([(t or "").encode() for t in column.slice(lo, 256).to_pylist()], bins, bits), bits)
        return pa.array(out, pa.string())

    return docs.drop("fingerprint").withColumn("fingerprint", stamp("text"))


def in_order(docs: DataFrame, columns: list[str], rows_per_bucket: int = 20_000) -> DataFrame:
    """``docs`` (doc_id and ``columns``) with a bucket of the id's range, and behind each bucket's end the row that follows it.

    The added rows have ``added`` 1. Borders are quantiles of the ids: one
    number for each ``rows_per_bucket`` rows is held by the driver.
    """
    spark = docs.sparkSession
    n = docs.count()
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // rows_per_bucket + 1)
    found = docs.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0] if n else None
    borders = np.array(sorted(set(found or [])), np.int64)

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(borders, ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    rows = docs.select("doc_id", *columns).withColumn("bucket", bucket("doc_id"))
    tops = {r.bucket: r.top for r in docs.select("doc_id", bucket("doc_id").alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops, reverse=True)
    heads = spark.createDataFrame([(tops[b], order[k - 1]) for k, b in enumerate(order)], "top long, behind int")
    first = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("behind").agg(F.max(F.struct("doc_id", *columns)).alias("row"))
    first = first.select("row.*", F.col("behind").alias("bucket"))
    return rows.withColumn("added", F.lit(0)).unionByName(first.withColumn("added", F.lit(1)))


def with_next(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Rows of :func:`in_order` with next_<column> of the next row by falling doc_id, then ``by``; after the last the first."""
    w = Window.partitionBy("bucket").orderBy("added", F.col("doc_id").desc_nulls_last(), *[F.col(c).desc() for c in by])
    return rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns]).where("added = 0")


def compare_edited(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_chars, edited, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the beginning of the next document.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(fingerprints(in_order(rows, ["text"]), bins, bits), ["text", "fingerprint"], ["text"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.col("next_text"), F.lit(1), half))
    paired = paired.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("text"), F.col("fingerprint").alias("own"), "next_fingerprint")

    def judge(batches):
        for batch in batches:
            for part in slices(batch, 256):
                docs = [t.encode() for t in texts(part)]
                own, following = part.column("own").to_pylist(), part.column("next_fingerprint").to_pylist()
                prints = pack(*sketch(docs, bins, bits), bits)
                sha = [hashlib.sha256(d).hexdigest() for d in docs]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_chars"), part.column("text"), pa.array(sha), part.column("own"), pa.array(prints), pa.array(likeness(own, prints, bins, bits)), pa.array(likeness(own, following, bins, bits))],
                    ["doc_id", "n_chars", "edited", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return paired.mapInArrow(judge, "doc_id long, n_chars long, edited string, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    return compare_edited(table(spark, sf_dir, "documents")).drop("edited")
