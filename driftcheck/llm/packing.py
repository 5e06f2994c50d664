"""Operator 6: variable-capacity best-fit packing of documents into sequences.

Documents longer than the largest permitted sequence are cut into pieces of
that length. Pieces are dealt to shards; in a shard the longest go first, each
into the open bin with the least room that still holds it. Where none does, a
bin is opened whose size costs least for each token it will hold: for every
permitted size the best fill from the pieces still to come is tried, and the
size to which the bin could then shrink, plus ``overhead``, is its cost. At the
end every bin shrinks to the smallest permitted size that holds its contents.

Defined cases: a null or zero token count gives one row of length 0 without a
bin; a null doc_id is packed like any other; repeated rows are packed each; an
empty table gives an empty result; only doc_id and n_tokens are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, prepare, releasing, table
from driftcheck.llm.token_counts import token_counts

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 8
SHARD_ROWS = 20_000
LEAST_SHARDS = 64
COPIES = 10_000


def shrunk(content: int, capacities: list[int]) -> int:
    """The smallest permitted size that holds the content."""
    return capacities[bisect_left(capacities, content)]


def best_size(length: int, coming: list[int], capacities: list[int], overhead: int, count=None) -> int:
    """The size to open for a piece: least cost for each token of its best fill.

    ``coming`` holds the distinct lengths still to place in rising order, ``count``
    the pieces of each; the fill takes the longest that fits, as often as it fits.
    """
    best = None
    for c in capacities[bisect_left(capacities, length) :]:
        filled, at = length, len(coming)
        while (at := bisect_right(coming, c - filled, 0, at) - 1) >= 0:
            n = coming[at]
            filled += min(count[n], (c - filled) // n) * n
        cost = ((shrunk(filled, capacities) + overhead) / filled, c)
        best = cost if best is None or cost < best else best
    return best[1]


def pack_lengths(lengths: list[int], capacities=CAPACITIES, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """For each piece (positive, at most the largest size): its bin, its offset there, and the bin's final size."""
    capacities = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    count = Counter(lengths)
    coming = sorted(count)
    room: list[tuple[int, int]] = []  # (room left, bin), rising
    content: list[int] = []
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in order:
        n = lengths[i]
        count[n] -= 1
        if not count[n]:
            coming.pop()
        at = bisect_left(room, (n, -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = best_size(n, coming, capacities, overhead, count), len(content)
            content.append(0)
        bins[i], offsets[i] = b, content[b]
        content[b] += n
        if left > n:
            insort(room, (left - n, b))
    return bins, offsets, [shrunk(content[b], capacities) for b in bins]


def pack(counted: DataFrame, capacities=CAPACITIES, overhead: int = OVERHEAD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``counted`` (doc_id, n_tokens) -> doc_id, piece, start, length, bin_id, bin_offset, capacity; one row for each piece.

    ``start`` counts tokens in the document, ``bin_offset`` in the bin. Bins
    never cross shards; there are 64 shards at least, else one for each
    ``shard_rows`` pieces.
    """
    prepare(counted.sparkSession)
    capacities = sorted(capacities)
    longest = capacities[-1]
    n = F.greatest(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.lit(0))
    # rows of one id and length are counted, then told apart by a number, so that they too spread over all shards
    same = counted.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n_tokens")).groupBy("doc_id", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    same = keep(same.withColumn("pieces", F.greatest(F.ceil(F.col("n_tokens") / longest), F.lit(1))))  # read twice below
    total = same.agg(F.sum(F.col("copies") * F.col("pieces"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-total // shard_rows))
    steps = same.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    docs = steps.withColumn("copy", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + COPIES, F.col("copies")) - 1)))
    pieces = docs.select("doc_id", "copy", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("piece"))
    pieces = pieces.select("doc_id", "copy", "piece", (F.col("piece") * longest).alias("start"), F.least(F.lit(longest), F.col("n_tokens") - F.col("piece") * longest).cast("long").alias("length"))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "copy", F.lit(6)), F.lit(shards)).cast("int"))

    def shard(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("doc_id", "piece", "start", "length", "copy"))), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[4]))
        full = [k for k, r in enumerate(rows) if r[3] > 0]
        found = dict(zip(full, zip(*pack_lengths([rows[k][3] for k in full], capacities, overhead))))
        first = t.column("shard")[0].as_py() << 32
        out = [(*r[:4], first + found[k][0], *found[k][1:]) if k in found else (*r[:4], None, None, None) for k, r in enumerate(rows)]
        names = ["doc_id", "piece", "start", "length", "bin_id", "bin_offset", "capacity"]
        return pa.table({name: pa.array(v, pa.int64()) for name, v in zip(names, zip(*out) if out else [()] * 7)})

    return dealt.groupBy("shard").applyInArrow(releasing(shard), "doc_id long, piece long, start long, length long, bin_id long, bin_offset long, capacity long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacities=CAPACITIES, overhead: int = OVERHEAD) -> DataFrame:
    """Pack ``docs`` (doc_id, text) by their token counts."""
    return pack(token_counts(docs, tokenizer_path).select("doc_id", "n_tokens"), capacities, overhead)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
