"""Operator 12: ranked lexical search by dense blocked matrix products.

The items of a block give a compact vocabulary. One pass over the documents
turns each text into its number of terms and its counts of vocabulary terms
(a table in the shared folder); document frequencies and lengths are sums over
that table. A second pass multiplies vocabulary tiles (items x terms, weight
times repeats) with document tiles (terms x documents, impacts) in float64.
Tiles are cut so that no partial sum reaches 2^53, so every product is exact
and whole scores are 64-bit sums over tiles. Each task keeps an item's best
documents with all ties that could still count, and a window merges the tasks.

Items come in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_CELLS`` cells
of items x vocabulary; every block is broadcast and is one pass over the
documents, so the bound holds for any number of items.

Defined cases: a null text has no terms; a null doc_id is a document and comes
last among equal scores; repeated documents rank one by one; equal items (id
and text) are answered once, items of one id with different texts each for
themselves; an item without a known term has no rows; empty tables give an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import partial, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, prepare, slices, table

TOP = 20
BLOCK_ITEMS = 512
BLOCK_CELLS = 4_000_000
TILE_TERMS = 4096
TILE_DOCS = 512
PART = 1 << 20
#: No impact reaches this, so weights of a tile may add up to 2^53 divided by it.
IMPACT = 1_000_000
EXACT = (1 << 53) // IMPACT - 1

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms_of(text: bytes):
    """The terms of a text in lists of bounded size; a longer text is cut at a separator."""
    at = 0
    while at < len(text):
        end = at + PART
        part = text[at:end].translate(_FOLD)
        if end < len(text):
            cut = part.rfind(b" ")
            if cut < 0:  # a term longer than a part: up to the next separator
                while end < len(text) and b" " not in (more := text[end : end + PART].translate(_FOLD)):
                    end += PART
                part = text[at : min(len(text), end + PART)].translate(_FOLD)
                cut = part.find(b" ", end - at) if end < len(text) else len(part)
            part = part[:cut]
        yield part.split()
        at += len(part)
        if not part:
            at += 1


def _counted(shared, batches):
    """Texts -> doc_id, number of terms, vocabulary numbers and their counts."""
    vocabulary = shared.value
    get = vocabulary.get
    size = max(1, len(vocabulary))
    for batch in batches:
        for part in slices(batch, 256):
            n, keys, counts = [], [], []
            for raw in part.column("text").to_pylist():
                total, seen = 0, Counter()
                for terms in terms_of(raw or b""):
                    total += len(terms)
                    ids = np.fromiter(map(get, terms, repeat(-1)), np.int64, len(terms))
                    found = np.bincount(ids + 1, minlength=1)[1:] if size <= 8 * len(terms) else None
                    if found is not None:
                        at = np.flatnonzero(found)
                        seen.update(dict(zip(at.tolist(), found[at].tolist())))
                    else:
                        seen.update(ids[ids >= 0].tolist())
                order = sorted(seen)
                n.append(total)
                keys.append(np.array(order, np.int32).tobytes())
                counts.append(np.array([seen[k] for k in order], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])


def _frequencies(size: int, batches):
    """Documents that hold each vocabulary term, summed over a task."""
    df = np.zeros(size, np.int64)
    for batch in batches:
        raw = b"".join(batch.column("terms").to_pylist())
        df += np.bincount(np.frombuffer(raw, np.int32), minlength=size)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "df"])


def weight_tiles(items: list[Counter], weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(terms, items x terms matrix) tiles; the weights of an item in a tile sum to EXACT at most.

    A term whose weight alone is too large for an item is in several tiles.
    """
    rest: dict[int, dict[int, int]] = {}
    for i, item in enumerate(items):
        for t, repeats in item.items():
            if weights[t]:
                rest.setdefault(t, {})[i] = int(weights[t]) * repeats
    tiles, terms, cells, used = [], [], [], np.zeros(len(items), np.int64)

    def close():
        nonlocal terms, cells, used
        if terms:
            q = np.zeros((len(items), len(terms)))
            for i, j, w in cells:
                q[i, j] = w
            tiles.append((np.array(terms, np.int64), q))
        terms, cells, used = [], [], np.zeros(len(items), np.int64)

    for t in sorted(rest):
        left = rest[t]
        while left:
            if len(terms) >= TILE_TERMS or any(used[i] + min(w, EXACT) > EXACT for i, w in left.items()):
                close()
            now = {i: min(w, EXACT) for i, w in left.items()}
            for i, w in now.items():
                cells.append((i, len(terms), w))
                used[i] += w
            terms.append(t)
            left = {i: w - now[i] for i, w in left.items() if w > now[i]}
    close()
    return tiles


def best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` rows of each item, highest score first, ties by id, null ids last."""
    order = np.lexsort((doc, null, -score, item))
    got = item[order]
    start = np.flatnonzero(np.r_[True, got[1:] != got[:-1]]) if len(got) else np.zeros(0, np.int64)
    rank = np.arange(len(got)) - np.repeat(start, np.diff(np.r_[start, len(got)]))
    return order[rank < top]


def _searched(shared, total: int, length: int, top: int, batches):
    """Counts of a task's documents -> the best of each item among them."""
    size, n_items, tiles = shared.value
    floor = np.ones(n_items, np.int64)  # what a score must reach to count
    kept = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]
    fresh, waiting = [], 0

    def prune():
        nonlocal kept, fresh, waiting
        item, score, doc, null = (np.concatenate(x) for x in zip(kept, *fresh))
        at = best(item, score, doc, null, top)
        kept, fresh, waiting = [item[at], score[at], doc[at], null[at]], [], 0
        full = np.bincount(kept[0], minlength=n_items) >= top
        least = np.full(n_items, np.iinfo(np.int64).max)
        np.minimum.at(least, kept[0], kept[1])
        floor[full] = least[full]

    place = np.full(size, -1, np.int64)
    for batch in batches:
        for part in slices(batch, TILE_DOCS):
            ids = [np.frombuffer(x, np.int32) for x in part.column("terms").to_pylist()]
            lens = np.array([len(x) for x in ids])
            col = np.repeat(np.arange(len(ids)), lens)
            term = np.concatenate(ids)
            tf = np.frombuffer(b"".join(part.column("counts").to_pylist()), np.int64)
            m = np.array([75 + 25 * n * total // max(1, length) for n in part.column("n").to_pylist()], np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[col])
            scores = np.zeros((n_items, len(ids)), np.int64)
            for terms, q in tiles:
                place[terms] = np.arange(len(terms))
                row = place[term]
                inside = row >= 0
                here, new = np.unique(row[inside], return_inverse=True)  # the terms of this tile that these documents hold
                d = np.zeros((len(here), len(ids)))
                d[new, col[inside]] = impact[inside]
                scores += (q[:, here] @ d).astype(np.int64)
                place[terms] = -1
            item, at = np.nonzero(scores >= floor[:, None])
            doc = part.column("doc_id")
            fresh.append((item, scores[item, at], doc.fill_null(0).to_numpy()[at], doc.is_null().to_numpy(zero_copy_only=False)[at]))
            waiting += len(item)
            if waiting > 50 * top * n_items:
                prune()
    prune()
    item, score, doc, null = kept
    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64(), mask=null), pa.array(score, pa.int64())], ["item", "doc_id", "score"])


def item_blocks(items: DataFrame, block_items: int = BLOCK_ITEMS, block_cells: int = BLOCK_CELLS):
    """Blocks of (ids, term counts, vocabulary), read one partition after the other by the driver."""
    ids, counts, vocabulary = [], [], {}
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).distinct().toLocalIterator():
        seen = Counter()
        for terms in terms_of(bytes(row.text or b"")):
            seen.update(terms)
        new = sum(t not in vocabulary for t in seen)
        if ids and (len(ids) >= block_items or (len(ids) + 1) * (len(vocabulary) + new) > block_cells):
            yield ids, counts, vocabulary
            ids, counts, vocabulary = [], [], {}
        ids.append(row.item_id)
        counts.append(Counter({vocabulary.setdefault(t, len(vocabulary)): k for t, k in seen.items()}))
    if vocabulary:
        yield ids, counts, vocabulary


def _block(docs: DataFrame, ids: list, counts: list[Counter], vocabulary: dict[bytes, int], top: int) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    held = keep(rows.mapInArrow(partial(_counted, sc.broadcast(vocabulary)), "doc_id long, n long, terms binary, counts binary"))
    size = len(vocabulary)
    total, length = held.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    known = held.where(F.length("terms") > 0)
    found = known.select("terms").mapInArrow(partial(_frequencies, size), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = dict(found.collect())  # a number for each term of the block's vocabulary
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) if t in df else 0 for t in range(size)], np.int64)
    tiles = sc.broadcast((size, len(ids), weight_tiles(counts, weights)))
    hits = known.mapInArrow(partial(_searched, tiles, total, length, top), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_items: int = BLOCK_ITEMS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    blocks = [_block(docs, *b, top) for b in item_blocks(items, block_items, block_cells)]
    if not blocks:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, blocks)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all of ``documents`` for each item of ``benchmark``."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = {
    "op12_ranked_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM d WHERE len(t) > 0),
i AS (SELECT row_number() OVER () AS k, item_id, {_TERMS} AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT k, term, count(*) AS repeats FROM (SELECT k, unnest(t) AS term FROM i) GROUP BY ALL),
c AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, docs),
p AS (SELECT c.r, c.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.t) * docs) // terms))) AS part FROM c JOIN w USING (term) JOIN d USING (r), s),
z AS (SELECT k, r, sum(part * repeats)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL),
o AS (SELECT item_id, (row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id ASC NULLS LAST))::INTEGER AS rank, doc_id, score FROM z JOIN d USING (r) JOIN i USING (k) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""",
}
