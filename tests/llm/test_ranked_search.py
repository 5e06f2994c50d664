"""Operator 12 against scores counted term by term."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftcheck.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    full = [b for _, b in bags if b]
    n_docs, length, df = len(full), sum(sum(b.values()) for b in full), Counter(t for b in full for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for doc, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // max(1, length)
            score = 0
            for t in terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k + 1, None if null else doc, -s) for k, (s, null, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["river", "Mill", "éTé", "日本", "a1", "x-y", "sack", "flour_", "winter", "the"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, weights=[50 / (k + 1) for k in range(len(words))], k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(None, "river mill mill"), (None, "river mill mill"), (5, "river"), (5, "river"), (-3, None), (1000, ""), (1001, "--- !!"), (1002, "winter " * 5000), (1003, "ß" * 2000 + " Sack")]
    items = [(1, "River mill MILL the"), (1, "River mill MILL the"), (1, "winter"), (2, None), (3, "unknown words"), (None, "日本 été"), (4, "x y x-y " * 30), (5, "the " * 400 + "a1")]
    return docs, items


DOCS, ITEMS = "doc_id long, text string, score long, rank int", "item_id long, text string, item int"


@pytest.mark.parametrize(("top", "block_items", "block_cells"), [(20, 512, 4_000_000), (3, 2, 10)])
def test_equals_plain_scores(spark, top, block_items, block_cells):
    docs, items = corpus(top)
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(*r, 9) for r in items], ITEMS)
    assert rows(R.ranked_search(d, q, top, block_items, block_cells)) == brute(docs, items, top)


def test_ties_across_tiles_and_tasks(spark, monkeypatch):
    """More equal scores than places, over many tiles; ids decide."""
    docs = [(i, "same words here") for i in range(3000, 0, -1)] + [(9000 + i, "other words") for i in range(50)]
    items = [(1, "same"), (2, "words")]
    got = rows(R.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items)


def test_query_over_given_tables(spark, sf_documents):
    docs = [(r.doc_id, r.text) for r in sf_documents.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    assert rows(R.op12_ranked_search(spark, "/root/testdata/sf0.001")) == brute(docs, items)


def test_edge_documents(spark, edge_documents, edge_rows):
    items = [(1, "river mill WORD"), (2, "café <s>x</s> word7")]
    got = rows(R.ranked_search(edge_documents, spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(edge_rows, items)


def test_no_rows(spark, no_documents):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert R.ranked_search(no_documents, items).collect() == []
    assert R.ranked_search(spark.createDataFrame([(1, "word")], "doc_id long, text string"), items.limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ09 -é日\x00[`{\x7f\x80"), max_size=60), st.integers(1, 12))
def test_terms_in_parts(text, part):
    whole, R.PART = R.PART, part
    try:
        got = [t.decode() for ts in R.terms_of(text.encode()) for t in ts]
    finally:
        R.PART = whole
    assert got == terms(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 5), st.integers(1, 3_000_000), max_size=4), min_size=1, max_size=5))
def test_tiles_keep_sums_exact(items):
    """Weights of a tile never add up beyond the bound, and all tiles together hold every weight."""
    weights = np.array([30_000, 1, 0, 7_000, 12_345, 2], np.int64)
    items = [Counter(x) for x in items]
    total = np.zeros((len(items), 6))
    for at, q in R.weight_tiles(items, weights):
        assert q.sum(axis=1).max() * R.IMPACT < 2**53
        total[:, at] += q
    want = np.zeros((len(items), 6))
    for i, item in enumerate(items):
        for t, k in item.items():
            want[i, t] = weights[t] * k
    assert (total == want).all()
