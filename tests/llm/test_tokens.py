"""Operators 2 and 10 against the libraries they must equal."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from driftcheck.llm.sentencepiece_bpe import Model, decode_ids, encode_documents, with_end
from driftcheck.llm.token_counts import Counts, token_counts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def model():
    with open(PIECE, "rb") as f:
        return Model(f.read())


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_counts_of_edge_texts(edge_documents, edge_rows, library):
    got = sorted(map(tuple, token_counts(edge_documents, BYTE).collect()), key=key)
    n = {t: len(library.encode(t or "", add_special_tokens=False).ids) for _, t in edge_rows}
    want = sorted(((i, len((t or "").encode()), n[t], n[t] > 512) for i, t in edge_rows), key=key)
    assert got == want


def test_counts_without_table_or_cache(sf_documents, library):
    """The table and the cache change no count."""
    got = {r.doc_id: r.n_tokens for r in token_counts(sf_documents, BYTE, sample_docs=0, table_size=1, cache_bytes=5000).collect()}
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in sf_documents.collect()}
    assert got == want


def test_counts_of_no_documents(no_documents):
    out = token_counts(no_documents, BYTE)
    assert out.collect() == [] and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_counts_of_any_text(docs):
    store = test_counts_of_any_text.__dict__
    if "counter" not in store:
        with open(BYTE, "rb") as f:
            store["counter"] = Counts(f.read(), {})
    counter = store["counter"]
    assert counter.count(docs) == [len(counter.tokenizer.encode(t, add_special_tokens=False).ids) for t in docs]


def test_pieces_of_edge_texts(edge_documents, edge_rows, processor):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids), r.decoded) for r in encode_documents(edge_documents, PIECE).collect()), key=key)
    want = []
    for i, t in edge_rows:
        ids = processor.encode(t or "", add_eos=True)
        text = processor.decode(ids)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert got == sorted(want, key=key)


def test_pieces_of_no_documents(no_documents):
    assert encode_documents(no_documents, PIECE, full=False).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="ab ▁é日\n", max_size=80)), max_size=8))
def test_pieces_of_any_text(docs):
    store = test_pieces_of_any_text.__dict__
    if "model" not in store:
        with open(PIECE, "rb") as f:
            store["model"] = Model(f.read(), cache_bytes=100_000)
        store["processor"] = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model, processor = store["model"], store["processor"]
    ids, off = with_end(*model.encode(docs), model.eos)
    decoded = model.decode(ids, off)
    for k, t in enumerate(docs):
        want = processor.encode(t, add_eos=True)
        assert ids[off[k] : off[k + 1]].tolist() == want
        assert decoded[k].decode() == processor.decode(want)


def test_long_words(model, processor):
    """Words beyond the vectorised length merge in the same order."""
    for t in ("a" * 700, " " * 900, "ab" * 700, "thequickbrownfox" * 90, "日本語" * 300):
        ids, off = with_end(*model.encode([t]), model.eos)
        assert ids.tolist() == processor.encode(t, add_eos=True)


def test_decoding_any_ids(spark, processor):
    rows = [(1, [259, 264, 287, 2]), (2, [3, 200, 13, 29142]), (3, []), (4, None), (5, [1, 0, 264])]
    got = {r.doc_id: r.decoded for r in decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PIECE).collect()}
    assert got == {i: processor.decode(ids or []) for i, ids in rows}


def test_offsets_with_end():
    ids, off = with_end(np.array([5, 6, 7]), np.array([0, 2, 2, 3]), 2)
    assert ids.tolist() == [5, 6, 2, 2, 7, 2] and off.tolist() == [0, 3, 4, 6]


def test_caches_are_bounded_in_bytes(library, model, processor):
    """Numbers, junk and texts without spaces: what a worker keeps does not grow with them, counts and ids stay right."""
    with open(BYTE, "rb") as f:
        counter = Counts(f.read(), {}, cache_bytes=100_000)
    rng = np.random.default_rng(2)
    for k in range(12):
        docs = ["x" * 30_000 + str(k), " ".join(map(str, rng.integers(0, 10**9, 400))), "日本語" * 4000 + str(k), f"word{k} the river"]
        assert counter.count(docs) == [len(library.encode(t, add_special_tokens=False).ids) for t in docs]
        for half in (counter.cache, counter.cache.older):
            assert sum(len(w) + counter.cache.OVERHEAD for w in half) <= 200_000 and max(map(len, half), default=0) <= 256
    small = Model(model.proto, cache_bytes=100_000)
    for k in range(6):
        docs = ["y" * 3000 + str(k), " ".join(map(str, rng.integers(0, 10**9, 300)))]
        ids, off = small.encode(docs)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == processor.encode(docs)
        assert small.held_bytes() <= 400_000


def test_pattern_for_shared_characters_splits_alike():
    import random

    from driftcheck.llm.token_counts import PRETOKEN, SHARED, SHARED_PRETOKEN

    rng = random.Random(1)
    shared = "".join(c for c in map(chr, range(0x10000)) if SHARED.fullmatch(c))
    for alphabet in (shared, shared[:128], shared[:400], " \n\t'sre ve1a.\x1c\x1f\x0b\x85\xa0é"):
        for _ in range(5000):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 14)))
            assert SHARED_PRETOKEN.findall(text) == PRETOKEN.findall(text)


def test_known_words_are_looked_up_once():
    """A word that the worker counted before costs one look into its cache, none into the frequent table."""
    class Asked(dict):
        n = 0

        def __contains__(self, key):
            Asked.n += 1
            return super().__contains__(key)

        def get(self, key, default=None):
            Asked.n += 1
            return super().get(key, default)

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        counter = Counts(f.read(), Asked({" the": 1, " of": 1}))
    docs = ["He said the end of the story, isn't it?\n\n  We'll see 12345 of  them's ", "naïve café of the l'été 東京 — “the”", "", "\x1c the \x85 end"]
    first = counter.count(docs)
    assert first == [len(e.ids) for e in counter.tokenizer.encode_batch(docs, add_special_tokens=False)]
    Asked.n = 0
    assert counter.count(docs) == first and Asked.n == 0
