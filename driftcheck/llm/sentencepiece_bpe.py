"""Operator 10: SentencePiece (BPE) encoding and decoding in vectorised merge rounds.

Texts are cut into words (a run of the space mark and what follows it; no
piece crosses such a border, which is checked when a model is loaded). The
distinct new words of a batch become one flat numpy symbol array; in each
round every word merges its leftmost pair of the best rank at once, and the
array is compacted, until no word has a pair. Each worker remembers the ids of
words in at most ``cache_bytes``, between batches. Ids and decoded texts are
then gathered from flat tables.

Defined cases: a null text counts as empty (only the end id); a null doc_id is
carried through; repeated rows give repeated rows; an empty table gives an
empty result; only doc_id and text are read of each row. Words of more than
``LONG`` symbols use the same merge order through a heap, so a text without
any space costs n log n, not n squared.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import hold, prepare, slices, table, take_ragged, texts

MARK = "▁"
LONG = 512
CACHE_BYTES = 112 << 20
WORD_BYTES = 160  # what a remembered word costs besides its characters and ids
NONE = np.int64(1 << 40)


def _one_byte_each(e):
    return ("�", e.start + 1)


codecs.register_error("one_byte_each", _one_byte_each)


class Model:
    """Tables of a BPE model with byte fallback, identity normaliser and a leading space mark."""

    def __init__(self, proto: bytes, cache_bytes: int = CACHE_BYTES):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.proto, self.unk, self.eos, self.cache_bytes = proto, sp.unk_id(), sp.eos_id(), cache_bytes
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(MARK in pieces[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece holds the space mark after another character: words are not independent")
        byte_id = {int(pieces[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_id = [byte_id.get(b, self.unk) for b in range(256)]
        self.has_bytes = len(byte_id) == 256
        # Symbols: the plain pieces, then characters that occur only inside pieces.
        self.text = [pieces[i] for i in plain]
        self.symbol = {p: k for k, p in enumerate(self.text)}
        for c in sorted({c for p in self.text for c in p} - set(self.symbol)):
            self.symbol[c] = len(self.text)
            self.text.append(c)
        self.ids = [[i] for i in plain] + [self.fallback(c) for c in self.text[len(plain) :]]
        scores = np.array([sp.get_score(i) for i in plain])
        _, dense = np.unique(-scores, return_inverse=True)  # equal scores share a rank
        pairs = {}
        for k in range(len(plain)):
            p = self.text[k]
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (k, int(dense[k]))
        self.pairs = pairs
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.merged, self.rank = keys[order], np.array([v[0] for v in pairs.values()], np.int64)[order], np.array([v[1] for v in pairs.values()], np.int64)[order]
        # Flat tables by id: decimal digits with a space, and the bytes a piece decodes to.
        self.digits = self._flat([f"{i} ".encode() for i in range(n)])
        surface = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                surface[i] = bytes([int(pieces[i][3:-1], 16)])
            elif sp.is_unknown(i):
                surface[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                surface[i] = pieces[i].replace(MARK, " ").encode()
        self.surface = self._flat(surface)
        self.plain_start = np.array([MARK == p[:1] for p in pieces])
        self._reset()

    @staticmethod
    def _flat(parts: list[bytes]):
        lens = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lens) - lens, lens

    def fallback(self, c: str) -> list[int]:
        return [self.byte_id[b] for b in c.encode()] if self.has_bytes else [self.unk]

    def _reset(self):
        self.chars = 0
        self.words: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int64), 0
        self.starts, self.lens = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NONE where there is none."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.rank[at], NONE), self.merged[at]

    def _rounds(self, words: list[str]) -> list[np.ndarray]:
        """Symbols of each word after all merges; unknown characters are -1 - code point."""
        get = self.symbol.get
        sym = np.array([get(c, -1 - ord(c)) for w in words for c in w], np.int64)
        lens = np.array([len(w) for w in words], np.int64)
        wid = np.repeat(np.arange(len(words), dtype=np.int64), lens)
        out: list = [None] * len(words)

        def pair_ranks(at):
            """Ranks of the pairs that start at the positions ``at``."""
            rank, merged = np.full(len(at), NONE), np.zeros(len(at), np.int64)
            ok = at + 1 < len(sym)
            ok[ok] = wid[at[ok]] == wid[at[ok] + 1]
            rank[ok], merged[ok] = self._lookup(sym[at[ok]], sym[at[ok] + 1])
            return rank, merged

        rank, merged = pair_ranks(np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.r_[True, wid[1:] != wid[:-1]])
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[wid[first[k]]] = sym[first[k] : first[k] + size[k]]
                stay = np.repeat(~done, size)
                sym, wid, rank, merged = sym[stay], wid[stay], rank[stay], merged[stay]
                first, best, size = None, best[~done], size[~done]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[np.r_[True, wid[at[1:]] != wid[at[:-1]]]]  # the leftmost of each word
            sym[at] = merged[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # positions after compaction: one symbol went in each earlier word
            sym, wid, rank, merged = sym[stay], wid[stay], rank[stay], merged[stay]
            near = np.unique(np.r_[at, at[at > 0] - 1])
            rank[near], merged[near] = pair_ranks(near)
        return out

    def _heap(self, word: str) -> np.ndarray:
        """The same merges for one long word: best rank first, then leftmost."""
        sym = [self.symbol.get(c, -1 - ord(c)) for c in word]
        n = len(sym)
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = []

        def push(i):
            j = right[i]
            if j >= 0 and (found := self.pairs.get((sym[i], sym[j]))):
                heapq.heappush(heap, (found[1], i, sym[i], sym[j], found[0]))

        for i in range(n):
            push(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], right[i] = merged, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return np.array([s for s, a in zip(sym, alive) if a], np.int64)

    def _learn(self, words: list[str]):
        """Encode new words and append them to the worker's store."""
        short = [w for w in words if len(w) <= LONG]
        found = dict(zip(short, self._rounds(short))) if short else {}
        for w in words:
            symbols = found[w] if w in found else self._heap(w)
            ids = [i for s in symbols.tolist() for i in (self.ids[s] if s >= 0 else self.fallback(chr(-1 - s)))]
            while self.used + len(ids) > len(self.flat):
                self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
            k = len(self.words)
            if k == len(self.starts):
                self.starts, self.lens = np.r_[self.starts, np.zeros_like(self.starts)], np.r_[self.lens, np.zeros_like(self.lens)]
            self.flat[self.used : self.used + len(ids)] = ids
            self.starts[k], self.lens[k], self.words[w] = self.used, len(ids), k
            self.used += len(ids)
            self.chars += len(w)

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts (no end id) and the offsets of each text."""
        cut = [re.findall(f"{MARK}+[^{MARK}]*", MARK + t.replace(" ", MARK)) if t else [] for t in docs]
        new = list({w for words in cut for w in words if w not in self.words})
        self._learn(new)
        get = self.words.__getitem__
        idx = np.array([get(w) for words in cut for w in words], np.int64)
        ids, off = take_ragged(self.flat, self.starts, self.lens, idx)
        if self.held_bytes() > self.cache_bytes:
            self._reset()
        return ids, off[np.cumsum([0, *map(len, cut)])]

    def held_bytes(self) -> int:
        """About what the remembered words take."""
        return self.chars + len(self.words) * WORD_BYTES + 8 * self.used

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
        """Decoded UTF-8 of each run of ids: pieces joined, marks to spaces, the leading one dropped."""
        flat, pos = take_ragged(*self.surface, ids)
        at, blob, out = pos[off], flat.tobytes(), []
        for a, b, i, j in zip(at[:-1].tolist(), at[1:].tolist(), off[:-1].tolist(), off[1:].tolist()):
            drop = int(i < j and self.plain_start[ids[i]])
            out.append(blob[a + drop : b].decode("utf-8", "one_byte_each").encode())
        return out

    def id_text(self, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
        """Decimal ids of each run, joined by one space."""
        flat, pos = take_ragged(*self.digits, ids)
        blob, at = flat.tobytes(), pos[off].tolist()
        return [blob[a : max(a, b - 1)] for a, b in zip(at, at[1:])]


def worker_model(proto: bytes, cache_bytes: int) -> Model:
    """This worker's model and its words, kept between tasks of one query."""
    return hold(("pieces", hash(proto), cache_bytes), lambda: Model(proto, cache_bytes))


def with_end(ids: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each run."""
    return np.insert(ids, off[1:], end), off + np.arange(len(off))


def encode_documents(docs: DataFrame, model_path: str, cache_bytes: int = CACHE_BYTES, full: bool = True) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_tokens, ids_sha256, decoded_sha256; with ``full`` also ids and decoded.

    Ids are those of the sentencepiece library with an end id only and no
    sampling; ``decoded`` is its decode(ids).
    """
    prepare(docs.sparkSession)
    with open(model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def sha(parts):
        return pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())

    def encode(batches):
        model = worker_model(shared.value, cache_bytes)
        for batch in batches:
            for part in slices(batch, 256):
                ids, off = with_end(*model.encode(texts(part)), model.eos)
                decoded = model.decode(ids, off)
                columns = [part.column("doc_id"), pa.array(np.diff(off)), sha(model.id_text(ids, off)), sha(decoded)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if full:
                    columns += [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32())), pa.array([d.decode() for d in decoded], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)


def decode_ids(rows: DataFrame, model_path: str, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """``rows`` (doc_id, ids array<int>) -> doc_id, decoded; null ids count as none."""
    prepare(rows.sparkSession)
    with open(model_path, "rb") as f:
        shared = rows.sparkSession.sparkContext.broadcast(f.read())

    def decode(batches):
        model = worker_model(shared.value, cache_bytes)
        for batch in batches:
            runs = [x or [] for x in batch.column("ids").to_pylist()]
            ids = np.array([i for run in runs for i in run], np.int64)
            out = model.decode(ids, np.cumsum([0, *map(len, runs)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([d.decode() for d in out], pa.string())], ["doc_id", "decoded"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decode, "doc_id long, decoded string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), full=False)
