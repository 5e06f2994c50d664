"""Operator 2: token counts by a map-side two-tier lookup.

Tier one is a compact table of frequent pre-tokens and their token counts,
sent to every executor (at most ``table_size`` entries, drawn from at most
``sample_docs`` documents; it only saves time and never changes a count).
Tier two is a cache in each Python worker, at most ``cache_bytes``: pre-tokens
missing from the table are encoded by the tokenizer library and remembered
while they recur; very long ones are not kept. No pre-token is ever shuffled;
every text is counted whole.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null doc_id
is carried through; repeated rows give repeated rows; an empty table gives an
empty result; only doc_id and text are read of each row.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import Recent, hold, prepare, release, slices, table, texts

#: Fixed value: the pre-token pattern of byte-level BPE as the library uses it.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Texts holding a character outside these blocks are split by the library itself:
#: there the two libraries may follow different Unicode versions.
SHARED = regex.compile(r"[\x00-ɏͰ-ϿА-я‐-‧‰-⁞€←-⇿ぁ-ゖァ-ヺ一-龥]*")



def _pattern(end: int) -> re.Pattern:
    """``PRETOKEN`` for texts of ``SHARED`` characters below ``end``, with the classes written out as ranges: ``re`` runs it several times as fast."""
    blocks = [chr(i) for i in range(end) if SHARED.fullmatch(chr(i))]

    def ranges(kind: str) -> str:
        found, out = [ord(c) for c in blocks if regex.match(kind, c)], []
        for i in found:
            if out and out[-1][1] == i - 1:
                out[-1][1] = i
            else:
                out.append([i, i])
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)

    letter, number, space = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    return re.compile(f" ?[{letter}]+|'(?:s|t|re|ve|m|ll|d)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


#: Letters come first: nothing that starts a contraction starts a run of letters.
SHARED_PRETOKEN = _pattern(0x10000)
#: The same for ASCII texts, whose classes are one small table each.
ASCII_PRETOKEN = _pattern(0x80)
SHARED_RE = re.compile(SHARED.pattern)

TABLE_SIZE = 65_536
SAMPLE_DOCS = 512
CACHE_BYTES = 160 << 20


class Counts:
    """Token counts of texts: the frequent table, then this worker's cache."""

    def __init__(self, spec: bytes, frequent: dict[str, int], cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a worker: Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = sorted((a["content"] for a in json.loads(spec)["added_tokens"]), key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.frequent, self.cache = frequent, Recent(cache_bytes)

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text and the number of special tokens inside it."""
        if self.split is None or not any(s in text for s in self.special):
            return self.pieces(text), 0
        parts = self.split.split(text)
        return [p for part in parts for p in self.pieces(part)], len(parts) - 1

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_PRETOKEN.findall(text)
        if SHARED_RE.fullmatch(text):
            return SHARED_PRETOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def count(self, docs: list[str]) -> list[int]:
        cut = [self.pretokens(t) for t in docs]
        frequent, cache = self.frequent, self.cache
        # one look into the newer half for each pre-token; those it lacks are few
        get = cache.get
        found = [list(map(get, pieces)) for pieces, _ in cut]
        lacking = [i for i, n in enumerate(found) if None in n]
        rest = {p: None for i in lacking for p, n in zip(cut[i][0], found[i]) if n is None}
        for p in rest:
            rest[p] = frequent.get(p)
        missing = cache.find([p for p, n in rest.items() if n is None])
        for i in range(0, len(missing), 2000):
            part = missing[i : i + 2000]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                rest[p] = len(e)
                if len(p) <= cache.LONGEST:
                    cache.put(p, len(e))
        for p, n in rest.items():
            if n is None:
                rest[p] = cache[p]
            elif p in frequent:
                cache.put(p, n)
        for i in lacking:
            found[i] = [rest[p] if n is None else n for p, n in zip(cut[i][0], found[i])]
        cache.trim()
        return [sum(n) + extra for n, (_, extra) in zip(found, cut)]


def worker_counts(spec: bytes, frequent: dict[str, int], cache_bytes: int) -> Counts:
    """This worker's counter, kept between tasks of one query."""
    return hold(("tokens", hash(spec), cache_bytes), lambda: Counts(spec, frequent, cache_bytes))


def frequent_table(docs: DataFrame, spec: bytes, sample_docs: int, table_size: int) -> dict[str, int]:
    """Counts of the commonest pre-tokens of a bounded sample; only a cache to start with."""
    rows = docs.select("text").where(F.octet_length("text").between(1, 65_536)).limit(sample_docs).collect()
    counter, seen = Counts(spec, {}), Counter()
    for row in rows:
        pieces, _ = counter.pretokens(row.text)
        seen.update(pieces)
    words = [w for w, _ in seen.most_common(table_size)]
    return {w: len(e.ids) for w, e in zip(words, counter.tokenizer.encode_batch(words, add_special_tokens=False))}


def token_counts(docs: DataFrame, tokenizer_path: str, max_tokens: int = 512, sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the tokenizers library for the file (special strings
    inside a text handled as its default), without added special tokens,
    truncation or padding.
    """
    prepare(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, frequent_table(docs, spec, sample_docs, table_size)))

    def count(batches):
        counter = worker_counts(*shared.value, cache_bytes)
        for batch in batches:
            for part in slices(batch, 256):
                n = counter.count(texts(part))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
