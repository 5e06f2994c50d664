"""Operator 5: suffix-array deduplication of byte strings that repeat across documents.

A byte goes if a string of ``length`` bytes over it also starts in a document
with a smaller doc_id. Equal strings have the same anchor (the smallest hash of
the 20-byte grams inside), so a few rounds find them without moving any text
that no other document shares:

0. equal texts are found by their digests; all but the one of the smallest id
   are repeats as a whole and take no further part;
1. each group of documents sends the hashes of its anchors to shards, which
   answer which ones several documents hold and which document had them first;
2. the stretches of text around shared anchors go to the shard of that first
   document; a group sends equal stretches once;
3. a shard sorts all suffixes of its stretches by induced sorting, computes the
   permuted common prefixes, and in each run of suffixes that share ``length``
   bytes every start in a document that is not the first one is a repeat (more
   than ``PART`` bytes are sorted in parts, by the hash that gave the shard);
4. around an anchor held by ``HOT`` documents or more, rounds 1 to 3 are gone
   through string by string: a group sends the hash of each string, hears which
   ones several documents hold and where the first one has them, and joins
   neighbours with the same first document to stretches, cut by the place there.
   What stands beside a common passage goes no further, the passage goes once a
   group, and no task gets all of a long one.

Defined cases: a null text counts as empty; texts shorter than ``length`` keep
all; a null doc_id is neither a source nor cut; rows with the same id are not
compared with each other; an empty table gives an empty result; only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.blocks import dealt, ordered_group, packed, read_group, runs, unpacked
from driftcheck.llm.common import keep, releasing, splitmix, table
from driftcheck.llm.suffix_array import permuted_prefixes, suffix_array, words_at

LENGTH = 50
GRAM = 20
HOT = 2048
PARTS = 64
PART = 1 << 20
BLOCK = 4096
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _parts(docs: list[bytes], rows: np.ndarray):
    """Runs of documents of about PART bytes."""
    held, size = [], 0
    for k in rows.tolist():
        if held and size + len(docs[k]) > PART:
            yield np.array(held)
            held, size = [], 0
        held.append(k)
        size += len(docs[k])
    if held:
        yield np.array(held)


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    have, y = 1, x
    while 2 * have <= width:
        y = np.minimum(y[:-have], y[have:])
        have *= 2
    return np.minimum(y[: len(x) - width + 1], y[width - have :][: len(x) - width + 1]) if have < width else y


def string_hashes(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place."""
    h = np.zeros(len(at), np.uint64)
    for j in [*range(0, length - 7, 8), length - 8]:
        h = splitmix(h * _A + words[at + j])
    return h


def _counted(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first``, ``first`` + 1 and so on, ``size`` numbers of each."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - first, size)


class Anchors:
    """For a run of documents: document, first and last string start, and hash of each anchor, in text order.

    ``doc`` counts in the group; starts count in the document.
    """

    def __init__(self, docs: list[bytes], rows: np.ndarray, length: int):
        blob = b"".join(docs[k] for k in rows)
        size = np.array([len(docs[k]) for k in rows], np.int64)
        begin = np.cumsum(size) - size
        self.blob, self.raw, self.rows, self.begin = blob, np.frombuffer(blob, np.uint8), rows, begin
        self.words = words_at(self.raw)
        n = len(blob) - GRAM + 1
        h = self.words[:n] * _A + self.words[8 : 8 + n] * _B + self.words[GRAM - 8 : GRAM - 8 + n] * _C
        h ^= h >> np.uint64(32)
        h *= _A
        key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        best = (_slide_min(key, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        count = np.maximum(size - length + 1, 0)  # strings that start in each document
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)
        row = np.repeat(np.arange(len(rows)), count)
        pick = best[at]
        first = np.flatnonzero(np.r_[True, (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])]) if len(pick) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(pick)] - 1 if len(pick) else first
        self.doc = rows[row[first]]
        self.first, self.last = at[first] - begin[row[first]], at[last] - begin[row[first]]
        self.hash = splitmix(h[pick[first]])

    def strings(self, doc: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
        """A hash of each string of ``length`` bytes."""
        return string_hashes(self.words, start + self.begin[np.searchsorted(self.rows, doc)], length)

    def texts(self, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        a = self.begin[np.searchsorted(self.rows, doc)]
        return [self.blob[b:e] for b, e in zip((a + start).tolist(), (a + end).tolist())]


def copies_of(ids: list, docs: list[bytes], digests: list[str], firsts: list[int]) -> set[int]:
    """Rows whose whole text a smaller id has too, from the digests that several rows share."""
    first = dict(zip(digests, firsts))
    if not first:
        return set()
    return {k for k, d in enumerate(docs) if ids[k] is not None and first.get(hashlib.sha256(d).hexdigest(), ids[k]) < ids[k]}


def anchors_of(ids: list, docs: list[bytes], length: int, copies: set[int]):
    """Anchors of all documents of a group that have an id and at least one string and are no copies."""
    rows = np.array([k for k in range(len(docs)) if ids[k] is not None and len(docs[k]) >= length and k not in copies], np.int64)
    for part in _parts(docs, rows):
        yield Anchors(docs, part, length)


def _code(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h % np.uint64(shards)) << np.uint64(32)) | (h >> np.uint64(32))


def _send_anchors(length: int, shards: int):
    """Group -> (shard, grp, keys, first, n): each anchor with its first document in the group and their number."""

    def send(t: pa.Table, equal: pa.Table) -> pa.Table:
        ids, docs = read_group(t)
        copies = copies_of(ids, docs, equal.column("digest").to_pylist(), equal.column("first").to_pylist())
        found = [(_code(a.hash, shards), a.doc) for a in anchors_of(ids, docs, length, copies)]
        code = np.concatenate([f[0] for f in found] or [np.zeros(0, np.uint64)])
        doc = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
        order = np.lexsort((doc, code))
        code, doc = code[order], doc[order]
        new = np.r_[True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])] if len(code) else np.zeros(0, bool)
        code, doc = code[new], doc[new]
        start, end = runs(code)
        code, doc, n = code[start], doc[start], np.minimum(end - start, 255)
        shard, cols = packed({"keys": code.astype(np.uint32), "first": doc.astype(np.uint32), "n": n.astype(np.uint8)}, (code >> np.uint64(32)).astype(np.int32))
        grp = t.column("grp")[0].as_py()
        return pa.table([pa.array(shard, pa.int32()), pa.array([grp] * len(shard), pa.int32()), *(pa.array(cols[c], pa.binary()) for c in ("keys", "first", "n"))], ["shard", "grp", "keys", "first", "n"])

    return send


def _shared(key: np.ndarray, grp: np.ndarray, n: np.ndarray):
    """Order by key and group; of the keys of several documents: a mask in that order, and for each entry its number of documents and the entry of the first group."""
    order = np.lexsort((grp, key))
    start, end = runs(key[order])
    total = np.add.reduceat(n[order].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    shared = np.repeat(total > 1, end - start)
    return order[shared], np.repeat(total, end - start)[shared], np.repeat(order[start], end - start)[shared]


def _shared_anchors(hot: int):
    """Shard -> (grp, shard, keys, owner, hot): anchors that several documents hold; the owner names the first one met."""

    def answer(t: pa.Table) -> pa.Table:
        key, lens = unpacked(t.column("keys"), np.uint32)
        first, _ = unpacked(t.column("first"), np.uint32)
        n, _ = unpacked(t.column("n"), np.uint8)
        grp = np.repeat(t.column("grp").to_numpy(), lens)
        held, total, lead = _shared(key, grp, n)
        owner = (grp[lead].astype(np.uint64) << np.uint64(32)) | first[lead]
        to_grp, cols = packed({"keys": key[held], "owner": owner, "hot": total >= hot}, grp[held])
        shard = t.column("shard")[0].as_py()
        return pa.table([pa.array(to_grp, pa.int32()), pa.array([shard] * len(to_grp), pa.int32()), *(pa.array(cols[c], pa.binary()) for c in ("keys", "owner", "hot"))], ["grp", "shard", "keys", "owner", "hot"])

    return answer


ARRAYS = ("ids", "lens", "parts", "which", "rows", "starts", "sizes")
STRETCHES = "key int, grp int, ids binary, lens binary, parts binary, which binary, rows binary, starts binary, sizes binary, body binary"
DECIDED = "grp int, ids binary, rows binary, starts binary, sizes binary, body binary, shard int, keys binary, owner binary, places binary"


def _answered(grp: np.ndarray, columns: dict[str, list]) -> pa.Table:
    """Rows of DECIDED; nulls where there is no column."""
    kinds = {name: pa.int32() if kind == "int" else pa.binary() for name, kind in map(str.split, DECIDED.split(", "))}
    columns = {"grp": grp, **columns}
    return pa.table({name: pa.array(columns[name], kind) if name in columns else pa.nulls(len(grp), kind) for name, kind in kinds.items()})


class Outbox:
    """Rows of a group to shards (key from 0) and to itself (key below 0)."""

    def __init__(self, grp: int, length: int, shards: int):
        self.grp, self.length, self.shards = grp, length, shards
        self.rows = {name: [] for name in ("key", "grp", *ARRAYS, "body")}
        self.sent: dict[tuple[int, bytes], list] = {}  # each stretch once, with its places in the smallest id; by shard and part of the shard
        self.local: list[tuple[int, int, int]] = []  # row, first start, number of starts: what a smaller id is known to have

    def codes(self, h: np.ndarray) -> list[int]:
        """Shard and part: ``shards`` times the part, and the shard."""
        return (splitmix(h) % np.uint64(self.shards * PARTS)).tolist()

    def stretch(self, code: int, body: bytes, doc_id: int, row: int, start: int) -> None:
        """To be called by rising ids."""
        places = self.sent.setdefault((code, body), [])
        if places and places[0][0] < doc_id:
            self.local.append((row, start, len(body) - self.length + 1))
        else:
            places.append((doc_id, row, start))

    def add(self, key: int, body: bytes = b"", **columns) -> None:
        self.rows["key"].append(key), self.rows["grp"].append(self.grp), self.rows["body"].append(body)
        for name in ARRAYS:
            self.rows[name].append(x if isinstance(x := columns.get(name, b""), bytes) else np.array(x, np.int64).tobytes())

    def table(self) -> pa.Table:
        by_shard: dict[int, list] = {}
        for (code, body), places in self.sent.items():
            by_shard.setdefault(code % self.shards, []).append((code // self.shards, body, places))
        for shard, items in by_shard.items():
            which, rows, starts = zip(*((k, r, b) for k, (_, _, places) in enumerate(items) for _, r, b in places))
            parts, bodies, held = zip(*items)
            self.add(shard, b"".join(bodies), ids=[places[0][0] for places in held], lens=list(map(len, bodies)), parts=parts, which=which, rows=rows, starts=starts)
        if self.local:
            rows, starts, sizes = zip(*self.local)
            self.add(-1 - self.grp, rows=rows, starts=starts, sizes=sizes)
        return pa.table({k: pa.array(v, pa.int32() if k in ("key", "grp") else pa.binary()) for k, v in self.rows.items()})


def _send_stretches(length: int, shards: int):
    """Group and answers -> stretches of text for each shard, and what the group itself decides; strings around common anchors go as hashes to the shards behind, and as text to the group itself."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, docs = read_group(left)
        equal = right.filter(pa.compute.is_valid(right.column("digest")))
        right = right.filter(pa.compute.is_null(right.column("digest")))
        copies = copies_of(ids, docs, equal.column("digest").to_pylist(), equal.column("first").to_pylist())
        key, lens = unpacked(right.column("keys"), np.uint32)
        owner, _ = unpacked(right.column("owner"), np.uint64)
        hot, _ = unpacked(right.column("hot"), np.bool_)
        code = (np.repeat(right.column("shard").to_numpy().astype(np.uint64), lens) << np.uint64(32)) | key
        order = np.argsort(code)
        code, owner, hot = code[order], owner[order], hot[order]
        out = Outbox(left.column("grp")[0].as_py(), length, shards)
        out.local += [(k, 0, len(docs[k]) - length + 1) for k in sorted(copies) if len(docs[k]) >= length]
        strings, common = [], []  # code, row and start of strings around common anchors; their runs
        for a in anchors_of(ids, docs, length, copies) if len(code) else ():
            mine = _code(a.hash, shards)
            at = np.minimum(np.searchsorted(code, mine), len(code) - 1)
            take = np.flatnonzero(code[at] == mine)
            at, doc, first, last = at[take], a.doc[take], a.first[take], a.last[take]
            # Neighbouring anchors of the same owner make one stretch, common ones whatever the owner.
            who, some = np.where(hot[at], np.uint64(0), owner[at]), hot[at]
            lead = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (some[1:] != some[:-1]) | (doc[1:] != doc[:-1]) | (first[1:] != last[:-1] + 1)]) if len(at) else at
            doc, first, size, who, some = doc[lead], first[lead], last[np.r_[lead[1:], len(at)] - 1] - first[lead] + 1, who[lead], some[lead]
            bodies = a.texts(doc, first, first + size - 1 + length)
            for s, h, x, r, b, n in zip(out.codes(who), some.tolist(), bodies, doc.tolist(), first.tolist(), size.tolist()):
                if h:
                    common.append((ids[r], r, b, n, x))
                else:
                    out.stretch(s, x, ids[r], r, b)
            if some.any():
                row, start = np.repeat(doc[some], size[some]), _counted(first[some], size[some])
                strings.append((_code(a.strings(row, start, length), shards), row, start))
        if common:
            for k, columns in _first_places(*map(np.concatenate, zip(*strings))):
                out.add(shards + k, **columns)
            of, rows, starts, sizes, bodies = zip(*common)
            out.add(-1 - out.grp, b"".join(bodies), ids=of, rows=rows, starts=starts, sizes=sizes)
        return out.table()

    return send


def _first_places(code: np.ndarray, row: np.ndarray, start: np.ndarray):
    """For each shard: the strings of a group, the first row and start of each, and the number of its rows."""
    order = np.lexsort((start, row, code))
    code, row, start = code[order], row[order], start[order]
    new = np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])]
    code, row, start = code[new], row[new], start[new]
    lead, end = runs(code)
    n = np.minimum(end - lead, 255).astype(np.uint8)
    code, row, start = code[lead], row[lead], start[lead]
    to, cols = packed({"which": code.astype(np.uint32), "rows": row.astype(np.uint32), "starts": start.astype(np.uint32), "sizes": n}, (code >> np.uint64(32)).astype(np.int32))
    for k, shard in enumerate(to.tolist()):
        yield shard, {name: cols[name][k] for name in cols}


def _shared_strings(t: pa.Table, shard: int) -> pa.Table:
    """The same for strings as for anchors; the owner names the first document met, the place where it has the string."""
    key, lens = unpacked(t.column("which"), np.uint32)
    first, _ = unpacked(t.column("rows"), np.uint32)
    place, _ = unpacked(t.column("starts"), np.uint32)
    n, _ = unpacked(t.column("sizes"), np.uint8)
    grp = np.repeat(t.column("grp").to_numpy(), lens)
    held, _, lead = _shared(key, grp, n)
    owner = (grp[lead].astype(np.uint64) << np.uint64(32)) | first[lead]
    to, cols = packed({"keys": key[held], "owner": owner, "places": place[lead]}, grp[held])
    return _answered(to, cols | {"shard": [shard] * len(to)})


def _send_common(length: int, shards: int):
    """Group's decisions, runs of strings around common anchors, and answers -> stretches of the shared strings; the decisions go to the group itself."""

    def send(t: pa.Table) -> pa.Table:
        out = Outbox(t.column("grp")[0].as_py(), length, shards)
        done = t.filter(pa.compute.and_(pa.compute.is_null(t.column("keys")), pa.compute.equal(pa.compute.binary_length(t.column("body")), 0)))
        if done.num_rows:
            out.add(-1 - out.grp, **{c: b"".join(done.column(c).to_pylist()) for c in ("rows", "starts", "sizes")})
        answers = t.filter(pa.compute.is_valid(t.column("keys")))
        if not answers.num_rows:
            return out.table()
        key, lens = unpacked(answers.column("keys"), np.uint32)
        owner, _ = unpacked(answers.column("owner"), np.uint64)
        place, _ = unpacked(answers.column("places"), np.uint32)
        code = (np.repeat(answers.column("shard").to_numpy().astype(np.uint64), lens) << np.uint64(32)) | key
        order = np.argsort(code)
        code, owner, place = code[order], owner[order], place[order]
        own = t.filter(pa.compute.and_(pa.compute.is_null(t.column("keys")), pa.compute.greater(pa.compute.binary_length(t.column("body")), 0)))
        ids, rows, starts, sizes = (unpacked(own.column(c), np.int64)[0] for c in ("ids", "rows", "starts", "sizes"))
        blob = b"".join(own.column("body").to_pylist())
        begin = np.cumsum(sizes + length - 1) - (sizes + length - 1)
        words = words_at(np.frombuffer(blob, np.uint8))
        edge = np.r_[np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum(), PART), side="left"), len(sizes)]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):  # runs of about PART strings
            run, at = np.repeat(np.arange(a, b), sizes[a:b]), _counted(begin[a:b], sizes[a:b])
            mine = _code(string_hashes(words, at, length), shards)
            found = np.minimum(np.searchsorted(code, mine), len(code) - 1)
            take = np.flatnonzero(code[found] == mine)
            run, at, found = run[take], at[take], found[take]
            if not len(at):
                continue
            who = splitmix(owner[found]) + (place[found] // BLOCK).astype(np.uint64)
            lead = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1)])
            end = at[np.r_[lead[1:], len(at)] - 1] + length
            run, at = run[lead], at[lead]
            for s, i, r, x, e, o in zip(out.codes(who[lead]), ids[run].tolist(), rows[run].tolist(), at.tolist(), end.tolist(), (starts[run] + at - begin[run]).tolist()):
                out.stretch(s, blob[x:e], i, r, o)
        return out.table()

    return send


def repeated_starts(raw: np.ndarray, ids: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Starts (in the joined stretches) of strings that also start in a stretch of a smaller id."""
    sa = suffix_array(raw)
    shared = permuted_prefixes(raw, sa)[sa] >= length
    begin = np.cumsum(sizes) - sizes
    count = np.maximum(sizes - length + 1, 0)
    owner = np.full(len(raw), np.iinfo(np.int64).max)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - begin, count)
    whole = np.zeros(len(raw), bool)  # a whole string of the stretch starts here
    whole[at] = True
    owner[at] = np.repeat(ids, count)
    start = np.flatnonzero(~shared)
    least = np.minimum.reduceat(owner[sa], start)
    smallest = np.empty(len(raw), np.int64)
    smallest[sa] = np.repeat(least, np.diff(np.r_[start, len(raw)]))
    return np.flatnonzero(whole & (owner > smallest))


def _decide(length: int, shards: int):
    """Shard -> for each group: row, first start and number of starts of repeated strings; the shards behind answer which strings are shared."""

    def decide(t: pa.Table) -> pa.Table:
        names = ["rows", "starts", "sizes"]
        key = t.column("key")[0].as_py()
        if key < 0:
            return _answered(t.column("grp").to_numpy(), {c: t.column(c).to_pylist() for c in ("ids", *names, "body")})
        if key >= shards:
            return _shared_strings(t, key - shards)
        ids, each = unpacked(t.column("ids"), np.int64)
        sizes, _ = unpacked(t.column("lens"), np.int64)
        which, placed = unpacked(t.column("which"), np.int64)
        which = which + np.repeat(np.cumsum(each) - each, placed)
        rows, _ = unpacked(t.column("rows"), np.int64)
        starts, _ = unpacked(t.column("starts"), np.int64)
        grp = np.repeat(t.column("grp").to_numpy(), placed).astype(np.int64)
        blob = b"".join(t.column("body").to_pylist())
        # Equal stretches of several groups are sorted once; the smallest id speaks for them.
        begin = (np.cumsum(sizes) - sizes).tolist()
        seen: dict[bytes, int] = {}
        same = np.array([seen.setdefault(blob[b : b + n], k) for k, (b, n) in enumerate(zip(begin, sizes.tolist()))], np.int64)
        kept = np.unique(same)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, same, ids)
        spans: dict[int, list] = {}  # of each distinct stretch: what a smaller id has
        part = unpacked(t.column("parts"), np.int64)[0][kept] % -(-int(sizes[kept].sum()) // PART)  # equal strings are in one part
        for held in (kept[part == p] for p in np.unique(part)):
            joined = np.frombuffer(b"".join(blob[begin[k] : begin[k] + int(sizes[k])] for k in held.tolist()), np.uint8)
            hit = repeated_starts(joined, least[held], sizes[held], length)
            first = np.cumsum(sizes[held]) - sizes[held]
            inside = np.searchsorted(first, hit, side="right") - 1
            offset = hit - first[inside]
            lead = np.flatnonzero(np.r_[True, (inside[1:] != inside[:-1]) | (offset[1:] != offset[:-1] + 1)]) if len(hit) else hit
            for w, o, c in zip(held[inside[lead]].tolist(), offset[lead].tolist(), np.diff(np.r_[lead, len(hit)]).tolist()):
                spans.setdefault(w, []).append((o, c))
        out: list[tuple[int, int, int, int]] = []
        for k, g, r, b in zip(which.tolist(), grp.tolist(), rows.tolist(), starts.tolist()):
            s = int(same[k])  # holders of a larger id lose all of the stretch
            found = spans.get(s, ()) if ids[k] == least[s] else [(0, int(sizes[k]) - length + 1)]
            out += [(g, r, b + o, c) for o, c in found]
        cols = np.array(out, np.int64).reshape(-1, 4).T
        to, cols = packed({name: v for name, v in zip(names, cols[1:])}, cols[0].astype(np.int32))
        return _answered(to, cols | {"body": [b""] * len(to)})

    return decide


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
FULL = ", kept binary, spans array<struct<start:long,end:long>>"


def _cut(length: int, full: bool, text: bool, carry: bool):
    """Group and decisions -> what is left of each document."""

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, docs, place = ordered_group(left)
        rows, starts, sizes = (unpacked(right.column(c), np.int64)[0] for c in ("rows", "starts", "sizes"))
        order = np.lexsort((starts, rows))
        rows, starts, sizes = rows[order], starts[order], sizes[order]
        at = np.searchsorted(rows, np.arange(len(docs) + 1))
        out = {"doc_id": ids, "n_bytes": [len(d) for d in docs], "n_removed": [], "n_spans": [], "kept_sha256": []}
        kept, spans, texts = [], [], []
        for k, d in enumerate(docs):
            gone, left_over, done = [], [], 0
            for b, c in zip(starts[at[k] : at[k + 1]].tolist(), sizes[at[k] : at[k + 1]].tolist()):
                e = b + c - 1 + length
                if gone and b <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], e)
                else:
                    gone.append([b, e])
            for b, e in gone:
                left_over.append(d[done:b])
                done = e
            rest = b"".join([*left_over, d[done:]])
            out["n_removed"].append(len(d) - len(rest)), out["n_spans"].append(len(gone)), out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
            if full:
                kept.append(rest), spans.append([{"start": b, "end": e} for b, e in gone])
            if text:
                texts.append(rest.decode("utf-8", "ignore"))
        made = {k: pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()}
        if full:
            made |= {"kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
        if text:
            made["kept_text"] = pa.array(texts, pa.string())
        if carry:
            made["row"] = left.column("row").take(pa.array(place, pa.int64()))
        return pa.table(made)

    return cut


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, full: bool = True, text: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``full`` also the kept bytes and the removed spans.

    With ``text`` also kept_text: the kept bytes as text, without what is left of a character cut in two. It is made where the
    bytes are cut: another Python function behind would have workers of its own, which stay in the executor's memory beside these.
    Columns in ``carry`` come back in a struct ``row``. After the digests all rounds are one plan: the texts are dealt to groups once.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    groups, n = dealt(docs, carry=carry)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest")
    held = groups.where("doc_id is not null").select("grp", "doc_id", digest).groupBy("grp", "digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    held = keep(held)  # an id and a digest for each distinct text of a group
    several = held.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    equal = keep(held.select("grp", "digest").join(several, "digest").select("grp", "digest", "first"))
    sent = groups.groupBy("grp").cogroup(equal.groupBy("grp")).applyInArrow(releasing(_send_anchors(length, n)), "shard int, grp int, keys binary, first binary, n binary")
    shared = sent.groupBy("shard").applyInArrow(releasing(_shared_anchors(hot)), "grp int, shard int, keys binary, owner binary, hot binary")
    answers = shared.unionByName(equal, allowMissingColumns=True)
    stretches = groups.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(releasing(_send_stretches(length, n)), STRETCHES)
    decided = stretches.groupBy("key").applyInArrow(releasing(_decide(length, n)), DECIDED)
    common = decided.groupBy("grp").applyInArrow(releasing(_send_common(length, n)), STRETCHES)
    decided = common.groupBy("key").applyInArrow(releasing(_decide(length, n)), DECIDED).select("grp", "rows", "starts", "sizes")
    schema = RESULT + (FULL if full else "") + (", kept_text string" if text else "") + (f", row {groups.schema['row'].dataType.simpleString()}" if carry else "")
    return groups.groupBy("grp").cogroup(decided.groupBy("grp")).applyInArrow(releasing(_cut(length, full, text, bool(carry))), schema)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    return remove_repeats(table(spark, sf_dir, "documents"), full=False)
