"""Operator 7: exact n-gram Jaccard join by universe partition and pigeonhole.

A set's shingles are hashed into the segments of its size band. Two sets with
a Jaccard similarity of at least ``percent`` / 100, the larger of size s,
differ in at most H(s) elements, so of any segments to which the larger set
gives H(s) + 1 units in all, one must agree: a segment of one unit in all its
elements, a reserve segment of two units up to one deletion. Every set is
indexed in its band and in the band of its largest possible partners (all
segments; reserve segments also with each element deleted); the larger set
chooses where to spend its units by exact costs: how many sets hold the same
key. Chosen keys that several sets hold give candidates, which are verified on
the whole sets.

The links are kept as classes, not as pairs. The holders of a chosen key form a
cluster around the most typical of them (the set whose segments most others
share). First every member meets only that centre. Members that are then still
outside the cluster's largest component ask all members of the cluster whose
size allows a link, in blocks that are bounded on both sides, so no pair is
ever a row. A group sends one entry of each of its keys to find the centres,
so a key that every document holds costs a shard one entry a group.

Defined cases: a null text, and one without a word, has no shingles and links
with nothing; a text of fewer than ``words`` words has its whole sequence as
one shingle; a row with a null id is returned with a null component and links
with nothing; rows with the same id are one node, each with its own
n_shingles; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.blocks import components, dealt, packed, read_group, runs, unpacked
from driftcheck.llm.common import keep, releasing, splitmix, table
from driftcheck.llm.shingles import WORDS, shingle_sets

PERCENT = 75
SLACK = 0.25
MEMBERS = 128
BLOCK = 512
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LOWER, DELETED, CHOSEN = 1, 2, 4


class Bands:
    """Size bands (upper ends are powers of two) and their segments for one threshold."""

    def __init__(self, percent: int):
        self.percent = percent

    def differ(self, size):
        """H: most elements in which a set of this size and a similar set, not larger, differ."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def band(self, size: np.ndarray) -> np.ndarray:
        return np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)

    def highest(self, size: np.ndarray) -> np.ndarray:
        """Band of the largest set that can be similar to one of this size."""
        return self.band(100 * size // self.percent)

    def segments(self, band: np.ndarray) -> np.ndarray:
        h = self.differ(np.int64(1) << band)
        return h + 1 + np.ceil(SLACK * h).astype(np.int64)

    def reserve(self, band: np.ndarray) -> np.ndarray:
        """The last segments of a band, indexed with one-deletion neighbourhoods too."""
        return np.where(self.differ(np.int64(1) << band) > 0, -(-self.segments(band) // 16), 0)


class Keys:
    """All keys of the sets of one group: arrays over the segments, then over the deletions."""

    def __init__(self, h: np.ndarray, off: np.ndarray, who: np.ndarray, bands: Bands):
        self.h, self.off, self.who, self.bands = h, off, who, bands

    @property
    def parts(self):
        """The keys in the sets' own bands, then those in the bands of their largest partners; made one after the other."""
        size = np.diff(self.off)[self.who]
        own = self.bands.band(size)
        for lift in (0, 1):
            band = own + lift
            take = np.flatnonzero((band <= self.bands.highest(size)) & (size > 0))
            if len(take):
                yield self._of_band(self.h, self.off, self.who[take], band[take], self.bands, lift)

    @staticmethod
    def _of_band(h, off, who, band, bands, lift):
        m, r = bands.segments(band), bands.reserve(band)
        first = np.cumsum(m) - m
        size = np.diff(off)[who]
        row = np.repeat(np.arange(len(who)), size)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size - off[:-1][who], size)
        token = splitmix(h[pos] * _A + np.uint64(1))
        segment = (splitmix(h[pos] + _B) % m[row].astype(np.uint64)).astype(np.int64)
        at = first[row] + segment
        total = np.zeros(m.sum(), np.uint64)
        np.add.at(total, at, token)
        count = np.bincount(at, minlength=len(total))
        seg_row = np.repeat(np.arange(len(who)), m)
        seg_no = np.arange(len(total)) - first[seg_row]
        salt = splitmix((band[seg_row] << 32 | seg_no).astype(np.uint64) + _B)
        full = splitmix(total + salt)
        spare = segment >= (m - r)[row]
        gone = splitmix(total[at[spare]] - token[spare] + salt[at[spare]])
        return {
            "lift": lift, "who": who, "band": band, "m": m, "first": first, "full": full, "row": seg_row, "no": seg_no, "count": count,
            "gone": gone, "gone_at": at[spare], "gone_row": row[spare], "reserve": seg_no >= (m - r)[seg_row],
        }


def code_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Shard in the high half, 32 more bits of the key in the low half."""
    return ((key % np.uint64(shards)) << np.uint64(32)) | (key >> np.uint64(32))


def group_sets(docs: list[bytes], words: int):
    """Sets of a group: flat hashes, offsets, two 64-bit digests of each set."""
    h, off = shingle_sets(docs, words)
    size = np.diff(off)
    total = np.r_[np.uint64(0), np.cumsum(splitmix(h * _A + np.uint64(1)))]
    other = np.r_[np.uint64(0), np.cumsum(splitmix(h * _B + np.uint64(7)))]
    one = splitmix(total[off[1:]] - total[off[:-1]] + size.astype(np.uint64))
    two = splitmix(other[off[1:]] - other[off[:-1]])
    return h, off, one.view(np.int64), two.view(np.int64)


def first_of_each(ids: list, off: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each row the first one (smallest id) of its group with the same set; -1 without a set or an id."""
    seen: dict[tuple, int] = {}
    out = np.full(len(ids), -1, np.int64)
    for i, same in enumerate(zip(one.tolist(), two.tolist())):
        if ids[i] is not None and off[i + 1] > off[i]:
            out[i] = seen.setdefault(same, i)
    return out


def leaders(first: np.ndarray) -> np.ndarray:
    return np.flatnonzero(first == np.arange(len(first)))


def _send_keys(words: int, bands: Bands, shards: int):
    """Group -> (shard, grp, keys, counts): every key of its sets, with how many sets hold it."""

    def send(t: pa.Table) -> pa.Table:
        ids, docs = read_group(t)
        h, off, one, two = group_sets(docs, words)
        del docs
        every = [np.zeros(0, np.uint64)]
        for p in Keys(h, off, leaders(first_of_each(ids, off, one, two)), bands).parts:
            every += [code_of(p["full"], shards), code_of(p["gone"], shards)]
            del p
        code, n = np.unique(np.concatenate(every), return_counts=True)
        del h, every
        shard, cols = packed({"keys": code.astype(np.uint32), "n": np.minimum(n, 65535).astype(np.uint16)}, (code >> np.uint64(32)).astype(np.int32))
        grp = t.column("grp")[0].as_py()
        return pa.table([pa.array(shard, pa.int32()), pa.array([grp] * len(shard), pa.int32()), pa.array(cols["keys"], pa.binary()), pa.array(cols["n"], pa.binary())], ["shard", "grp", "keys", "n"])

    return send


def _count_keys(t: pa.Table) -> pa.Table:
    """Shard -> (grp, shard, keys, n): the keys that more than one set holds, to each group that holds them."""
    key, lens = unpacked(t.column("keys"), np.uint32)
    n, _ = unpacked(t.column("n"), np.uint16)
    grp = np.repeat(t.column("grp").to_numpy(), lens)
    order = np.argsort(key, kind="stable")
    start, end = runs(key[order])
    total = np.add.reduceat(n[order].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    each = np.zeros(len(key), np.int64)
    each[order] = np.repeat(total, end - start)
    shared = each > 1
    to, cols = packed({"keys": key[shared], "n": np.minimum(each[shared], 0xFFFFFFFF).astype(np.uint32)}, grp[shared])
    shard = t.column("shard")[0].as_py()
    return pa.table([pa.array(to, pa.int32()), pa.array([shard] * len(to), pa.int32()), pa.array(cols["keys"], pa.binary()), pa.array(cols["n"], pa.binary())], ["grp", "shard", "keys", "n"])


def choose(cost: np.ndarray, extra: dict[int, int], need: int) -> tuple[np.ndarray, set[int]]:
    """Segments that get one unit (a mask) and those that get a second, for ``need`` units at about the least cost.

    ``cost`` is that of each segment's first unit, ``extra`` that of a second unit where there is one.
    """
    offers = []  # cost of a unit, kind, segment, units
    for j, c in enumerate(cost.tolist()):
        more = extra.get(j)
        if more is None or more >= c:
            offers.append((c, 0, j, 1))
            if more is not None:
                offers.append((more, 1, j, 1))
        else:  # the second unit is the cheaper one, but needs the first
            offers.append(((c + more) / 2, 2, j, 2))
    one, second, units = np.zeros(len(cost), bool), set(), 0
    for _, kind, j, n in sorted(offers):
        if units >= need:
            break
        units += n
        one[j] = True
        if kind:
            second.add(j)
    return one, second


ANSWER = "kind int, shard int, doc_id long, n long, lead long, one long, two long, body binary, ids binary, ranks binary, flags binary"


def _choose_keys(words: int, bands: Bands, shards: int):
    """Group and its answers -> a row for each document (kind 0), the sets that can have a partner (kind 1), their shared keys (kind 2)."""

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, docs = read_group(left)
        h, off, one, two = group_sets(docs, words)
        del docs
        size = np.diff(off)
        first = first_of_each(ids, off, one, two)
        names = ("kind", "shard", "doc_id", "n", "lead", "one", "two")
        made = [(0, None, ids[d], int(size[d]), ids[first[d]] if first[d] >= 0 else None, int(one[d]), int(two[d])) for d in range(len(ids))]
        binary = {name: [None] * len(ids) for name in ("body", "ids", "ranks", "flags")}
        key, lens = unpacked(right.column("keys"), np.uint32)
        n, _ = unpacked(right.column("n"), np.uint32)
        code = (np.repeat(right.column("shard").to_numpy().astype(np.uint64), lens) << np.uint64(32)) | key
        order = np.argsort(code)
        code, n = code[order], n[order].astype(np.int64)
        del key, order

        def held(keys: np.ndarray) -> np.ndarray:
            """How many sets hold each key."""
            if not len(code):
                return np.ones(len(keys), np.int64)
            at = np.minimum(np.searchsorted(code, keys), len(code) - 1)
            return np.where(code[at] == keys, n[at], 1)

        sent: list[tuple] = []
        active: set[int] = set()
        typical = np.zeros(len(ids), np.int32)  # how much of a set others share, in its own band
        for p in Keys(h, off, leaders(first), bands).parts:
            full, gone = code_of(p["full"], shards), code_of(p["gone"], shards)
            cost, gone_cost = held(full) - 1, held(gone) - 1
            # A linked set agrees with its partner in all segments but H: fewer shared keys cannot be a link.
            near = np.bincount(p["row"], weights=cost > 0, minlength=len(p["who"]))
            own = size[p["who"]]
            largest = np.minimum(np.int64(1) << p["band"], 100 * own // bands.percent)  # of the possible partners
            may = near >= p["m"] - bands.differ(largest)
            flags = np.full(len(full), LOWER if p["lift"] else 0, np.uint8)
            gone_flags = np.full(len(gone), DELETED | (LOWER if p["lift"] else 0), np.uint8)
            if not p["lift"]:
                full_of = p["count"] > 0
                share = np.bincount(p["row"][full_of], weights=np.log2(1.0 + cost[full_of]), minlength=len(p["who"]))
                typical[p["who"]] = 1000 * share / np.maximum(np.bincount(p["row"][full_of], minlength=len(p["who"])), 1)
                by_row = np.argsort(p["gone_row"], kind="stable")
                gone_first = np.searchsorted(p["gone_row"][by_row], np.arange(len(p["who"]) + 1))
                for row in np.flatnonzero(may).tolist():
                    a, b = p["first"][row], p["first"][row] + p["m"][row]
                    mine = by_row[gone_first[row] : gone_first[row + 1]]
                    extra = dict.fromkeys(p["no"][a:b][p["reserve"][a:b]].tolist(), 0)
                    for g in mine.tolist():
                        extra[int(p["no"][p["gone_at"][g]])] += int(gone_cost[g])
                    unit, second = choose(cost[a:b], extra, int(bands.differ(size[p["who"][row]])) + 1)
                    flags[a:b][unit] |= CHOSEN
                    for g in mine.tolist():
                        if int(p["no"][p["gone_at"][g]]) in second:
                            gone_flags[g] |= CHOSEN
            for keys, cost_, row, flag in ((full, cost, p["row"], flags), (gone, gone_cost, p["gone_row"], gone_flags)):
                take = (cost_ > 0) & may[row]
                if take.any():
                    doc = p["who"][row[take]]
                    active.update(np.unique(doc).tolist())
                    sent.append((keys[take], doc, flag[take]))
            # the keys of one part are let go before the next is made
            del p, full, gone, cost, gone_cost, flags, gone_flags, keys, cost_, row, flag
        for d in sorted(active):
            made.append((1, None, ids[d], int(size[d]), ids[d], int(one[d]), int(two[d])))
            for name in binary:
                binary[name].append(h[off[d] : off[d + 1]].tobytes() if name == "body" else None)
        if sent:
            keys, doc, flag = (np.concatenate(x) for x in zip(*sent))
            who = np.array([i or 0 for i in ids], np.int64)[doc]
            shard, cols = packed({"body": keys, "ids": who, "ranks": typical[doc], "flags": flag}, (keys >> np.uint64(32)).astype(np.int32))
            grp = left.column("grp")[0].as_py() if left.num_rows else None
            for k in range(len(shard)):
                made.append((2, int(shard[k]), grp, None, None, None, None))  # kind 2 names its group where others have an id
                for name in binary:
                    binary[name].append(cols[name][k])
        kinds = {"kind": pa.int32(), "shard": pa.int32()}
        plain = zip(names, zip(*made) if made else [()] * len(names))
        return pa.table({name: pa.array(v, kinds.get(name, pa.int64())) for name, v in plain} | {name: pa.array(v, pa.binary()) for name, v in binary.items()})

    return answer


def _pairs_table(pairs: np.ndarray) -> pa.Table:
    return pa.table([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def _centres(key: np.ndarray, ids: np.ndarray, rank: np.ndarray, flag: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each key the most typical holder (ties to the smaller id), its rank, all flags together, and the holders."""
    order = np.lexsort((ids, -rank, key))
    start, end = runs(key[order])
    if not len(start):
        return tuple(x[:0] for x in (key, ids, rank, flag, n))
    return key[order][start], ids[order][start], rank[order][start], np.bitwise_or.reduceat(flag[order], start), np.add.reduceat(n[order], start)


KINDS = {"body": np.uint64, "ids": np.int64, "ranks": np.int32, "flags": np.uint8, "holders": np.int64}


def _own_centres(batches):
    """Rows of (shard, grp, keys and holders) -> the same with one entry a key."""
    for batch in batches:
        out = {name: [] for name in KINDS}
        for row in batch.to_pylist():
            cols = [np.frombuffer(row[name], kind) for name, kind in list(KINDS.items())[:4]]
            for name, values in zip(KINDS, _centres(*cols, np.ones(len(cols[0]), np.int64))):
                out[name].append(values.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("grp"), *(pa.array(v, pa.binary()) for v in out.values())], ["shard", "grp", *KINDS])


def _all_centres(t: pa.Table) -> pa.Table:
    """Shard -> (shard, grp, keys, leads): to each group the centres of its keys that are chosen and that several sets hold."""
    key, lens = unpacked(t.column("body"), np.uint64)
    ids, rank, flag, n = (unpacked(t.column(name), kind)[0] for name, kind in list(KINDS.items())[1:])
    grp, shard = np.repeat(t.column("grp").to_numpy(), lens), t.column("shard")[0].as_py()
    of, lead, _, flags, holders = _centres(key, ids, rank, flag, n)
    at = np.searchsorted(of, key)
    held = ((flags & CHOSEN) > 0) & (holders > 1)
    take = held[at] if len(of) else np.zeros(0, bool)
    to, cols = packed({"keys": key[take], "leads": lead[at[take]]}, grp[take])
    return pa.table([pa.array([shard] * len(to), pa.int32()), pa.array(to, pa.int64()), pa.array(cols["keys"], pa.binary()), pa.array(cols["leads"], pa.binary())], ["shard", "grp", "keys", "leads"])


def _members(held: pa.Table, found: pa.Table) -> pa.Table:
    """A group's keys with their holders, and the centres of its chosen keys -> (a, b): holder and centre, each pair once."""
    (key, _), (ids, _) = unpacked(held.column("body"), np.uint64), unpacked(held.column("ids"), np.int64)
    (keys, _), (leads, _) = unpacked(found.column("keys"), np.uint64), unpacked(found.column("leads"), np.int64)
    if not len(keys):
        return _pairs_table(np.zeros((0, 2), np.int64))
    order = np.argsort(keys)
    keys, leads = keys[order], leads[order]
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    take = keys[at] == key
    a, b = ids[take], leads[at[take]]
    del key, ids, keys, leads, at
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return _pairs_table(np.c_[a[fresh], b[fresh]])


def clusters_of(made: DataFrame) -> DataFrame:
    """(a, b): the holders a of each chosen key with the most typical holder b, from the key rows of ``ANSWER``.

    All keys of a group meet their centres in one task, so a holder and a
    centre that share many keys are one row, whatever the number of shards
    and batches.
    """
    held = made.where("kind = 2").select("shard", F.col("doc_id").alias("grp"), "body", "ids", "ranks", "flags")
    own = held.mapInArrow(_own_centres, "shard int, grp long, body binary, ids binary, ranks binary, flags binary, holders binary")
    found = own.groupBy("shard").applyInArrow(releasing(_all_centres), "shard int, grp long, keys binary, leads binary")
    return held.select("grp", "body", "ids").groupBy("grp").cogroup(found.select("grp", "keys", "leads").groupBy("grp")).applyInArrow(releasing(_members), "a long, b long")


def _verify(percent: int):
    """(b, part) -> the links between b's sets and the others, counted on the whole sets."""

    def verify(t: pa.Table) -> pa.Table:
        b = t.column("b")[0].as_py()
        ids = t.column("doc_id").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in t.column("body").to_pylist()]
        lead = [s for i, s in zip(ids, sets) if i == b]
        linked = set()
        for i, s in zip(ids, sets):
            if i != b:
                for c in lead:
                    if 100 * min(len(s), len(c)) >= percent * max(len(s), len(c)):
                        at = np.minimum(np.searchsorted(c, s), len(c) - 1)
                        both = int((c[at] == s).sum())
                        if 100 * both >= percent * (len(s) + len(c) - both):
                            linked.add(i)
        return pa.table([pa.array(sorted(linked), pa.int64()), pa.array([b] * len(linked), pa.int64())], ["a", "b"])

    return verify


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links. A very common b meets its partners in several tasks of at most about ``MEMBERS``."""
    parts = keep(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts")))
    asked = pairs.join(parts, "b").select(F.col("a").alias("doc_id"), "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    leads = parts.select(F.col("b").alias("doc_id"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    shipped = asked.unionByName(leads).join(sets.select("doc_id", "body"), "doc_id")
    return shipped.groupBy("b", "part").applyInArrow(releasing(_verify(percent)), "a long, b long")


def _ask(percent: int):
    """A block of askers and one of members -> links between them across components."""

    def ask(t: pa.Table) -> pa.Table:
        ids, part = t.column("doc_id").to_numpy(), t.column("component").to_numpy()
        asks = t.column("asks").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("body").to_pylist()]
        members = np.flatnonzero(~asks)
        out = []
        if len(members):
            size = np.array([len(sets[k]) for k in members], np.int64)
            token = np.concatenate([sets[k] for k in members])
            owner = np.repeat(np.arange(len(members)), size)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            for k in np.flatnonzero(asks).tolist():
                lo, hi = np.searchsorted(token, sets[k]), np.searchsorted(token, sets[k], side="right")
                n = hi - lo
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)
                both = np.bincount(owner[at], minlength=len(members))
                linked = (100 * both >= percent * (size + len(sets[k]) - both)) & (part[members] != part[k])
                out += [(ids[k], ids[m]) for m in members[linked].tolist()]
        return _pairs_table(np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0))

    return ask


def asked(clusters: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found when members outside a cluster's largest component ask the other members.

    Sizes fall into classes so wide that linked sets are in the same or in
    neighbouring ones; members and askers of a class are dealt into blocks of
    about ``BLOCK``, and each block of askers meets each block of members of
    the three classes.
    """
    held = keep(clusters.select(F.col("a").alias("doc_id"), "b").join(labels, "doc_id"))
    sizes = held.groupBy("b", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("b").agg(F.max(F.struct("n", (-F.col("component")).alias("c"))).alias("m"), F.count(F.lit(1)).alias("parts"))
    main = main.where("parts > 1").select("b", (-F.col("m.c")).alias("largest"))
    step = math.log(100 / percent) if percent < 100 else math.log(1.01)
    band = F.floor(F.log(F.octet_length("body") / 8) / step).cast("int")
    open_ = held.join(keep(main), "b").join(sets.select("doc_id", band.alias("band")), "doc_id")
    open_ = keep(open_.withColumn("asks", F.col("component") != F.col("largest")))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    counts = keep(open_.groupBy("b", "band").agg(blocks(F.count(F.lit(1))).alias("parts"), blocks(F.count_if("asks")).alias("ask_parts"), F.count_if("asks").alias("asking")))
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    # blocks of members: each goes to every block of askers of its own class and of the neighbouring ones
    askers = counts.where("asking > 0").select("b", near.alias("band"), F.col("band").alias("ask_band"), "ask_parts")
    own = open_.join(counts.select("b", "band", "parts"), ["b", "band"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    members = own.join(askers, ["b", "band"]).select("doc_id", "component", "b", "band", "part", "ask_band", F.explode(F.sequence(F.lit(0), F.col("ask_parts") - 1)).alias("ask_part"), F.lit(False).alias("asks"))
    # blocks of askers: each goes to every block of members of the three classes
    ask = open_.where("asks").join(counts.select("b", "band", "ask_parts"), ["b", "band"])
    ask = ask.withColumn("ask_part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("ask_parts")).cast("int")).withColumnRenamed("band", "ask_band").select("doc_id", "component", "b", "ask_band", "ask_part", F.explode(F.array(F.col("ask_band") - 1, F.col("ask_band"), F.col("ask_band") + 1)).alias("band"))
    asking = ask.join(counts.select("b", "band", "parts"), ["b", "band"]).select("doc_id", "component", "b", "band", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "ask_band", "ask_part", F.lit(True).alias("asks"))
    shipped = members.unionByName(asking).join(sets, "doc_id")
    return shipped.groupBy("b", "band", "part", "ask_band", "ask_part").applyInArrow(releasing(_ask(percent)), "a long, b long")


def join_classes(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_shingles, component_id: the smallest id reachable by links."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    bands = Bands(percent)
    groups, n = dealt(docs)
    keys = groups.groupBy("grp").applyInArrow(releasing(_send_keys(words, bands, n)), "shard int, grp int, keys binary, n binary")
    shared = keys.groupBy("shard").applyInArrow(releasing(_count_keys), "grp int, shard int, keys binary, n binary")
    made = keep(groups.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(releasing(_choose_keys(words, bands, n)), ANSWER))

    # Equal sets are one class, named by its smallest id; a group sends one row of each.
    rows = made.where("kind = 0").select("doc_id", "n", "lead", "one", "two")
    classes = rows.where("doc_id = lead").groupBy("one", "two").agg(F.min("doc_id").alias("rep"))
    leads = keep(rows.where("doc_id = lead").select("lead", "one", "two").distinct().join(classes, ["one", "two"]))
    sets = made.where("kind = 1")  # the sets that may have a partner
    name = keep(sets.select("doc_id", "one", "two").join(classes, ["one", "two"]).select("doc_id", "rep"))
    sets = sets.select("doc_id", "body")

    found = clusters_of(made)
    left, right = name.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra")), name.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb"))
    clusters = keep(found.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())  # the centre is a member too
    links = keep(verified(clusters.where("a <> b"), sets, percent))
    parts = keep(components(links))
    labels = name.select(F.col("rep").alias("node")).distinct().join(parts, "node", "left").select(F.col("node").alias("doc_id"), F.coalesce("component", "node").alias("component"))
    more = keep(asked(clusters, labels, sets, percent))
    if not more.isEmpty():
        parts = keep(components(links.unionByName(more)))

    named = leads.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("lead", "one", "two", F.coalesce("component", "rep").alias("component"))
    out = rows.join(named, ["lead", "one", "two"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    return join_classes(table(spark, sf_dir, "documents"))
