"""Operator 13: conversation structure repair by a rank-convergence parallel Viterbi.

The cheapest edits that turn a conversation's roles into ``(s?(ua)+)?`` are a
shortest path over four states (nothing yet, after system, after user, after
assistant). A chunk of rows maps the cost vector behind it to the one before
it. All chunks start at once from a speculative vector (that of a conversation's
end); fix-up passes rerun a chunk from what its neighbour really gave until the
old and the new vector differ only by a constant, from where on nothing changes.
Tracing runs the other way in the same manner: with the stitched backward costs
each state has one least edit, chunks start from a speculative state and are
rerun until both paths meet. Fix-up pass ``k`` walks stretches of 16^(k-1)
chunks, so that rows that pass everything on (a run of blank rows, say) need
few passes too.

Rows reach their chunks by a range partitioning on (conversation, turn, role,
text): a conversation of any length spreads over tasks. Equal rows are counted
beforehand. Only audit and SHA-256 of a conversation of several chunks meet in
one task, which streams the chunks in order: the first is one value of the
result, the second can only be computed in order.

Defined cases: a null role or text counts as one space; a null conversation id
is a conversation of its own; null turns come first and count in no gap; rows
of one turn go by role, then text; a blank row is never a duplicate, a role
that starts with no letter of s, u, a can only be deleted or reroled; a role's
first letter decides, case counts; ids without rows get zeros, an empty audit
and the hash of the empty string; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, prepare, table

CHUNK_ROWS = 1024
CHUNK_BYTES = 1 << 20
SPACES = " \t\n\x0b\x0c\r"

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
#: The one state that a user or assistant turn may lead to.
NEXT = (2, 2, 3, 2)
#: Initials by number (0: any other), and the state that a kept row leads to.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (3, USER): 2, (2, ASSISTANT): 3}
NAMES = {2: "user", 3: "assistant"}
DELETE, TRUNCATED = 4, 8
#: Costs behind the last row, and the letters that end a path there.
END = bytes((0, 4, 2, 0))
LAST = ("", "II", "I", "")


@lru_cache(maxsize=65_536)
def step(after: bytes, symbol: int) -> tuple[bytes, tuple]:
    """Cost vector before a row (its least is 0), and for each state the least edits: letters, next state, cost."""
    late = symbol >> 3 & 1
    here = []
    for x in range(4):
        ways = [(3 + after[x], "D", x, 3)]
        if not symbol & DELETE:
            if (y := KEPT.get((x, symbol & 3))) is not None:
                ways.append((late + after[y], "K", y, late))
            ways.append((2 + late + after[NEXT[x]], "R", NEXT[x], 2 + late))
        here.append(ways)
    eaten = [min(w[0] for w in ways) for ways in here]
    before = [min(eaten[x], 2 + eaten[NEXT[x]], 4 + eaten[NEXT[NEXT[x]]]) for x in range(4)]
    edits = []
    for x in range(4):
        letters, cost = "", 0
        while True:  # letters in ASCII order: D, I, K, R
            first = {w[1]: w for w in here[x] if w[0] == before[x]}
            if "D" not in first and 2 + before[NEXT[x]] == before[x]:
                letters, cost, x = letters + "I", cost + 2, NEXT[x]
                continue
            way = first[min(first)]
            edits.append((letters + way[1], way[2], cost + way[3]))
            break
    least = min(before)
    return bytes(b - least for b in before), tuple(edits)


def edits_of(symbols: bytes, after: bytes) -> list[tuple]:
    """The least edits of each state at each row, from the vector behind the last."""
    out = []
    for s in reversed(symbols):
        after, edits = step(after, s)
        out.append(edits)
    out.reverse()
    return out


def vector_before(row: dict, old: bytes | None, new: bytes) -> bytes:
    """The vector before a chunk; the one found from ``old`` once both differ only by a constant."""
    for s in reversed(row["symbols"]):
        if old == new:
            return row["left"]
        new = step(new, s)[0]
        old = step(old, s)[0] if old is not None else None
    return new


def state_after(row: dict, old: bytes | None, new: bytes) -> bytes:
    """The state that the least path leaves a chunk in; the one found from ``old`` once both paths meet."""
    x, y = new[0], old[0] if old is not None else None
    for edits in edits_of(row["symbols"], row["after"]):
        if x == y:
            return row["left"]
        x = edits[x][1]
        y = edits[y][1] if y is not None else None
    return bytes((x,))


def stitched(chunks: DataFrame, run, ahead: int, first: Column) -> DataFrame:
    """(..., came, left): what truly reaches each chunk from its neighbour and what leaves it.

    ``ahead`` is 1 where values flow to the next chunk, -1 to the one before;
    ``first`` is the value that each chunk starts from.
    """
    names = [c for c in chunks.columns if c not in ("came", "left")]
    schema = ", ".join(f"{c} {chunks.schema[c].dataType.simpleString()}" for c in names) + ", came binary, left binary"

    def work(batches):
        behind = left = None
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                here = (r["conv"], r["stretch"])
                new = left if here == behind else r["fresh"]
                if new is not None and new != r["came"]:
                    r["left"] = run(r, r["came"], new)
                    r["came"] = new
                behind, left = here, r["left"]
            arrays = [pa.array([r[c] for r in rows], batch.schema.field(c).type) for c in (*names, "came", "left")]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "came", "left"])

    none = F.lit(None).cast("binary")
    now = chunks.select(*names, none.alias("came"), none.alias("left"), first.alias("fresh"), F.col("chunk").alias("stretch"))
    width = 1
    while True:
        dealt = now.repartition("conv", "stretch").sortWithinPartitions("conv", "stretch", F.col("chunk") * ahead)
        done = keep(dealt.mapInArrow(work, schema))
        given = done.select("conv", (F.col("chunk") + ahead).alias("chunk"), F.col("left").alias("fresh"))
        now = done.join(given, ["conv", "chunk"], "left").withColumn("stretch", F.floor(F.col("chunk") / F.lit(width)))
        if now.where("fresh <> came").isEmpty():
            return done
        width *= 16


def _cut(chunk_rows: int, chunk_bytes: int):
    """Sorted rows of a partition -> its chunks."""

    def work(batches):
        part, conv, seq, held, before = TaskContext.get().partitionId(), None, 0, [], ""

        def chunk():
            blank = duplicate = truncated = 0
            last, illegal = before, 0
            for r in held:
                s, c = r["symbol"], r["copies"]
                blank += c if r["blank"] else 0
                duplicate += 0 if r["blank"] else c - 1 + (s >> 2 & 1)
                truncated += s >> 3 & 1
                initial = r["role"][:1]
                illegal += c - 1 + (last + initial not in ("su", "ua", "au") if last is not None else 0)
                last = initial
            return {
                "conv": conv, "part": part, "seq": seq, "symbols": bytes(r["symbol"] for r in held), "copies": [r["copies"] for r in held], "roles": [r["role"] for r in held],
                "texts": ["" if r["symbol"] & DELETE else r["text"] for r in held], "first": held[0]["role"][:1], "last": last, "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": illegal,
            }

        size, out, waiting = 0, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                new = r["conv"] != conv
                if held and (new or len(held) >= chunk_rows or size + len(r["text"]) > chunk_bytes):
                    out.append(chunk())
                    waiting += size
                    seq, before, held, size = seq + 1, held[-1]["role"][:1], [], 0
                if new:
                    conv, seq, before = r["conv"], 0, None
                held.append(r)
                size += len(r["text"])
                if len(out) >= 256 or waiting > 4 * chunk_bytes:
                    yield pa.RecordBatch.from_pylist(out, CHUNKS)
                    out, waiting = [], 0
        if held:
            out.append(chunk())
        if out:
            yield pa.RecordBatch.from_pylist(out, CHUNKS)

    return work


CHUNKS = pa.schema([
    ("conv", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("symbols", pa.binary()), ("copies", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("first", pa.string()), ("last", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
])
_CHUNKS = "conv string, part long, seq long, symbols binary, copies array<long>, roles array<string>, texts array<string>, first string, last string, blank long, duplicate long, truncated long, illegal long"


def _conv(column: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _rows(turns: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and their symbol."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select(_conv().alias("conv"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    counted = keep(rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")))
    # two rows say the same if their length, role and text read together are the same
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rank = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    again = keep(counted.groupBy("conv", said.alias("said")).agg(F.min(rank).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("conv", "said", "least"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    blank = trimmed == ""
    late = ~F.substring(trimmed, -1, 1).isin(".", "!", "?")
    seen = F.col("least").isNotNull() & ~F.col("least.turn").eqNullSafe(F.col("turn"))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    symbol = number + F.when(blank | seen, DELETE).when(late, TRUNCATED).otherwise(0)
    return counted.withColumn("said", said).join(again, ["conv", "said"], "left").select("conv", "turn", "role", "text", "copies", blank.alias("blank"), symbol.alias("symbol"))


def traced(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of ``turns`` (conv_id, turn, role, text) with their edits.

    conv, chunk (its place), total (chunks of the conversation), the counts of
    the faults, cost and audit of its part, roles and texts of its repaired rows.
    """
    spark = turns.sparkSession
    prepare(spark)
    rows = _rows(turns)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    chunks = keep(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut(chunk_rows, chunk_bytes), _CHUNKS))
    # place of each chunk: a row for each conversation and range, as many as ranges for a long one
    parts = chunks.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min_by("first", "seq").alias("first"), F.max_by("last", "seq").alias("last"))
    each = Window.partitionBy("conv")
    so_far = each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pair = F.concat(F.lag("last").over(each.orderBy("part")), "first")
    parts = parts.select("conv", "part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("offset"), F.sum("n").over(each).alias("total"), F.when(pair.isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0).alias("between"))
    placed = chunks.join(parts, ["conv", "part"]).withColumn("chunk", F.col("offset") + F.col("seq"))
    placed = placed.withColumn("illegal", F.col("illegal") + F.when(F.col("seq") == 0, F.col("between")).otherwise(0)).drop("part", "seq", "offset", "between", "first", "last")
    long = keep(placed.where("total > 1").select("conv", "chunk", "symbols"))
    if long.isEmpty():
        ready = placed.withColumn("after", F.lit(END)).withColumn("state", F.lit(bytes(1)))
    else:
        costs = stitched(long, vector_before, -1, F.lit(END)).select("conv", "chunk", "symbols", F.col("came").alias("after"))
        states = stitched(costs, state_after, 1, F.lit(bytes(1))).select("conv", "chunk", "after", F.col("came").alias("state"))
        ready = placed.join(states, ["conv", "chunk"], "left").withColumn("after", F.coalesce("after", F.lit(END))).withColumn("state", F.coalesce("state", F.lit(bytes(1))))
    return ready.mapInArrow(_trace, _TRACED)


TRACED = pa.schema([("conv", pa.string()), ("chunk", pa.int64()), ("total", pa.int64()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_TRACED = "conv string, chunk long, total long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles array<string>, texts array<string>"


def _trace(batches):
    """Chunks with true vector and state -> their edits and repaired rows."""
    for batch in batches:
        for k in range(batch.num_rows):  # a chunk holds up to CHUNK_BYTES of text
            r = batch.slice(k, 1).to_pylist()[0]
            x, cost, audit, roles, texts = r["state"][0], 0, [], [], []
            for edits, copies, role, text in zip(edits_of(r["symbols"], r["after"]), r["copies"], r["roles"], r["texts"]):
                letters, end, price = edits[x]
                for letter in letters:
                    if letter == "D":
                        continue
                    x = NEXT[x] if letter != "K" else end
                    roles.append(role if letter == "K" else NAMES[x])
                    texts.append("" if letter == "I" else text)
                audit.append(letters + "D" * (copies - 1))
                cost += price + 3 * (copies - 1)
                x = end
            if r["chunk"] == r["total"] - 1:
                for letter in LAST[x]:
                    x = NEXT[x]
                    roles.append(NAMES[x])
                    texts.append("")
                    audit.append(letter)
                    cost += 2
            out = {c: r[c] for c in ("conv", "chunk", "total", "blank", "duplicate", "truncated", "illegal")}
            yield pa.RecordBatch.from_pylist([out | {"cost": cost, "audit": "".join(audit), "roles": roles, "texts": texts}], TRACED)


def repaired_turns(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, pos, role, text): the repaired rows of :func:`traced`, in order of chunk and pos."""
    return chunks.select("conv", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row")).select("conv", "chunk", "pos", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


SUMS = ("blank", "duplicate", "truncated", "illegal", "cost")
_SUMMED = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _summed(batches):
    """Chunks in order -> a row for each conversation; holds one chunk, a hash and the audit so far."""
    conv = None
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            if r["conv"] != conv:
                if conv is not None:
                    out.append(done())  # noqa: F821
                conv, audit, digest, sums, begun = r["conv"], [], hashlib.sha256(), dict.fromkeys(SUMS, 0), False

                def done(conv=conv, audit=audit, digest=digest, sums=sums):
                    return {"conv": conv, **sums, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

            for c in SUMS:
                sums[c] += r[c]
            audit.append(r["audit"])
            if r["roles"]:
                digest.update(("\n" * begun + "\n".join(f"{a}:{b}" for a, b in zip(r["roles"], r["texts"]))).encode())
                begun = True
        if out:
            yield pa.RecordBatch.from_pylist(out, SUMMED)
    if conv is not None:
        yield pa.RecordBatch.from_pylist([done()], SUMMED)


SUMMED = pa.schema([("conv", pa.string()), *((c, pa.int64()) for c in SUMS), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def repair(turns: DataFrame, ids: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    ``turns`` has conv_id, turn, role, text; ``ids`` (conv_id) names the
    conversations to return, those of ``turns`` if it is not given.
    """
    prepare(turns.sparkSession)
    chunks = keep(traced(turns, chunk_rows, chunk_bytes))
    sole = chunks.where("total = 1").sortWithinPartitions("conv").mapInArrow(_summed, _SUMMED)
    split = chunks.where("total > 1").repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_summed, _SUMMED)
    numbers = turns.select(_conv().alias("conv"), F.col("turn").cast("long").alias("turn")).distinct().groupBy("conv")
    gaps = numbers.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    found = sole.unionByName(split).join(gaps, "conv")
    every = (turns if ids is None else ids).select("conv_id").distinct().withColumn("conv", _conv())
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *SUMS)]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return every.join(found, "conv", "left").select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the faults that the contract plants by crc32 of ``conv_id:turn``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(space("conv_id"), F.lit(":"), space("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``conversations``."""
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations.select("conv_id"))
