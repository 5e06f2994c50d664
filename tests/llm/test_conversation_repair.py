"""Operator 13 against a shortest-path search over whole conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftcheck.llm.conversation_repair import END, KEPT, damaged, edits_of, op13_conversation_repair, repair, repaired_turns, step, traced

NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def brute(rows):
    """Counts and least edits of one conversation's (turn, role, text) rows, by uniform-cost search over edit strings."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in rows if t is not None}
    faults, seen = [], set()
    for _, role, text in rows:
        found = NOT_SPACE.findall(text)
        faults.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    heap, done = [(0, "", 0, ())], set()
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        roles = "".join(o[0][:1] or "?" for o in out)
        if i == len(rows) and LEGAL.match(roles):
            break
        # what comes next depends on the row and the last role alone
        if (i, roles[-1:]) in done or (roles and not re.match(r"s?(ua)*u?\Z", roles)):
            continue
        done.add((i, roles[-1:]))
        for name in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, (*out, (name, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, out))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, (*out, (role, text))))
                for name in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, (*out, (name, text))))
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest), out


def broken(conv, turn, role, text):
    """The damage of the contract to one row."""
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
    return [row] * (0 if kind == 0 else 2 if kind == 3 else 1)


def conversations(seed, n=60, most=14):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for _ in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No!", "and then", "", " \n\t", "a? ", "Yes.", "ü", None, "what.\n", "x:y"])
            rows.append((conv, rng.choice([None, *range(12)]), role, text))
    return rows


def expected(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(row)
    return {conv: brute(rows)[0] for conv, rows in groups.items()}


def result(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 1024])
def test_equals_the_search(spark, chunk_rows):
    rows = conversations(chunk_rows)
    got = result(repair(spark.createDataFrame(rows, SCHEMA).repartition(5), chunk_rows=chunk_rows))
    assert got == expected(rows)


def test_query_over_a_table(spark, tmp_path):
    dropped = next(i for i in range(1000, 2000) if not broken(i, 0, "user", "Hi."))
    rows = [*conversations(77, n=120), (dropped, 0, "user", "Hi.")]
    extra = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA + ", audit string, chunk int, conv string")
    extra.write.parquet(f"{tmp_path}/conversations.parquet")
    after = {}
    for r in rows:
        after.setdefault(r[0], []).extend(broken(*r))
    want = {conv: brute(rows)[0] for conv, rows in after.items()}
    assert result(op13_conversation_repair(spark, str(tmp_path))) == want
    assert want[dropped][1:] == (0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_whole_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = {}
    for r in rows:
        after.setdefault(r[0], []).extend(broken(*r))
    assert result(op13_conversation_repair(spark, "/root/testdata/sf0.001")) == {conv: brute(rows)[0] for conv, rows in after.items()}


def long_conversation(n):
    """Stretches that let every cost vector through: blank rows, system rows, other roles; then ordinary ones."""
    kinds = [("user", " "), ("system", "Go on."), ("tool", "done"), ("user", "Why?"), ("assistant", "So."), ("assistant", "cut")]
    rows, turn = [], 0
    for k in (0, 1, 2, 0, 3, 4, 1, 5, 2, 3, 0):
        for i in range(n):
            rows.append((turn, kinds[k][0], kinds[k][1] if k == 0 else f"{turn} {kinds[k][1]}"))
            turn += 2 if i == 3 else 1
    return rows


def sequential(rows):
    """The same edits by one walk over the rows, without chunks."""
    faults, seen, symbols = [], set(), []
    for _, role, text in rows:
        found = NOT_SPACE.findall(text)
        bad = not found or (role, text) in seen
        seen.add((role, text))
        symbols.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + (4 if bad else 8 if found[-1] not in ".!?" else 0))
        faults.append(bad)
    x, cost, audit = 0, 0, ""
    for edits in edits_of(bytes(symbols), END):
        letters, x, price = edits[x]
        audit, cost = audit + letters, cost + price
    return cost + (2 if x == 2 else 4 if x == 1 else 0), audit + ("I" if x == 2 else "II" if x == 1 else "")


def test_a_conversation_of_many_chunks(spark):
    rows = long_conversation(97)
    cost, audit = sequential(rows)
    df = spark.createDataFrame([(1, *r) for r in rows] + [(2, 0, "user", "Hi.")], SCHEMA).repartition(7)
    got = {r.conv_id: r for r in repair(df, chunk_rows=8).collect()}
    assert (got[1].cost, got[1].audit) == (cost, audit)
    assert got[2].audit == "KI" and got[2].cost == 2
    short = brute(rows[:150])
    assert sequential(rows[:150]) == (short[0][5], short[0][6])


def test_repaired_rows_are_lawful(spark):
    df = spark.createDataFrame(conversations(5), SCHEMA)
    rows = repaired_turns(traced(df, chunk_rows=3)).orderBy("conv", "chunk", "pos").collect()
    by = {}
    for r in rows:
        by.setdefault(r.conv, []).append(r.role[:1])
    assert by and all(LEGAL.match("".join(x)) for x in by.values())


def test_a_row_repeated_very_often(spark):
    df = spark.range(5000).selectExpr("7L conv_id", "1L turn", "'user' role", "'Hello.' text")
    r = repair(df).collect()[0]
    assert (r.duplicate, r.illegal, r.gaps, r.cost, r.audit) == (4999, 4999, 0, 3 * 4999 + 2, "K" + "D" * 4999 + "I")


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair(none).collect() == []
    ids = spark.createDataFrame([(3,), (None,), (3,)], "conv_id long")
    assert sorted(map(tuple, repair(damaged(none), ids).collect()), key=str) == sorted([(i, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in (3, None)], key=str)


def test_a_very_long_text(spark):
    text = "word " * 600_000 + "end."
    rows = [(1, 0, "user", text), (1, 1, "assistant", "Yes."), (1, 2, "user", text[:-1]), (1, 3, "assistant", "No.")]
    assert result(repair(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list(range(16))), max_size=12))
def test_vectors_stay_bounded(symbols):
    after = END
    for s in symbols:
        after, edits = step(after, s)
        assert min(after) == 0 and max(after) <= 16 and all(e[0][-1] in "DKR" for e in edits)
    assert len(KEPT) == 5
