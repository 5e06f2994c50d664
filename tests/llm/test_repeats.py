"""Operator 5 and its suffix arrays against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftcheck.llm import repeats
from driftcheck.llm import suffix_array as suffixes
from driftcheck.llm.repeats import remove_repeats
from driftcheck.llm.suffix_array import by_doubling, permuted_prefixes, suffix_array


def naive(raw):
    return sorted(range(len(raw)), key=lambda i: raw[i:])


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=150), st.lists(st.sampled_from([0, 1, 7]), min_size=1, max_size=200).map(bytes)), st.integers(1, 3))
def test_suffix_array_and_prefixes(raw, times):
    raw = raw * times
    t = np.frombuffer(raw, np.uint8)
    want = naive(raw)
    assert suffix_array(t).tolist() == want and by_doubling(t).tolist() == want
    plcp = permuted_prefixes(t, np.array(want))
    for a, b in zip(want, want[1:]):
        n = 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        assert plcp[b] == n
    assert plcp[want[0]] == 0


def test_long_runs_and_copies():
    raw = b"a" * 3000 + b"ab" * 1500 + b"xyz" * 700 + b"a" * 3000
    t = np.frombuffer(raw, np.uint8)
    sa = suffix_array(t)
    assert sa.tolist() == naive(raw)
    plcp = permuted_prefixes(t, sa)
    for r in (1, 500, 3000, 9000):
        a, b = sa[r - 1], sa[r]
        n = int(plcp[b])
        assert raw[a : a + n] == raw[b : b + n] and raw[a + n : a + n + 1] != raw[b + n : b + n + 1]


def brute(rows, length=50):
    docs = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, d in docs:
        if i is not None:
            for p in range(len(d) - length + 1):
                w = d[p : p + length]
                least[w] = min(least.get(w, i), i)
    out = []
    for i, d in docs:
        gone = bytearray(len(d))
        if i is not None:
            for p in range(len(d) - length + 1):
                if least[d[p : p + length]] < i:
                    gone[p : p + length] = b"\1" * length
        left = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), len(d) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def removed(df, **kw):
    return sorted((tuple(r)[:5] for r in remove_repeats(df, **kw).collect()), key=str)


def pasted(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdeé \n") for _ in range(rng.randint(40, 160))) for _ in range(15)]
    rows = []
    for n in range(200):
        t = ""
        for _ in range(rng.randint(0, 5)):
            x = rng.random()
            if x < 0.5:
                t += rng.choice(passages)[rng.randint(0, 30) :]
            elif x < 0.6:
                t += "ab " * rng.randint(10, 60)
            elif x < 0.7:
                t += "z" * rng.randint(20, 200)
            else:
                t += "".join(rng.choice("qwertyuiop") for _ in range(rng.randint(1, 90)))
        rows.append((rng.randint(0, 180) if n < 190 else None, t))
    return rows + [(-5, rows[0][1]), (2000, rows[3][1] * 3), (rows[3][0], rows[3][1])]


@pytest.mark.parametrize("hot", [3, 512])
def test_pasted_passages(spark, hot):
    """Also where nearly every anchor counts as common."""
    rows = pasted(hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df, hot=hot) == brute(rows)


def test_passage_in_a_third_of_all(spark):
    rng = random.Random(9)
    passage = "this very passage of more than fifty bytes stands in a third of all texts"
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(60)) + (passage if i % 3 == 0 else "") + "".join(rng.choice("abcdefgh") for _ in range(60))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df, hot=50) == brute(rows)


def gathered(tables, by):
    """Rows of several tables, by a column."""
    t = pa.concat_tables(tables)
    return {k: t.filter(pa.compute.equal(t.column(by), k)) for k in set(t.column(by).to_pylist())}


def test_what_stands_beside_a_common_passage_is_not_sent(spark):
    """A passage longer than a block goes about once a group to the shards, whatever the number of documents that hold it."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, groups = word(6000), 4
    rows = [(i, word(120) + passage[: 6000 if i % 3 else 300] + word(120)) for i in range(80)]
    texts = {g: pa.table({"grp": pa.array([g] * 20, pa.int32()), "doc_id": [i for i, _ in rows[g::groups]], "text": [t for _, t in rows[g::groups]]}) for g in range(groups)}
    equal = pa.table({"digest": pa.array([], pa.string()), "first": pa.array([], pa.int64())})
    found = gathered([repeats._send_anchors(50, groups)(t, equal) for t in texts.values()], "shard")
    answers = gathered([repeats._shared_anchors(20)(t) for t in found.values()], "grp")
    sent = []
    for g, t in texts.items():
        right = answers[g].append_column("digest", pa.nulls(answers[g].num_rows, pa.string())).append_column("first", pa.nulls(answers[g].num_rows, pa.int64()))
        sent.append(repeats._send_stretches(50, groups)(t, right))
    bodies = [x for t in sent for x, k in zip(t.column("body").to_pylist(), t.column("key").to_pylist()) if k >= 0]
    assert sum(map(len, bodies)) < 2 * groups * len(passage)
    decided = gathered([repeats._decide(50, groups)(t) for t in gathered(sent, "key").values()], "grp")
    sent = [repeats._send_common(50, groups)(t) for t in decided.values()]
    bodies = [x for t in sent for x, k in zip(t.column("body").to_pylist(), t.column("key").to_pylist()) if k >= 0]
    assert len(passage) <= sum(map(len, bodies)) < 2 * groups * len(passage)
    assert not any(t[:100].encode() in b"".join(bodies) for _, t in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df, hot=20) == brute(rows)


def test_shard_sorted_in_parts(monkeypatch):
    """A shard of many owners gives the same whether its stretches are sorted at once or in parts."""
    rng = random.Random(8)
    out = repeats.Outbox(3, 50, 1)
    for k in range(40):
        text = bytes(rng.choice(b"abcdef ") for _ in range(90))
        code = out.codes(np.array([k], np.uint64))[0]
        for row in range(3):
            out.stretch(code, text[5 * row :], 10 + row if row else 10 + k, 100 * k + row, 7)
    t = out.table()
    t = t.filter(pa.compute.greater_equal(t.column("key"), 0))
    sorts, starts = [], repeats.repeated_starts
    monkeypatch.setattr(repeats, "repeated_starts", lambda raw, *a: sorts.append(len(raw)) or starts(raw, *a))
    whole = repeats._decide(50, 1)(t)
    assert len(sorts) == 1
    monkeypatch.setattr(repeats, "PART", 1000)
    parts = repeats._decide(50, 1)(t)
    assert len(sorts) > 5 and sum(sorts[1:]) == sorts[0]
    assert parts.equals(whole) and parts.num_rows == 1


def test_common_strings_beside_rare_ones(spark):
    """Common passages that overlap, parts of them, repeated ids and a passage twice in a document."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    passages = [word(n) for n in (49, 50, 51, 70, 200, 5000)]
    rows = []
    for i in range(150):
        p = rng.choice(passages)
        a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p)))) if i % 4 == 0 else (0, len(p))
        rows.append((rng.randint(0, 120), word(rng.randint(0, 60)) + p[a:b] + word(rng.choice((0, 30))) + rng.choice(passages)[:90] + p[a:b]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df, hot=8) == removed(df) == brute(rows)


def test_reduced_strings_of_many_names_are_not_induced(monkeypatch):
    """An induction goes through the buckets one by one: a reduced string must have many suffixes in each."""
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    raw = np.frombuffer(" ".join(rng.choice(words) for _ in range(2000)).encode(), np.uint8)
    seen, induce = [], suffixes.induce
    monkeypatch.setattr(suffixes, "induce", lambda t, s, lms, k: seen.append((len(t), k)) or induce(t, s, lms, k))
    assert suffix_array(raw).tolist() == naive(raw.tobytes())
    assert [x for x in seen if x[0] == len(raw)] and all(n >= 100 * k for n, k in seen if n < len(raw))
    seen.clear()
    raw = np.frombuffer(b"ab" * 3000 + b"abc" * 2000, np.uint8)  # few names: induced as before
    assert suffix_array(raw).tolist() == naive(raw.tobytes())
    assert any(n < len(raw) for n, _ in seen)


def test_edge_texts(edge_documents, edge_rows):
    rows = [r for r in edge_rows if r[0] not in (11, 12)]  # brute force cannot hold the very long ones
    assert removed(edge_documents.where("doc_id is null or doc_id not in (11, 12)")) == brute(rows)


def test_very_long_copy(edge_documents, edge_rows):
    got = {r.doc_id: r for r in remove_repeats(edge_documents, carry=("source", "score")).where("doc_id in (11, 12)").collect()}
    texts = dict(edge_rows[10:12])
    assert got[11].n_removed == 0 and bytes(got[11].kept) == texts[11].encode()
    assert bytes(got[12].kept) != texts[12].encode() and got[12].n_spans >= 1 and got[12].row.score == "x"


def test_no_documents(no_documents):
    assert remove_repeats(no_documents).collect() == []


def test_spans_and_kept_bytes(sf_documents):
    text = {r.doc_id: r.text.encode() for r in sf_documents.collect()}
    for r in remove_repeats(sf_documents).collect():
        left, done = b"", 0
        for s in r.spans:
            left += text[r.doc_id][done : s.start]
            done = s.end
        left += text[r.doc_id][done:]
        assert left == bytes(r.kept) and len(r.spans) == r.n_spans
