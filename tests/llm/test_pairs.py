"""Operators 7 and 8 against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from driftcheck.llm.blocks import components
from driftcheck.llm.fingerprint import compare_edited, likeness, pack, sketch, unpack
from driftcheck.llm.jaccard_join import CHOSEN, Bands, choose, clusters_of, join_classes
from driftcheck.llm.shingles import shingle_sets


def shingles(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_classes(rows, percent=75):
    """(doc_id, n_shingles) -> component of each row, over all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for k, s in enumerate(sets):
        if rows[k][0] is None:
            continue
        for j, both in Counter(j for x in s for j in holders[x] if j < k).items():
            if rows[j][0] is not None and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k)) if i is not None else None) for k, (i, _) in enumerate(rows)), key=str)


def classes(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join_classes(df, **kw).collect()), key=str)


def mutated(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        n = rng.choice([1, 3, 4, 5, 6, 7, 8, 9, 12, 16, 25, 60, 150])
        base = [rng.choice(words) for _ in range(n)]
        for _ in range(rng.randint(1, 9)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, n // 12))):
                k = rng.randrange(len(t))
                op = rng.random()
                t[k : k + 1] = [rng.choice(words)] if op < 0.4 else ([t[k], rng.choice(words)] if op < 0.7 or len(t) == 1 else [])
            rows.append((len(rows) * 3, " ".join(t)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [60, 75])
def test_classes_of_mutated_texts(spark, percent):
    rows = mutated(percent)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(df, percent=percent) == brute_classes(rows, percent)


def test_classes_of_edge_texts(edge_documents, edge_rows):
    assert classes(edge_documents) == brute_classes(edge_rows)


def test_classes_of_no_documents(no_documents):
    assert classes(no_documents) == []


def test_classes_of_documents(spark, sf_documents):
    rows = [(r.doc_id, r.text) for r in sf_documents.collect()]
    assert classes(sf_documents) == brute_classes(rows)


def test_hot_group_of_copies_and_near_copies(spark):
    """A third of the rows are copies, a third near copies of one text."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(base)) for i in range(150)]
    for i in range(150, 300):
        t = list(base)
        t[rng.randrange(80)] = f"edit{i}"
        rows.append((i, " ".join(t)))
    rows += [(i, " ".join(f"x{rng.randrange(9999)}" for _ in range(60))) for i in range(300, 450)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(df) == brute_classes(rows)


def test_bound_on_the_difference():
    """No similar pair differs in more elements than the bands allow for."""
    for percent in (60, 75, 90):
        bands = Bands(percent)
        for large in range(1, 120):
            for small in range(1, large + 1):
                for both in range(small + 1):
                    if 100 * both >= percent * (large + small - both):
                        assert large + small - 2 * both <= bands.differ(large)
                        assert bands.band(np.array(large)) <= bands.highest(np.array(small))


def test_choose_gives_all_units():
    rng = random.Random(2)
    for _ in range(200):
        m = rng.randint(1, 20)
        cost = np.array([rng.randint(0, 50) for _ in range(m)])
        extra = {j: rng.randint(0, 50) for j in range(m - m // 4, m)}
        need = rng.randint(1, m)
        one, second = choose(cost, extra, need)
        assert one.sum() + len(second) >= need and all(one[j] for j in second)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    tied = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in tied}


def test_likeness_estimates_jaccard():
    rng = random.Random(5)
    pairs = []
    for keep in (0.0, 0.3, 0.6, 0.9, 1.0):
        a = [f"w{rng.randrange(10**6)}" for _ in range(600)]
        k = int(keep * 600)
        pairs.append((" ".join(a), " ".join(a[:k] + [f"v{rng.randrange(10**6)}" for _ in range(600 - k)])))
    left, right = (pack(*sketch([p[i].encode() for p in pairs])) for i in (0, 1))
    for (a, b), j in zip(pairs, likeness(left, right)):
        x, y = shingles(a), shingles(b)
        assert abs(j - len(x & y) / len(x | y)) < 0.1
    short = pack(*sketch([b"a b", b"A B", b"a c", b"", b" "]))
    assert short[0] == short[1] and short[3] == short[4] == ""
    assert likeness([short[0], short[3], short[0]], [short[1], short[4], short[3]]).tolist() == [1, 1, 0]
    assert likeness([short[0]], [short[2]])[0] < 0.2


def test_few_shingles_agree_by_chance_alone():
    """Disjoint texts of one to eight shingles look no more alike than long ones; a standard error of 512 bins of 4 bits is 0.011."""
    rng = random.Random(8)
    for n in (1, 2, 4, 8, 300):
        words = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n + 4)).encode()
        pairs = [(words(), words()) for _ in range(2000 if n < 300 else 200)]
        found = likeness(*(pack(*sketch([p[k] for p in pairs])) for k in (0, 1)))
        assert found.max() < 0.06, n
        raw = (unpack(pack(*sketch([p[0] for p in pairs[:200]])))[0] == unpack(pack(*sketch([p[1] for p in pairs[:200]])))[0]).mean(axis=1)
        assert abs(np.mean(raw) - 1 / 16) < 0.004 and np.std(raw) < 0.02, n
    # few shared shingles among few: the estimate follows their share
    for n, both in ((4, 2), (8, 4), (8, 6)):
        made, true = [], []
        for _ in range(300):
            common = [f"c{rng.randrange(10**9)}" for _ in range(both + 4)]
            made.append([" ".join([*common, *(f"x{rng.randrange(10**9)}" for _ in range(n - both))]) for _ in range(2)])
            x, y = map(shingles, made[-1])
            true.append(len(x & y) / len(x | y))
        errors = likeness(*(pack(*sketch([m[k].encode() for m in made])) for k in (0, 1))) - true
        assert abs(np.mean(errors)) < 0.05, (n, both)


def test_texts_without_spaces():
    """One word is one shingle: half of it replaced leaves another text altogether."""
    a, b = "日本語の文章は空白を含まないことが多い。" * 20, "中文文本通常也不包含任何空格字符。" * 20
    edited = a[: len(a) // 2] + b[: len(a) // 2]
    prints = pack(*sketch([x.encode() for x in (a, edited, b, a)]))
    assert likeness([prints[0]] * 3, prints[1:]).tolist()[:2] < [0.06, 0.06] and likeness([prints[0]], [prints[3]])[0] == 1


def brute_edited(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    out = []
    for k, (i, t) in enumerate(order):
        nxt, half = order[(k + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        prints = pack(*sketch([x.encode() for x in (t, edited, nxt)]))
        near = likeness([prints[0]] * 2, prints[1:])
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], round(near[0], 9), round(near[1], 9)))
    return sorted(out, key=str)


def edited(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in compare_edited(df).collect()), key=str)


def test_fingerprints_of_edge_texts(edge_documents, edge_rows):
    assert edited(edge_documents) == brute_edited(edge_rows)


def test_fingerprints_of_documents(sf_documents):
    assert edited(sf_documents) == brute_edited([(r.doc_id, r.text) for r in sf_documents.collect()])


def test_fingerprints_of_none_and_one(spark, no_documents):
    assert edited(no_documents) == []
    one = [(3, "a single text of seven words here")]
    assert edited(spark.createDataFrame(one, "doc_id long, text string")) == brute_edited(one)


def test_shingle_sets_of_long_texts(edge_rows):
    docs = [(t or "").encode() for _, t in edge_rows]
    h, off = shingle_sets(docs)
    assert np.diff(off).tolist() == [len(shingles(t)) for _, t in edge_rows]


def test_a_template_of_many_components(spark, monkeypatch):
    """Sets that share a template but are no near copies, of several sizes, with a few links among them: small blocks on both sides lose none."""
    import driftcheck.llm.jaccard_join as J

    monkeypatch.setattr(J, "BLOCK", 7)
    rng = random.Random(12)
    template = [f"t{i}" for i in range(14)]
    rows = []
    for i in range(120):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.choice([8, 20, 40]))]
        rows.append((i, " ".join(template + own)))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join(template + own[:-1] + ["changed"])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert classes(df) == brute_classes(rows)


def test_size_classes_hold_every_link():
    """Linked sets lie in the same or in neighbouring classes."""
    import math

    for percent in (50, 60, 75, 90, 99, 100):
        step = math.log(100 / percent) if percent < 100 else math.log(1.01)
        for small in range(1, 400):
            for large in range(small, 100 * small // percent + 1):
                assert abs(math.floor(math.log(large) / step) - math.floor(math.log(small) / step)) <= 1 + (percent == 100)


def test_holder_and_centre_are_one_row(spark):
    """A holder that shares several keys with a centre, in several shards and batches, is paired with it once."""
    key = lambda shard, low: np.uint64(shard << 32 | low)
    rows = []
    for grp, ids in ((0, [1, 2]), (1, [3])):
        for shard in range(6):
            keys = np.array([key(shard, low) for low in (5, 9) for _ in ids], np.uint64)
            who = np.array(ids * 2, np.int64)
            rank, flag = np.where(who == 3, 9, 1).astype(np.int32), np.full(len(who), CHOSEN, np.uint8)
            rows.append((2, shard, grp, *[bytearray(x.tobytes()) for x in (keys, who, rank, flag)]))
    made = spark.createDataFrame(rows, "kind int, shard int, doc_id long, body binary, ids binary, ranks binary, flags binary").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        paired = clusters_of(made)
        assert sorted(tuple(r) for r in paired.collect()) == [(1, 3), (2, 3), (3, 3)]
        plan = paired._jdf.queryExecution().optimizedPlan().toString()
        assert "Distinct" not in plan and "Aggregate" not in plan
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
