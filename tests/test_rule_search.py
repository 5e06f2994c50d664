"""Rules over lines against Python's search in the whole text."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftcheck.functions.patterns import fold, shape
from driftcheck.operators import rule_search as S
from driftcheck.operators import triage as TR
from driftcheck.sources.specs import rules_table

ATOMS = ["foo", "ba", "z", r"\n", r"\s", "[\t-~]", "[^a]", ".", r"\w", "[a-f]", "(?:foo|ba)", r"\bba", "[ \n]", r"(?:o\n)", r"\d"]
TAILS = ["", "", "", "+", "*?", "{0,2}", "{1,3}", "?"]
EDGES = ["", "", "", "^", "(?m)^", "(?s)"]


def made_patterns(rng, n):
    out = []
    while len(out) < n:
        p = rng.choice(EDGES) + "".join(rng.choice(ATOMS) + rng.choice(TAILS) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", "", "$", r"(?=\n)", r"(?!\w)"])
        try:
            re.compile(p)
        except re.error:
            continue
        out.append(p)
    return out


def made_logs(rng, n):
    words = ["foo", "ba", "z", "", " ", "foo ba", "\tz", "a", "fo", "o", "7", "FOO", "\r", "ſ"]
    return {k: [" ".join(rng.choices(words, k=rng.randint(0, 3))) for _ in range(rng.randint(1, 25))] for k in [*range(n), None]}


def expected(logs, rules):
    out = {}
    for key, lines in logs.items():
        text = "\n".join(lines)
        out[key] = next((n for n, p in sorted(rules) if re.search(p, text, re.IGNORECASE)), None)
    return out


def rows(spark, logs):
    data = [(k, 10 * i, line) for k, lines in logs.items() for i, line in enumerate(lines)]
    random.Random(0).shuffle(data)
    return spark.createDataFrame(data, "log_id long, line_no long, line string").repartition(4)


def rule_df(spark, patterns, first=1):
    return rules_table(spark, [{"pattern": p, "diagnosis": "d", "action": "escalate"} for p in patterns])


@pytest.mark.parametrize("seed", range(3))
def test_lines_give_what_the_text_gives(spark, seed):
    """One rule a table, so that no other rule hides it; all in one table, so that the lowest wins."""
    rng = random.Random(seed)
    logs, patterns = made_logs(rng, 25), made_patterns(rng, 25)
    df = rows(spark, logs)
    numbered = list(enumerate(patterns, start=1))
    got = {r["log_id"]: r["rule_no"] for r in S.first_rules_in_lines(df, rule_df(spark, patterns), stretch=3).collect()}
    assert {k: got.get(k) for k in logs} == expected(logs, numbered)
    for n, p in numbered[:4]:
        got = {r["log_id"]: r["rule_no"] for r in S.first_rules_in_lines(df, rule_df(spark, [p]), stretch=2).collect()}
        assert {k: got.get(k) for k in logs} == expected(logs, [(1, p)]), (n, p)


def test_two_thousand_rules(spark):
    rng = random.Random(9)
    patterns = [rf"\berror{i}\b.*code {i % 7}" for i in range(1990)] + [r"first\s+second", r"[\t-~]zz", "needle.*here", r"a\r?b", "ab$", r"\Ax", "(foo|bar)baz", "日本.*x", r"^q", "K9"]
    logs = {k: [f"line {i} error{rng.randint(0, 4000)} code {rng.randint(0, 6)}" if rng.random() < 0.1 else "quiet" for i in range(60)] for k in range(30)}
    logs |= {100: ["first", "", "second"], 101: ["a needle or two here"], 102: ["x"], 103: ["q"], 104: ["yy", "ab"], 105: ["foobaz"], 106: ["日本 の x"], 107: ["K9"], None: ["a\rb"]}
    want = expected(logs, list(enumerate(patterns, start=1)))
    got = {r["log_id"]: r["rule_no"] for r in TR.match_rules_lines(rows(spark, logs), rule_df(spark, patterns)).collect()}
    assert got == want and sum(v is not None for v in want.values()) > 12
    texts = spark.createDataFrame([(k, "\n".join(v)) for k, v in logs.items()], "log_id long, text string")
    assert {r["log_id"]: r["rule_no"] for r in TR.match_rules(texts, rule_df(spark, patterns), ["log_id"]).collect()} == want


def test_few_rules_that_cross_lines(spark):
    """A class with a range over the line break, a break that ``.`` may cross, and one that it may not."""
    logs = {1: ["foo", "bar zip"], 2: ["foo\rbar"], 3: ["foo", "bar"]}
    rules = rule_df(spark, [r"foo[\t-~]+bar", "foo.bar", "zip"])
    assert {r["log_id"]: r["rule_no"] for r in TR.match_rules_lines(rows(spark, logs), rules).collect()} == {1: 1, 2: 1, 3: 1}
    rules = rule_df(spark, ["foo.bar", "zip"])
    assert {r["log_id"]: r["rule_no"] for r in TR.match_rules_lines(rows(spark, logs), rules).collect()} == {1: 2, 2: 1, 3: None}


def test_a_long_log_over_many_ranges(spark):
    """Matches over the borders of ranges, in a log that holds nearly all lines."""
    logs = {1: [f"begin {i}" if i % 2 else f"end {i}" for i in range(4000)], 2: ["begin 1", "end 3"]}
    df = rows(spark, logs).repartition(8)
    patterns = [rf"begin {i}\nend {i + 1}\nbegin {i + 2}\nend" for i in range(3991, 3200, -2)] + [r"begin 1\s+end 3"]
    want = expected(logs, list(enumerate(patterns, start=1)))
    assert {r["log_id"]: r["rule_no"] for r in S.first_rules_in_lines(df, rule_df(spark, patterns)).collect()} == want
    one = rule_df(spark, [r"end 2000\nbegin 2001"])
    assert [r["rule_no"] for r in S.first_rules_in_lines(df, one).collect()] == [1]
    for at in range(0, 3998, 97):  # wherever a range ends
        assert re.search(r"\n", "\n".join(logs[1][at : at + 2]))


def test_a_rule_that_python_refuses(spark):
    with pytest.raises(ValueError, match="rule 1"):
        S.first_rules_in_lines(rows(spark, {1: ["x"]}), rule_df(spark, ["(unclosed"])).collect()


@settings(max_examples=300, deadline=None)
@given(st.randoms(use_true_random=False))
def test_literals_are_in_every_match(rng):
    pattern = made_patterns(rng, 1)[0]
    s = shape(pattern)
    for lines in made_logs(rng, 6).values():
        text = "\n".join(lines)
        m = re.search(pattern, text, re.IGNORECASE)
        if m:
            assert s.literal is None or s.literal in fold(text)
            assert m[0].count("\n") <= s.breaks


@settings(max_examples=150, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 9))
def test_streams_find_what_a_search_finds(rng, chars):
    pattern = made_patterns(rng, 1)[0]
    whole, S.STREAM_CHARS = S.STREAM_CHARS, chars
    try:
        for lines in made_logs(rng, 5).values():
            s = S._Stream(1, pattern, shape(pattern).special)
            hit = any(s.add(line if i == 0 else "\n" + line) for i, line in enumerate(lines)) or s.found(True)
            assert hit == (re.search(pattern, "\n".join(lines), re.IGNORECASE) is not None), (pattern, lines)
    finally:
        S.STREAM_CHARS = whole
