"""Operator 9: rules against a plain matcher, the model, and that no Python is in the plan."""

import random

import numpy as np
from pyspark.sql import functions as F

from driftcheck.llm.url_filter import LABELLED, RULES, features, filter_urls, labelled_table, match_rules, op9_url_filter, split_url, train

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:cut]


def best(host, path, rules):
    fits = []
    for rule, verdict in rules:
        r_host, r_path = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == r_host or host.endswith("." + r_host)) and path.startswith(r_path):
            fits.append((-len(rule), rule, verdict))
    return min(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "://", "HTTP://WWW.Example.NET/EN/1?q#f", "http://example.net", "http://example.net/", "http://example.net/en", "http://example.net/en/x",
    "http://notexample.net/en/x", "http://a.b.example.com/de/1", "http://example.com/d", "http://x.org/fr/", "http://org/fr/1", "http://x.org?/fr/", "http://x.org#/fr/", "http://x.org/a/../fr/",
    "http://exÄmple.NET/é?x", "http://a..net/x", "http://net/", "a://b://c.net/x", "http://casino-bonus.example.com/win", "http://garden.example.com/roses", "http://x.net\n/y", "http://" + "a." * 900 + "net/z",
]


def test_splitting(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    host, path = split_url(F.col("url"))
    got = {r.page_id: (r.h, r.p) for r in df.select("page_id", host.alias("h"), path.alias("p")).collect()}
    assert got == {i: parts(u) for i, u in enumerate(URLS)}


def test_rules_against_a_plain_matcher(spark):
    rng = random.Random(3)
    names = ["net", "org", "example.net", "example.com", "a.example.com", "b.org"]
    rules = {f"{rng.choice(names)}/{rng.choice(['', 'en/', 'de/', 'e', 'en/x/'])}": rng.choice(["block", "allow"]) for _ in range(14)} | dict(RULES)
    hosts = names + ["www.example.net", "x.a.example.com", "xnet", ""]
    rows = [(i, rng.choice(hosts), rng.choice(["", "/", "/en/", "/en", "/en/x/y", "/de/1", "/e"])) for i in range(300)]
    got = {r.id: (r.rule, r.verdict) for r in match_rules(spark.createDataFrame(rows, "id long, host string, path string"), spark.createDataFrame(list(rules.items()), "rule string, verdict string"), "id").collect()}
    assert got == {i: best(h, p, rules.items()) for i, h, p in rows if best(h, p, rules.items())[0]}


def test_edge_urls(spark):
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    df = spark.createDataFrame([(i if i else None, u, "x", "y") for i, u in enumerate(URLS)] + [(5, URLS[5], "x", "y")], "page_id long, url string, rule string, host string")
    rows = filter_urls(df, rules, train(labelled_table(spark))).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = parts(r.url)
        rule, verdict = best(host, path, RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.probability >= 0.5 else "allow"))
    by_url = {r.url: r for r in rows}
    assert by_url["http://casino-bonus.example.com/win"].verdict == "block"
    assert by_url["http://garden.example.com/roses"].verdict == "allow"


def test_model_learns_its_table(spark):
    table = labelled_table(spark)
    rows = filter_urls(table.select(F.monotonically_increasing_id().alias("page_id"), "url"), spark.createDataFrame([], "rule string, verdict string"), train(table)).collect()
    label = dict(LABELLED)
    assert all((r.probability >= 0.5) == bool(label[r.url]) for r in rows)


def test_training_without_rows(spark):
    empty = spark.createDataFrame([], "url string, label int")
    weights = train(empty, rounds=2)
    assert weights.collect() == []
    odd = train(spark.createDataFrame([(None, 1), ("http://a.test/", None), (None, 1)], "url string, label int"), rounds=2)
    assert odd.collect()


def test_query_plan_is_native(spark):
    out = op9_url_filter(spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan
    rows = out.collect()
    assert len(rows) == 250 and {r.verdict for r in rows} == {"block", "allow"}


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(empty, spark.createDataFrame(RULES, "rule string, verdict string"), train(labelled_table(spark), rounds=1)).collect() == []


def test_weights_equal_plain_gradient_descent(spark):
    """The rounds of aggregates against the same descent over one dense matrix."""
    table = labelled_table(spark).unionByName(spark.createDataFrame([(LABELLED[0][0], 1), (None, 0)], "url string, label int"))
    host, path = split_url(F.col("url"))
    rows = table.select(features(host, path).alias("f"), "label").collect()
    found = {r.feature: r.weight for r in train(table, rounds=6).collect()}
    names = sorted({i for r in rows for i in r.f})
    x = np.array([[i in r.f for i in names] for r in rows], float)
    x = np.c_[x / np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True))), np.ones(len(rows))]
    y = np.array([r.label for r in rows], float)
    w, m = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(6):
        m = 0.9 * m + x.T @ (y - 1 / (1 + np.exp(-x @ w))) / len(y) - 1e-3 * w
        w = w + 4.0 * m
    assert sorted(found) == [-1, *names]
    assert np.allclose([found[i] for i in [*names, -1]], w, atol=1e-9)
