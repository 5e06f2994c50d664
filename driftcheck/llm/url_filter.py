"""Operator 9 (native): URL filter.

A logistic regression over hashed character n-grams of host and path, trained
from a small labelled URL table, behind a list of block and allow rules. All
work is DataFrame / SQL expressions: splitting, n-grams, training rounds and
scoring run in the JVM; no Python function touches a row.

Defined cases: a null url, or one without ``://``, has an empty host and path,
meets no rule and is judged by the model on an empty feature list (its bias).
Repeated pages are judged one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import keep, table

#: Rule text (host and path) and its verdict.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]

#: The small labelled URL table (1: block, 0: allow).
LABELLED = [
    ("http://casino-win.test/en/1", 1),
    ("https://www.casino-royal.test/play/slots", 1),
    ("http://m.best-casino.test/bonus", 1),
    ("https://blog.online-casino.test/jackpot.html", 1),
    ("http://free-bets.test/en/7", 1),
    ("https://www.sports-bets.test/odds/today", 1),
    ("http://bets-now.test/free/spins", 1),
    ("https://m.free-spins.test/win", 1),
    ("http://cheap-pills.test/buy", 1),
    ("https://blog.pills-online.test/cheap/meds", 1),
    ("http://www.cheap-meds.test/pharmacy/order", 1),
    ("https://discount-pills.test/de/33", 1),
    ("http://adult-cams.test/live", 1),
    ("https://www.xxx-videos.test/free", 1),
    ("http://porn-tube.test/watch/9", 1),
    ("https://m.hot-adult.test/xxx", 1),
    ("http://win-money-fast.test/now", 1),
    ("https://payday-loans.test/cheap/cash", 1),
    ("http://lottery-win.test/jackpot/claim", 1),
    ("https://free-poker.test/bonus/win.html", 1),
    ("http://encyclopedia.test/wiki/river", 0),
    ("https://www.library.test/en/catalogue/12", 0),
    ("http://m.weather.test/fr/today", 0),
    ("https://blog.garden.test/de/2024/roses.html", 0),
    ("http://news.test/en/4021", 0),
    ("https://www.university.test/physics/lecture-3", 0),
    ("http://museum.test/en/collection?page=2", 0),
    ("https://docs.software.test/manual/install", 0),
    ("http://m.recipes.test/fr/soup.html", 0),
    ("https://history.test/en/8812", 0),
    ("http://www.hospital.test/de/contact", 0),
    ("https://blog.travel.test/en/mountains", 0),
    ("http://school.test/timetable/7", 0),
    ("https://science.test/articles/oceans", 0),
    ("http://www.city.test/council/meeting", 0),
    ("https://m.maps.test/en/route/77", 0),
    ("http://thether.test/en/5821", 0),
    ("https://blog.station.test/fr/711/", 0),
    ("http://music.test/theory/chords", 0),
    ("https://www.theatre.test/en/903.html", 0),
]

SIZES = (3, 4)
DIM = 4096


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) by the contract's rule; both empty where there is no ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def features(host: Column, path: Column, dim: int = DIM) -> Column:
    """Distinct hashed n-grams of the framed host and of the path."""

    def grams(part: Column, n: int, salt: str) -> Column:
        framed = F.concat(F.lit("^"), part, F.lit("$"))
        at = F.when(F.length(framed) >= n, F.sequence(F.lit(1), F.length(framed) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(salt), F.substring(framed, i, n)), F.lit(dim)).cast("int"))

    parts = [grams(col, n, f"{name}{n}") for name, col in (("h", host), ("p", path)) for n in SIZES]
    return F.array_distinct(F.concat(*parts))


def labelled_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED, "url string, label int")


def train(labelled: DataFrame, dim: int = DIM, rounds: int = 24, rate: float = 4.0, decay: float = 0.9, ridge: float = 1e-3) -> DataFrame:
    """Weights (feature, weight; feature -1 is the bias) by gradient descent with momentum.

    ``labelled`` is (url, label); rows with a null label are left out, repeated
    rows count each time. Every round is two aggregates over the exploded
    features; each round's weights are written to the shared folder, so the
    plan does not grow. Without a labelled row the model is empty (all zero).
    """
    host, path = split_url(F.col("url"))
    rows = labelled.select("url", F.col("label").cast("double").alias("y")).where("y is not null")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "y", features(host, path, dim).alias("f"))
    value = 1.0 / F.sqrt(F.greatest(F.size("f"), F.lit(1)).cast("double"))
    cells = keep(rows.select("row", "y", value.alias("v"), F.explode(F.concat("f", F.array(F.lit(-1)))).alias("feature")).withColumn("v", F.when(F.col("feature") == -1, 1.0).otherwise(F.col("v"))))
    n = max(1, cells.where("feature = -1").count())
    weights = cells.groupBy("feature").agg(F.lit(0.0).alias("w"), F.lit(0.0).alias("m"))
    for _ in range(rounds):
        margin = cells.join(weights, "feature").groupBy("row", "y").agg(F.sum(F.col("v") * F.col("w")).alias("z"))
        residual = margin.select("row", (F.col("y") - 1.0 / (1.0 + F.exp(-F.col("z")))).alias("r"))
        slope = cells.join(residual, "row").groupBy("feature").agg((F.sum(F.col("v") * F.col("r")) / n).alias("g"))
        step = weights.join(slope, "feature").select("feature", "w", (decay * F.col("m") + F.col("g") - ridge * F.col("w")).alias("m"))
        weights = keep(step.select("feature", (F.col("w") + rate * F.col("m")).alias("w"), "m"))
    return weights.select("feature", F.col("w").alias("weight"))


def probability(host: Column, path: Column, weights: DataFrame, dim: int = DIM) -> Column:
    """P(block). The model goes into the plan as one folded literal of ``dim`` + 1 numbers, a fixed size."""
    found = {r.feature: r.weight for r in weights.collect()}
    dense = F.from_json(F.lit(json.dumps([found.get(i, 0.0) for i in range(dim)])), "array<double>")
    f = features(host, path, dim)
    total = F.aggregate(f, F.lit(0.0), lambda acc, i: acc + F.get(dense, i))
    z = total / F.sqrt(F.greatest(F.size(f), F.lit(1)).cast("double")) + F.lit(found.get(-1, 0.0))
    return 1.0 / (1.0 + F.exp(-z))


def match_rules(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, rule, verdict): the longest fitting rule of each row of (key, host, path).

    ``rules`` is (rule, verdict), a rule being a host and a path that starts
    with ``/``. A url has one candidate for each host suffix and each path
    length that occurs in the rules; these meet the rules in an equi-join, so
    a large rule list needs no pairwise comparison. Equal length: smaller text.
    """
    rule = rules.where("rule is not null").select("rule", "verdict", F.substring_index("rule", "/", 1).alias("r_host"), F.expr("substring(rule, locate('/', rule))").alias("r_path")).where("locate('/', rule) > 0")
    lengths = sorted(r[0] for r in rule.select(F.length("r_path")).distinct().collect())
    if not lengths:
        return urls.select(key, F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.struct(F.substring("path", 1, n).alias("r_path")) for n in lengths])
    tried = urls.select(key, "path", F.explode(F.array_distinct(suffixes)).alias("r_host"), prefixes.alias("p"))
    tried = tried.select(key, "r_host", F.explode(F.array_distinct("p")).alias("p")).select(key, "r_host", "p.r_path")
    best = F.struct((-F.length("rule")).alias("n"), "rule", "verdict")
    return tried.join(rule, ["r_host", "r_path"]).groupBy(key).agg(F.min(best).alias("b")).select(key, "b.rule", "b.verdict")


def filter_urls(pages: DataFrame, rules: DataFrame, weights: DataFrame, threshold: float = 0.5, dim: int = DIM) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, probability and verdict; one row for each row.

    The distinct (host, path) meet the rules once; the result joins back to
    the rows by an equi-join, which Spark splits where one url is very common.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    parts = rows.select("host", "path").distinct().select(F.struct("host", "path").alias("part"), "host", "path")
    ruled = match_rules(parts, rules, "part").select(F.col("part.host").alias("r_host"), F.col("part.path").alias("r_path"), "rule", F.col("verdict").alias("ruled"))
    joined = rows.join(ruled, (F.col("host") == F.col("r_host")) & (F.col("path") == F.col("r_path")), "left")
    scored = joined.withColumn("probability", probability(F.col("host"), F.col("path"), weights, dim))
    verdict = F.coalesce("ruled", F.when(F.col("probability") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "url", "host", "path", "rule", "probability", verdict.alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``pages``."""
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules, train(labelled_table(spark))).select("page_id", "host", "path", "rule", "verdict")
