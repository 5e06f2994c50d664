"""Operator 4: quality classifier.

Each text gives about twenty statistics. Random Fourier features of the
standardised statistics approximate a Gaussian kernel; every partition sums
its part of the normal equations, which give ridge scores; isotonic regression
on a separate share of the labelled rows turns scores into probabilities.

The fit uses about ``fit_rows`` labelled documents, picked by a hash of the id
(a documented bound). Every text is scored whole.

Defined cases: null and empty texts are scored like a text of no words; a null
doc_id is carried through and never held out; repeated rows give repeated
rows; rows of ``labels`` with a null id or quality teach nothing, repeated
ones count each time; without any label all scores are 0.5 (predicted 1); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import drop, keep, remainder, slices, table, texts

FIT_ROWS = 4000
FEATURES = 256
GAMMA = 0.01
SYMBOLS = b"#$%&*|!~^<>{}=_\\@+"


def _kinds() -> np.ndarray:
    """256 byte values by kind: one row of 0/1 for each kind."""
    b = np.arange(256)
    letters = ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122))
    punctuation = np.isin(b, np.frombuffer(b".,;:'\"?-()[]/", np.uint8))
    return np.array([(b >= 65) & (b <= 90), letters, (b >= 48) & (b <= 57), punctuation, np.isin(b, np.frombuffer(SYMBOLS, np.uint8)), np.isin(b, [9, 10, 11, 12, 13, 32]), b == 10, b >= 128], float)


KINDS = _kinds()


def statistics(text: str) -> list[float]:
    """Statistics of one whole text, all finite for any text."""
    raw = text.encode("utf-8", "replace")
    n = max(1, len(raw))
    bins = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, letters, digits, punctuation, symbols, spaces, newlines, high = KINDS @ bins
    p = bins[bins > 0] / n
    words = text.split()
    seen = Counter(words)
    m = max(1, len(words))
    top = sum(c for _, c in seen.most_common(3))
    lines = [x for x in text.split("\n") if x.strip()]
    marked = sum(c for w, c in seen.items() if w[-1] in "#$%&*!|" or w[0] in "#$%&*!|")
    lone = sum(c for w, c in seen.items() if not any(map(str.isalnum, w)))
    capital = sum(c for w, c in seen.items() if w[:1].isupper())
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(c for w, c in seen.items() if w[-1] in ".?!")
    return [
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / m if words else 0.0, upper / max(1, letters), digits / n, punctuation / n,
        symbols / n, spaces / n, np.log1p(newlines), high / n, letters / n, len(seen) / m, top / m, len(set(lines)) / max(1, len(lines)),
        np.log1p(len(raw) / max(1, len(lines))), marked / m, lone / m, capital / m, repeats / m, ends / m, -(p * np.log2(p)).sum(),
    ]


def statistics_of(docs: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in docs], float).reshape(len(docs), -1)


WIDTH = len(statistics(""))


class Fourier:
    """cos(Wx + b) of standardised statistics; W is drawn once from a fixed seed."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int = FEATURES, gamma: float = GAMMA):
        rng = np.random.default_rng(4)
        self.mean, self.scale = mean, np.where(deviation > 1e-9, deviation, 1)
        self.w, self.b = rng.normal(0, np.sqrt(2 * gamma), (WIDTH, features)), rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.c_[np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones(len(x))]


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the knots of a non-decreasing curve through the pools' middles."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        pools.append([v, 1, s])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            v2, n2, s2 = pools.pop()
            pools[-1] = [pools[-1][0] + v2, pools[-1][1] + n2, pools[-1][2] + s2]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


class Quality:
    def __init__(self, fourier: Fourier, weights: np.ndarray, knots: tuple[np.ndarray, np.ndarray] | None):
        self.fourier, self.weights, self.knots = fourier, weights, knots

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1; a hundredth part is the raw score, so that order is kept inside a pool."""
        raw = self.raw(x)
        if self.knots is None:
            return np.clip(raw, 0, 1)
        return np.clip(0.99 * np.interp(raw, *self.knots) + 0.01 * np.clip(raw, 0, 1), 0, 1)


def _sums(rows: DataFrame, make, width: int) -> np.ndarray:
    """Sum over all rows of ``make(features, labels)``: each partition sums its own, one row leaves each of eight."""

    def add(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column("x").to_numpy(zero_copy_only=False))
                total += make(x, batch.column("y").to_numpy(zero_copy_only=False).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["s"])

    parts = rows.repartition(8).mapInArrow(add, "s array<double>").collect()
    return np.sum([p.s for p in parts], axis=0) if parts else np.zeros(width)


def labelled_statistics(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """(y, x, part) of about ``fit_rows`` labelled documents; part 0 calibrates, the rest fits.

    At most twice ``fit_rows`` ids are broadcast, so texts stay where they are.
    """
    known = labels.select(F.col("doc_id").alias("l_id"), F.col("quality").cast("double").alias("y")).where("l_id is not null and y is not null")
    n = known.count()
    whole = 1 << 30
    known = known.where(F.pmod(F.xxhash64("l_id", F.lit(5)), F.lit(whole)) < min(whole, whole * fit_rows // max(1, n) + 1)).limit(2 * fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("l_id"))

    def measure(batches):
        for batch in batches:
            for part in slices(batch, 256):
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(statistics_of(texts(part)).tolist(), pa.list_(pa.float64())), part.column("part")], ["y", "x", "part"])

    part = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(3)).cast("int")
    return keep(rows.select("y", "text", part.alias("part")).mapInArrow(measure, "y double, x array<double>, part int"))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES, gamma: float = GAMMA, ridge: float = 1e-4) -> Quality | None:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, quality); None without a labelled text."""
    rows = labelled_statistics(docs, labels, fit_rows)
    train = rows.where("part > 0")
    m = _sums(train, lambda x, y: np.r_[len(x), x.sum(axis=0), (x * x).sum(axis=0)], 1 + 2 * WIDTH)
    if not m[0]:
        return None
    mean = m[1 : 1 + WIDTH] / m[0]
    fourier = Fourier(mean, np.sqrt(np.maximum(0, m[1 + WIDTH :] / m[0] - mean**2)), features, gamma)
    k = features + 1

    def equations(x, y):
        z = fourier(x)
        return np.r_[(z.T @ z).ravel(), z.T @ y]

    s = _sums(train, equations, k * k + k)
    weights = np.linalg.solve(s[: k * k].reshape(k, k) / m[0] + ridge * np.eye(k), s[k * k :] / m[0])
    model = Quality(fourier, weights, None)
    held = rows.where("part = 0").select("x", "y").collect()  # at most twice fit_rows, about a third of it
    if held:
        score, y = model.raw(np.array([r.x for r in held])), np.array([r.y for r in held])
        model.knots = isotonic(score, y)
    return model


def rate(docs: DataFrame, model: Quality | None) -> DataFrame:
    """``docs`` with score and predicted (columns of these names are replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def judge(column: pa.Array) -> pa.Array:
        drop()
        model, out = shared.value, []
        for lo in range(0, len(column), 256):
            docs = [t or "" for t in column.slice(lo, 256).to_pylist()]
            out += model.score(statistics_of(docs)).tolist() if model else [0.5] * len(docs)
        return pa.array(out, pa.float64())

    return docs.drop("score", "predicted").withColumn("score", judge("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = fit(docs, labels.where(~held))
    return rate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", held.alias("held_out"), "score", "predicted")
