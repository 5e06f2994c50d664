"""Operators 3 and 4: held-out accuracy, defined cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from driftcheck.llm import langid, quality
from driftcheck.llm.langid import op3_language_id
from driftcheck.llm.quality import op4_quality

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_language_edge_texts(spark, edge_documents, edge_rows, sf_documents):
    model = langid.fit(sf_documents)
    out = langid.identify(edge_documents, model)
    assert set(edge_documents.columns) - {"score"} <= set(out.columns)
    got = out.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(got) == len(edge_rows)
    for r in got:
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en", "es", "fr")


def test_language_without_labels_or_rows(sf_documents, no_documents):
    assert langid.fit(no_documents) is None
    assert langid.identify(no_documents, None).collect() == []
    blank = langid.identify(sf_documents.withColumn("lang", F.lit(None).cast("string")), None)
    assert {r.lang_pred for r in blank.collect()} == {"und"}


def test_kernel_is_a_normalised_presence_kernel():
    x = langid.presence(["abab", "abab abab", "zzz"])
    assert np.allclose((x * x).sum(axis=1), 1)
    a, b = (set(langid.grams(t).tolist()) for t in ("abab", "zzz"))
    assert np.isclose(x[0] @ x[2], len(a & b) / np.sqrt(len(a) * len(b)))


def test_scores_equal_exact_kernel_ridge(sf_documents):
    """With every training text as a landmark the scores are those of the dense weighted kernel ridge regression."""
    rows = sf_documents.where("lang is not null and length(text) > 200").orderBy("doc_id").collect()
    train, test = rows[:60], rows[60:100]
    model = langid.KernelRidge([r.text for r in train], [r.lang for r in train], landmarks=60)
    x = langid.presence([r.text for r in train]).astype(float)
    kernel, across = x @ x.T, langid.presence([r.text for r in test]).astype(float) @ x.T
    labels, y = np.unique([r.lang for r in train], return_inverse=True)
    w = 1.0 / np.bincount(y)[y]
    one, target = np.ones(len(y)), (np.arange(len(labels)) == y[:, None]).astype(float)
    penalty = 1e-2 / len(labels)
    left = np.block([[kernel * w @ kernel + penalty * kernel, (kernel @ w)[:, None]], [(w @ kernel)[None, :], np.array([[w.sum()]])]])
    right = np.r_[kernel @ (w[:, None] * target), (w[:, None] * target).sum(axis=0)[None, :]]
    solved = np.linalg.lstsq(left, right, rcond=None)[0]
    exact = across @ solved[:-1] + solved[-1]
    found = (langid.presence([r.text for r in test]) @ model.landmarks.T) @ model.weights + model.bias
    assert len(one) == 60 and np.abs(found - exact).max() < 5e-3
    assert (labels[exact.argmax(axis=1)] == model.predict([r.text for r in test])[0]).all()


def test_labels_of_long_texts_alone_are_learned(spark, sf_documents, monkeypatch):
    monkeypatch.setattr(langid, "FIT_BYTES", 4000)
    words = ["szczęście", "źródło", "gęś", "jaźń", "zażółć", "księżyc", "wszyscy", "ludzie", "rodzą", "się"]
    rng = np.random.default_rng(1)
    long = [(10_000 + i, " ".join(rng.choice(words, 1500)), "pl") for i in range(3)]
    docs = sf_documents.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(long, "doc_id long, text string, lang string"))
    model = langid.fit(docs)
    assert "pl" in model.labels and len(model.landmarks) > 4 * langid.LANDMARKS
    assert model.predict([" ".join(rng.choice(words, 40))])[0].tolist() == ["pl"]


def test_quality_held_out(spark):
    rows = op4_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_quality_edge_texts(spark, edge_documents, edge_rows, sf_documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(sf_documents, labels.select("doc_id", "quality", "toxic").union(odd))
    got = quality.rate(edge_documents, model).select("doc_id", "text", "score", "predicted").collect()
    assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in got:
        assert abs(by_text.setdefault(r.text or "", r.score) - r.score) < 1e-9


def test_quality_without_labels(spark, sf_documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(sf_documents, labels) is None
    assert {(r.score, r.predicted) for r in quality.rate(sf_documents, None).collect()} == {(0.5, 1)}
    assert quality.rate(no_documents, None).collect() == []


def test_isotonic_pools():
    x, y = quality.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0.0, 1.0, 0.0, 1.0, 1.0]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()
    assert np.allclose(y, [0, 0.5, 1])


def test_statistics_are_finite():
    for t in ("", " ", "\n\n", "a", "!!!", "x" * 100_000, "é\x00"):
        assert np.isfinite(quality.statistics(t)).all()


def test_quality_equals_exact_ridge_and_isotonic(spark, sf_documents):
    """The partition-summed fit against one dense ridge solve over all labelled rows and a min-max isotonic regression."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.fit(sf_documents, labels)
    rows = quality.labelled_statistics(sf_documents, labels, quality.FIT_ROWS).collect()
    assert len(rows) == sf_documents.join(labels, "doc_id").where("quality is not null").count()
    train = [r for r in rows if r.part > 0]
    x, y = np.array([r.x for r in train]), np.array([r.y for r in train])
    assert np.allclose(model.fourier.mean, x.mean(axis=0))
    deviation = x.std(axis=0)
    assert np.allclose(model.fourier.scale[deviation > 1e-6], deviation[deviation > 1e-6])
    z = model.fourier(x)
    augmented = np.r_[z, np.sqrt(1e-4 * len(y)) * np.eye(z.shape[1])]
    exact = np.linalg.lstsq(augmented, np.r_[y, np.zeros(z.shape[1])], rcond=None)[0]
    assert np.abs(z @ exact - z @ model.weights).max() < 1e-6

    held = sorted((model.raw(np.array([r.x]))[0], r.y) for r in rows if r.part == 0)
    v = np.array([t for _, t in held])
    n = len(v)
    least = [max(min(v[i : j + 1].mean() for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
    pools = sorted(set(np.round(least, 9)))
    assert np.allclose(model.knots[1], pools)


def test_fourier_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, quality.WIDTH))
    z = quality.Fourier(np.zeros(quality.WIDTH), np.ones(quality.WIDTH), features=20_000)(x)[:, :-1]
    exact = np.exp(-quality.GAMMA * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).max() < 0.05
