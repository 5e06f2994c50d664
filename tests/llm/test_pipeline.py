"""The pipeline's stages, each on its own input, and the queries' registration."""

import base64
import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from driftcheck.llm import langid
from driftcheck.llm.registry import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, sf_documents):
    """What each stage gives, on what the one before gave."""
    docs, out = sf_documents, {}
    for name, stage in P.STAGES:
        out[name] = (docs, stage(spark, docs, SF).persist())
        docs = out[name][1]
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages):
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.columns == P.COLUMNS, name


def test_language_keeps_texts(stages):
    docs, out = stages["language"]
    assert ids(out) == ids(docs)


def test_language_rejects(spark, sf_documents):
    odd = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "1234 !!", None, "s", 7), (9003, "", None, "s", 0)], sf_documents.schema)
    assert ids(P.language(spark, sf_documents.unionByName(odd), SF)) == ids(sf_documents)


def test_language_rejects_what_fits_no_language(spark):
    """An unlearned language, encoded data, random letters and keyboard junk go, all held-out texts stay, with four labels and with one."""
    rng = random.Random(5)
    odd = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. " * 5,
        "La vita è bella quando il sole splende sopra le colline e gli uccelli cantano nel giardino della nonna. " * 5,
        "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 5,
        base64.b64encode(rng.randbytes(900)).decode(), rng.randbytes(900).hex(),
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(1200)), "asdf jkl; qwer uiop zxcv asdfgh hjkl qwerty poiu lkjh",
    ]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null and text is not null")
    held = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4)) == 0
    junk = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(odd)], docs.schema)
    for of in (docs, docs.where("lang = 'en'")):
        clean = of.where(held)
        model = langid.fit(of, train=~held)
        found = langid.identify(clean.unionByName(junk), model, judge=True).select("doc_id", "fits").collect()
        assert {r.doc_id for r in found if r.fits} == ids(clean)


def test_quality_follows_labels(spark, stages):
    docs, out = stages["quality"]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = ids(out)
    known = [i for i in ids(docs) if i in label]
    assert sum((i in kept) == bool(label[i]) for i in known) >= 0.9 * len(known)


def test_one_of_each_group_stays(stages):
    from driftcheck.llm.jaccard_join import join_classes

    docs, out = stages["near_duplicates"]
    classes = join_classes(docs).collect()
    assert ids(out) == {r.component_id for r in classes}


def test_no_string_repeats(stages):
    docs, out = stages["repeated_strings"]
    rows = {r.doc_id: r for r in out.collect()}
    for r in docs.collect():
        if r.doc_id in rows:
            assert len(rows[r.doc_id].text) <= len(r.text) and rows[r.doc_id].n_chars == len(rows[r.doc_id].text)
            assert rows[r.doc_id].lang == r.lang and rows[r.doc_id].source == r.source


def test_cut_texts_come_from_one_python_step(spark):
    """What is left is text where it is cut: no further Python function, whose workers would stay in the executor's memory, runs behind."""
    shared, own = "the same forty-nine letters of a text, up to here ", "only here: "
    assert len(shared) == 50
    rows = [(1, shared[1:] + "é end"), (2, own + shared[1:] + "è und ß"), (3, shared[1:] + "é end"), (4, None), (5, "short"), (None, shared[1:] + "é end")]
    docs = spark.createDataFrame([(i, t, "en", f"s{i}", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = P.repeated_strings(spark, docs, SF)
    got = sorted(map(tuple, out.collect()), key=str)
    want = [(1, shared[1:] + "é end"), (2, own + " und ß"), (5, "short"), (None, shared[1:] + "é end")]
    assert got == sorted([(i, t, "en", f"s{i}", len(t)) for i, t in want], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "EvalPython" not in plan


def test_packing_holds_all(stages):
    docs, out = stages["packing"]
    assert ids(docs) == ids(out)


def test_odd_rows_go_through(spark, edge_documents):
    docs = edge_documents
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    docs.collect()


def test_equal_rows_leave_one(spark, edge_documents):
    out = P.near_duplicates(spark, edge_documents, SF).where(F.col("doc_id").isNotNull()).collect()
    assert len(out) == len({r.doc_id for r in out})
    assert not {2, 3} & {r.doc_id for r in out}


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    """Unrelated texts of one id both stay; of linked ones the smallest id stays, whichever row it is."""
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    a, b, c, d = text(), text(), text(), text()
    rows = [(1, a), (2, b), (2, c), (3, c + " more"), (4, d), (4, d), (4, a + " too"), (5, None), (5, None), (6, ""), (None, a)]
    for seed in range(2):
        docs = spark.createDataFrame([(i, t, "en", f"s{k}", 1) for k, (i, t) in enumerate(rng.sample(rows, len(rows)))], "doc_id long, text string, lang string, source string, n_chars long").repartition(3 + seed)
        got = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SF).collect()), key=str)
        assert got == sorted([(1, a), (2, b), (2, c), (4, d), (5, None), (6, ""), (None, a)], key=str)


def test_registered():
    import __spark_entry__

    assert [name.split("_")[0] for name in sorted(queries(), key=lambda q: int(q[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert {"pipeline", *queries()} <= set(__spark_entry__.queries())
    assert [f.__module__ for _, f in P.STAGES] == ["corpus_pipeline"] * 5
