import pytest

#: Columns whose names clash with those that operators use or add.
EXTRA = "grp string, score string, shard string, row string, n_tokens string, component_id string, fingerprint string"


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): null and empty texts, no word, no letter, one word, repeated rows, ties, a very long text, odd characters."""
    prose = "the river runs past the old mill and the miller counts the sacks of flour before the winter comes"
    long_text = " ".join(f"word{i % 977} number{i}" for i in range(30_000))
    rows = [
        (1, prose), (2, prose), (3, prose + " again"), (4, None), (5, ""), (6, " \n\t "), (7, "12345 !!"), (8, "word"), (9, "WORD"),
        (10, "a b c"), (11, long_text), (12, long_text + " end"), (13, "naïve café ﬁ ① 日本語 𝔘 ▁ \x00 <|endoftext|> <s>x</s>"), (14, "x" * 3000),
        (1, prose), (15, "ab " * 400), (16, "line\n" * 50), (None, prose), (None, None), (-7, "negative id " + prose),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_documents(spark, edge_rows):
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    rows = [(i, t, "en" if i and i % 2 else None, None, None, *["x"] * 7) for i, t in edge_rows]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sf_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
