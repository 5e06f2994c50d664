"""The corpus pipeline: language, quality, near duplicates, repeated strings, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm import jaccard_join, langid, packing, quality, repeats
from driftcheck.llm.common import keep, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language identification, learned from the texts with a language; null texts, texts without a letter and texts that fit no language go."""
    found = langid.identify(docs.select(*COLUMNS), langid.fit(docs), judge=True)
    return found.where("fits").select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learned from ``labels``; texts predicted 0 go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.rate(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join; of each group of linked documents the one with the smallest id stays.

    Each row is judged by its own text: rows that share an id are documents of
    their own, told apart by their texts (of rows equal in id and text one
    stays, the least by the other columns). A row with a null id stays.
    """
    rows = docs.select(*COLUMNS)
    named = rows.where("doc_id is not null")
    shared = keep(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id", F.lit(True).alias("shared")))
    if shared.isEmpty():
        classes = jaccard_join.join_classes(named.select("doc_id", "text"))
        return rows.join(classes.where("doc_id <> component_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)
    own = F.when(F.col("shared"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id").cast("long"))
    nodes = named.join(shared, "doc_id", "left").withColumn("node", own)
    classes = jaccard_join.join_classes(nodes.select(F.col("node").alias("doc_id"), "text")).select(F.col("doc_id").alias("node"), "component_id").distinct()
    named_by = nodes.select("node", "doc_id").distinct()
    first = classes.join(named_by, "node").groupBy("component_id").agg(F.min(F.struct("doc_id", "node")).alias("first")).select(F.col("first.node").alias("node"))
    stay = nodes.join(first, "node", "left_semi")
    of_shared = stay.where("shared").groupBy("node").agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return stay.where("shared is null").select(*COLUMNS).unionByName(of_shared).unionByName(rows.where("doc_id is null"))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array deduplication; what is left of a character cut in two goes too, and so do documents of which nothing is left."""
    cut = repeats.remove_repeats(docs.select(*COLUMNS), full=False, text=True, carry=("lang", "source"))
    out = cut.select("doc_id", F.col("kept_text").alias("text"), "row.lang", "row.source")
    return out.where("text <> ''").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing by token counts: a row for each piece of a document."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("packing", packed)]

#: Learned models, word sets of whole texts and byte strings: no SQL for the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
