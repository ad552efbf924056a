"""The corpus pipeline: raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns the
documents that its successor gets, with all their columns; the last returns the packed pieces.

In every stage a null text is an empty one, rows that repeat an id or are equal as a whole are rows of
their own, a null id is an id like any other, long texts are read whole, other columns pass through
whatever their names are, and an empty table gives an empty result. Ties are named per stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmetrics.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from feedmetrics.llm.store import land


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labels given.

    Each row is judged by its text alone, so equal texts go or stay together. Texts without words are judged
    like others; without labels of both classes nothing is called toxic unless most labels are.
    """
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space.

    The longest original stays, then the smallest id (null last), then one of the rows that tie in both.
    Texts without any other character are one group.
    """
    return exact_dedup.drop_copies(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    The smallest id stays (null last), then the first row. Texts without words are no duplicates and stay.
    """
    return jaccard_join.drop_near_duplicates(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; an empty benchmark removes nothing."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left and their places in training sequences.

    An empty text is one piece, its closing id. Pieces of one length take their places in the order of reading.
    """
    return packing.pack_documents(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", not_toxic),
    ("exact dedup", one_of_each_text),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", not_in_benchmark),
    ("best-fit packing", packed),
]

# A trained classifier and token ids are not SQL: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
