"""A corpus in, training batches out: filters by quality and language, one document of each group, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. ``run`` applies them in order, each result written to the shared folder
as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airq.llm import jaccard_join, language, packing, quality_model
from airq.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject; it learns from the rows of ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.keep_good(docs, quality_model.fit_quality(docs, labels))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that consist of learned languages, texts of several of them included, with ``lang`` as predicted; see ``keep_known``."""
    return language.keep_known(docs, language.fit_language(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by the n-gram join (exact and near copies) the one with the least id."""
    return jaccard_join.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and slot of every document; a batch has one predicted language, a document's length is its number of words."""
    return packing.pack(docs, packing.word_count(docs["text"]), group_column="lang")


STAGES = [
    ("quality classifier", good_quality),
    ("language id", known_language),
    ("n-gram jaccard join", one_of_each_group),
    ("packing", packed),
]

# Learned models and graph components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
