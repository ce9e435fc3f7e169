"""From raw documents to sharded training data: quality, near-duplicates, benchmark leaks, mixture, shards.

Each stage is written as Parquet and read again as the next one's input, in
the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtally.llm.common import count_words, table
from fieldtally.llm.decontaminate import without_leaks
from fieldtally.llm.mixing import mixed_documents
from fieldtally.llm.neardup import one_of_each
from fieldtally.llm.quality import accepted
from fieldtally.llm.sharding import hilbert_shards
from fieldtally.session import settle

SHARDS = 40


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture at the sources' target weights; a document appears as often as it is taken."""
    return mixed_documents(docs, count_words(F.col("text")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of the documents with shard and slot along the curve."""
    return hilbert_shards(docs, SHARDS, keep=docs.columns).select("row.*", "hilbert", "shard", "slot")


STAGES = [
    ("quality classifier", quality_filter),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: Signatures and the classifier have no SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
