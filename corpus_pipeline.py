"""Documents to mixed, sharded training text: quality, near copies, benchmark, mix, shards.

Every stage works on all rows the one before it kept. They read ``documents`` and, beside it,
``labels`` and ``benchmark``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricetrail.llm import decontaminate, jaccard_join, mixing, quality, sharding
from pricetrail.session import store
from pricetrail.sources.tables import load


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.7 or more."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each class of five-word shingle Jaccard 0.8."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words in a row of a benchmark item occur."""
    return decontaminate.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the number of its shard."""
    return sharding.sharded_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", free_of_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: No SQL: neither the classifier nor the components of the join can be put in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
