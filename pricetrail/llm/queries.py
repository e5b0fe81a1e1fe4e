"""The corpus operators as registered queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from pricetrail.llm import (
    chunk_recipes, decontaminate, fingerprints, hard_negatives, importance, jaccard_join, license_scan, mixing, quality,
    secret_scan, sharding, token_files, url_filter,
)
from pricetrail.llm.common import load
from pricetrail.plans.registry import Query

CORPUS_QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    def add(run):
        CORPUS_QUERIES[run.__name__] = Query(run, sql)
        return run

    return add


@query()
def op1_license_patience(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in every document."""
    return license_scan.scan(load(spark, folder, "documents"))


@query()
def op2_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document, learnt outside the held-out fold."""
    return quality.scored(load(spark, folder, "documents"), load(spark, folder, "labels"))


@query()
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how many others are near."""
    return fingerprints.fingerprints(load(spark, folder, "documents"))


@query()
def op4_kd_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    placed = sharding.shard_documents(load(spark, folder, "documents"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query()
def op5_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written to and read back from wavelet matrix files."""
    return token_files.token_digests(load(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_url_trust(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on every page by rule or by its host's place in the link graph."""
    return url_filter.judge(load(spark, folder, "pages"))


@query()
def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The words each document gives to the mix."""
    mixed = mixing.mix(load(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@query()
def op8_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, live ones told from examples by ownership counts."""
    return secret_scan.scan(load(spark, folder, "documents"))


@query()
def op9_grouped_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the class that links of 0.9 over three-word shingles put it into."""
    return jaccard_join.classes(load(spark, folder, "documents"), size=3, percent=90)


@query()
def op10_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.report(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query()
def op11_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the document that stays of those equal but for white space."""
    return chunk_recipes.exact_copies(load(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_chars", "n_chunks"
    )


@query()
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's importance for the benchmark's distribution, and its rank if it is drawn."""
    return importance.resampled(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


@query()
def op13_hilbert_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, from all vectors."""
    return hard_negatives.mined(load(spark, folder, "embeddings"))


CORPUS_QUERIES["pipeline"] = Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
