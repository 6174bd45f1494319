"""A corpus pipeline over ``documents``: each stage is written as Parquet and read back as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import quality
from tidewater.llm.bpe import digests, encode_decode
from tidewater.llm.common import staged
from tidewater.llm.dedup import without_copies
from tidewater.llm.mixing import mixed_documents
from tidewater.llm.simhash import one_of_each
from tidewater.session import ship_package, use_utc


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; it learns from the labels of this input.

    Without learnable labels of both kinds nothing is rejected.
    """
    return quality.good_documents(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without blanks, the longest stays."""
    return without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, the one with the smallest id stays."""
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents repeat or go."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every document of the mixture."""
    return digests(encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("mix_sources", mixture),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
