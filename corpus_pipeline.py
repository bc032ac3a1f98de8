"""A corpus from raw documents to sampled segmentations, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusmill.llm import exact_dedup, mixing, near_copies, piece_sampling, quality_rules
from locusmill.llm.common import materialise, table
from locusmill.llm.queries import PIECE_BPE, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash of five-word shingles, a similarity of 0.8 or more."""
    return near_copies.drop_similar(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of each document of the mix, with their token ids."""
    return piece_sampling.sample_segmentations(docs, tokenizer_path(PIECE_BPE), k=2, with_ids=True, cache_units=100_000, block_chars=250_000, release=True)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("segmentation", segmentations)]

#: SimHash components and sampled segmentations have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
