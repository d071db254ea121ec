"""The corpus pipeline: quality, near-duplicates, personal data, mixture, packing.

Each stage reads what the one before it wrote; all but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablerail.llm import common, mixing, packing, pii, quality, queries, simhash


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (trained on their labelled rows) accepts."""
    return quality.keep_good(docs, quality.fit(docs, common.read(spark, sf_dir, "labels")), threshold=0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (smallest id)."""
    return simhash.keep_first(docs, words=3, max_bits=2)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by its kind; n_chars follows the text."""
    return pii.redact(docs, pii.train(docs), length_column="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the raked source, language and topic targets."""
    return mixing.sample(docs, share=0.7, power=0.8, seed="mix")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into windows of 2048 tokens."""
    return packing.digests(packing.pack(docs, queries.vocabulary(), window=2048))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

# a learned model, fingerprints and boosted trees: no SQL form; the tests hold
# every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
