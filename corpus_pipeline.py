"""A training corpus from ``documents``: language ID, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeledger.llm import language, near_copies, packing, suffixes
from lakeledger.llm.queries import BYTE_VOCABULARY
from lakeledger.session import configure, cut_lineage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language identification rejects."""
    configure(spark)
    return language.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class of near copies: SimHash pairs that share 0.8 of their five-word shingles."""
    configure(spark)
    return near_copies.keep_first(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 100 bytes that start earlier out of the texts."""
    configure(spark)
    return suffixes.keep_rest(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, and their places in sequences."""
    configure(spark)
    return packing.pack_documents(docs, BYTE_VOCABULARY)


STAGES = [("language_id", identify_language), ("simhash_near_dedup", drop_near_copies),
          ("suffix_array_dedup", drop_repeats), ("best_fit_packing", pack)]

ORACLE_SQL = None  # SQL cannot train the language models; the tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is a table in the shared folder."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
