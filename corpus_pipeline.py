"""The corpus pipeline: five operators in sequence, each stage written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wafertide.llm import langid, packing, pii, quality, simhash
from wafertide.llm.common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail their own rules or whose host is rejected go."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts become pieces of training sequences."""
    return packing.digests(packing.pack_documents(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Language identification and tokenization are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
