"""The thin queries over the synthetic tables: ``QUERIES`` by name, and ``ORACLES`` where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import embeddings, langid, licenses, packing, pii, quality, sentencepiece, sharding, simhash, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack_documents(_table(spark, sf_dir, "documents")))


def op3_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op4_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_table(spark, sf_dir, "documents").select("doc_id"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.round_trip(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_hilbert_packing": op2_hilbert_packing,
    "op3_host_quality": op3_host_quality,
    "op4_url_cascade": op4_url_cascade,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_lookup_sharding": op6_lookup_sharding,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_license_scan": op8_license_scan,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_contextual_pii": op10_contextual_pii,
}

ORACLES: dict[str, str] = {
    "op3_host_quality": quality.ORACLE,
    "op4_url_cascade": urlfilter.ORACLE,
    "op8_license_scan": licenses.oracle(),
}
