"""The registered query of each operator, applied to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import (extraction, licences, mixing, neardup, passages, periodic, pieces, quality, resampling, secrets, sharding,
                             token_files, vectors)
from ledgerlens.llm.common import table
from ledgerlens.llm.queries_sql import ORACLES as ORACLES

SHARDS = 40
END_ID = 2
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    base = ~quality.passes(F.col("failed"), "base")
    return (rows.withColumn("base_failed", base)
            .withColumn("kept", ~base & quality.passes(F.col("failed"), quality.LATEST)))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.dedup_units(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.ordered(mixing.mix(table(spark, sf_dir, "documents")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign(table(spark, sf_dir, "documents"), [1.0] * SHARDS, added=[1.0])
    return shards.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_quality_rules, op3_substring_dedup, op4_mixing, op5_near_duplicates, op6_sharding, op7_token_files, op8_top_k,
    op9_licence_scan, op10_sentencepiece, op11_importance_resampling, op12_html_extraction, op13_periodic_runs)}
