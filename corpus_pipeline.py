"""The corpus pipeline: its stages in order, and ``run``, which applies them to ``documents``.

Each stage gets what the one before it kept, written and read again.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import mixing, neardup, pieces, quality, secrets
from ledgerlens.session import work_path

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the latest policy."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return neardup.one_of_each(docs, shingle=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts become the name of their kind; n_chars follows."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each use of a document in the mix, in training order; n_chars follows where a text is cut."""
    return mixing.training_stream(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row, and whether they decode to the text."""
    return pieces.encode_pieces(docs, PIECE_MODEL)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixing_to_targets),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL can express neither the search for near copies nor the lexer or the pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = work_path(spark, f"pipeline-{k}-{uuid.uuid4().hex}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
