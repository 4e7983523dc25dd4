"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a score from the key alone and the lowest score wins, so a new
shard only takes the keys for which its own score is the lowest, and no other
key moves. A shard of weight w gets w parts of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.common import column, running
from ledgerlens.session import materialize


def scores(key: Column, weights: Sequence[float], first: int = 0) -> list[Column]:
    """Exponential draws with rates ``weights``; the least of them falls on shard i with probability w_i / sum(w)."""
    def draw(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / float(weight)

    return [draw(first + i, w) for i, w in enumerate(weights)]


def choose(key: Column, weights: Sequence[float]) -> Column:
    """Struct of the winning score and shard; equal scores go to the lower shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("a shard's weight must be above 0")
    return F.array_min(F.array(*[F.struct(s.alias("score"), F.lit(i).alias("shard"))
                                 for i, s in enumerate(scores(key, weights))]))


def assign(df: DataFrame, weights: Sequence[float], added: Sequence[float] = (), id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """One row per row: id, size, text_crc32, shard, slot and the shard once ``added`` shards exist.

    The id and the shards decide alone: rows of one id share a shard, whatever
    their text. A null id is a key like any other. A null text has size 16 and
    no checksum, an empty one size 16 and checksum 0. ``slot`` counts a shard's
    rows from 0 in the order of id, size and checksum; repeated rows take
    adjoining slots. An empty table gives no rows; further columns are not read.
    """
    key, text = column(id_column), column(text_column)
    best = choose(key, weights).alias("best")
    base = df.select(
        key.alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"), best)
    grown = F.col("best")
    for i, s in enumerate(scores(F.col("id"), added, len(weights)), len(weights)):
        grown = F.least(grown, F.struct(s.alias("score"), F.lit(i).alias("shard")))
    placed = materialize(base.select(
        "id", "size", "text_crc32", F.col("best.shard").alias("shard"), grown.getField("shard").alias("grown_shard")),
        "sharded")
    order = [F.col("id").asc_nulls_last(), F.col("size").asc(), F.col("text_crc32").asc_nulls_last()]
    return running(placed, ["shard"], order, None, "slot").select(
        F.col("id").alias(id_column), "size", "text_crc32", "shard", "slot", "grown_shard")
