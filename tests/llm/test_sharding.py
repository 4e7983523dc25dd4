import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import sharding
from ledgerlens.llm.queries import QUERIES
from tests.llm.helpers import ROWS, SF, no_rows, odd_rows


def check(rows, shards):
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, shards) for r in rows)
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})


def test_query(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op6_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and {r.law for r in rows} == {"key"}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw)) and 0 <= r.shard < 40
    check(rows, 40)


def test_weights_and_growth(spark):
    """Shares follow the weights, and a shard more takes its share from all others and moves nothing else."""
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    rows = sharding.assign(ids, [1, 1, 2], added=[4]).collect()
    n, moved = Counter(r.shard for r in rows), Counter(r.shard for r in rows if r.grown_shard == 3)
    check(rows, 3)
    for shard, weight in enumerate((1, 1, 2)):
        assert n[shard] == pytest.approx(10_000 * weight, rel=0.05) and moved[shard] == pytest.approx(n[shard] / 2, rel=0.07)


def test_key_alone_decides(spark):
    a = {r.doc_id: r.shard for r in sharding.assign(odd_rows(spark), [1.0] * 5).collect()}
    b = {r.doc_id: r.shard for r in sharding.assign(odd_rows(spark).withColumn("text", F.lit("other")).repartition(1), [1.0] * 5).collect()}
    assert a == b
    with pytest.raises(ValueError):
        sharding.assign(odd_rows(spark), [1.0, 0.0])


def test_odd_rows(spark):
    rows = sharding.assign(odd_rows(spark), [1.0] * 4, added=[1.0]).collect()
    assert len(rows) == len(ROWS)
    check(rows, 4)
    own = {r.doc_id: r for r in rows}
    assert (own[4].size, own[4].text_crc32, own[5].size, own[5].text_crc32) == (16, None, 16, 0)
    assert sharding.assign(no_rows(spark), [1.0]).count() == 0


def plain_shard(key, weights):
    """Every shard's draw for one key, from the public hash of the key's bytes and then of the shard's."""
    draws = []
    for shard, weight in enumerate(weights):
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        bits = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed) >> 11
        draws.append((-math.log((bits + 0.5) / (1 << 53)) / weight, shard))
    return min(draws)[1]


@pytest.mark.parametrize("weights, added", [([1.0] * 40, [1.0]), ([1.0, 2.5, 0.5], [4.0, 0.1]), ([1.0], [])])
def test_the_winning_shard_against_all_draws(spark, weights, added):
    keys = [*range(-50, 400), (1 << 63) - 1, -(1 << 63), None]
    df = spark.createDataFrame([(k, "text") for k in keys], "doc_id bigint, text string")
    got = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.assign(df, weights, added).collect()}
    assert got == {k: (plain_shard(k, weights), plain_shard(k, [*weights, *added])) for k in keys}
