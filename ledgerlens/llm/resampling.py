"""Importance resampling towards a target corpus by hashed word features.

Both corpora are counted into buckets; a bucket's gain is the log ratio of its
two smoothed shares. A document's weight adds up the gains of its features by
lookups in one array, a Gumbel term of its id makes the score, and the highest
scores are the sample. The cut is found by bisection over the persisted scores:
each step is one exact count job, and nothing is sorted but the drawn rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.llm.common import bounded_batches, column, running
from ledgerlens.session import materialize

BUCKETS = 10_000
LONGEST_RUN = 3
#: ASCII characters other than digits and small letters part words.
PARTING = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else 32 for b in range(256))
#: Texts are taken together up to this many bytes; a longer text comes alone.
TOGETHER = 1 << 20
#: Thresholds tried by one count job; four bits of the cut each time.
CUTS = 15
LAST_ID = (1 << 63) - 1


class Shift:
    """What following bytes do to a checksum: crc32(a + b) is crc32(a) moved on by len(b), xor crc32(b).

    Moving on is linear, so 32 single bits tell four tables of 256 entries for each length.
    """

    def __init__(self) -> None:
        self.known: dict[int, np.ndarray] = {}

    def tables(self, length: int) -> np.ndarray:
        found = self.known.get(length)
        if found is None:
            zeros = bytes(length)
            nothing = zlib.crc32(zeros, 0)
            found = np.zeros((4, 256), np.uint32)
            for bit in range(32):
                k, b = divmod(bit, 8)
                found[k, 1 << b:2 << b] = found[k, :1 << b] ^ np.uint32(zlib.crc32(zeros, 1 << bit) ^ nothing)
            if length <= 256:
                self.known[length] = found
        return found

    def many(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One stack of tables for the distinct lengths, and the place of each length in it."""
        distinct, place = np.unique(lengths, return_inverse=True)
        return np.stack([self.tables(int(n)) for n in distinct]).reshape(-1), place.astype(np.int64) * 1024


def moved(crc: np.ndarray, stack: np.ndarray, place: np.ndarray) -> np.ndarray:
    out = stack[place + (crc & 255)]
    for k in (1, 2, 3):
        out = out ^ stack[place + (256 * k) + ((crc >> np.uint32(8 * k)) & 255)]
    return out


def runs_of_words(texts: list[bytes | None], shift: Shift) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of each text, and the buckets of all runs of one, two and three words in order of their last words.

    Runs over the end of a text have bucket ``BUCKETS``.
    """
    split = [t.lower().translate(PARTING).split() if t else [] for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    words = [w for own in split for w in own]
    if not words:
        return counts, [np.zeros(0, np.int64)] * LONGEST_RUN
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    space = zlib.crc32(b" ")
    plain = np.array([zlib.crc32(w) for w in number], np.uint32)
    behind = np.array([zlib.crc32(w, space) for w in number], np.uint32)[ids]
    stack, place = shift.many(np.fromiter((len(w) + 1 for w in number), np.int64, len(number)))
    place = place[ids]
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    at = np.arange(len(words)) - starts
    crc = plain[ids]
    out = [(crc % BUCKETS).astype(np.int64)]
    for k in range(1, LONGEST_RUN):
        longer = np.zeros(len(words), np.uint32)
        longer[1:] = moved(crc[:-1], stack, place[1:]) ^ behind[1:]
        crc = longer
        out.append(np.where(at >= k, (crc % BUCKETS).astype(np.int64), BUCKETS))
    return counts, out


def groups(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Places from which and to which texts are taken together."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t or b"") > TOGETHER:
            yield start, i
            start, held = i, 0
        held += len(t or b"")
    if start < len(texts):
        yield start, len(texts)


def count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket met by the task."""
    total, shift = np.zeros(BUCKETS + 1, np.int64), Shift()
    for batch in batches:
        texts = batch.column(0).cast(pa.binary()).to_pylist()
        for a, b in groups(texts):
            for buckets in runs_of_words(texts[a:b], shift)[1]:
                total += np.bincount(buckets, minlength=BUCKETS + 1)
    met = np.flatnonzero(total[:BUCKETS])
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=["bucket", "n"])


def bucket_counts(df: DataFrame, text_column: str = "text") -> list[int]:
    """Features in each bucket over all texts of ``df``: at most 10,000 rows a task, 10,000 numbers to the driver."""
    bounded_batches(df.sparkSession)
    rows = df.select(column(text_column)).mapInArrow(count_buckets, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = [0] * BUCKETS
    for r in rows.collect():
        out[r.bucket] = r.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the natural logarithm of how much more frequent each bucket is in the target, rounded down."""
    all_source, all_target = sum(source), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (all_source + BUCKETS) / ((s + 1) * (all_target + BUCKETS)))) for s, t in zip(source, target)]


def weigh(of_bucket: list[int], n_named: int):
    """A function for mapInArrow that replaces the last column, a text, by its words, features and weight."""
    gain = np.array([*of_bucket, 0], np.int64)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = Shift()
        for batch in batches:
            texts = batch.column(n_named).cast(pa.binary()).to_pylist()
            n_words, features, weights = ([np.zeros(0, np.int64)] for _ in range(3))
            for a, b in groups(texts):
                counts, runs = runs_of_words(texts[a:b], shift)
                sums = np.concatenate([[0], np.cumsum(sum(gain[r] for r in runs))])
                ends = np.cumsum(counts)
                n_words.append(counts)
                features.append(sum(np.maximum(counts - k, 0) for k in range(LONGEST_RUN)))
                weights.append(sums[ends] - sums[ends - counts])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_named], *[pa.array(np.concatenate(v), pa.int64()) for v in (n_words, features, weights)]],
                names=[*batch.schema.names[:n_named], "n_words", "n_features", "weight"])

    return weighed


def gumbel(id_column: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate that depends on seed and id only, rounded down; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def nth_smallest(df: DataFrame, key: str, n: int) -> tuple[int, int, int]:
    """The ``n``-th smallest value of a whole-number column, rows below it and rows up to it, by bisection.

    Every step counts the rows up to each of a few thresholds in one job, exactly;
    a range of 64 bits is settled after sixteen of them.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    below, upto = 0, None
    while low < high:
        step = max(1, (high - low + 1) // (CUTS + 1))
        cuts = [c for c in (low + step * k - 1 for k in range(1, CUTS + 1)) if c < high]
        for c, m in zip(cuts, df.agg(*[F.count_if(F.col(key) <= F.lit(c)) for c in cuts]).first()):
            if m >= n:
                high, upto = c, m
                break
            low, below = c + 1, m
    return low, below, df.filter(F.col(key) <= F.lit(low)).count() if upto is None else upto


def up_to_nth(df: DataFrame, keys: list[str], n: int) -> Column:
    """Condition that holds for exactly the first ``n`` rows of ``df`` by ``keys``, of which the last one is unique."""
    if n <= 0:
        return F.lit(False)
    key, rest = keys[0], keys[1:]
    value, below, upto = nth_smallest(df, key, n)
    if upto == n or not rest:
        return F.col(key) <= F.lit(value)
    return (F.col(key) < F.lit(value)) | ((F.col(key) == F.lit(value)) & up_to_nth(df.filter(F.col(key) == F.lit(value)), rest, n - below))


def resample(df: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, least_words: int = 20, id_column: str = "doc_id",
             text_column: str = "text", target_text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_features, weight, score and rank, null for rows that are not drawn.

    Drawn are the ``percent`` in a hundred, rounded down, of the rows with at least
    ``least_words`` words that have the highest scores; ties go to the smaller id,
    null last. Null and empty texts have no features and weight 0. Repeated rows
    are rows of their own and get ranks of their own, in any order among equal
    ones. An empty target gives every bucket its smoothed share, an empty table no
    rows; further columns are not read. Ids are whole numbers.
    """
    bounded_batches(df.sparkSession)
    of_bucket = gains(bucket_counts(df, text_column), bucket_counts(target, target_text))
    id_type = df.select(column(id_column)).schema[0].dataType
    named = df.select(F.monotonically_increasing_id().alias("row"), column(id_column).alias("id"), column(text_column).alias("text"))
    schema = T.StructType([*named.schema[:2], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    scored = materialize(
        named.mapInArrow(weigh(of_bucket, 2), schema)
        .withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
        .withColumn("first", -F.col("score")).withColumn("second", F.coalesce(F.col("id").cast("bigint"), F.lit(LAST_ID))), "scores")
    able = F.col("n_words") >= least_words
    n = percent * scored.filter(able).count() // 100
    drawn = able & up_to_nth(scored.filter(able), ["first", "second", "row"], n)
    ranked = running(scored.filter(drawn), [], [F.col("first"), F.col("second"), F.col("row")], None, "rank")
    rows = scored.filter(~drawn).withColumn("rank", F.lit(None).cast("bigint")).unionByName(ranked.withColumn("rank", F.col("rank") + 1))
    return rows.select(F.col("id").cast(id_type).alias(id_column), "n_features", "weight", "score", "rank")
