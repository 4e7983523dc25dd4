"""Pieces that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlens.session import materialize

#: One word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes of one Arrow batch, so that a task never holds more texts than this at once.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch limits to those above, unless they are lower already."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key, None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front if the table has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, by: Sequence[str], order: Sequence[Column], weight: str | None, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` (rows, without one) over the rows of the same ``by`` that sort earlier.

    Rows are placed by range of (by, order) and written, so the placement holds.
    Windows run inside one part of one key. A table with one row for each part
    and key carries the sums across parts, so a key with most of the rows is
    spread over many parts. Rows equal in ``by`` and ``order`` come in any order.
    """
    own = materialize(
        df.repartitionByRange(shuffle_partitions(df.sparkSession), *[F.col(c).asc_nulls_last() for c in by], *order)
        .withColumn("part", F.spark_partition_id()), "ordered")
    w = F.col(weight) if weight else F.lit(1).cast("bigint")
    sums = own.groupBy("part", *by).agg(F.sum(w).alias("part_sum"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("part").alias("of_part"), *[F.col(c).alias(f"of_{c}") for c in by],
        F.coalesce(F.sum("part_sum").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = own.withColumn(name, F.coalesce(F.sum(w).over(within), F.lit(0)))
    same = F.col("part") == F.col("of_part")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return (local.join(offsets, same).withColumn(name, (F.col(name) + F.col("offset")).cast("bigint"))
            .select(*df.columns, name))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the lowest hashes of their ``key``; all if there are fewer.

    A count first tells below which hash about four times as many lie. So tasks
    send the driver about that many in all, and not ``rows`` from each of them.
    """
    share = min(1.0, 4 * rows / max(1, df.count()))
    place = F.pmod(F.xxhash64(column(key)), F.lit(1 << 40))
    return df.filter(place <= int(share * (1 << 40))).orderBy(place, column(key)).limit(rows)
