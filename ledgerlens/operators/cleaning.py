"""Carrying out the advice: repairs that change a table, and views of the rows in question."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerlens.functions import fixed
from ledgerlens.functions.parsing import is_placeholder, normal_form, parse_boolean, parse_date, parse_number, strip
from ledgerlens.operators.ordering import quantile_columns, quantile_picks, running_weight
from ledgerlens.operators.profile.columns import QUARTILES
from ledgerlens.operators.profile.dataset import digested, identical_pairs, positional, suspects, unnamed_columns
from ledgerlens.session import materialize


def named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    gone = set(columns)
    return df.select(*[named(c) for c in df.columns if c not in gone])


def _replace(df: DataFrame, columns: Sequence[str], change) -> DataFrame:
    targets = set(columns)
    return df.select(*[change(named(c)).alias(c) if c in targets else named(c) for c in df.columns])


# --- whole table ---------------------------------------------------------------------------

def list_repeated_rows(df: DataFrame) -> DataFrame:
    """Every copy of every row that occurs more than once, sorted by all columns.

    The rows are found by semi joins, first with the digests that repeat, then
    with the rows that do, so no group of copies has to fit in one task, and rows
    that only share a digest are left out.
    """
    rows = positional(df)
    often = suspects(rows)
    found = digested(rows).join(often, ["digest_a", "digest_b"], "left_semi")
    twins = found.groupBy(*found.columns).agg(F.count("*").alias("copies")).where("copies > 1").toDF(*[f"twin_{c}" for c in found.columns], "copies")
    same = [F.col(c).eqNullSafe(F.col(f"twin_{c}")) for c in rows.columns]
    keys = [F.col(c) == F.col(f"twin_{c}") for c in ("digest_a", "digest_b")]
    copies = found.join(twins, reduce(and_, keys + same), "left_semi").select(*rows.columns, F.monotonically_increasing_id().alias("row"))
    # The row number as last key lets the range sort split a long run of equal rows over several tasks.
    ordered = copies.orderBy(*[F.asc_nulls_last(c) for c in copies.columns])
    return ordered.drop("row").toDF(*df.columns)


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows."""
    return df.dropDuplicates()


def drop_identical_columns(df: DataFrame) -> DataFrame:
    """Keeps the first column of each identical pair."""
    return drop_columns(df, [b for _, b in identical_pairs(df)])


def drop_unnamed_columns(df: DataFrame) -> DataFrame:
    return drop_columns(df, unnamed_columns(df.columns))


def drop_uninformative_columns(df: DataFrame) -> DataFrame:
    """Drops columns that are empty or hold one value, placeholders counting as missing.

    Smallest and largest value tell a constant column apart from the rest without
    counting distinct values.
    """
    rows = positional(df)
    held = {c: F.when(~is_placeholder(F.col(c).cast("string")), F.col(c)) for c in rows.columns}
    ends = rows.agg(*[(F.min(h).eqNullSafe(F.max(h))).alias(c) for c, h in held.items()]).first()
    return drop_columns(df, [name for name, c in zip(df.columns, rows.columns) if ends[c]])


# --- one column ----------------------------------------------------------------------------

def placeholders_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, columns, lambda c: F.when(~is_placeholder(c), c))


def text_to_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, columns, parse_number)


def text_to_date(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, columns, parse_date)


def text_to_boolean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, columns, parse_boolean)


def normalise_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, columns, normal_form)


def strip_whitespace(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(df, columns, strip)


def sentinels_to_null(df: DataFrame, column: str, values: Sequence[float]) -> DataFrame:
    """Nulls the confirmed codes, compared as numbers so that ``999`` and ``999.0`` are the same."""
    return _replace(df, [column], lambda c: F.when(
        ~F.coalesce(parse_number(c.cast("string")).isin(*[float(v) for v in values]), F.lit(False)), c))


def pool_rare_categories(df: DataFrame, column: str, keep: int, other: str = "Other") -> DataFrame:
    """Keeps the ``keep`` most frequent categories and pools the rest.

    Whether the short list of kept names is broadcast is left to Spark's size limit.
    """
    counts = df.where(named(column).isNotNull()).groupBy(named(column).alias("v")).agg(F.count("*").alias("n"))
    mark = next(m for m in (f"kept_{i}" for i in range(len(df.columns) + 1)) if m not in {c.lower() for c in df.columns})
    top = counts.orderBy(F.desc("n"), "v").limit(keep).select(F.col("v").alias(mark))
    joined = df.join(top, named(column) == F.col(mark), "left")
    pooled = F.when(named(column).isNull() | F.col(mark).isNotNull(), named(column)).otherwise(F.lit(other))
    return joined.select(*[pooled.alias(c) if c == column else named(c) for c in df.columns])


# --- looking at rows -----------------------------------------------------------------------

def value_counts(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent non-null values; equal counts are ordered by value."""
    return df.where(named(column).isNotNull()).groupBy(named(column).alias("value")).agg(
        F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def unparseable_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The most frequent values that are not numbers."""
    return value_counts(df.where(named(column).isNotNull() & parse_number(named(column)).isNull()), column, k)


def repeated_identifiers(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The identifiers shared by most rows."""
    counts = df.where(named(column).isNotNull()).groupBy(named(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > 1).orderBy(F.desc("n"), "value").limit(k)


def negative_rows(df: DataFrame, column: str, order: Sequence[str], k: int = 20) -> DataFrame:
    """The first ``k`` rows, in the given order, with a value below zero."""
    return df.where(parse_number(named(column).cast("string")) < 0).orderBy(*[named(c) for c in order]).limit(k)


def describe_missing(df: DataFrame, column: str) -> DataFrame:
    """The rows in which ``column`` is missing, summed up over every other column.

    Count, distinct values, the commonest value (the smallest of those) and its
    count, extremes, and for numeric columns mean, deviation and exact quartiles.
    Values are counted once, combined map-side, and written; all else follows from
    the counts. Deviations are taken from the mean, so large values lose no digits.
    """
    spark = df.sparkSession
    missing = df.where(named(column).isNull())
    others = [c for c in df.columns if c != column]
    numeric = [str(i) for i, c in enumerate(others) if isinstance(df.schema[c].dataType, T.NumericType)]
    cells = missing.select(*[named(c).cast("string").alias(str(i)) for i, c in enumerate(others)], F.lit("").alias("rows"))
    counted = cells.unpivot([], [str(i) for i in range(len(others))] + ["rows"], "place", "v").groupBy("place", "v").agg(F.count("*").alias("n"))
    values = materialize(counted.withColumn("x", F.when(F.col("place").isin(numeric), F.col("v").try_cast("double"))), "missing")
    x, n, held = F.col("x"), F.col("n"), F.col("v").isNotNull()
    sums = values.groupBy("place").agg(
        F.coalesce(F.sum(F.when(held, n)), F.lit(0)).alias("count"), F.count("v").alias("unique"),
        F.min(F.when(held, F.struct((-n).alias("n"), F.col("v").alias("v")))).alias("top"),
        F.max(F.when(held, n)).alias("freq"), F.min("v").alias("min"), F.max("v").alias("max"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.sum(F.when(x.isNotNull(), n)).alias("k"), F.try_divide(F.sum(x * n), F.sum(F.when(x.isNotNull(), n))).alias("mean"))
    sums = materialize(sums.repartition(1), "sums")
    numbers = values.where(x.isNotNull())
    # One row for each column: the broadcast table is as wide as the schema.
    apart = x - F.col("mean")
    squares = numbers.join(F.broadcast(sums.select("place", "mean")), "place").groupBy("place").agg(F.sum(apart * apart * n).alias("m2"))
    placed = running_weight(numbers.select("place", "x", "n"), ["place"], ["x"], numbers.count(), "n", total="all")
    quartiles = placed.groupBy("place").agg(*quantile_picks("x", "n", F.col("all"), QUARTILES)).select("place", *quantile_columns(QUARTILES))
    rows = sums.where("place = 'rows'").select(F.col("count").alias("rows"))
    frame = spark.createDataFrame([(str(i), c) for i, c in enumerate(others)], "place string, name string")
    end = lambda text, number: F.coalesce(F.col(number).cast("string"), F.col(text))
    return frame.join(sums, "place", "left").join(squares, "place", "left").join(quartiles, "place", "left").select(
        F.coalesce(rows.scalar(), F.lit(0)).cast("bigint").alias("rows"), "name", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        F.coalesce("unique", F.lit(0)).cast("bigint").alias("unique"), F.col("top.v").alias("top"), "freq",
        end("min", "low").alias("min"), end("max", "high").alias("max"), "mean", F.sqrt(F.try_divide(F.col("m2"), F.col("k") - 1)).alias("std"), *QUARTILES)


def outlier_rows(df: DataFrame, column: str, columns: DataFrame) -> DataFrame:
    """Rows outside the quartile fence; the bounds come from the column profile as a scalar."""
    fence = columns.where(F.col("name") == column).select(F.struct(
        (F.col("stats.q1") - fixed.FENCE * (F.col("stats.q3") - F.col("stats.q1"))).alias("lo"),
        (F.col("stats.q3") + fixed.FENCE * (F.col("stats.q3") - F.col("stats.q1"))).alias("hi"))).scalar()
    x = parse_number(named(column).cast("string"))
    return df.where((x < fence.getField("lo")) | (x > fence.getField("hi")))


def future_rows(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """Rows dated after ``as_of``; text dates are parsed, typed ones compared directly."""
    when = parse_date(named(column)) if dict(df.dtypes)[column] == "string" else named(column)
    return df.where(when > F.lit(as_of).cast("timestamp"))
