"""Exact running totals, quantiles and top fractions without a single-task sort.

A window over a whole table would sort it in one task. Here the rows are range
partitioned by the sort order, written once so the placement cannot change, and
each partition is offset by the weight of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from ledgerlens.session import materialize

ROWS_PER_PART = 2_000_000
#: A quantile sketch errs by at most one in so many ranks.
SKETCH_ACCURACY = 10_000


def merged_rows(df: DataFrame, columns: Sequence[str], weight: str | None) -> DataFrame:
    return df.groupBy(*columns).agg(F.sum(weight).alias(weight)) if weight else df


def ordered_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, weight: str | None = None,
                  descending: bool = False) -> DataFrame:
    """``df`` with a ``part`` number that follows the sort order; equal rows merge if there is a ``weight``.

    Equal rows merge first, combined map-side, so that a value most rows share is
    a handful of rows by the time it is placed. The parts are the range partitions
    of (keys, order), balanced by Spark's sampling; one key with most of the rows
    is spread over many parts because the order column splits it.
    """
    sort = [F.asc(k) for k in keys] + [F.desc(c) if descending else F.asc(c) for c in order]
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(shuffle, -(-rows // ROWS_PER_PART))
    placed = merged_rows(df, [*keys, *order], weight).repartitionByRange(n, *sort)
    return materialize(placed.withColumn("part", F.spark_partition_id()), "ordered")


def running_weight(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, weight: str | None = None,
                   descending: bool = False, neighbours: str | None = None, total: str | None = None) -> DataFrame:
    """Adds ``before``: the weight of all rows of the same key that sort earlier.

    ``rows`` is an upper bound on the rows of ``df``; rows of equal keys and order
    merge if there is a ``weight``. With ``neighbours`` naming the order column it
    also adds ``previous`` and ``next``, the adjacent values; ``total`` names a
    column for the weight of the whole key.

    Windows run inside parts, and a table with one row per key and part, whose
    size follows the number of partitions, carries sums and edge values across the
    borders.
    """
    parts, group = ordered_parts(df, keys, order, rows, weight, descending), [*keys, "part"]
    w = F.col(weight) if weight else F.lit(1)
    within = Window.partitionBy(*group).orderBy(*[F.desc(c) if descending else F.asc(c) for c in order])
    to_here = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.withColumn("before", F.sum(w).over(to_here) - w)
    if neighbours:
        local = local.withColumn("previous", F.lag(neighbours).over(within)).withColumn(
            "next", F.lead(neighbours).over(within))
    edges = [F.min(neighbours).alias("part_min"), F.max(neighbours).alias("part_max")] if neighbours else []
    by_part = Window.partitionBy(*keys).orderBy("part")
    offsets = parts.groupBy(*group).agg(F.sum(w).alias("part_weight"), *edges).withColumn(
        "part_before", F.sum("part_weight").over(by_part) - F.col("part_weight"))
    if total:
        offsets = offsets.withColumn(total, F.sum("part_weight").over(Window.partitionBy(*keys)))
    if neighbours:
        offsets = (offsets.withColumn("previous_max", F.lag("part_max").over(by_part))
                   .withColumn("next_min", F.lead("part_min").over(by_part)))
    joined = local.join(offsets, group).withColumn("before", F.col("before") + F.col("part_before"))
    if neighbours:
        joined = joined.withColumn("previous", F.coalesce("previous", "previous_max")).withColumn(
            "next", F.coalesce("next", "next_min"))
    return joined.drop("part", "part_weight", "part_before", "part_min", "part_max", "previous_max", "next_min")


def quantile_picks(value: str, weight: str, total: Column, probabilities: dict[str, float]) -> list[Column]:
    """Aggregates that find the two values around each quantile; see :func:`quantile_columns`.

    Each quantile lies between two ranks. The row covering a rank is known from
    ``before``, so a plain maximum over matching rows picks its value.
    """
    picks = []
    for name, p in probabilities.items():
        position = F.lit(p) * (total - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            covers = (F.col("before") <= rank) & (rank < F.col("before") + F.col(weight))
            picks.append(F.max(F.when(covers, F.col(value))).alias(f"{name}_{side}"))
        picks.append(F.max(position - F.floor(position)).alias(f"{name}_share"))
    return picks


def merge_picks(probabilities: dict[str, float]) -> list[Column]:
    """The same picks gathered over finer groups."""
    return [F.max(f"{name}_{part}").alias(f"{name}_{part}") for name in probabilities for part in ("lo", "hi", "share")]


def quantile_columns(probabilities: dict[str, float]) -> list[Column]:
    """Linear interpolation between the picked values."""
    return [(F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * F.col(f"{name}_share")).alias(name)
            for name in probabilities]


def top_rows(df: DataFrame, k: int, by: str, tie_keys: Sequence[str], rows: int) -> DataFrame:
    """The ``k`` rows with the largest ``by``, ties settled by ``tie_keys``; any ``k``.

    The counts per distinct value give the exact cut; rows above it pass a plain
    filter, and only rows equal to the cut are ordered by their keys. ``rows`` is
    the number of rows of ``df``.
    """
    if k <= 0:
        return df.where(F.lit(False))
    df = df.where(F.col(by).isNotNull())
    counts = df.groupBy(by).agg(F.count("*").alias("n"))
    ranked = running_weight(counts, [], [by], rows, "n", descending=True)
    cut = ranked.where((F.col("before") < k) & (F.col("before") + F.col("n") >= k)).select(by, "before", "n").first()
    if cut is None:
        return df
    above, ties = df.where(F.col(by) > F.lit(cut[by])), df.where(F.col(by) == F.lit(cut[by]))
    wanted = k - cut["before"]
    if wanted == cut["n"]:
        return df.where(F.col(by) >= F.lit(cut[by]))
    placed = running_weight(ties, [], tie_keys, rows=cut["n"])
    return above.unionByName(placed.where(F.col("before") < wanted).select(*df.columns))


def top_fraction_and(df: DataFrame, fraction: float, by: str, tie_keys: Sequence[str], *measures: Column) -> tuple[DataFrame, Row]:
    """The largest ``fraction`` of the rows that have a value, rounded down to whole rows, and ``measures`` over all of these.

    Two reads of ``df``. The first counts, takes the measures, and sketches the
    quantiles on either side of the cut, of which the sketch bounds the error. The
    second writes the rows from the lower one up. All that is exact happens in the
    narrow range between the two: counts per value settle the cut, and keys settle
    the rows equal to it. Rows without a value never count.
    """
    df = df.where(F.col(by).isNotNull())
    x = F.col(by).cast("double")
    around = [min(1.0, max(0.0, 1 - fraction + d / SKETCH_ACCURACY)) for d in (-2, 2)]
    whole = df.agg(F.count("*").alias("rows"), F.percentile_approx(x, around, SKETCH_ACCURACY).alias("around"), *measures).first()
    k = int(Decimal(str(fraction)) * whole["rows"])
    if k <= 0:
        return df.where(F.lit(False)), whole
    low, high = whole["around"]
    near = materialize(df.where(x >= F.lit(low)), "near")
    above, rows = near.agg(F.count_if(x > F.lit(high)), F.count("*")).first()
    if not above <= k <= rows:  # the sketch promises that this does not happen
        return top_rows(df, k, by, tie_keys, whole["rows"]), whole
    rest = top_rows(near.where(x <= F.lit(high)), k - above, by, tie_keys, rows - above)
    return near.where(x > F.lit(high)).unionByName(rest), whole


def top_fraction(df: DataFrame, fraction: float, by: str, tie_keys: Sequence[str]) -> DataFrame:
    """The rows of :func:`top_fraction_and` alone."""
    return top_fraction_and(df, fraction, by, tie_keys)[0]


def largest_rows(df: DataFrame, k: int, by: str, tie_keys: Sequence[str]) -> DataFrame:
    """A short top-k report; Spark keeps k rows per task and merges them."""
    return df.orderBy(F.desc_nulls_last(by), *tie_keys).limit(k)
