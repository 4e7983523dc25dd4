"""Counts, averages, bands and correlations over a survey table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions import fixed
from ledgerlens.functions.expressions import half_up, mean_of, ordinal, pct
from ledgerlens.operators.revenue import grand_totals

SCORES = {"todep": "average_phq", "tosc": "average_scs", "toas": "average_as"}


def group_sizes(df: DataFrame, by: str = "inter_dom") -> DataFrame:
    """Rows per category, largest first; rows without a category form their own group."""
    return df.groupBy(by).agg(F.count("*").alias("n_students")).orderBy(F.desc("n_students"), F.asc_nulls_last(by))


def unlabelled(df: DataFrame, column: str = "inter_dom") -> DataFrame:
    return df.where(F.col(column).isNull()).agg(F.count("*").alias("n_unlabeled"))


def score_ranges(df: DataFrame, valid: Mapping[str, tuple[int, int]] = fixed.SCORE_RANGES) -> DataFrame:
    """Smallest and largest value of every score, and whether both lie in the valid range."""
    names = {"todep": "phq", "tosc": "scs", "toas": "as"}
    measures, flags = [], []
    for column, (low, high) in valid.items():
        name = names.get(column, column)
        measures += [F.min(column).alias(f"min_{name}"), F.max(column).alias(f"max_{name}")]
        flags.append(((F.col(f"min_{name}") >= low) & (F.col(f"max_{name}") <= high)).alias(f"{name}_range_ok"))
    return df.agg(*measures).select("*", *flags)


def distribution(df: DataFrame, by: str = "stay") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n_students")).orderBy(F.asc_nulls_last(by))


def average_scores(df: DataFrame, by: str = "stay", scores: Mapping[str, str] = SCORES,
                   count_as: str = "count_int", descending: bool = True) -> DataFrame:
    """Mean of several scores per group; a missing score leaves only its own mean out."""
    grouped = df.groupBy(by).agg(
        F.count("*").alias(count_as),
        *[F.sum(c).alias(f"{c}_sum") for c in scores], *[F.count(c).alias(f"{c}_n") for c in scores])
    order = F.desc_nulls_first(by) if descending else F.asc_nulls_last(by)
    return grouped.orderBy(order).select(
        by, count_as, *[mean_of(F.col(f"{c}_sum"), F.col(f"{c}_n")).alias(name) for c, name in scores.items()])


def correlation(a: str, b: str, digits: int = 3) -> Column:
    """Pearson correlation, null when either side does not vary."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return half_up(F.try_divide(F.covar_pop(x, y), spread), digits)


def score_correlations(df: DataFrame) -> DataFrame:
    return df.agg(correlation("todep", "tosc").alias("corr_depression_connectedness"),
                  correlation("todep", "toas").alias("corr_depression_stress"))


def severity_breakdown(df: DataFrame, band: str = "depsev",
                       order: Sequence[str] = fixed.SEVERITY_BANDS) -> DataFrame:
    """Rows and share per band, in the order of severity and not of the alphabet."""
    grouped = df.groupBy(band).agg(F.count("*").alias("n_students"))
    whole = grand_totals(grouped, "n_students")
    return grouped.select(
        band, "n_students", pct(F.col("n_students"), whole["n_students"]).alias("pct_of_international"),
    ).orderBy(ordinal(band, order).asc_nulls_last())


def tail_share(df: DataFrame, band: str = "depsev", worst: Sequence[str] = fixed.SEVERITY_BANDS[2:]) -> DataFrame:
    """How many rows fall in the worst bands, and their share of all rows."""
    counted = df.agg(F.count_if(F.col(band).isin(*worst)).alias("n_tail"), F.count("*").alias("n_students"))
    return counted.select("n_tail", "n_students", pct(F.col("n_tail"), F.col("n_students")).alias("pct_tail"))
