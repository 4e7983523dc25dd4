"""Constraint checks: Spark tables do not enforce keys or NOT NULL, so violations are queried."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, or contain a null, with their row count."""
    has_null = F.lit(False)
    for c in key:
        has_null = has_null | F.col(c).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where((F.col("n_rows") > 1) | has_null)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, one row per column, from a single pass without a shuffle of rows."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_null"))
                     for i, c in enumerate(columns)])
    return counted.select(F.inline(rows))


def is_empty(df: DataFrame) -> bool:
    """True for a table without rows; reads at most one row."""
    return df.isEmpty()
