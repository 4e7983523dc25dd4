"""Scoring the code detector against planted truth over a range of rates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions import fixed
from ledgerlens.functions.expressions import half_up
from ledgerlens.functions.parsing import is_placeholder
from ledgerlens.operators.diagnose import sentinel_hits
from ledgerlens.operators.profile import JointProfile
from ledgerlens.operators.profile.frequency import carrier_of, column_at


#: How text that reads as a number begins; other text may begin so too.
NUMBER_START = rf"^[{re.escape(fixed.NUMBER_MARKS + fixed.WHITESPACE)}(+-]*[0-9.iI]"


def maybe_numeric(df: DataFrame) -> DataFrame:
    """The columns that can turn out numeric, from one pass in which no value moves.

    A column is numeric if PARSE_SHARE of its held values are numbers, so one in
    which fewer begin like a number has no codes to look for. A table without any
    such column is given back whole.
    """
    texts = [i for i, f in enumerate(df.schema.fields) if carrier_of(f.dataType) == "string"]
    if not texts:
        return df
    counts = []
    for i in texts:
        x = column_at(df, i).cast("string")
        counts += [F.count_if(x.isNotNull() & ~is_placeholder(x)).alias(f"held{i}"), F.count_if(x.rlike(NUMBER_START)).alias(f"like{i}")]
    seen = df.agg(*counts).first()
    kept = [i for i in range(len(df.columns)) if i not in texts or 0 < seen[f"like{i}"] >= fixed.PARSE_SHARE * seen[f"held{i}"]]
    return df.select(*[column_at(df, i) for i in kept]) if kept else df


def flagged(profile: JointProfile, rates: Sequence[float] = fixed.SWEEP_RATES) -> DataFrame:
    """(rate, dataset, column, value, n) for every flag in any of the tables; at most 1 / rate to a column."""
    owner = F.element_at(F.array(*[F.lit(o) for o in profile.owners]), F.col("position") + 1)
    return sentinel_hits(profile.numeric, profile.repeated_values, list(rates)).select(
        "rate", owner.alias("dataset"), F.col("name").alias("column"), "value", "n")


def judged(hits: DataFrame, truth: DataFrame, rates: Sequence[float] = fixed.SWEEP_RATES) -> DataFrame:
    """Flags and truth side by side at every rate: found, false alarm or missed."""
    expected = truth.withColumn("rate", F.explode(F.array(*[F.lit(float(r)) for r in rates]))).withColumn("planted", F.lit(True))
    both = hits.withColumn("flag", F.lit(True)).join(expected, ["rate", "dataset", "column", "value"], "full_outer")
    outcome = (F.when(F.col("flag") & F.col("planted"), "found").when(F.col("flag"), "false alarm").otherwise("missed"))
    return both.select("rate", "dataset", "column", "value", "n", outcome.alias("outcome"))


def column_scores(outcomes: DataFrame) -> DataFrame:
    """Found, false and missed values per rate and column."""
    return outcomes.groupBy("rate", "dataset", "column").agg(
        F.count_if(F.col("outcome") == "found").alias("found"),
        F.count_if(F.col("outcome") == "false alarm").alias("false_alarms"),
        F.count_if(F.col("outcome") == "missed").alias("missed"))


def sensitivity(outcomes: DataFrame, rates: Sequence[float] = fixed.SWEEP_RATES) -> DataFrame:
    """Precision and recall per rate over all data sets; precision is undefined without flags."""
    spark = outcomes.sparkSession
    totals = column_scores(outcomes).groupBy("rate").agg(*[F.sum(c).alias(c) for c in ("found", "false_alarms", "missed")])
    every = spark.createDataFrame([(float(r),) for r in rates], "rate double").join(totals, "rate", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("found", "false_alarms", "missed")]
    tp, fp, fn = (F.col(c).cast("double") for c in ("found", "false_alarms", "missed"))
    return every.select("rate", *counts).select(
        "rate", "found", "false_alarms", "missed", half_up(F.try_divide(tp, tp + fp), 4).alias("precision"),
        half_up(F.try_divide(tp, tp + fn), 4).alias("recall")).orderBy("rate")


def flag_detail(outcomes: DataFrame) -> DataFrame:
    """Per rate, the list of flags with their verdict."""
    flags = outcomes.where(F.col("outcome") != "missed")
    text = F.concat("dataset", F.lit(":"), "column", F.lit("="), F.col("value").cast("decimal(18,4)").cast("string"),
                    F.lit(" ("), F.when(F.col("outcome") == "found", "ok").otherwise("FALSE POSITIVE"), F.lit(")"))
    return flags.groupBy("rate").agg(F.array_join(F.array_sort(F.collect_list(text)), "; ").alias("flags"))


def sensitivity_of(profile: JointProfile, truth: DataFrame) -> DataFrame:
    return sensitivity(judged(flagged(profile), truth))
