"""Profiling: measures of a table and of each of its columns, with no judgement."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.functions import fixed
from ledgerlens.operators.profile import columns as C
from ledgerlens.operators.profile.dataset import dataset_profile, positional
from ledgerlens.operators.profile.frequency import value_frequencies, whole_texts
from ledgerlens.session import materialize
from ledgerlens.sources.delimited import duplicate_names, header_of, read_delimited

@dataclass
class Profile:
    """The measures of one table, each computed on first use and written once.

    ``text`` tells whether the table was read as text, in which case the storage
    label is worked out from the values; otherwise it is the Spark type.
    ``as_of`` is the moment after which a date counts as future.
    """

    df: DataFrame
    source: str
    as_of: str
    text: bool = True
    repeated_names: tuple[str, ...] = ()

    #: Fields of the column profile that follow from the summary alone.
    SCALARS: ClassVar[tuple[str, ...]] = (
        "name", "position", "stored_as", "inferred_type", "count", "null_count", "null_pct", "unique_count", "unique_pct",
        "disguised_null_count", "disguised_null_tokens", "whitespace_count", "numeric_parseable_pct", "date_parseable_pct",
        "is_boolean_like", "mixed_type_count")

    @property
    def names(self) -> list[str]:
        return self.df.columns

    @property
    def stored(self) -> list[str] | None:
        return None if self.text else [f.dataType.simpleString() for f in self.df.schema.fields]

    @cached_property
    def frequencies(self) -> DataFrame:
        return materialize(value_frequencies(positional(self.df)), "frequencies")

    @cached_property
    def summary(self) -> DataFrame:
        """One row per column; bounded by the width of the schema."""
        summary = materialize(C.summarize(self.frequencies, self.names, self.stored, self.as_of).repartition(1), "summary")
        if summary.isEmpty():
            raise ValueError(f"{self.source} holds no rows")
        return summary

    @cached_property
    def distinct_numbers(self) -> int:
        """Upper bound on the distinct numbers of all numeric columns together."""
        return self.summary.where("has_stats").agg(F.coalesce(F.sum("n_number_values"), F.lit(0))).first()[0]

    @cached_property
    def ranked(self) -> DataFrame:
        return materialize(C.ranked_numbers(self.frequencies, self.summary, self.distinct_numbers), "ranked")

    @cached_property
    def binned(self) -> DataFrame:
        """At most ten rows per column."""
        return materialize(C.binned_numbers(self.ranked, self.summary).repartition(1), "bins")

    @cached_property
    def numeric(self) -> DataFrame:
        """Statistics of the numeric columns, one row per column."""
        s = self.summary
        counts = s.where("has_stats").select(
            "position", "name", F.col("n_held").alias("count"), F.col("n_distinct").alias("unique_count"))
        joined = counts.join(C.number_stats(self.binned, s), "position").join(
            C.typical_gaps(self.ranked, self.distinct_numbers), "position", "left")
        return materialize(joined.withColumn(
            "typical_value_gap", F.coalesce("typical_value_gap", F.lit(0.0))).repartition(1), "numeric")

    @property
    def histogram(self) -> DataFrame:
        return C.histogram(self.binned, self.summary)

    @cached_property
    def repeated_values(self) -> DataFrame:
        """Numbers frequent enough for the lowest rate of the sweep; at most 1 / rate to a column."""
        return materialize(C.repeated_numbers(self.ranked, self.numeric, self.summary, min(fixed.SWEEP_RATES)), "repeated")

    @property
    def frequent_values(self) -> DataFrame:
        """A listing of at most sixty rows per numeric column, drawn from all that repeat."""
        return C.frequent_numbers(C.repeated_numbers(self.ranked, self.numeric, self.summary, 0.0))

    @property
    def scalars(self) -> DataFrame:
        """The SCALARS of the column profile, without the passes that its other fields need."""
        return self.summary.withColumns({"count": F.col("n_held"), "unique_count": F.col("n_distinct")}).select(*self.SCALARS)

    @property
    def stats(self) -> DataFrame:
        """Name and ``stats`` of the column profile; null for columns without numbers."""
        s = self.summary
        return s.join(self.numeric.drop("name", "count", "unique_count"), "position", "left").select("name", C.number_fields().alias("stats"))

    @property
    def samples(self) -> DataFrame:
        """Name and ``sample_values`` of the column profile, from the first rows and a pass over columns that are short of values there."""
        names = F.element_at(F.array(*[F.lit(n) for n in self.names]), F.col("position") + 1)
        return C.sample_values(positional(self.df)).select(names.alias("name"), "sample_values")

    @cached_property
    def columns(self) -> DataFrame:
        """The column profile: one row per column."""
        s = self.summary
        joined = (
            s.join(self.numeric.drop("name", "count", "unique_count"), "position", "left")
            .join(C.collapsed_distinct(self.frequencies, s), "position", "left")
            .join(C.listed(C.top_values(self.frequencies, s, lambda wanted: whole_texts(positional(self.df), wanted))), "position", "left")
            .join(C.sample_values(positional(self.df), s), "position", "left"))
        span = F.timestamp_diff("DAY", F.col("min_date"), F.col("max_date")).cast("int")
        dates = F.struct("min_date", "max_date", span.alias("span_days"), "future_count")
        is_date = F.col("inferred_type") == "datetime"
        profile = joined.select(
            "name", "position", "stored_as", "inferred_type", F.col("n_held").alias("count"), "null_count", "null_pct",
            F.col("n_distinct").alias("unique_count"), "unique_pct", "sample_values", "top_values",
            "disguised_null_count", "disguised_null_tokens", "whitespace_count", "case_collapsed_unique",
            "numeric_parseable_pct", "date_parseable_pct", "is_boolean_like", "mixed_type_count",
            C.number_fields().alias("stats"), F.when(is_date, dates).alias("date_stats"),
            F.coalesce("typical_value_gap", F.lit(0.0)).alias("typical_value_gap"))
        return materialize(profile.repartition(1), "columns")

    @cached_property
    def dataset(self) -> DataFrame:
        """The dataset profile: one row. It needs no summary, but takes its sums from one that is there."""
        if self.df.isEmpty():
            raise ValueError(f"{self.source} holds no rows")
        return materialize(dataset_profile(self.df, self.__dict__.get("summary"), self.source, list(self.repeated_names)), "dataset")


class JointProfile(Profile):
    """Measures of the columns of several tables, taken by one set of jobs.

    The tables' columns are numbered one after the other, so the frequency table,
    the ranks and all that follows from them hold every table's columns side by
    side. ``owners`` tells the table of each position. What only one table has, a
    dataset profile and sample values, a joint profile has not.
    """

    def __init__(self, tables: Mapping[str, DataFrame], as_of: str, text: bool = True):
        super().__init__(None, ", ".join(tables), as_of, text)
        self.tables = dict(tables)
        self.owners = [name for name, df in tables.items() for _ in df.columns]

    @property
    def names(self) -> list[str]:
        return [c for df in self.tables.values() for c in df.columns]

    @property
    def stored(self) -> list[str] | None:
        return None if self.text else [f.dataType.simpleString() for df in self.tables.values() for f in df.schema.fields]

    @cached_property
    def frequencies(self) -> DataFrame:
        parts, first = [], 0
        for df in self.tables.values():
            parts.append(value_frequencies(positional(df), first))
            first += len(df.columns)
        return materialize(reduce(DataFrame.unionByName, parts), "frequencies")


def profile_file(spark: SparkSession, path: str, as_of: str, header: list[str | None] | None = None, **options) -> Profile:
    """The profile of a delimited text file, with the names that its header repeats."""
    names = header if header is not None else header_of(spark, path, **options)
    return Profile(read_delimited(spark, path, header=header, **options), path, as_of, repeated_names=tuple(duplicate_names(names)))
