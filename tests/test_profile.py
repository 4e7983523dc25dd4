"""Profiles checked against pandas on small tables, in the small and in the distributed way."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ordering
from ledgerlens.operators.profile import Profile
from ledgerlens.operators.profile import dataset as whole

AS_OF = "2026-08-09"


def profile(spark, columns: dict, text=True):
    n = len(next(iter(columns.values())))
    rows = [tuple(None if c[i] is None else str(c[i]) for c in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    return Profile(df, "test", AS_OF, text=text)


def by_name(p):
    return {r["name"]: r for r in p.columns.collect()}


def test_numeric_measures_agree_with_pandas(spark):
    """Distinct numbers lie in several range partitions here, as on a large table."""
    rng = np.random.default_rng(3)
    data = {"a": rng.gamma(2, 50, 400).round(2), "b": rng.integers(0, 12, 400), "c": [7] * 399 + [8]}
    p = profile(spark, data)
    got = by_name(p)
    for name, values in data.items():
        s, stats = pd.Series(values, dtype=float), got[name]["stats"]
        expected = {"mean": s.mean(), "std": s.std(), "min": s.min(), "q1": s.quantile(.25), "median": s.median(),
                    "q3": s.quantile(.75), "max": s.max(), "zeros": (s == 0).sum(), "negatives": 0, "skew": s.skew()}
        assert {k: stats[k] for k in expected} == pytest.approx(expected, rel=1e-9)
        distinct = np.sort(s.unique())
        typical = float(np.median(np.diff(distinct))) if len(distinct) >= 3 else 0.0
        assert got[name]["typical_value_gap"] == pytest.approx(typical)
        counts = s.value_counts()
        expected_gaps = {v: min(abs(distinct[distinct != v] - v)) for v in counts[counts >= 3].index} if len(distinct) >= 3 else {}
        gaps = {r["value"]: r["gap"] for r in p.frequent_values.where(f"name = '{name}'").collect()}
        assert len(gaps) == (counts >= 3).sum()
        if expected_gaps:
            assert gaps == pytest.approx(expected_gaps)
    bins = {r["bin"]: r["n"] for r in p.histogram.where("name = 'a'").collect()}
    assert [bins[i] for i in range(10)] == np.histogram(data["a"], bins=10)[0].tolist()


def test_only_the_sixty_furthest_frequent_values_stay(spark):
    values = [v for v in range(100) for _ in range(3)]
    rows = profile(spark, {"v": values}).frequent_values.collect()
    assert len(rows) == 60
    assert {r["value"] for r in rows} == set(range(30)) | set(range(70, 100))


def test_storage_and_meaning_of_columns(spark):
    n = 60
    p = profile(spark, {
        "id": [f"K{i}" for i in range(n)], "whole": list(range(n)), "gaps": [None] + list(range(n - 1)),
        "flag": ["True", "False"] * 30, "yes": [" Yes", "no"] * 30, "nothing": [None] * n, "same": ["x"] * n,
        "blank": ["", " ", "N/A"] * 20, "city": ["Oslo", "oslo ", "Rome"] * 20, "day": ["2025-01-31", "31/01/2025"] * 30,
        "essay": [f"{i} " + "word " * 20 for i in range(20)] * 3, "mixed": [str(i % 7) if i % 2 else "n" + str(i % 5) for i in range(n)]})
    got = by_name(p)
    assert {k: (r["stored_as"], r["inferred_type"]) for k, r in got.items()} == {
        "id": ("str", "identifier"), "whole": ("int64", "numeric"), "gaps": ("float64", "numeric"), "flag": ("bool", "boolean"),
        "yes": ("str", "boolean"), "nothing": ("float64", "empty"), "same": ("str", "constant"), "blank": ("str", "empty"),
        "city": ("str", "categorical"), "day": ("str", "datetime"), "essay": ("str", "categorical"), "mixed": ("str", "categorical")}
    assert got["blank"]["disguised_null_tokens"] == ["", "n/a"] and got["blank"]["null_pct"] == 100.0
    assert (got["city"]["unique_count"], got["city"]["case_collapsed_unique"], got["city"]["whitespace_count"]) == (3, 2, 20)
    assert got["mixed"]["mixed_type_count"] == 30
    assert got["id"]["sample_values"] == [f"K{i}" for i in range(5)]
    assert [tuple(v) for v in got["city"]["top_values"]] == [("Oslo", 20), ("Rome", 20), ("oslo ", 20)]


def test_sample_values_beyond_the_first_rows(spark):
    """A column whose first values come late is searched in full."""
    values = [None] * 1500 + ["late1", "late2"]
    p = profile(spark, {"a": list(range(1502)), "b": values})
    assert by_name(p)["b"]["sample_values"] == ["late1", "late2"]


def test_typed_tables_use_the_spark_type_and_skip_nan(spark):
    df = spark.createDataFrame([(1, 1.5, True), (2, float("nan"), False), (2**60 + 1, 2.5, None), (2**60, 2.5, None)],
                               "k bigint, x double, b boolean")
    got = by_name(Profile(df, "typed", AS_OF, text=False))
    assert {k: r["stored_as"] for k, r in got.items()} == {"k": "bigint", "x": "double", "b": "boolean"}
    assert got["x"]["null_count"] == 1 and got["k"]["unique_count"] == 4


def test_one_row_and_empty_tables(spark):
    stats = by_name(profile(spark, {"v": ["5"]}))["v"]["stats"]
    assert (stats["std"], stats["skew"], stats["q1"]) == (0.0, 0.0, 5.0)
    with pytest.raises(ValueError, match="no rows"):
        Profile(spark.createDataFrame([], "v string"), "none", AS_OF).summary


def test_duplicates_treat_nulls_as_equal_and_count_copies_only(spark):
    df = spark.createDataFrame([("a", None)] * 3 + [(None, "a"), ("b", "c"), ("b", "c")], "x string, y string")
    assert whole.surplus_rows(df).first()[0] == 3
    assert {tuple(r) for r in whole.repeated_rows(df).collect()} == {("a", None, 3), ("b", "c", 2)}


def test_identical_columns_need_the_same_rows_not_only_the_same_values(spark):
    rows = [("1", "1", "2", None, None), ("2", "2", "1", None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, shuffled string, e1 string, e2 string")
    assert whole.identical_pairs(df) == [("a", "b")]


def test_many_copies_of_one_row(spark):
    rows = [("hot", None)] * 500 + [("cold", "x")] * 2 + [(f"u{i}", "x") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(8)
    assert {tuple(r) for r in whole.repeated_rows(df).collect()} == {("hot", None, 500), ("cold", "x", 2)}
    assert whole.surplus_rows(df).first()[0] == 500


def test_only_digests_move_to_count_duplicates(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = whole.surplus_rows(df)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("digest_a" in e and "c0" not in e for e in exchanges)


def test_columns_of_doubled_rows_are_not_taken_for_copies(spark):
    df = spark.createDataFrame([(i, i * i, -i, i % 3) for i in range(20)] * 2, "a int, b int, c int, d int")
    assert whole.identical_pairs(df.selectExpr("*", "a as e", "c as f")) == [("a", "e"), ("c", "f")]


def test_values_are_placed_in_several_parts(spark):
    df = spark.range(5000).selectExpr("1 as k", "cast(id as double) as x", "1L as n")
    parts = ordering.ordered_parts(df, ["k"], ["x"], 5000, "n")
    assert parts.select("part").distinct().count() > 1
    hot = ordering.ordered_parts(spark.range(5000).selectExpr("1 as k", "1.0 as x", "1L as n"), ["k"], ["x"], 5000, "n")
    assert [(r["x"], r["n"]) for r in hot.collect()] == [(1.0, 5000)]


def test_rows_are_spelled_apart_without_the_text_of_numbers(spark):
    rows = [(1.0, 12, "3"), (1.0, 1, "23"), (None, 1, "-"), (float("nan"), 1, None), (float("nan"), 1, "-;"), (0.0, None, "x"), (-0.0, None, "x"),
            (5e-324, None, "x"), (1e16, -1, ""), (1.0000000000000002e16, -1, ""), (float("inf"), -1, "")]
    df = whole.positional(spark.createDataFrame(rows, "x double, k bigint, v string"))
    spelled = df.select(whole.spelled(df).alias("s"))
    assert spelled.distinct().count() == len(rows) - 1
    plan = spelled._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(c0" not in plan and "cast(c1" not in plan


def test_scalars_need_neither_ranks_nor_top_values(spark):
    p = profile(spark, {"a": [1, 2, "n/a", None], "b": ["x", " y", "Y", "x"]})
    scalars = p.scalars.orderBy("position").collect()
    assert not {"ranked", "numeric", "columns"} & set(p.__dict__)
    assert scalars == p.columns.select(*p.SCALARS).orderBy("position").collect()


def test_a_dataset_profile_needs_no_counts_of_values(spark):
    df = spark.createDataFrame([(1, 1.5, " N/A ", "é"), (None, float("nan"), None, ""), (3, None, "x", "tbd")] * 2, "k int, x double, v string, w string")
    df = df.withColumn("t", F.timestamp_micros(F.lit(1_700_000_000_500_000)))
    p, q = Profile(df, "one", AS_OF, text=False), Profile(df, "one", AS_OF, text=False)
    alone = p.dataset.collect()
    assert not {"frequencies", "summary"} & set(p.__dict__)
    assert q.summary.count() == 5 and q.dataset.collect() == alone and alone[0].missing_cells == 14
