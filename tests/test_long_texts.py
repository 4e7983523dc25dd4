"""Columns of texts longer than what travels of them."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators.profile import Profile
from ledgerlens.operators.profile.frequency import HEAD, value_frequencies

SAME = "The same beginning of many a text, longer than what is sent along with its count: "
ROWS = ([f"{SAME}{i % 30:02d}" for i in range(90)] + [f"{SAME}{i:02d} once" for i in range(40, 60)] + ["Short"] * 3 + ["  short  "] * 2 + [None, "", "N/A" + " " * 90, "   -  "]
        + [SAME.upper() + "07"] * 5 + ["x" * 70 + " "])


def plain():
    held = [v for v in ROWS if v is not None and v.strip().lower() not in ("", "n/a", "-")]
    counts = {v: held.count(v) for v in held}
    return held, sorted(counts.items(), key=lambda e: (-e[1], e[0]))


def test_profile_of_long_texts(spark):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(ROWS)], "words string, k int").repartition(4)
    row = {r.name: r for r in Profile(df, "texts", "2026-01-01", text=False).columns.collect()}["words"]
    held, top = plain()
    assert (row["count"], row.unique_count, row.disguised_null_count) == (len(held), len(set(held)), 3)
    assert [(t.value, t.n) for t in row.top_values] == top[:8]
    assert row.case_collapsed_unique == len({v.strip().lower() for v in held})
    assert row.whitespace_count == sum(v != v.strip() for v in held) and row.disguised_null_tokens == ["", "-", "n/a"]


def test_long_numbers_and_dates_are_read(spark):
    df = spark.createDataFrame([("0" * 70 + str(i), f"{' ' * 40}2024-01-{i + 10}{' ' * 40}") for i in range(9)], "a string, b string")
    rows = {r.name: r for r in Profile(df, "wide", "2026-01-01").columns.collect()}
    assert rows["a"].stored_as == "int64" and (rows["a"].stats.min, rows["a"].stats.max) == (0.0, 8.0)
    assert rows["b"].inferred_type == "datetime" and rows["b"].date_stats.max_date == dt.datetime(2024, 1, 18) and rows["b"].whitespace_count == 0


def test_one_scan_and_no_long_text_in_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(v, i, i / 7, dt.date(2024, 1, 1)) for i, v in enumerate(ROWS)], "words string, k int, share double, day date").write.parquet(path)
    frequencies = value_frequencies(spark.read.parquet(path))
    plan = frequencies._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert frequencies.agg(F.max(F.length("value"))).first()[0] <= HEAD
    assert {r.position for r in frequencies.select("position").distinct().collect()} == {0, 1, 2, 3}


def test_equal_rows_of_two_types(spark):
    df = spark.createDataFrame([(1, 1.0, "1", True, b"1")] * 3, "i int, d double, s string, b boolean, raw binary")
    got = {r.position: (r.value, r.n, r.x) for r in value_frequencies(df).collect()}
    assert got == {0: ("1", 3, 1.0), 1: ("1.0", 3, 1.0), 2: ("1", 3, 1.0), 3: ("true", 3, None), 4: ("1", 3, 1.0)}


def test_measures_are_in_the_plan_once_whatever_the_columns(spark):
    def digests(n):
        df = spark.range(3).select(*[F.concat(F.lit(SAME), F.col("id") + k).alias(f"c{k}") for k in range(n)])
        return value_frequencies(df)._jdf.queryExecution().optimizedPlan().toString().count("sha2(")
    assert digests(9) == digests(1) > 0
