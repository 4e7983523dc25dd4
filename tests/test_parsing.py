"""Tolerant parsing, value by value."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import parsing
from ledgerlens.operators.profile import Profile

NUMBERS = [
    ("$1,836.47", 1836.47), ("17.8%", 17.8), ("(5)", -5.0), ("(-5)", None), ("1d", None), ("3f", None), ("1_000", None),
    ("0x10", None), ("True", None), ("1e5", 1e5), ("1.", 1.0), (".5", 0.5), ("+7", 7.0), ("\t€1,5 ", 15.0), ("1 000", 1000.0),
    ("  12 ", 12.0), ("", None), ("-", None), ("()", None), ("inf", math.inf), ("-Infinity", -math.inf), ("abc", None)]
DATES = [
    ("2025-01-31", dt.datetime(2025, 1, 31)), ("2025-1-5", dt.datetime(2025, 1, 5)), ("31/01/2025", dt.datetime(2025, 1, 31)),
    ("03/04/2025", dt.datetime(2025, 3, 4)), ("20240105", dt.datetime(2024, 1, 5)), ("2025", dt.datetime(2025, 1, 1)),
    ("Mar 4 2025", dt.datetime(2025, 3, 4)), ("March 4, 2025", dt.datetime(2025, 3, 4)), ("4 Mar 2025", dt.datetime(2025, 3, 4)),
    ("2025/02/03", dt.datetime(2025, 2, 3)), ("2025-01-05T10:00:00Z", dt.datetime(2025, 1, 5, 10)), ("10:00", None), ("May", None),
    ("2025-13-01", None), ("99/99/2025", None), ("ORD-1000", None), (" 2025-01-31 ", dt.datetime(2025, 1, 31))]
DAY, NOON = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 12, 34, 56)
MORE_DATES = [
    *[(t, DAY) for t in ("2024-1-5", "2024/01/05", "2024.1.05", "1/5/2024", "01.05.2024", "1-5-24", "01/05/24", "Jan 5 2024", "January 5th, 2024", "Jan. 5, 24",
                         "5 Jan 2024", "5th January, 2024", "05-Jan-24", "Fri, 5 Jan 2024", "friday, January 5, 2024", "Jan-5-2024")],
    *[(t, NOON) for t in ("2024-01-05 12:34:56", "2024-01-05T12:34:56", "1/5/2024 12:34:56 PM", "Jan 5, 2024, 12:34:56", "20240105T123456", "5 Jan 2024 12:34:56pm",
                          "2024-01-05 12:34:56Z", "2024-01-05T14:34:56+02:00", "2024-01-05T07:04:56-0530", "Fri 5 Jan 2024 12:34:56 GMT")],
    ("2024-01-05 12:34:56.5", NOON.replace(microsecond=500_000)), ("2024-01-05 12:34:56.123456789", NOON.replace(microsecond=123_456)),
    ("2024-01-05 12:34", NOON.replace(second=0)), ("20240105T1234", NOON.replace(second=0)), ("2024-01-05 12:04 am", dt.datetime(2024, 1, 5, 0, 4)),
    ("2024-01-05 1:02 PM", dt.datetime(2024, 1, 5, 13, 2)), ("2024-01", dt.datetime(2024, 1, 1)), ("Jan 2024", dt.datetime(2024, 1, 1)), ("1/5/69", dt.datetime(1969, 1, 5)),
    ("1/5/68", dt.datetime(2068, 1, 5)), ("29 Feb 2024", dt.datetime(2024, 2, 29)), ("29/02/2024", dt.datetime(2024, 2, 29)), ("Sept 3 2024", dt.datetime(2024, 9, 3)),
    ("3rd   Sept 2024", None), ("2023-02-29", None), ("30/02/2024", None), ("13/13/2024", None), ("0/1/2024", None), ("Foo 5 2024", None), ("Anf 5 2024", None),
    ("2024-01-05 24:00", None), ("2024-01-05 12:60", None), ("2024-01-05 12:00:60", None), ("2024-00-05", None), ("20241305", None), ("2024-01-05 x", None),
    ("5 Jan", None), ("", None), (None, None), ("1234567", None), ("123456789", None), ("1.5", None), ("12/34", None), ("2024-01-05\n2024-01-05", None),
    ("January 5, 2024" + " " * 60 + "12:34:56", NOON), ("x" * 50_000, None), ("1" * 50_000, None)]
PLACEHOLDERS = [("N/A", True), (" Unknown ", True), ("-", True), ("\t", True), ("", True), ("n.a.", True), ("none of it", False), (None, False)]


@pytest.mark.parametrize("cases, parse", [
    (NUMBERS, lambda c: parsing.parse_number(c)), (DATES + MORE_DATES, lambda c: parsing.parse_date(c)),
    (PLACEHOLDERS, lambda c: parsing.is_placeholder(c))], ids=["numbers", "dates", "placeholders"])
def test_each_value(spark, cases, parse):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(parse(F.col("v"))).collect()]
    assert got == [e for _, e in cases]


def compiled_only(spark):
    """Makes Spark raise where it would else go on without generated code."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.codegen.fallback", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    return before


def test_the_date_reader_compiles(spark):
    before = compiled_only(spark)
    try:
        df = spark.range(50).select(*[F.concat(F.lit(f"2024-01-0{k} 0"), F.col("id") % 10, F.lit(":30")).alias(f"c{k}") for k in range(1, 7)])
        rows = df.select(*[parsing.parse_date(F.col(c)).alias(c) for c in df.columns]).collect()
        assert {r.c3.hour for r in rows} == set(range(10)) and rows[0].c6 == dt.datetime(2024, 1, 6, 0, 30)
        assert Profile(df, "dates", as_of="2026-01-01").columns.filter("inferred_type = 'datetime'").count() == 6
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_empty_fields_of_a_date_raise_no_errors_inside_spark(spark):
    """A failed try_cast is an error made and caught; dates without a clock time had some ten of them each."""
    cases = [("2024-01-05",), ("2024-1-5",), ("20249905",), ("2024-01-05 24:00",), ("2024-99-05",), ("2024-02-30",)]
    df = spark.createDataFrame(cases, "v string").select(parsing.parse_date(F.col("v")).alias("t"))
    assert "try_cast(lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [r.t for r in df.collect()] == [DAY, DAY, None, None, None, None]


def test_strip_takes_tabs_and_wide_spaces(spark):
    df = spark.createDataFrame([("\t a b 　 \n",)], "v string")
    assert df.select(parsing.strip(F.col("v"))).first()[0] == "a b"


def test_boolean_words(spark):
    df = spark.createDataFrame([(" YES",), ("n",), ("maybe",)], "v string")
    assert [r[0] for r in df.select(parsing.parse_boolean(F.col("v"))).collect()] == [True, False, None]
