"""Revenue operators on published totals and on small edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import expressions as ex
from ledgerlens.operators import checks, ordering, revenue, survey
from ledgerlens.plans.registry import QUERIES

# Published monthly net revenue per warehouse, with its change in percent.
WAREHOUSE_MONTHS = [
    ("Central", 6, "43327.68", None), ("Central", 7, "47393.4", 9.4), ("Central", 8, "48797.13", 3.0),
    ("North", 6, "32752.96", None), ("North", 7, "28636.86", -12.6), ("North", 8, "37194.84", 29.9),
    ("West", 6, "17578.41", None), ("West", 7, "15865.59", -9.7), ("West", 8, "12661.56", -20.2)]
MONTHS = [(6, 93659.04, None, None), (7, 91895.85, -1763.19, -1.9), (8, 98653.53, 6757.68, 7.4)]

SALES = "order_number string, date date, warehouse string, client_type string, product_line string, quantity int, " \
        "unit_price decimal(18,2), total decimal(18,2), payment string, payment_fee decimal(9,4)"


def sale(key, day, warehouse, client, product, quantity, total, payment="Cash", fee="0"):
    total = Decimal(total)
    return (key, day, warehouse, client, product, quantity, total / quantity, total, payment, Decimal(fee))


@pytest.fixture(scope="module")
def published(spark):
    """One order per warehouse and month that carries the published total."""
    rows = [sale(f"N{i}", dt.date(2021, m, 15), w, "Wholesale", "Engine", 1, t)
            for i, (w, m, t, _) in enumerate(WAREHOUSE_MONTHS)]
    return spark.createDataFrame(rows, SALES)


def test_warehouse_trend_matches_published_changes(published):
    got = [(r[0], r[1].month, r[2], r[3]) for r in revenue.segment_trend(published).collect()]
    assert got == [(w, m, float(t), p) for w, m, t, p in WAREHOUSE_MONTHS]


def test_monthly_trend_is_the_sum_over_warehouses(published):
    got = [(r[0].month, r[1], r[2], r[3]) for r in revenue.monthly_trend(published).collect()]
    for (m, net, change, pct), (em, enet, echange, epct) in zip(got, MONTHS, strict=True):
        assert m == em and abs(net - enet) < 0.02 and pct == epct
        assert change is None if echange is None else abs(change - echange) < 0.02


def test_season_trend_is_in_month_order_not_alphabetical(published):
    assert [r["month"] for r in revenue.season_trend(published).collect()] == ["June", "July", "August"]


def test_only_the_falling_warehouse_declines_steadily(published):
    assert {r[0]: r["always_falling"] for r in revenue.steady_decline(published).collect()} == {
        "Central": False, "North": False, "West": True}


def test_top_per_group_keeps_ties_and_tally_counts_them(spark):
    d = dt.date(2021, 6, 1)
    df = spark.createDataFrame([
        sale("a", d, "North", "Wholesale", "Engine", 1, "10"), sale("b", d, "West", "Wholesale", "Engine", 1, "10"),
        sale("c", d, "West", "Wholesale", "Frame", 1, "5"), sale("d", d, "North", "Retail", "Frame", 1, "50")], SALES)
    assert {(r[0], r[2]) for r in revenue.top_per_group(df).collect()} == {
        ("Engine", "North"), ("Engine", "West"), ("Frame", "West")}
    assert [(r[0], r[1]) for r in revenue.win_tally(df).collect()] == [("West", 2), ("North", 1)]


def test_net_revenue_is_taken_row_by_row(spark):
    d = dt.date(2021, 6, 1)
    df = spark.createDataFrame([sale("a", d, "N", "Retail", "E", 1, "100", fee="0.03"),
                                sale("b", d, "N", "Retail", "E", 1, "300", fee="0.01")], SALES)
    net = df.agg(F.sum(ex.net_revenue())).first()[0]
    assert net == Decimal("394.000000")
    assert net != df.agg(F.sum("total") - F.sum("payment_fee")).first()[0]


def test_segment_split_with_a_null_segment_and_zero_total(spark):
    df = spark.createDataFrame([("x", Decimal("0.00")), (None, Decimal("0.00"))], "client_type string, total decimal(18,2)")
    rows = {r[0]: r for r in revenue.segment_split(df).collect()}
    assert set(rows) == {"x", None}
    assert rows["x"]["pct_of_orders"] == 50.0 and rows["x"]["pct_of_revenue"] is None


@pytest.mark.parametrize("name", ["c05_segment_split", "c09_payment_mix", "c18_severity_breakdown", "c22_share_by_category",
                                  "c24_top_products"])
def test_shares_of_the_total_scan_the_fact_table_once(spark, name):
    """The totals reuse the shuffle of the grouped rows; no cross join brings them in."""
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ReusedExchange" in plan or "Subquery" not in plan


def test_rounding_is_half_up(spark):
    got = spark.range(1).select(ex.half_up(F.lit(0.25), 1).alias("a"), ex.half_up(F.lit(2.5), 0).alias("b"),
                                ex.money(F.lit(Decimal("1.005"))).alias("c")).first()
    assert tuple(got) == (0.3, 3.0, 1.01)
    got = spark.range(1).select(*[ex.half_up(F.lit(x), d) for x, d in ((-0.25, 1), (-2.5, 0), (1e18, 2), (float("-inf"), 1), (-0.04, 1))]).first()
    assert tuple(got) == (-0.3, -3.0, 1e18, float("-inf"), 0.0)


def test_averages_skip_nulls(spark):
    rows = [("A", Decimal("10.00"), Decimal("4.00"), None, Decimal("0.02")), ("A", None, None, 3, None)]
    df = spark.createDataFrame(rows, "g string, total decimal(18,2), unit_price decimal(18,2), quantity int, payment_fee decimal(9,4)")
    df = df.withColumn("client_type", F.lit("Retail"))
    assert revenue.segment_split(df, "g").first()["avg_order_value"] == 10.0
    assert revenue.segment_performance(df, "g").first()["avg_order_value"] == 10.0
    assert revenue.product_performance(df, "g").first()["avg_order_value"] == 10.0
    assert revenue.payment_mix(df, "g").first()["avg_fee_pct"] == 2.0
    assert tuple(revenue.price_and_quantity(df, ["g"]).first())[1:3] == (4.0, 3.0)


def test_top_fraction_counts_rows_with_a_value(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (4, None), (5, 6.0)], "id int, total double")
    assert sorted(r["id"] for r in ordering.top_fraction(df, 0.7, "total", ["id"]).collect()) == [3, 5]


def test_price_difference(spark):
    rows = [("E", "Retail", Decimal("40.00")), ("E", "Wholesale", Decimal("30.00")), ("F", "Retail", Decimal("5.00"))]
    df = spark.createDataFrame(rows, "product_line string, client_type string, unit_price decimal(18,2)")
    assert [tuple(r) for r in revenue.price_difference(df).collect()] == [("E", 40.0, 30.0, -25.0), ("F", 5.0, None, None)]


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.37, 1.0])
def test_top_fraction_equals_a_full_sort(spark, fraction):
    """A third of the rows tie at the cut."""
    data = [(i, 50 if i % 3 == 0 else (i * 37) % 101) for i in range(300)]
    df = spark.createDataFrame(data, "id int, total int")
    expected = sorted(data, key=lambda r: (-r[1], r[0]))[: int(fraction * 300 + 1e-9)]
    got = ordering.top_fraction(df, fraction, "total", ["id"]).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_survey_order_is_by_severity_and_nulls_are_kept_last(spark):
    df = spark.createDataFrame([("Sev",), ("Min",), ("Mod",), ("odd",), (None,)], "depsev string")
    assert [r[0] for r in survey.severity_breakdown(df).collect()][:3] == ["Min", "Mod", "Sev"]
    assert survey.tail_share(df).first()["n_tail"] == 2


def test_average_skips_nulls_and_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 4, 1, 7), (1, None, 2, 7), (2, 8, 3, 7)], "stay int, todep int, tosc int, toas int")
    assert [tuple(r) for r in survey.average_scores(df).collect()] == [(2, 1, 8.0, 3.0, 7.0), (1, 2, 4.0, 1.5, 7.0)]
    assert tuple(survey.score_correlations(df).first()) == (1.0, None)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "id int, v string")
    assert {(r[0], r[1]) for r in checks.key_violations(df, ["id"]).collect()} == {(1, 2), (None, 1)}
    assert {tuple(r) for r in checks.null_counts(df).collect()} == {("id", 1), ("v", 1)}
