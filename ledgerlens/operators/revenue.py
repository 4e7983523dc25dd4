"""Segment, share, trend and pricing queries over a fact table of orders.

Every operator takes any DataFrame with the named columns. Raw rows pass only
through map-side combined aggregates; shares come from a scalar subquery over
the grouped rows, whose shuffle Spark reuses, so the fact table is scanned once
and no window ever holds raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.functions.expressions import (
    fee_dollars, half_up, mean_of, money, month_label, month_name, month_number, month_start,
    net_revenue, pct, ratio, when_value,
)


def grand_totals(grouped: DataFrame, *columns: str) -> dict[str, Column]:
    """Sums of ``columns`` over all grouped rows, as scalar subqueries.

    Name and use every measure of ``grouped``: then the subquery keeps the same
    shuffle as the main query and Spark reads it again instead of the source.
    """
    totals = grouped.agg(F.struct(*[F.sum(c).alias(c) for c in columns]).alias("totals")).scalar()
    return {c: totals.getField(c) for c in columns}


def overview(df: DataFrame, date: str = "date",
             categories: Sequence[str] = ("product_line", "warehouse", "payment")) -> DataFrame:
    """Row count, date range and distinct values per category.

    Grouping by the categories first shrinks the rows before the distinct
    counts, which would otherwise copy every fact row once per category.
    """
    names = {"product_line": "n_product_lines", "warehouse": "n_warehouses", "payment": "n_payment_methods"}
    cells = df.groupBy(*categories).agg(
        F.count("*").alias("n"), F.min(date).alias("first"), F.max(date).alias("last"))
    return cells.agg(
        F.sum("n").alias("n_orders"), F.min("first").alias("first_order_date"),
        F.max("last").alias("last_order_date"),
        *[F.count_distinct(c).alias(names.get(c, f"n_{c}")) for c in categories])


def segment_split(df: DataFrame, by: str = "client_type", measure: str = "total") -> DataFrame:
    grouped = df.groupBy(by).agg(F.count("*").alias("n"), F.count(measure).alias("held"), F.sum(measure).alias("s"))
    whole = grand_totals(grouped, "n", "held", "s")
    return grouped.select(
        by, F.col("n").alias("n_orders"), money(F.col("s")).alias("gross_revenue"),
        mean_of(F.col("s"), F.col("held")).alias("avg_order_value"),
        pct(F.col("n"), whole["n"]).alias("pct_of_orders"),
        pct(F.col("s"), whole["s"]).alias("pct_of_revenue"),
    ).orderBy(F.desc_nulls_first("gross_revenue"))


def net_cells(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Unrounded net revenue per combination of ``by``."""
    return df.groupBy(*by).agg(F.sum(net_revenue()).alias("net"))


def revenue_cells(df: DataFrame, client_type: str = "Wholesale") -> DataFrame:
    """Net revenue per product line, calendar month and warehouse for one client type."""
    cells = net_cells(df.where(F.col("client_type") == client_type).withColumn("month", month_start()),
                      ["product_line", "month", "warehouse"])
    return cells.select("product_line", "month", "warehouse", money(F.col("net")).alias("net_revenue")).orderBy(
        F.asc_nulls_last("product_line"), F.asc_nulls_last("month"), F.desc_nulls_first("net_revenue"))


def segment_performance(df: DataFrame, by: str = "warehouse", highlight: Column | None = None) -> DataFrame:
    """Orders, gross, average order and the share of gross from the highlighted rows."""
    highlight = F.col("client_type") == "Wholesale" if highlight is None else highlight
    grouped = df.groupBy(by).agg(
        F.count("*").alias("n"), F.count("total").alias("held"), F.sum("total").alias("s"),
        F.sum(when_value(highlight, F.col("total"))).alias("h"))
    return grouped.select(
        by, F.col("n").alias("n_orders"), money(F.col("s")).alias("gross_revenue"),
        mean_of(F.col("s"), F.col("held")).alias("avg_order_value"),
        money(F.col("h")).alias("wholesale_revenue"), pct(F.col("h"), F.col("s")).alias("pct_wholesale"),
    ).orderBy(F.desc_nulls_first("gross_revenue"))


def product_performance(df: DataFrame, by: str = "product_line") -> DataFrame:
    grouped = df.groupBy(by).agg(
        F.count("*").alias("n"), F.count("total").alias("held"), F.sum("total").alias("s"), F.sum("quantity").alias("units_sold"))
    return grouped.select(
        by, F.col("n").alias("n_orders"), money(F.col("s")).alias("gross_revenue"),
        mean_of(F.col("s"), F.col("held")).alias("avg_order_value"), "units_sold",
    ).orderBy(F.desc_nulls_first("gross_revenue"))


def payment_mix(df: DataFrame, by: str = "payment") -> DataFrame:
    """Orders, share of orders, average fee rate and fees per payment method."""
    grouped = df.groupBy(by).agg(
        F.count("*").alias("n"), F.count("payment_fee").alias("held"), F.sum("payment_fee").alias("rates"),
        F.sum(fee_dollars()).alias("fees"))
    whole = grand_totals(grouped, "n", "held", "rates", "fees")
    return grouped.select(
        by, F.col("n").alias("n_orders"), pct(F.col("n"), whole["n"]).alias("pct_of_orders"),
        ratio(F.col("rates"), F.col("held"), 2, scale=100.0).alias("avg_fee_pct"),
        money(F.col("fees")).alias("total_fees_paid"),
    ).orderBy(F.desc_nulls_first("total_fees_paid"))


def fee_burden(df: DataFrame) -> DataFrame:
    """Fees over the whole table and their share of gross revenue."""
    sums = df.agg(F.sum(fee_dollars()).alias("fees"), F.sum("total").alias("s"))
    return sums.select(money(F.col("fees")).alias("total_fees_paid"), money(F.col("s")).alias("gross_revenue"),
                       pct(F.col("fees"), F.col("s")).alias("pct_of_gross"))


def payment_by_client(df: DataFrame, parent: str = "client_type", child: str = "payment") -> DataFrame:
    """Child segments with their share inside the parent segment."""
    grouped = df.groupBy(parent, child).agg(F.count("*").alias("n"), F.sum(fee_dollars()).alias("fees"))
    within = F.sum("n").over(Window.partitionBy(parent))
    return grouped.select(
        parent, child, F.col("n").alias("n_orders"), pct(F.col("n"), within).alias("pct_within_client_type"),
        money(F.col("fees")).alias("fees_paid"),
    ).orderBy(F.asc_nulls_last(parent), F.desc_nulls_first("fees_paid"))


def determined_by(df: DataFrame, dependent: str = "payment", determinant: str = "client_type") -> DataFrame:
    """How many determinant values each dependent value occurs with; 1 means no overlap."""
    pairs = df.groupBy(dependent, determinant).agg(F.count("*").alias("n"))
    return pairs.groupBy(dependent).agg(
        F.count(determinant).alias("n_determinants"), F.sum("n").alias("n_orders"),
    ).withColumn("no_overlap", F.col("n_determinants") <= 1)


def price_and_quantity(df: DataFrame, by: Sequence[str] = ("product_line", "client_type")) -> DataFrame:
    grouped = df.groupBy(*by).agg(
        F.sum("unit_price").alias("p"), F.count("unit_price").alias("p_held"), F.sum("quantity").alias("q"),
        F.count("quantity").alias("q_held"), F.count("*").alias("n"))
    return grouped.select(
        *by, mean_of(F.col("p"), F.col("p_held")).alias("avg_unit_price"),
        mean_of(F.col("q"), F.col("q_held"), 1).alias("avg_quantity_per_order"), F.col("n").alias("n_orders"),
    ).orderBy(*[F.asc_nulls_last(c) for c in by])


def price_difference(df: DataFrame, base: str = "Retail", other: str = "Wholesale",
                     by: str = "product_line", segment: str = "client_type") -> DataFrame:
    """Average unit price of two segments side by side and their difference in percent."""
    wide = df.groupBy(by).pivot(segment, [base, other]).agg(
        F.sum("unit_price").alias("p"), F.count("unit_price").alias("n"))
    first, second = (ratio(F.col(f"`{s}_p`"), F.col(f"`{s}_n`")) for s in (base, other))
    return wide.select(
        by, half_up(first, 2).alias(f"{base.lower()}_avg_price"), half_up(second, 2).alias(f"{other.lower()}_avg_price"),
        half_up(F.try_divide(F.lit(100.0) * (second - first), first), 1).alias("pct_difference"),
    ).orderBy(F.asc_nulls_last(by))


def period_change(cells: DataFrame, period: str, by: Sequence[str] = (), measure: str = "net") -> DataFrame:
    """Change against the previous period inside each segment, absolute and in percent.

    ``cells`` is already aggregated: one row per segment and period, so a window
    partition holds at most one row per calendar period.
    """
    w = Window.partitionBy(*by).orderBy(period)
    return (cells.withColumn("previous", F.lag(measure).over(w))
            .withColumn("change", F.col(measure) - F.col("previous"))
            .withColumn("pct_change", pct(F.col("change"), F.col("previous"))))


def monthly_trend(df: DataFrame) -> DataFrame:
    """Net revenue per calendar month with its change against the month before."""
    changed = period_change(net_cells(df.withColumn("month", month_start()), ["month"]), "month")
    return changed.orderBy(F.asc_nulls_last("month")).select(
        "month", money(F.col("net")).alias("net_revenue"), money(F.col("change")).alias("change_vs_prev_month"),
        "pct_change")


def season_trend(df: DataFrame) -> DataFrame:
    """The three-month form: month number and name, sorted by a number that is not shown.

    The month number merges years, so ``df`` has to lie within one year.
    """
    changed = period_change(net_cells(df.withColumn("month_num", month_number()), ["month_num"]), "month_num")
    return changed.orderBy(F.asc_nulls_last("month_num")).select(
        month_label(F.col("month_num")).alias("month"), money(F.col("net")).alias("net_revenue"),
        money(F.col("change")).alias("change_vs_prev_month"), "pct_change")


def segment_trend(df: DataFrame, by: Sequence[str] = ("warehouse",)) -> DataFrame:
    """Monthly net revenue and its change inside each segment."""
    cells = net_cells(df.withColumn("month", month_start()), [*by, "month"])
    return period_change(cells, "month", by).orderBy(
        *[F.asc_nulls_last(c) for c in by], F.asc_nulls_last("month")).select(
        *by, "month", money(F.col("net")).alias("net_revenue"),
        F.col("pct_change").alias("pct_change_vs_prev_month"))


def steady_decline(df: DataFrame, by: str = "warehouse") -> DataFrame:
    """Segments whose net revenue fell in every month after the first."""
    changed = period_change(net_cells(df.withColumn("month", month_start()), [by, "month"]), "month", [by])
    return changed.groupBy(by).agg(
        F.count("*").alias("n_months"), F.count_if(F.col("change") < 0).alias("n_falls"),
        F.coalesce(F.max("change") < 0, F.lit(False)).alias("always_falling"))


def top_per_group(df: DataFrame, group: Sequence[str] = ("product_line", "month"), item: str = "warehouse",
                  client_type: str = "Wholesale") -> DataFrame:
    """The best item of each group by net revenue; ties are all kept."""
    cells = net_cells(df.where(F.col("client_type") == client_type).withColumn("month", month_start()),
                      [*group, item])
    ranked = cells.withColumn("rank", F.rank().over(Window.partitionBy(*group).orderBy(F.desc("net"))))
    return ranked.where("rank = 1").orderBy(*[F.asc_nulls_last(c) for c in group]).select(
        *group, item, money(F.col("net")).alias("net_revenue"))


def win_tally(df: DataFrame, item: str = "warehouse", **kwargs) -> DataFrame:
    """How many groups each item comes first in."""
    return top_per_group(df, item=item, **kwargs).groupBy(item).agg(F.count("*").alias("n_wins")).orderBy(
        F.desc("n_wins"), item)


def sales_profit_pivot(df: DataFrame, region: str, category: str, categories: Sequence[str],
                       measures: Sequence[str] = ("sales", "profit")) -> DataFrame:
    """Region by category cross-tab in wide form, for a caller who names the categories that are wanted."""
    wide = df.groupBy(region).pivot(category, list(categories)).agg(*[F.sum(m).alias(m) for m in measures])
    return wide.select(region, *[money(F.col(f"`{c}_{m}`")).alias(f"{c}_{m}".lower())
                                 for c in categories for m in measures])


def sales_profit_cells(df: DataFrame, region: str, category: str, measures: Sequence[str] = ("sales", "profit")) -> DataFrame:
    """The same cross-tab in long form: every category that occurs, whatever their number."""
    grouped = df.groupBy(region, category).agg(*[F.sum(m).alias(m) for m in measures])
    return grouped.select(region, category, *[money(F.col(m)).alias(m) for m in measures])


def time_summary(df: DataFrame, date: str = "date") -> DataFrame:
    """Sales, profit and margin per calendar month."""
    grouped = df.groupBy(month_start(date).alias("month")).agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return grouped.select("month", money(F.col("s")).alias("sales"), money(F.col("p")).alias("profit"),
                          pct(F.col("p"), F.col("s"), 2).alias("margin_pct"))


def profit_margin(df: DataFrame) -> DataFrame:
    sums = df.agg(F.sum("sales").alias("s"), F.sum("profit").alias("p"))
    return sums.select(money(F.col("s")).alias("sales"), money(F.col("p")).alias("profit"),
                       pct(F.col("p"), F.col("s"), 2).alias("margin_pct"))


def share_by(df: DataFrame, by: str, measures: Sequence[str] = ("sales", "profit")) -> DataFrame:
    """Each category's share of the total of every measure."""
    grouped = df.groupBy(by).agg(*[F.sum(m).alias(m) for m in measures])
    whole = grand_totals(grouped, *measures)
    return grouped.select(by, *[money(F.col(m)).alias(m) for m in measures],
                          *[pct(F.col(m), whole[m]).alias(f"pct_of_{m}") for m in measures])


def peak_periods(df: DataFrame, date: str = "date", measure: str = "sales") -> DataFrame:
    """Calendar months ranked by sales, best first."""
    grouped = df.groupBy(month_start(date).alias("month")).agg(F.sum(measure).alias("s"))
    ranked = grouped.withColumn("sales_rank", F.rank().over(Window.orderBy(F.desc("s"))))
    return ranked.orderBy("sales_rank", "month").select("month", money(F.col("s")).alias(measure), "sales_rank")


def top_items(df: DataFrame, by: str, k: int = 10, measure: str = "sales") -> DataFrame:
    """The ``k`` best-selling items with their share of all sales."""
    grouped = df.groupBy(by).agg(F.sum(measure).alias("s"))
    whole = grand_totals(grouped, "s")
    return grouped.orderBy(F.desc("s"), by).limit(k).select(
        by, money(F.col("s")).alias(measure), pct(F.col("s"), whole["s"], 2).alias(f"pct_of_{measure}"))


def weakest_by_region(df: DataFrame, region: str, item: str, k: int = 3, measure: str = "profit") -> DataFrame:
    """The items with the lowest profit inside each region; ties are all kept."""
    grouped = df.groupBy(region, item).agg(F.sum(measure).alias("p"))
    ranked = grouped.withColumn("low_rank", F.rank().over(Window.partitionBy(region).orderBy(F.asc("p"))))
    return ranked.where(F.col("low_rank") <= k).orderBy(region, "low_rank", item).select(
        region, item, money(F.col("p")).alias(measure), "low_rank")


def month_names(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows and gross revenue per named month, the general form of the month label."""
    grouped = df.groupBy(month_number(date).alias("month_num"), month_name(date).alias("month")).agg(
        F.count("*").alias("n_orders"), F.sum("total").alias("s"))
    return grouped.select("month_num", "month", "n_orders", money(F.col("s")).alias("gross_revenue"))
