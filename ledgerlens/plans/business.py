"""Registered revenue, survey and dashboard queries with their reference SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ledgerlens.functions import expressions as ex, fixed
from ledgerlens.operators import checks, ordering, revenue, survey
from ledgerlens.plans.views import dashboard_view, sales_view, season, survey_table, survey_view, table
from ledgerlens.session import work_path
from ledgerlens.sources import tables

KEY = ("order_number",)
ALL_SALES = ("order_number", "date", "warehouse", "client_type", "product_line", "quantity", "unit_price",
             "total", "payment", "payment_fee")

SALES_SQL = """WITH sales AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_number,
         CAST(l_shipdate AS DATE) AS date, l_returnflag AS warehouse,
         CASE l_linestatus WHEN 'O' THEN 'Wholesale' ELSE 'Retail' END AS client_type,
         p_type AS product_line, CAST(l_quantity AS INT) AS quantity,
         CAST(floor(l_extendedprice / nullif(l_quantity, 0) * 1e2 + 0.5) / 1e2 AS DECIMAL(18,2)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total, o_orderstatus AS payment,
         CAST(l_tax AS DECIMAL(9,4)) AS payment_fee
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)
"""
SEASON_SQL = SALES_SQL.rstrip()[:-1] + "\n  WHERE l_shipdate >= DATE '1998-06-01' AND l_shipdate < DATE '1998-09-01')\n"
STUDENTS_SQL = """WITH students AS (
  SELECT CASE quality WHEN 1 THEN 'Inter' WHEN 0 THEN 'Dom' END AS inter_dom, lang AS region,
         CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) AS stay, CAST(n_chars AS INT) AS todep,
         CASE WHEN n_chars <= 500 THEN 'Min' WHEN n_chars <= 1500 THEN 'Mild' WHEN n_chars <= 4000 THEN 'Mod'
              WHEN n_chars <= 9000 THEN 'ModSev' ELSE 'Sev' END AS depsev,
         CAST(length(text) - length(replace(text, ' ', '')) + 1 AS INT) AS tosc,
         CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INT) AS toas
  FROM documents LEFT JOIN labels USING (doc_id))
"""
STUDENTS_TABLE_SQL = """SELECT CASE quality WHEN 1 THEN 'Inter' WHEN 0 THEN 'Dom' END AS inter_dom, lang AS region,
  CASE doc_id % 2 WHEN 0 THEN 'Female' ELSE 'Male' END AS gender, CASE doc_id % 3 WHEN 0 THEN 'Grad' ELSE 'Under' END AS academic,
  CAST(17 + doc_id % 14 AS INT) AS age, CAST(doc_id % 14 // 3 + 1 AS INT) AS age_cate, stay,
  CASE WHEN stay <= 1 THEN 'Short' WHEN stay <= 3 THEN 'Medium' WHEN stay > 3 THEN 'Long' END AS stay_cate,
  CAST(doc_id % 5 + 1 AS INT) AS japanese, CASE WHEN doc_id % 5 < 2 THEN 'Low' WHEN doc_id % 5 = 2 THEN 'Average' ELSE 'High' END AS japanese_cate,
  CAST(doc_id // 5 % 5 + 1 AS INT) AS english, CASE WHEN doc_id // 5 % 5 < 2 THEN 'Low' WHEN doc_id // 5 % 5 = 2 THEN 'Average' ELSE 'High' END AS english_cate,
  CAST(n_chars AS INT) AS todep,
  CASE WHEN n_chars <= 500 THEN 'Min' WHEN n_chars <= 1500 THEN 'Mild' WHEN n_chars <= 4000 THEN 'Mod' WHEN n_chars <= 9000 THEN 'ModSev' ELSE 'Sev' END AS depsev,
  CAST(length(text) - length(replace(text, ' ', '')) + 1 AS INT) AS tosc, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INT) AS toas,
  CASE toxic WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS suicide
FROM (SELECT *, CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) AS stay FROM documents) LEFT JOIN labels USING (doc_id)
"""
DASHBOARD_SQL = """WITH retail AS (
  SELECT l_returnflag AS region, p_type AS category, p_brand AS product, CAST(l_shipdate AS DATE) AS date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS sales,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(l_discount AS DECIMAL(9,4)) - CAST(l_tax AS DECIMAL(9,4))) AS profit
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
"""


def _up(x: str, digits: int) -> str:
    x = f"({x})"
    return f"(CASE WHEN abs({x}) * 1e{digits} < 4e15 THEN sign({x}) * floor(abs({x}) * 1e{digits} + 0.5) / 1e{digits} + 0.0 ELSE {x} END)"


def _money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def _ratio(a: str, b: str, digits: int, scale: str = "1.0") -> str:
    return _up(f"CAST({scale} AS DOUBLE) * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits)


def _pct(a: str, b: str, digits: int = 1) -> str:
    return _ratio(a, b, digits, "100.0")


NET = "sum(total * (1 - payment_fee))"
FEES = "sum(total * payment_fee)"
MONTH = "CAST(date_trunc('month', date) AS DATE)"
LABEL = "CASE month_num WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' END"


def exported(view: DataFrame, name: str) -> str:
    """A view written as delimited text with a header, at a path of its own."""
    path = work_path(view.sparkSession, f"export-{name}-{uuid.uuid4().hex}")
    view.write.option("escape", '"').csv(path, header=True)
    return path


def a06_sales_table(spark, d):
    sales = tables.load_sales(spark, exported(sales_view(spark, d, ALL_SALES), "sales"), None)
    return sales.select(*[F.col(c).cast("double").alias(c) if c in ("unit_price", "total", "payment_fee") else c for c in ALL_SALES])


def a07_students_table(spark, d):
    return tables.load_students(spark, exported(survey_table(spark, d), "students"), None)


def a08_primary_key_check(spark, d):
    return checks.key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def a08_primary_key_clean(spark, d):
    return checks.key_violations(sales_view(spark, d, KEY), KEY)


def b06_net_revenue(spark, d):
    sales = sales_view(spark, d, ("order_number", "total", "payment_fee"))
    return sales.select("order_number", ex.net_revenue().cast("double").alias("net_revenue"),
                        ex.fee_dollars().cast("double").alias("fee_dollars"))


def b09_month_extract(spark, d):
    sales = sales_view(spark, d, ("date", "total"))
    return sales.groupBy(ex.month_number().alias("month_num")).agg(
        F.count("*").alias("n_orders"), ex.money(F.sum("total")).alias("gross_revenue"))


def b10_month_label(spark, d):
    sales = sales_view(spark, d, ("date", "total"))
    return sales.groupBy(ex.month_label(ex.month_number()).alias("month")).agg(F.count("*").alias("n_orders"))


def b12_rounding(spark, d):
    grouped = sales_view(spark, d, ("warehouse", "total")).groupBy("warehouse").agg(
        F.sum("total").alias("s"), F.count("*").alias("n"))
    return grouped.select("warehouse", *[ex.money(F.col("s"), k).alias(f"gross_{k}dp") for k in range(3)],
                          *[ex.mean_of(F.col("s"), F.col("n"), k).alias(f"avg_{k}dp") for k in range(4)])


def b15_conditional_count(spark, d):
    return sales_view(spark, d, ("client_type", "total", "quantity")).agg(
        F.count_if(F.col("client_type") == "Wholesale").alias("n_wholesale"),
        F.count_if((F.col("client_type") == "Wholesale") & (F.col("quantity") >= 25)).alias("n_large_wholesale"),
        ex.money(F.sum(ex.when_value(F.col("client_type") == "Wholesale", F.col("total")))).alias("wholesale_revenue"))


def b16_severity_ordinal(spark, d):
    return survey_view(spark, d).groupBy("depsev", ex.ordinal("depsev", fixed.SEVERITY_BANDS).alias("ordinal")).agg(
        F.count("*").alias("n_students"))


def c17_constant_guard(spark, d):
    constant = survey_view(spark, d).withColumn("one", F.lit(1))
    return constant.agg(survey.correlation("todep", "one").alias("corr_with_constant"))


def c15_revenue_concentration(spark, d, fraction=0.2):
    sales = sales_view(spark, d, ("order_number", "total", "client_type"))
    rows, whole = ordering.top_fraction_and(sales, fraction, "total", KEY, F.sum("total").alias("s"))
    whole = F.lit(whole["s"])
    top = rows.agg(
        F.count("*").alias("n"), F.sum("total").alias("s"),
        F.count_if(F.col("client_type") == "Wholesale").alias("w"))
    return top.select(
        F.col("n").alias("n_orders_in_top20pct"), ex.money(F.col("s")).alias("revenue_from_top20pct"),
        ex.pct(F.col("s"), whole).alias("pct_of_total_revenue"), F.col("w").alias("n_wholesale_in_top20"),
        ex.pct(F.col("w"), F.col("n")).alias("pct_wholesale_in_top20"))


def e03_top_orders(spark, d):
    columns = ("order_number", "date", "warehouse", "client_type", "product_line", "quantity", "total")
    lines = sales_view(spark, d, columns)
    return ordering.largest_rows(lines, 20, "total", KEY).withColumn("total", F.col("total").cast("double"))


def e04_top_fraction(spark, d):
    sales = sales_view(spark, d, ("order_number", "total", "client_type"))
    return ordering.top_fraction(sales, 0.2, "total", KEY).withColumn("total", F.col("total").cast("double"))


def f02_scalar_subquery(spark, d):
    """The same totals written as scalar subqueries in SQL text."""
    return spark.sql("""
        SELECT client_type, count(*) AS n_orders,
               floor(100D * count(*) / (SELECT count(*) FROM {sales}) * 1e1 + 0.5D) / 1e1 AS pct_of_orders
        FROM {sales} GROUP BY client_type""", sales=sales_view(spark, d, ("client_type",)))


def f03_group_by_alias(spark, d):
    return spark.sql("""
        WITH monthly AS (SELECT month(date) AS month_num, sum(quantity) AS units FROM {sales} GROUP BY month_num)
        SELECT month_num, units FROM monthly""", sales=sales_view(spark, d, ("date", "quantity")))


def _sales(*columns):
    return lambda spark, d: sales_view(spark, d, columns)


def _apply(operator, view):
    return lambda spark, d: operator(view(spark, d))


def _season(*columns):
    return lambda spark, d: season(sales_view(spark, d, columns))


def _students(condition=None):
    def view(spark, d):
        df = survey_view(spark, d)
        return df if condition is None else df.where(condition)
    return view


INTER = "inter_dom = 'Inter'"


def _change(by="", extra=""):
    part = f"PARTITION BY {by} " if by else ""
    lag = f"lag(net) OVER ({part}ORDER BY month)"
    cols = f"{by}, " if by else ""
    return cols, lag


def _trend_sql(by: str = "") -> str:
    cols, lag = _change(by)
    absolute = "" if by else f", {_money(f'net - {lag}')} AS change_vs_prev_month"
    name = "pct_change_vs_prev_month" if by else "pct_change"
    return SALES_SQL + f""", m AS (SELECT {cols}{MONTH} AS month, {NET} AS net FROM sales GROUP BY ALL)
SELECT {cols}month, {_money('net')} AS net_revenue{absolute}, {_pct(f'net - {lag}', lag)} AS {name} FROM m"""


TOP_SQL = SALES_SQL + f""", m AS (
  SELECT product_line, {MONTH} AS month, warehouse, {NET} AS net FROM sales
  WHERE client_type = 'Wholesale' GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY product_line, month ORDER BY net DESC) AS k FROM m)
"""
RANKED_SQL = SALES_SQL + """, r AS (SELECT *, row_number() OVER (ORDER BY total DESC, order_number) AS rn,
  count(*) OVER () AS n_total FROM sales), t AS (SELECT * FROM r WHERE rn <= n_total * 0.2)
"""
AVG_SCORES = ", ".join(f"{_ratio(f'sum({c})', f'count({c})', 2)} AS {n}" for c, n in survey.SCORES.items())


def _corr(b: str) -> str:
    return (f"CASE WHEN min(todep) < max(todep) AND min({b}) < max({b}) "
            f"THEN {_up(f'corr(todep, {b})', 3)} END")


SPECS = {
    "a06_sales_table": (a06_sales_table, SALES_SQL + """SELECT order_number, date, warehouse, client_type, product_line,
  quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total AS DOUBLE) AS total, payment,
  CAST(payment_fee AS DOUBLE) AS payment_fee FROM sales"""),
    "a07_students_table": (a07_students_table, STUDENTS_TABLE_SQL),
    "a08_primary_key_check": (a08_primary_key_check, """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"""),
    "a08_primary_key_clean": (a08_primary_key_clean, SALES_SQL + """SELECT order_number, count(*) AS n_rows FROM sales
GROUP BY ALL HAVING count(*) > 1 OR order_number IS NULL"""),
    "a09_not_null_check": (_apply(checks.null_counts, _sales(*ALL_SALES)), SALES_SQL + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM sales" for c in ALL_SALES)),
    "a09_not_null_survey": (_apply(checks.null_counts, _students()), STUDENTS_SQL + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM students"
        for c in ("inter_dom", "region", "stay", "todep", "depsev", "tosc", "toas"))),
    "b01_equality_filter": (
        lambda s, d: sales_view(s, d, ("order_number", "client_type", "quantity")).where("client_type = 'Wholesale'"),
        SALES_SQL + "SELECT order_number, client_type, quantity FROM sales WHERE client_type = 'Wholesale'"),
    "b02_in_list_filter": (
        lambda s, d: survey_view(s, d).where(F.col("inter_dom").isin("Inter", "Dom")).select("inter_dom", "stay", "todep"),
        STUDENTS_SQL + "SELECT inter_dom, stay, todep FROM students WHERE inter_dom IN ('Inter', 'Dom')"),
    "b03_is_null_count": (_apply(survey.unlabelled, _students()),
                          STUDENTS_SQL + "SELECT count(*) AS n_unlabeled FROM students WHERE inter_dom IS NULL"),
    "b06_net_revenue_and_fees": (b06_net_revenue, SALES_SQL + """SELECT order_number,
  CAST(total * (1 - payment_fee) AS DOUBLE) AS net_revenue, CAST(total * payment_fee AS DOUBLE) AS fee_dollars FROM sales"""),
    "b09_month_extract": (b09_month_extract, SALES_SQL + f"""SELECT CAST(extract(month FROM date) AS INT) AS month_num,
  count(*) AS n_orders, {_money('sum(total)')} AS gross_revenue FROM sales GROUP BY 1"""),
    "b10_month_label": (b10_month_label, SALES_SQL + """SELECT CASE extract(month FROM date) WHEN 6 THEN 'June'
  WHEN 7 THEN 'July' WHEN 8 THEN 'August' END AS month, count(*) AS n_orders FROM sales GROUP BY 1"""),
    "b10_month_name": (_apply(revenue.month_names, _sales("date", "total")), SALES_SQL + f"""SELECT
  CAST(extract(month FROM date) AS INT) AS month_num, monthname(date) AS month, count(*) AS n_orders,
  {_money('sum(total)')} AS gross_revenue FROM sales GROUP BY 1, 2"""),
    "b12_rounding": (b12_rounding, SALES_SQL + "SELECT warehouse, "
                     + ", ".join(f"CAST(round(sum(total), {k}) AS DOUBLE) AS gross_{k}dp" for k in range(3)) + ", "
                     + ", ".join(f"{_ratio('sum(total)', 'count(*)', k)} AS avg_{k}dp" for k in range(4))
                     + " FROM sales GROUP BY 1"),
    "b14_conditional_value_and_count": (b15_conditional_count, SALES_SQL + f"""SELECT
  count(*) FILTER (WHERE client_type = 'Wholesale') AS n_wholesale,
  count(*) FILTER (WHERE client_type = 'Wholesale' AND quantity >= 25) AS n_large_wholesale,
  {_money("sum(CASE WHEN client_type = 'Wholesale' THEN total ELSE 0 END)")} AS wholesale_revenue FROM sales"""),
    "b16_severity_ordinal_and_banding": (b16_severity_ordinal, STUDENTS_SQL + """SELECT depsev,
  CASE depsev WHEN 'Min' THEN 1 WHEN 'Mild' THEN 2 WHEN 'Mod' THEN 3 WHEN 'ModSev' THEN 4 WHEN 'Sev' THEN 5 END AS ordinal,
  count(*) AS n_students FROM students GROUP BY 1, 2"""),
    "c01_overview": (_apply(revenue.overview, _sales("date", "product_line", "warehouse", "payment")), SALES_SQL + """
SELECT count(*) AS n_orders, min(date) AS first_order_date, max(date) AS last_order_date,
  count(DISTINCT product_line) AS n_product_lines, count(DISTINCT warehouse) AS n_warehouses,
  count(DISTINCT payment) AS n_payment_methods FROM sales"""),
    "c02_group_sizes": (_apply(survey.group_sizes, _students()),
                        STUDENTS_SQL + "SELECT inter_dom, count(*) AS n_students FROM students GROUP BY 1"),
    "c03_distribution": (_apply(survey.distribution, _students(INTER)),
                         STUDENTS_SQL + f"SELECT stay, count(*) AS n_students FROM students WHERE {INTER} GROUP BY 1"),
    "c04_score_ranges": (_apply(survey.score_ranges, _students(INTER)), STUDENTS_SQL + f"""SELECT min(todep) AS min_phq,
  max(todep) AS max_phq, min(tosc) AS min_scs, max(tosc) AS max_scs, min(toas) AS min_as, max(toas) AS max_as,
  min(todep) >= 0 AND max(todep) <= 27 AS phq_range_ok, min(tosc) >= 8 AND max(tosc) <= 48 AS scs_range_ok,
  min(toas) >= 36 AND max(toas) <= 180 AS as_range_ok FROM students WHERE {INTER}"""),
    "c05_segment_split": (_apply(revenue.segment_split, _sales("client_type", "total")), SALES_SQL + f"""SELECT client_type,
  count(*) AS n_orders, {_money('sum(total)')} AS gross_revenue, {_ratio('sum(total)', 'count(total)', 2)} AS avg_order_value,
  {_pct('count(*)', '(SELECT count(*) FROM sales)')} AS pct_of_orders,
  {_pct('sum(total)', '(SELECT sum(total) FROM sales)')} AS pct_of_revenue FROM sales GROUP BY 1"""),
    "c06_wholesale_revenue_cells": (
        _apply(revenue.revenue_cells, _sales("date", "warehouse", "client_type", "product_line", "total", "payment_fee")),
        SALES_SQL + f"""SELECT product_line, {MONTH} AS month, warehouse, {_money(NET)} AS net_revenue FROM sales
WHERE client_type = 'Wholesale' GROUP BY 1, 2, 3"""),
    "c07_warehouse_performance": (
        _apply(revenue.segment_performance, _sales("warehouse", "client_type", "total")), SALES_SQL + f"""SELECT warehouse,
  count(*) AS n_orders, {_money('sum(total)')} AS gross_revenue, {_ratio('sum(total)', 'count(total)', 2)} AS avg_order_value,
  {_money("sum(CASE WHEN client_type = 'Wholesale' THEN total ELSE 0 END)")} AS wholesale_revenue,
  {_pct("sum(CASE WHEN client_type = 'Wholesale' THEN total ELSE 0 END)", "sum(total)")} AS pct_wholesale
FROM sales GROUP BY 1"""),
    "c08_product_performance": (
        _apply(revenue.product_performance, _sales("product_line", "total", "quantity")), SALES_SQL + f"""SELECT product_line,
  count(*) AS n_orders, {_money('sum(total)')} AS gross_revenue, {_ratio('sum(total)', 'count(total)', 2)} AS avg_order_value,
  CAST(sum(quantity) AS BIGINT) AS units_sold FROM sales GROUP BY 1"""),
    "c09_payment_mix": (_apply(revenue.payment_mix, _sales("payment", "total", "payment_fee")), SALES_SQL + f"""SELECT payment,
  count(*) AS n_orders, {_pct('count(*)', '(SELECT count(*) FROM sales)')} AS pct_of_orders,
  {_pct('sum(payment_fee)', 'count(payment_fee)', 2)} AS avg_fee_pct, {_money(FEES)} AS total_fees_paid FROM sales GROUP BY 1"""),
    "c10_fee_burden": (_apply(revenue.fee_burden, _sales("total", "payment_fee")), SALES_SQL + f"""SELECT
  {_money(FEES)} AS total_fees_paid, {_money('sum(total)')} AS gross_revenue, {_pct(FEES, 'sum(total)')} AS pct_of_gross
FROM sales"""),
    "c11_payment_by_client": (
        _apply(revenue.payment_by_client, _sales("client_type", "payment", "total", "payment_fee")), SALES_SQL + f"""SELECT
  client_type, payment, count(*) AS n_orders,
  {_pct('count(*)', 'sum(count(*)) OVER (PARTITION BY client_type)')} AS pct_within_client_type,
  {_money(FEES)} AS fees_paid FROM sales GROUP BY 1, 2"""),
    "c12_functional_dependency": (_apply(revenue.determined_by, _sales("payment", "client_type")), SALES_SQL + """SELECT
  payment, count(DISTINCT client_type) AS n_determinants, count(*) AS n_orders,
  count(DISTINCT client_type) <= 1 AS no_overlap FROM sales GROUP BY 1"""),
    "c13_price_and_quantity": (
        _apply(revenue.price_and_quantity, _sales("product_line", "client_type", "unit_price", "quantity")),
        SALES_SQL + f"""SELECT product_line, client_type, {_ratio('sum(unit_price)', 'count(unit_price)', 2)} AS avg_unit_price,
  {_ratio('sum(quantity)', 'count(quantity)', 1)} AS avg_quantity_per_order, count(*) AS n_orders FROM sales GROUP BY 1, 2"""),
    "c14_price_difference": (
        _apply(revenue.price_difference, _sales("product_line", "client_type", "unit_price")), SALES_SQL + f""", p AS (
  SELECT product_line,
    CAST(sum(unit_price) FILTER (WHERE client_type = 'Retail') AS DOUBLE) / nullif(count(*) FILTER (WHERE client_type = 'Retail'), 0) AS r,
    CAST(sum(unit_price) FILTER (WHERE client_type = 'Wholesale') AS DOUBLE) / nullif(count(*) FILTER (WHERE client_type = 'Wholesale'), 0) AS w
  FROM sales GROUP BY 1)
SELECT product_line, {_up('r', 2)} AS retail_avg_price, {_up('w', 2)} AS wholesale_avg_price,
  {_up('CAST(100.0 AS DOUBLE) * (w - r) / r', 1)} AS pct_difference FROM p"""),
    "c15_revenue_concentration": (c15_revenue_concentration, RANKED_SQL + f"""SELECT count(*) AS n_orders_in_top20pct,
  {_money('sum(total)')} AS revenue_from_top20pct, {_pct('sum(total)', '(SELECT sum(total) FROM sales)')} AS pct_of_total_revenue,
  count(*) FILTER (WHERE client_type = 'Wholesale') AS n_wholesale_in_top20,
  {_pct("count(*) FILTER (WHERE client_type = 'Wholesale')", 'count(*)')} AS pct_wholesale_in_top20 FROM t"""),
    "c16_scores_by_stay": (_apply(survey.average_scores, _students(INTER)), STUDENTS_SQL + f"""SELECT stay,
  count(*) AS count_int, {AVG_SCORES} FROM students WHERE {INTER} GROUP BY 1"""),
    "c16_scores_by_group": (
        lambda s, d: survey.average_scores(survey_view(s, d).where(F.col("inter_dom").isin("Inter", "Dom")), "inter_dom",
                                           count_as="n_students", descending=False),
        STUDENTS_SQL + f"""SELECT inter_dom, count(*) AS n_students, {AVG_SCORES} FROM students
WHERE inter_dom IN ('Inter', 'Dom') GROUP BY 1"""),
    "c17_score_correlations": (_apply(survey.score_correlations, _students(INTER)), STUDENTS_SQL + f"""SELECT
  {_corr('tosc')} AS corr_depression_connectedness, {_corr('toas')} AS corr_depression_stress
FROM students WHERE {INTER}"""),
    "c17_correlation_of_constant": (c17_constant_guard,
                                    "SELECT CAST(NULL AS DOUBLE) AS corr_with_constant FROM documents HAVING count(*) > 0"),
    "c18_severity_breakdown": (_apply(survey.severity_breakdown, _students(INTER)), STUDENTS_SQL + f"""SELECT depsev,
  count(*) AS n_students, {_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_international
FROM students WHERE {INTER} GROUP BY 1"""),
    "c19_tail_share": (_apply(survey.tail_share, _students(INTER)), STUDENTS_SQL + f"""SELECT
  count(*) FILTER (WHERE depsev IN ('Mod', 'ModSev', 'Sev')) AS n_tail, count(*) AS n_students,
  {_pct("count(*) FILTER (WHERE depsev IN ('Mod', 'ModSev', 'Sev'))", 'count(*)')} AS pct_tail
FROM students WHERE {INTER}"""),
    "c20_sales_profit_pivot": (
        lambda s, d: revenue.sales_profit_cells(dashboard_view(s, d), "region", "category"),
        DASHBOARD_SQL + f"SELECT region, category, {_money('sum(sales)')} AS sales, {_money('sum(profit)')} AS profit FROM retail GROUP BY 1, 2"),
    "c20_time_summary": (_apply(revenue.time_summary, dashboard_view), DASHBOARD_SQL + f"""SELECT {MONTH} AS month,
  {_money('sum(sales)')} AS sales, {_money('sum(profit)')} AS profit, {_pct('sum(profit)', 'sum(sales)', 2)} AS margin_pct
FROM retail GROUP BY 1"""),
    "c21_profit_margin": (_apply(revenue.profit_margin, dashboard_view), DASHBOARD_SQL + f"""SELECT
  {_money('sum(sales)')} AS sales, {_money('sum(profit)')} AS profit, {_pct('sum(profit)', 'sum(sales)', 2)} AS margin_pct
FROM retail"""),
    "c22_share_by_category": (lambda s, d: revenue.share_by(dashboard_view(s, d), "category"), DASHBOARD_SQL + f"""SELECT
  category, {_money('sum(sales)')} AS sales, {_money('sum(profit)')} AS profit,
  {_pct('sum(sales)', '(SELECT sum(sales) FROM retail)')} AS pct_of_sales,
  {_pct('sum(profit)', '(SELECT sum(profit) FROM retail)')} AS pct_of_profit FROM retail GROUP BY 1"""),
    "c23_peak_periods": (_apply(revenue.peak_periods, dashboard_view), DASHBOARD_SQL + f"""SELECT {MONTH} AS month,
  {_money('sum(sales)')} AS sales, CAST(rank() OVER (ORDER BY sum(sales) DESC) AS INT) AS sales_rank FROM retail GROUP BY 1"""),
    "c24_top_products": (lambda s, d: revenue.top_items(dashboard_view(s, d), "product"), DASHBOARD_SQL + f"""SELECT product,
  {_money('sum(sales)')} AS sales, {_pct('sum(sales)', '(SELECT sum(sales) FROM retail)', 2)} AS pct_of_sales
FROM retail GROUP BY 1 ORDER BY sum(sales) DESC, product LIMIT 10"""),
    "c25_weakest_by_region": (lambda s, d: revenue.weakest_by_region(dashboard_view(s, d), "region", "product"),
                              DASHBOARD_SQL + f""", p AS (SELECT region, product, sum(profit) AS p FROM retail GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY region ORDER BY p) AS k FROM p)
SELECT region, product, {_money('p')} AS profit, CAST(k AS INT) AS low_rank FROM r WHERE k <= 3"""),
    "d01_monthly_trend": (_apply(revenue.monthly_trend, _sales("date", "total", "payment_fee")), _trend_sql()),
    "d01_season_trend": (_apply(revenue.season_trend, _season("date", "total", "payment_fee")), SEASON_SQL + f""", m AS (
  SELECT CAST(extract(month FROM date) AS INT) AS month_num, {NET} AS net FROM sales GROUP BY 1)
SELECT {LABEL} AS month, {_money('net')} AS net_revenue, {_money('net - lag(net) OVER (ORDER BY month_num)')} AS change_vs_prev_month,
  {_pct('net - lag(net) OVER (ORDER BY month_num)', 'lag(net) OVER (ORDER BY month_num)')} AS pct_change FROM m"""),
    "d02_warehouse_trend": (
        _apply(revenue.segment_trend, _sales("warehouse", "date", "total", "payment_fee")), _trend_sql("warehouse")),
    "d03_product_trend": (
        lambda s, d: revenue.segment_trend(sales_view(s, d, ("product_line", "date", "total", "payment_fee")),
                                           ["product_line"]), _trend_sql("product_line")),
    "d03_product_warehouse_trend": (
        lambda s, d: revenue.segment_trend(sales_view(s, d, ("product_line", "warehouse", "date", "total", "payment_fee")),
                                           ["product_line", "warehouse"]), _trend_sql("product_line, warehouse")),
    "d04_top_per_group": (
        _apply(revenue.top_per_group, _sales("date", "warehouse", "client_type", "product_line", "total", "payment_fee")),
        TOP_SQL + f"SELECT product_line, month, warehouse, {_money('net')} AS net_revenue FROM r WHERE k = 1"),
    "d05_win_tally": (
        _apply(revenue.win_tally, _sales("date", "warehouse", "client_type", "product_line", "total", "payment_fee")),
        TOP_SQL + "SELECT warehouse, count(*) AS n_wins FROM r WHERE k = 1 GROUP BY 1"),
    "d10_steady_decline": (
        _apply(revenue.steady_decline, _sales("warehouse", "date", "total", "payment_fee")), SALES_SQL.rstrip() + f""", m AS (
  SELECT warehouse, {MONTH} AS month, {NET} AS net FROM sales GROUP BY 1, 2),
c AS (SELECT *, net - lag(net) OVER (PARTITION BY warehouse ORDER BY month) AS change FROM m)
SELECT warehouse, count(*) AS n_months, count(*) FILTER (WHERE change < 0) AS n_falls,
  coalesce(max(change) < 0, false) AS always_falling FROM c GROUP BY 1"""),
    "e03_top_orders": (e03_top_orders, SALES_SQL + """SELECT order_number, date, warehouse, client_type, product_line, quantity,
  CAST(total AS DOUBLE) AS total FROM (SELECT * FROM sales ORDER BY total DESC, order_number LIMIT 20)"""),
    "e04_top_fraction": (e04_top_fraction, RANKED_SQL + "SELECT order_number, CAST(total AS DOUBLE) AS total, client_type FROM t"),
    "f02_scalar_subquery": (f02_scalar_subquery, SALES_SQL + f"""SELECT client_type, count(*) AS n_orders,
  {_pct('count(*)', '(SELECT count(*) FROM sales)')} AS pct_of_orders FROM sales GROUP BY 1"""),
    "f03_group_by_alias": (f03_group_by_alias, SALES_SQL + """SELECT CAST(extract(month FROM date) AS INT) AS month_num,
  CAST(sum(quantity) AS BIGINT) AS units FROM sales GROUP BY 1"""),
}
