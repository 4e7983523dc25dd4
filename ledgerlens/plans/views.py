"""The business tables of the library expressed over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.functions.expressions import MONEY, RATE, banded, half_up
from ledgerlens.functions import fixed

DEPRESSION_BOUNDS = (500, 1500, 4000, 9000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_view(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """One row per order line with the requested ``columns``.

    Product line and payment are lookups by a unique key in ``part`` and
    ``orders``. A left join on a unique key neither adds nor drops lines, so a
    query that does not ask for the column can leave the whole join out. Spark
    broadcasts a lookup only below its size threshold; otherwise it sort-merges
    and splits skewed keys at run time.
    """
    lines = table(spark, sf_dir, "lineitem")
    if "product_line" in columns:
        part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("product_line"))
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left")
    if "payment" in columns:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("payment"))
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    expressions = {
        "order_number": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        "date": F.col("l_shipdate").cast("date"),
        "warehouse": F.col("l_returnflag"),
        "client_type": F.when(F.col("l_linestatus") == "O", "Wholesale").otherwise("Retail"),
        "product_line": F.col("product_line") if "product_line" in columns else None,
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": half_up(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 2).cast(MONEY),
        "total": F.col("l_extendedprice").cast(MONEY),
        "payment": F.col("payment") if "payment" in columns else None,
        "payment_fee": F.col("l_tax").cast(RATE),
    }
    return lines.select(*[expressions[c].alias(c) for c in columns])


def season(df: DataFrame, first: str = "1998-06-01", last: str = "1998-08-31") -> DataFrame:
    """Rows of one June to August, where a month number is unambiguous."""
    return df.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def survey_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the label as group, the source number as stay, three size scores."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    text = F.col("text")
    joined = documents.join(labels.select("doc_id", "quality"), "doc_id", "left")
    todep = F.col("n_chars").cast("int")
    return joined.select(
        F.when(F.col("quality") == 1, "Inter").when(F.col("quality") == 0, "Dom").alias("inter_dom"),
        F.col("lang").alias("region"),
        F.regexp_extract("source", "([0-9]+)", 1).cast("int").alias("stay"),
        todep.alias("todep"),
        banded(todep, DEPRESSION_BOUNDS, fixed.SEVERITY_BANDS).alias("depsev"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("int").alias("tosc"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("int").alias("toas"),
    )


def survey_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey with all columns of its typed table; those that documents lack follow from the document's number."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = documents.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
    level = lambda x: F.when(x < 2, "Low").when(x == 2, "Average").otherwise("High")
    i, text, stay = F.col("doc_id"), F.col("text"), F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    many = lambda c: (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) + 1).cast("int")
    todep, second = F.col("n_chars").cast("int"), F.floor(i / 5) % 5
    return rows.select(
        F.when(F.col("quality") == 1, "Inter").when(F.col("quality") == 0, "Dom").alias("inter_dom"), F.col("lang").alias("region"),
        F.when(i % 2 == 0, "Female").otherwise("Male").alias("gender"), F.when(i % 3 == 0, "Grad").otherwise("Under").alias("academic"),
        (i % 14 + 17).cast("int").alias("age"), (F.floor(i % 14 / 3) + 1).cast("int").alias("age_cate"), stay.alias("stay"),
        F.when(stay <= 1, "Short").when(stay <= 3, "Medium").when(stay > 3, "Long").alias("stay_cate"),
        (i % 5 + 1).cast("int").alias("japanese"), level(i % 5).alias("japanese_cate"),
        (second + 1).cast("int").alias("english"), level(second).alias("english_cate"), todep.alias("todep"),
        banded(todep, DEPRESSION_BOUNDS, fixed.SEVERITY_BANDS).alias("depsev"), many(" ").alias("tosc"), many("\n").alias("toas"),
        F.when(F.col("toxic") == 1, "Yes").when(F.col("toxic") == 0, "No").alias("suicide"))


def dashboard_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail sales by region and category; the two rates of a line give a profit that can be a loss."""
    sales = F.col("l_extendedprice").cast(MONEY)
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(part.select("p_partkey", "p_type", "p_brand"), lines.l_partkey == part.p_partkey, "left")
    margin = F.col("l_discount").cast(RATE) - F.col("l_tax").cast(RATE)
    return joined.select(
        F.col("l_returnflag").alias("region"), F.col("p_type").alias("category"), F.col("p_brand").alias("product"),
        F.col("l_shipdate").cast("date").alias("date"), sales.alias("sales"),
        (sales * margin).alias("profit"))
