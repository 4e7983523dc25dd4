"""Typed loads of the two fixed-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# Column names and types of the order table and of the survey table.
SALES = T.StructType([
    T.StructField("order_number", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("warehouse", T.StringType(), False),
    T.StructField("client_type", T.StringType(), False),
    T.StructField("product_line", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DecimalType(18, 2), False),
    T.StructField("total", T.DecimalType(18, 2), False),
    T.StructField("payment", T.StringType(), False),
    T.StructField("payment_fee", T.DecimalType(9, 4), False),
])
STUDENTS = T.StructType([T.StructField(n, t()) for n, t in (
    ("inter_dom", T.StringType), ("region", T.StringType), ("gender", T.StringType), ("academic", T.StringType),
    ("age", T.IntegerType), ("age_cate", T.IntegerType), ("stay", T.IntegerType), ("stay_cate", T.StringType),
    ("japanese", T.IntegerType), ("japanese_cate", T.StringType), ("english", T.IntegerType),
    ("english_cate", T.StringType), ("todep", T.IntegerType), ("depsev", T.StringType), ("tosc", T.IntegerType),
    ("toas", T.IntegerType), ("suicide", T.StringType))])


def load_table(spark: SparkSession, path: str, schema: T.StructType, view: str | None = None) -> DataFrame:
    """Parquet, ORC or headed CSV read with a fixed schema, optionally as a named view."""
    reader = spark.read.schema(schema)
    if path.endswith(".parquet"):
        df = reader.parquet(path)
    elif path.endswith(".orc"):
        df = reader.orc(path)
    else:
        df = reader.option("escape", '"').option("mode", "FAILFAST").csv(path, header=True)
    if view:
        df.createOrReplaceTempView(view)
    return df


def load_sales(spark: SparkSession, path: str, view: str | None = "sales") -> DataFrame:
    return load_table(spark, path, SALES, view)


def load_students(spark: SparkSession, path: str, view: str | None = "students") -> DataFrame:
    return load_table(spark, path, STUDENTS, view)
