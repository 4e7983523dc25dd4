"""Writing query results and reviews."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "source string, attempt string, `table` string, path string, format string"


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """One query's full output; CSV gets a header."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("escape", '"').csv(path, header=True)
    elif fmt in ("parquet", "json", "orc"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def write_review(tables: Mapping[str, DataFrame], source: str, folder: str, fmt: str = "parquet") -> dict[str, str]:
    """The tables of one review, published together.

    Every table is written to a folder of this attempt first. Only when all of
    them are there, one more row in the manifest names them; readers follow the
    manifest, so a job that fails half-way leaves the review before it as it was,
    and reviews of many data sets share a folder. Returns the tables' paths.
    """
    folder = folder.rstrip("/")
    attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    paths = {name: f"{folder}/staged/{attempt}/{name}" for name in tables}
    for name, df in tables.items():
        df.withColumn("source", F.lit(source)).write.format(fmt).save(paths[name])
    spark = next(iter(tables.values())).sparkSession
    entries = spark.createDataFrame([(source, attempt, name, path, fmt) for name, path in paths.items()], MANIFEST)
    entries.coalesce(1).write.mode("append").parquet(f"{folder}/manifest")
    return paths


def read_review(spark: SparkSession, folder: str, source: str) -> dict[str, DataFrame]:
    """The tables of the last published review of ``source``, by name; none if there is no such review."""
    entries = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest").where(F.col("source") == F.lit(source))
    # At most one row for each table of a review: a few rows come to the driver.
    last = entries.where(F.col("attempt") == entries.agg(F.max("attempt")).scalar()).collect()
    return {r["table"]: spark.read.format(r["format"]).load(r["path"]) for r in last}
