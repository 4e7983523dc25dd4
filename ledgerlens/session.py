"""Session settings the library relies on, and the one place that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Call-site capture for error messages doubles the time to build wide expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app_name: str = "ledgerlens", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; anything passed in wins.

    Shuffle partition count, memory and the checkpoint folder belong to the
    cluster, so they are left alone unless the caller names them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode with nothing configured; on a
    cluster a machine-local folder would lose data with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgerlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several later passes or where row placement must
    not change between them. Parquet in shared storage survives lost executors
    and lets the later passes read only the columns they need.
    """
    path = work_path(df.sparkSession, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A path of this application in the shared folder; all of them can be removed together once it has ended."""
    return f"{shared_folder(spark)}/ledgerlens/{spark.sparkContext.applicationId}/{name}"
