"""Cutting lineage through the shared folder that spark.checkpoint.dir names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..storage import new_folder

#: Texts in a batch to Python.
ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lets a Python worker hold ROWS texts at a time instead of Spark's 10,000, unless the session says otherwise. It holds
    for the session, as Spark offers no other way; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ROWS))


def cut(df: DataFrame, what: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: later reads survive lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
