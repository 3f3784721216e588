"""The session the library expects, and the loader of a table folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemark", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
