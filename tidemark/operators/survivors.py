"""The one row of each key that wins within a unit of delivered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def survivors(stage: DataFrame, key: list[str], arrival: str, sort: tuple[str, str] | None = None) -> DataFrame:
    """Last wins: the row of greatest arrival. With sort (column, "asc" or "desc") the first row by that column, nulls
    last either way, and of ties the last to arrive. Plans as a group limit, so each task keeps one row a key before the shuffle."""
    order = [F.col(arrival).desc()]
    if sort:
        order.insert(0, F.col(sort[0]).desc_nulls_last() if sort[1] == "desc" else F.col(sort[0]).asc_nulls_last())
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return stage.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def flagged(df: DataFrame, column: str) -> Column:
    """Whether a row is flagged for deletion: true for a boolean column, anything but null for another."""
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return F.coalesce(F.col(column), F.lit(False))
    return F.col(column).isNotNull()


def with_keys(stage: DataFrame, key: list[str]) -> DataFrame:
    """stage, failing when a row without a key is read: null keys can't be merged."""
    for name in key:
        kind = stage.schema[name].dataType
        stage = stage.withColumn(name, F.when(F.col(name).isNull(), F.raise_error(F.lit(f"null in merge key {name}")).cast(kind)).otherwise(F.col(name)))
    return stage
