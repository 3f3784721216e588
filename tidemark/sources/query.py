"""Streams that are a query: any read-only SELECT over named tables, wrapped as a sub-query so windows push into it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def query_stream(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of sql, in which tables go by their names. Statements that write are refused."""
    head = sql.lstrip("( \n\t").split(None, 1)[0].lower() if sql.strip() else ""
    if head not in ("select", "with", "values"):
        raise ValueError("a query stream takes one SELECT")
    named, suffix = {}, uuid.uuid4().hex[:8]
    for name, df in tables.items():
        named[name] = f"{name}_{suffix}"
        df.createOrReplaceTempView(named[name])
    ctes = ", ".join(f"`{n}` AS (SELECT * FROM `{v}`)" for n, v in named.items())
    return spark.sql(f"WITH {ctes} SELECT * FROM ({sql}) AS q" if ctes else f"SELECT * FROM ({sql}) AS q")


def select_columns(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Chosen columns. Naming both lists, an unknown column, an empty list, or leaving none is refused."""
    if include is not None and exclude is not None:
        raise ValueError("include and exclude don't go together")
    chosen = include if include is not None else exclude
    if chosen is None:
        return df
    if not chosen:
        raise ValueError("the list of columns is empty")
    if unknown := [c for c in chosen if c not in df.columns]:
        raise ValueError(f"no column {', '.join(unknown)}")
    left = list(include) if include is not None else [c for c in df.columns if c not in chosen]
    if not left:
        raise ValueError("no column is left")
    return df.select(*left)
