"""Incremental reads: the cursor's window, rows already seen at its boundary, and the state that a run leaves."""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Order
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that a cursor may have; booleans, floats, binary and nested ones may not.
CURSOR_TYPES = (T.IntegralType, T.DecimalType, T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)


@dataclass(frozen=True)
class Window:
    """What a run reads. lower and upper are typed values; lag is a span of time as text ("2 days 6 hours"), or a number."""

    column: str
    direction: str = "max"
    lower: object = None
    lower_closed: bool = True
    upper: object = None
    upper_closed: bool = False
    nulls: str = "exclude"
    lag: object = None


@dataclass(frozen=True)
class State:
    """The cursor's high-water mark, and the folder of a table with the keys (row_key) of the rows that have it."""

    watermark: object = None
    keys: str | None = None


_SPAN = re.compile(r"\s*(\d+(?:\.\d+)?)\s*(day|hour|minute|second)s?\s*")


def span(text: str) -> Column:
    """A day-time interval from text such as 2 days 6 hours; parsed, never handed to SQL."""
    parts, at = dict.fromkeys(("day", "hour", "minute", "second"), Decimal(0)), 0
    while at < len(text):
        found = _SPAN.match(text, at)
        if found is None:
            raise ValueError(f"{text} isn't a span of days, hours, minutes and seconds")
        parts[found[2]] += Decimal(found[1])
        at = found.end()
    if not at or any(v % 1 for k, v in parts.items() if k != "second"):
        raise ValueError(f"{text} isn't a span of days, hours, minutes and seconds")
    return F.make_dt_interval(*[F.lit(int(parts[k])) for k in ("day", "hour", "minute")], F.lit(parts["second"]).cast("decimal(18,6)"))


def check_cursor(df: DataFrame, column: str) -> None:
    """Refuse a cursor that isn't selected or whose type has no exact order."""
    if column not in df.columns:
        raise ValueError(f"cursor {column} isn't among the selected columns")
    if not isinstance(df.schema[column].dataType, CURSOR_TYPES):
        raise ValueError(f"cursor {column} has type {df.schema[column].dataType.simpleString()}, which can't be a cursor")


def bound(df: DataFrame, column: str, value) -> Column:
    """A literal of the cursor's own type, so the filter reaches the scan without a cast of the column."""
    return F.lit(value).cast(df.schema[column].dataType)


def window(df: DataFrame, w: Window) -> DataFrame:
    """Rows within the window. Direction max reads upward from lower, min downward."""
    check_cursor(df, w.column)
    c, keep = F.col(w.column), F.lit(True)
    up = w.direction == "max"
    if w.lower is not None:
        low, closed = bound(df, w.column, w.lower), w.lower_closed or w.lag is not None
        if w.lag is not None:
            by = span(w.lag) if isinstance(w.lag, str) else F.lit(w.lag)
            low = (low - by if up else low + by).cast(df.schema[w.column].dataType)
        keep = (c >= low if closed else c > low) if up else (c <= low if closed else c < low)
    if w.upper is not None:
        high = bound(df, w.column, w.upper)
        keep = keep & ((c <= high if w.upper_closed else c < high) if up else (c >= high if w.upper_closed else c > high))
    if w.nulls == "include":
        return df.filter(keep | c.isNull())
    if w.nulls == "error":
        return df.filter(keep | c.isNull()).withColumn(w.column, F.coalesce(c, F.raise_error(F.lit(f"null in cursor {w.column}")).cast(df.schema[w.column].dataType)))
    return df.filter(keep & c.isNotNull())


def in_order(df: DataFrame, column: str, direction: str = "max") -> DataFrame:
    """Rows in cursor order, nulls first either way."""
    return df.orderBy(F.col(column).asc_nulls_first() if direction == "max" else F.col(column).desc_nulls_first())


def out_of_order(df: DataFrame, column: str, arrival: str, parts: int = 64) -> DataFrame:
    """Rows whose cursor is below one that came before them by arrival, a number. The rows are dealt to ranges of arrival
    by at most parts quantiles; within a range a running greatest is kept, and one row a range carries it on."""
    edges = sorted({e for e in df.approxQuantile(arrival, [k / parts for k in range(1, parts)], 0.01)})
    part = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col(arrival))) if edges else F.lit(0)
    rows = df.withColumn("_part", part)
    ends = rows.groupBy("_part").agg(F.max(column).alias("_top"))
    before = ends.withColumn("_before", F.max("_top").over(Order.orderBy("_part").rowsBetween(Order.unboundedPreceding, -1))).drop("_top")
    inside = F.max(column).over(Order.partitionBy("_part").orderBy(arrival).rowsBetween(Order.unboundedPreceding, -1))
    marked = rows.withColumn("_inside", inside).join(F.broadcast(before), "_part")
    return marked.filter(F.col(column) < F.greatest("_inside", "_before")).select(*df.columns)


def row_key(df: DataFrame, key: list[str] | None) -> Column:
    """What tells a row: its key, else a hash of all its values with nulls kept apart."""
    if key:
        return F.struct(*[F.col(c) for c in key])
    return F.struct(F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}), 256).alias("hash"))


def drop_seen(df: DataFrame, column: str, key: list[str] | None, watermark, seen: DataFrame) -> DataFrame:
    """Without the rows at the watermark whose key, as row_key() gives it, is in seen (column row_key). Only rows at the
    watermark are joined; those past it aren't shuffled."""
    at = F.coalesce(F.col(column) == bound(df, column, watermark), F.lit(False))
    there = df.filter(at).withColumn("_key", row_key(df, key))
    left = there.join(seen.select(F.col("row_key").alias("_seen")), F.col("_key").eqNullSafe(F.col("_seen")), "left_anti").drop("_key")
    return df.filter(~at).unionByName(left)


def resume(df: DataFrame, w: Window, state: State | None, key: list[str] | None = None) -> DataFrame:
    """What the next run reads. With saved boundary keys the bound is closed and rows seen at it are dropped; without, open."""
    if state is None or state.watermark is None:
        return window(df, w)
    if w.lag is not None and (not key or state.keys is None):
        raise ValueError("a lag needs an inclusive boundary and a primary key")
    rows = window(df, Window(w.column, w.direction, state.watermark, state.keys is not None, w.upper, w.upper_closed, w.nulls, w.lag))
    if state.keys is None:
        return rows
    return drop_seen(rows, w.column, key, state.watermark, df.sparkSession.read.parquet(state.keys))


def watermark(df: DataFrame, column: str, direction: str = "max") -> DataFrame:
    """One row: the extreme of the cursor."""
    return df.agg((F.max if direction == "max" else F.min)(column).alias("watermark"))


def boundary_rows(df: DataFrame, column: str, direction: str = "max") -> DataFrame:
    """The rows that have the extreme cursor."""
    top = watermark(df, column, direction)
    return df.join(F.broadcast(top), F.col(column) == F.col("watermark"), "left_semi")


def advance(df: DataFrame, column: str, key: list[str] | None, before: State | None = None, direction: str = "max", folder: str | None = None) -> State:
    """The state after rows were read. It never moves back. The keys at the watermark are written to folder as a table, with
    those before them where the watermark stays; without a folder none are kept. One value goes to the driver."""
    top = watermark(df, column, direction).first()["watermark"]
    old = before or State()
    if top is None or (old.watermark is not None and (top < old.watermark if direction == "max" else top > old.watermark)):
        return old
    if folder is None:
        return State(top)
    keys = df.filter(F.col(column) == bound(df, column, top)).select(row_key(df, key).alias("row_key"))
    if top == old.watermark and old.keys is not None:
        keys = keys.unionByName(df.sparkSession.read.parquet(old.keys))
    keys.distinct().write.mode("overwrite").parquet(folder)
    return State(top, folder)


def keyset_resume(df: DataFrame, column: str, tie: str, after, after_tie) -> DataFrame:
    """Rows past (cursor, tie), ties being unique."""
    c, w = F.col(column), bound(df, column, after)
    return df.filter((c > w) | ((c == w) & (F.col(tie) > bound(df, tie, after_tie))))


def text_watermark(df: DataFrame, column: str) -> DataFrame:
    """The greatest cursor as text, in byte order."""
    return df.agg(F.max(F.col(column).cast("string")).alias("watermark"))
