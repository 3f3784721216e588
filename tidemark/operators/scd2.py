"""History of slowly changing rows: each version with the instants from and to which it holds."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import VALID_FROM, VALID_TO
from .survivors import survivors


def _instant(df: DataFrame, column: str, value) -> Column:
    return F.lit(value).cast(df.schema[column].dataType)


def is_open(valid_to: str, marker: Column | None) -> Column:
    """Open versions have a null, or the marker if there is one; with a marker nulls still count as open."""
    return F.col(valid_to).isNull() if marker is None else F.col(valid_to).isNull() | (F.col(valid_to) == marker)


def scd2_merge(history: DataFrame, stage: DataFrame, key: list[str], arrival: str, boundary, *, marker=None, absent: str = "keep", scope: list[str] | None = None, sort: tuple[str, str] | None = None, ignore: tuple[str, ...] = (), valid_from: str = VALID_FROM, valid_to: str = VALID_TO) -> DataFrame:
    """The new history. Versions whose survivor differs, nulls being equal, close at boundary; survivors without an open
    version open one; with absent="retire" open keys that weren't delivered close too, within the delivered scopes if
    scope is named. Columns in ignore don't make a change. An empty delivery with "retire" closes nothing."""
    b, m = _instant(history, valid_from, boundary), None if marker is None else _instant(history, valid_to, marker)
    data = [c for c in history.columns if c not in (valid_from, valid_to)]
    compared = [c for c in data if c not in key and c not in ignore]
    open_now = is_open(valid_to, m)
    closed, live = history.filter(~open_now), history.filter(open_now)
    rows = survivors(stage, key, arrival, sort)
    # One full join of open versions and survivors gives both what closes and what opens.
    new = rows.select(F.struct(*[F.col(c) for c in data]).alias("_new"), *[F.col(c).alias(f"_key_{c}") for c in key])
    old = live.select(F.struct(*[F.col(c) for c in history.columns]).alias("_old"), *[F.col(c).alias(f"_own_{c}") for c in key])
    on = reduce(lambda x, y: x & y, [F.col(f"_own_{c}") == F.col(f"_key_{c}") for c in key])
    both = old.join(new, on, "full_outer")
    met, had = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    differs = reduce(or_, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in compared], F.lit(False))
    closes = had & met & differs
    if absent == "retire":
        lost = had & ~met
        if scope:
            scopes = stage.select(*[F.col(c).alias(f"_scope_{c}") for c in scope]).dropna().distinct().withColumn("_in_scope", F.lit(True))
            both = both.join(scopes, reduce(lambda x, y: x & y, [F.col(f"_old.{c}") == F.col(f"_scope_{c}") for c in scope]), "left")
            lost = lost & F.col("_in_scope").isNotNull()
        else:
            # One row that tells whether anything was delivered at all: an empty unit never retires.
            some = stage.limit(1).select(F.lit(True).alias("_some")).agg(F.max("_some").alias("_some"))
            both = both.join(F.broadcast(some))
            lost = lost & F.coalesce(F.col("_some"), F.lit(False))
        closes = closes | lost
    kinds = {f.name: f.dataType for f in history.schema.fields}
    until = lambda column, end: F.when(column, b).otherwise(end).cast(kinds[valid_to])
    before = F.struct(*[(until(closes, F.col(f"_old.{c}")) if c == valid_to else F.col(f"_old.{c}").cast(kinds[c])).alias(c) for c in history.columns])
    end = F.lit(None) if m is None else m
    opened = F.struct(*[(b if c == valid_from else end if c == valid_to else F.col(f"_new.{c}")).cast(kinds[c]).alias(c) for c in history.columns])
    versions = F.array(F.when(had, before), F.when(met & (~had | differs), opened))
    return closed.unionByName(both.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("_v")).select("_v.*"))


def first_history(stage: DataFrame, key: list[str], arrival: str, boundary, kind: str = "timestamp_ntz", *, marker=None, sort=None, valid_from: str = VALID_FROM, valid_to: str = VALID_TO) -> DataFrame:
    """The history of a first delivery."""
    rows = survivors(stage, key, arrival, sort)
    return rows.withColumn(valid_from, F.lit(boundary).cast(kind)).withColumn(valid_to, F.lit(marker).cast(kind))


def as_of(history: DataFrame, instant, valid_from: str = VALID_FROM, valid_to: str = VALID_TO) -> DataFrame:
    """The versions that held at an instant."""
    t = _instant(history, valid_from, instant)
    return history.filter((F.col(valid_from) <= t) & (F.col(valid_to).isNull() | (F.col(valid_to) > t)))


def overlaps(history: DataFrame, key: list[str], valid_from: str = VALID_FROM, valid_to: str = VALID_TO) -> DataFrame:
    """Versions that begin before the version of their key before them ends; a sound history has none."""
    from pyspark.sql import Window

    order = Window.partitionBy(*key).orderBy(F.col(valid_from), F.col(valid_to).asc_nulls_last())
    begun, ended = F.lag(valid_from).over(order), F.lag(valid_to).over(order)
    return history.withColumn("_bad", begun.isNotNull() & (ended.isNull() | (ended > F.col(valid_from)))).filter("_bad").drop("_bad")
