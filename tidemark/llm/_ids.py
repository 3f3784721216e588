"""Ids on their way through Python, where a column with nulls would become floats and lose digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import cut

#: Stands for a null id: the least long. Ids are integers above it; others are refused when read.
NO_ID = -(1 << 63)


def named(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def others(docs: DataFrame, added: tuple[str, ...], kept: tuple[str, ...]) -> list[Column]:
    """The columns of docs but those named like an added one in whatever case, as Spark tells names apart without case."""
    taken = {a.lower() for a in added} - {k.lower() for k in kept}
    return [named(c) for c in docs.columns if c.lower() not in taken]


def masked(column: Column) -> Column:
    """An id as a long, null as the least; an id that is the least itself, or that isn't a whole number, fails."""
    whole = column.try_cast("long")
    bad = F.raise_error(F.concat(F.lit("not an id: "), column.cast("string"))).cast("long")
    return F.when(column.isNull(), F.lit(NO_ID)).when(whole.isNull() | (whole == NO_ID) | (whole.cast("double") != column.try_cast("double")), bad).otherwise(whole)


def unique(docs: DataFrame, id_col: str) -> bool:
    """Whether ids are whole and tell every row; only they are read."""
    ids = docs.select(named(id_col).alias("id"))
    return ids.filter("id is null").isEmpty() and ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def mark_of(text: Column) -> Column:
    """A hash of a text, null counting as empty, to tell rows apart that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose (id, mark) isn't in gone; a null id equals a null id."""
    gone = gone.select(F.col("id").alias("_gone_id"), F.col("mark").alias("_gone_mark")).distinct()
    same = named(id_col).cast("long").eqNullSafe(gone["_gone_id"]) & (mark_of(named(text_col)) == gone["_gone_mark"])
    return docs.join(gone, same, "left_anti")


def one_of_each(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with one row of each group of kept (id, mark, group), which has a row for each of docs in a group that may have
    several. Where one has, rows are numbered and cut so that the number stays; other rows of docs are left alone."""
    again = kept.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.isEmpty():
        return docs
    members = kept.join(again, "group", "left_semi").select(F.col("id").alias("own_id"), F.col("mark").alias("own_mark"), "group").distinct()
    row = F.struct(*[named(c) for c in docs.columns])
    rows = cut(docs.select(row.alias("row"), named(id_col).cast("long").alias("id"), mark_of(named(text_col)).alias("mark"), F.monotonically_increasing_id().alias("number")), "numbered")
    dealt = rows.join(members, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))).select("group", "number")
    gone = dealt.join(dealt.groupBy("group").agg(F.min("number").alias("least")), "group").filter("number > least").select("number")
    return rows.join(gone, "number", "left_anti").select("row.*")


def unmasked(column: Column) -> Column:
    return F.nullif(column, F.lit(NO_ID))
