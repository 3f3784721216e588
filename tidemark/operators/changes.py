"""Applying a log of row changes: (txn, seq, op, before, after) with before and after structs of the table's columns.

op is I, U, D or T (truncate). Transactions are applied whole and in the order of their commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import DELETED


class FeedError(ValueError):
    """Names the table or position and what is wrong with it."""


def identity(table: str, columns: list[str], declared: list[str], primary: list[str] | None = None, index: list[str] | None = None, full: bool = False) -> list[str]:
    """The columns by which a log tells rows of the table: those of a chosen index, all (full), or the primary key. The
    declared merge key must be the same columns, unless all are told."""
    found = list(index) if index is not None else list(columns) if full else list(primary or [])
    if not found:
        raise FeedError(f"{table} has no primary key: tell rows by a unique index, or by all columns")
    if lost := [c for c in [*found, *declared] if c not in columns]:
        raise FeedError(f"{table}: key column {lost[0]} isn't read")
    if not declared:
        raise FeedError(f"{table}: a change feed is merged, and no key is declared")
    if not full and sorted(found) != sorted(declared):
        raise FeedError(f"{table}: rows are told by {', '.join(found)}, but the declared key is {', '.join(declared)}")
    return found


def check_feed(table: str, cursor: int | None, first: int | None, created: int | None = None, holder: str | None = None) -> None:
    """Whether a feed still has all after cursor. first: the oldest position it keeps (None: it is lost); created: where it
    began, if it was made anew; holder: who else reads it."""
    if holder is not None:
        raise FeedError(f"{table}: the feed is read by {holder}")
    if cursor is None:
        return
    if first is None:
        raise FeedError(f"{table}: the feed is gone; changes after {cursor} are lost, so take a new snapshot")
    if created is not None and created > cursor:
        raise FeedError(f"{table}: the feed was made anew at {created}, after {cursor}; take a new snapshot")
    if first > cursor + 1:
        raise FeedError(f"{table}: changes from {cursor + 1} to {first - 1} are gone; take a new snapshot")


def check_columns(log: DataFrame, wanted: T.StructType) -> None:
    """Fail where the log's rows lack a column that the table has: it vanished at the source."""
    have = log.schema["after"].dataType.fieldNames()
    if lost := [f.name for f in wanted.fields if f.name not in have]:
        raise FeedError(f"column {', '.join(lost)} vanished from the feed")


def lag_report(cursors: DataFrame, commits: DataFrame, time: str | None = None) -> DataFrame:
    """(stream, cursor, behind, seconds): how far each stream's cursor is behind the last commit (lsn), in positions, and in
    seconds where commits tell a time. Two small tables; the last commit is one row."""
    seconds = F.unix_micros(F.max(F.col(time).cast("timestamp"))) if time else F.lit(None).cast("long")
    last = commits.agg(F.max("lsn").alias("_last"), seconds.alias("_then"))
    rows = cursors.join(F.broadcast(last))
    if time:
        at = commits.groupBy("lsn").agg(F.unix_micros(F.max(F.col(time).cast("timestamp"))).alias("_at"))
        rows = rows.join(at, rows["cursor"] == at["lsn"], "left").drop("lsn")
    else:
        rows = rows.withColumn("_at", F.lit(None).cast("long"))
    behind = F.greatest(F.lit(0), F.col("_last") - F.coalesce("cursor", F.lit(0)))
    return rows.select("stream", "cursor", behind.alias("behind"), ((F.col("_then") - F.col("_at")) / 1e6).alias("seconds"))


def handover(snapshot: DataFrame, applied: DataFrame, deleted: str = DELETED) -> DataFrame:
    """Rows of a snapshot, taken after the feed was opened, and then its changes, to be merged in the order of (lsn, seq): what
    is in both is applied twice, and the later wins."""
    first = snapshot.select(F.lit(-1).cast(applied.schema["lsn"].dataType).alias("lsn"), F.lit(0).cast(applied.schema["seq"].dataType).alias("seq"), *snapshot.columns, F.lit(None).cast("boolean").alias(deleted))
    return first.unionByName(applied)


def committed(log: DataFrame, commits: DataFrame, since=None, until=None) -> DataFrame:
    """Changes of transactions in commits (txn, lsn) after since and up to until; open transactions have no commit and wait."""
    done = commits
    if since is not None:
        done = done.filter(F.col("lsn") > F.lit(since))
    if until is not None:
        done = done.filter(F.col("lsn") <= F.lit(until))
    return log.join(done, "txn")


def apply_changes(log: DataFrame, key: list[str], deleted: str = DELETED, unchanged: Column | None = None) -> DataFrame:
    """(lsn, seq, columns..., deleted): rows to merge. A delete keeps its key and nothing else, with the flag true; a change
    of key is a delete of the old one and then an insert. Truncation, and a delete without a key, fail when read."""
    columns = log.schema["after"].dataType.fieldNames()
    kinds = {f.name: f.dataType for f in log.schema["after"].dataType.fields}
    moved = F.lit(False)
    for c in key:
        moved = moved | ~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}"))
    moved = (F.col("op") == "U") & F.col("before").isNotNull() & moved
    gone = F.struct(*[(F.col(f"before.{c}") if c in key else F.lit(None).cast(kinds[c])).alias(c) for c in columns], F.lit(True).alias(deleted))
    # A value that the change left out is taken from the row as it was.
    value = lambda c: F.when(F.array_contains(unchanged, c), F.col(f"before.{c}")).otherwise(F.col(f"after.{c}")) if unchanged is not None else F.col(f"after.{c}")
    come = F.struct(*[value(c).alias(c) for c in columns], F.lit(None).cast("boolean").alias(deleted))
    bad = F.raise_error(F.concat(F.lit("change that can't be applied: "), F.col("op"))).cast("array<int>").isNull()
    keyless = F.lit(False)
    for c in key:
        keyless = keyless | F.coalesce(F.col(f"before.{c}").isNull(), F.lit(True))
    keyless = (F.col("op") == "D") & keyless
    if unchanged is not None:  # the old image must tell what was left out
        blind = F.coalesce(F.size(unchanged), F.lit(0)) > 0
        blind = blind & (F.col("before").isNull() | F.coalesce(F.exists(unchanged, lambda c: ~c.isin(*columns)), F.lit(False)))
        keyless = keyless | blind
    rows = F.when((F.col("op") == "T") | keyless, F.when(bad, F.array(gone))).when(F.col("op") == "D", F.array(gone)).when(moved, F.array(gone, come)).otherwise(F.array(come))
    return log.select("lsn", "seq", F.posexplode(rows).alias("_step", "_row")).select("lsn", (F.col("seq") * 2 + F.col("_step")).alias("seq"), "_row.*")


def acknowledge(cursors: DataFrame) -> DataFrame:
    """The position that may be acknowledged: the least committed cursor over all streams; null while one has none."""
    return cursors.agg(F.when(F.count(F.lit(1)) == F.count("cursor"), F.min("cursor")).alias("ack"))
