"""Publishing a stream: each micro-batch is a commit unit, so a batch that Spark runs again is a no-op."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import apply_changes, check_columns, committed
from ..plans.commit import Table
from ..sinks.snapshots import SnapshotDestination


def publish_stream(rows: DataFrame, destination: SnapshotDestination, table: Table, checkpoint: str, arrival: str, load: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, boundary=None, tail: str | None = None) -> StreamingQuery:
    """Merge or append a stream into a table. tail: the pause between batches ("5 seconds"); without it the stream is
    read up to what is there now, and ends."""

    def one(batch: DataFrame, seq: int) -> None:
        destination.commit([table], {table.name: prepare(batch)}, load, seq, arrival, boundary)

    writer = rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=tail) if tail else writer.trigger(availableNow=True)).start()


def catch_up(spark: SparkSession, log: DataFrame, commits: DataFrame, key: list[str], since, until, destination: SnapshotDestination, table: Table, load: str, seq: int) -> bool:
    """One pass over a change log: transactions committed after since and up to until, merged as one unit whose state is until."""
    if (live := destination.read(table.name)) is not None:
        check_columns(log, live.schema)
    rows = apply_changes(committed(log, commits, since, until), key)
    rows = rows.withColumn("_arrival", F.struct("lsn", "seq")).drop("lsn", "seq")
    return destination.commit([table], {table.name: rows}, load, seq, "_arrival", state={"lsn": until}, empty=lambda _: rows.drop("_arrival", "_deleted").limit(0))
