"""Targets in a database over JDBC: rows are staged by Spark's tasks, and a unit is published in one transaction.

In this order: tables and columns (statements that a database may commit by itself), the stage with a check of its row
count, and then in a transaction, rolled back on any error: clearing, deletes, inserts, the state, the receipt.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import check_case
from ..operators.survivors import flagged, survivors, with_keys
from ..plans.commit import Table, full_feed
from ..plans.options import OptionError, check_opened, check_parsed
from ..sources.database import Database, apart, imported, load

RECEIPTS, STATES = "_sys_receipts", "_sys_states"
FLAG = "_sys_gone"


class DatabaseDestination:
    def __init__(self, spark: SparkSession, db: Database, schema: str, pipeline: str, fail_at: Callable[[str], None] = lambda point: None):
        self.spark, self.db, self.schema, self.pipeline, self.fail_at = spark, db, schema, pipeline, fail_at

    def name(self, table: str) -> str:
        return self.db.name(self.schema, table)

    def execute(self, connection, sql: str, *values) -> int:
        ask = connection.prepareStatement(sql)
        try:
            for k, v in enumerate(values, 1):
                ask.setString(k, str(v))
            return ask.executeUpdate()
        finally:
            ask.close()

    def value(self, connection, sql: str, *values):
        ask = connection.prepareStatement(sql)
        try:
            for k, v in enumerate(values, 1):
                ask.setString(k, str(v))
            rows = ask.executeQuery()
            return rows.getString(1) if rows.next() else None
        finally:
            ask.close()

    def columns(self, connection, table: str) -> list[str]:
        rows, out = connection.getMetaData().getColumns(None, self.schema, table, "%"), []
        while rows.next():
            if rows.getString("TABLE_NAME") == table:
                out.append(rows.getString("COLUMN_NAME"))
        return out

    def ensure(self, connection) -> None:
        for table, columns in ((RECEIPTS, "pipeline VARCHAR(200), load_id VARCHAR(200), seq VARCHAR(40), target VARCHAR(200)"), (STATES, "pipeline VARCHAR(200), state VARCHAR(30000)")):
            if not self.columns(connection, table):
                named = ", ".join(f"{self.db.name(c.split()[0])} {c.split()[1]}" for c in columns.split(", "))
                self.execute(connection, f"CREATE TABLE {self.name(table)} ({named})")

    def state(self):
        connection = self.db.connect(self.spark)
        try:
            if not self.columns(connection, STATES):
                return None
            found = self.value(connection, f"SELECT {self.db.name('state')} FROM {self.name(STATES)} WHERE {self.db.name('pipeline')} = ?", self.pipeline)
            return None if found is None else json.loads(found)
        finally:
            connection.close()

    def write_rows(self, df: DataFrame, table: str, mode: str) -> int:
        """Rows written into a table by Spark's tasks, or where these can't reach the database, by it from their files."""
        seen = Observation()
        rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if apart(self.spark, self.db):
            df.limit(0).write.format("jdbc").options(**self.db.options(), dbtable=self.name(table)).mode(mode).save()
            imported(self.spark, self.db, self.schema, table, rows)
            return seen.get["n"]
        rows.write.format("jdbc").options(**self.db.options(), dbtable=self.name(table)).mode(mode).save()
        return seen.get["n"]

    def commit(self, t: Table, stage: DataFrame, load: str, seq: int, arrival: str, state=None) -> bool:
        """Publish a unit of a table: append, replace, or a keyed merge by delete-insert or upsert. False if it was committed before."""
        columns = [c for c in stage.columns if c != arrival]
        check_parsed(t.name, t.options)
        check_opened(t.name, t.options, columns, t.mode, list(t.key), child=t.parent is not None, keyed=t.keyed and t.parent is None)
        check_case(t.name, columns)
        if t.mode == "merge" and (not t.key or t.options.strategy == "scd2" or full_feed(t)):
            raise OptionError(f"{t.name}: a database target takes keyed merges by delete_insert or upsert")
        connection = self.db.connect(self.spark)
        try:
            self.ensure(connection)
            unit = (self.pipeline, load, seq, t.name)
            met = " AND ".join(f"{self.db.name(c)} = ?" for c in ("pipeline", "load_id", "seq", "target"))
            if self.value(connection, f"SELECT COUNT(*) FROM {self.name(RECEIPTS)} WHERE {met}", *unit) != "0":
                return False
            data = [c for c in columns if c != t.options.hard_delete] if t.mode == "merge" else columns
            self.grow(connection, t.name, stage.select(*[f"`{c}`" for c in data]))
            rows = stage
            if t.mode == "merge":
                rows = survivors(with_keys(stage, list(t.key)), list(t.key), arrival, t.options.dedup_sort)
                gone = flagged(rows, t.options.hard_delete) if t.options.hard_delete else F.lit(False)
                rows = rows.withColumn(FLAG, F.when(gone, 1).otherwise(0))
            rows = rows.select(*[f"`{c}`" for c in data], *([FLAG] if t.mode == "merge" else []))
            staged = f"{t.name}_stage"
            written = self.write_rows(rows, staged, "overwrite")
            there = int(self.value(connection, f"SELECT COUNT(*) FROM {self.name(staged)}"))
            if written != there:
                raise RuntimeError(f"{t.name}: {written} rows were written and {there} are in the stage")
            if t.mode == "merge" and not any(isinstance(rows.schema[k].dataType, (T.StringType, T.BinaryType)) for k in t.key):
                # Else a database without hash joins would look through the stage for each row. Long texts can't be indexed everywhere.
                index = self.name(f"{staged}_key") if self.db.url.startswith("jdbc:derby:") else self.db.name(f"{staged}_key")
                self.execute(connection, f"CREATE INDEX {index} ON {self.name(staged)} ({', '.join(self.db.name(k) for k in t.key)})")
            after = state() if callable(state) else state
            self.publish(connection, t, data, staged, unit, met, after)
            self.execute(connection, f"DROP TABLE {self.name(staged)}")
            return True
        finally:
            connection.close()

    def grow(self, connection, table: str, rows: DataFrame) -> None:
        """The target, made or given the columns that it lacks; the types are Spark's for the database."""
        live = self.columns(connection, table)
        new = [c for c in rows.columns if c not in live]
        if not live:
            rows.limit(0).write.format("jdbc").options(**self.db.options(), dbtable=self.name(table)).mode("append").save()
        elif new:
            shape = f"{table}_shape"
            rows.select(*[f"`{c}`" for c in new]).limit(0).write.format("jdbc").options(**self.db.options(), dbtable=self.name(shape)).mode("overwrite").save()
            kinds = connection.getMetaData().getColumns(None, self.schema, shape, "%")
            while kinds.next():
                size = f"({kinds.getInt('COLUMN_SIZE')}, {kinds.getInt('DECIMAL_DIGITS')})" if kinds.getString("TYPE_NAME") in ("DECIMAL", "NUMERIC") else f"({kinds.getInt('COLUMN_SIZE')})" if "CHAR" in kinds.getString("TYPE_NAME") else ""
                self.execute(connection, f"ALTER TABLE {self.name(table)} ADD COLUMN {self.db.name(kinds.getString('COLUMN_NAME'))} {kinds.getString('TYPE_NAME')}{size}")
            self.execute(connection, f"DROP TABLE {self.name(shape)}")

    def publish(self, connection, t: Table, data: list[str], staged: str, unit: tuple, met: str, state) -> None:
        target, stage, names = self.name(t.name), self.name(staged), ", ".join(self.db.name(c) for c in data)
        connection.setAutoCommit(False)
        connection.setTransactionIsolation(2)  # read committed
        try:
            if t.mode == "replace":
                loaded = f"{self.db.name('pipeline')} = ? AND {self.db.name('load_id')} = ? AND {self.db.name('target')} = ?"
                if self.value(connection, f"SELECT COUNT(*) FROM {self.name(RECEIPTS)} WHERE {loaded}", unit[0], unit[1], unit[3]) == "0":
                    self.execute(connection, f"DELETE FROM {target}")
            if t.mode == "merge":
                same = " AND ".join(f"s.{self.db.name(k)} = {target}.{self.db.name(k)}" for k in t.key)
                self.execute(connection, f"DELETE FROM {target} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {same})")
            self.fail_at("deleted")
            self.execute(connection, f"INSERT INTO {target} ({names}) SELECT {names} FROM {stage}" + (f" WHERE {self.db.name(FLAG)} = 0" if t.mode == "merge" else ""))
            self.fail_at("inserted")
            if state is not None:
                self.execute(connection, f"DELETE FROM {self.name(STATES)} WHERE {self.db.name('pipeline')} = ?", self.pipeline)
                self.execute(connection, f"INSERT INTO {self.name(STATES)} VALUES (?, ?)", self.pipeline, json.dumps(state, sort_keys=True))
            self.execute(connection, f"INSERT INTO {self.name(RECEIPTS)} VALUES (?, ?, ?, ?)", *unit)
            self.fail_at("receipt")
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.setAutoCommit(True)

    def read(self, table: str) -> DataFrame:
        return load(self.spark, self.db, self.name(table))
