"""An append-only table of snapshots with partition transforms, in the manner of table formats, over plain files.

A unit's files are written beside the others, by folders of the transforms' values; then the next metadata document,
stamped with (pipeline, load, seq), is created by its number. Of two writers one creates it, the other builds on it. A
unit whose stamp is there is a no-op. The transforms of a table are fixed when it is made; columns may be added.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import transform
from ..functions.types import align, check_case, evolve, ingest
from ..storage import Storage

VERSION = 1
#: The end of a partition field's name, by transform (fixed values).
SUFFIX = {"identity": "", "year": "_year", "month": "_month", "day": "_day", "hour": "_hour", "bucket": "_bucket", "truncate": "_trunc"}


class LakeDestination:
    def __init__(self, spark: SparkSession, root: str, pipeline: str, partitions: list[tuple] = (), tries: int = 5):
        for name, column, *parameter in partitions:
            if name not in SUFFIX:
                raise ValueError(f"no transform {name}")
            if (name in ("bucket", "truncate")) != bool(parameter) or any(p < 1 for p in parameter):
                raise ValueError(f"{name} of {column}: bucket and truncate take a number of at least 1, others none")
        self.spark, self.store, self.pipeline, self.tries = spark, Storage(spark, root), pipeline, tries
        self.partitions = [list(p) for p in partitions]

    def document(self, table: str) -> tuple[int, dict]:
        """The number and content of the last metadata document."""
        numbers = [int(n.rpartition("/v")[2].removesuffix(".json")) for n, _ in self.store.files(f"{table}/metadata")]
        if not numbers:
            return 0, {"version": VERSION, "partitions": self.partitions, "schema": None, "snapshots": []}
        found = self.store.read_json(f"{table}/metadata/v{max(numbers)}.json")
        if found["version"] > VERSION:
            raise ValueError("the table was written by a newer version: upgrade, do not reset")
        return max(numbers), found

    def write(self, table: str, df: DataFrame, load: str, seq: int, mode: str = "append", state=None) -> bool:
        if mode != "append":
            raise ValueError(f"{table}: {mode} isn't offered, a table of snapshots only grows")
        df, stamp = ingest(df), [self.pipeline, load, seq]
        number, doc = self.document(table)
        if any(s["unit"] == stamp for s in doc["snapshots"]):
            return False
        if doc["partitions"] != self.partitions:
            raise ValueError(f"{table}: its partitions are {doc['partitions']}, fixed when it was made")
        check_case(table, df.columns)
        schema = self.schema_of(doc, df)
        folder = f"{table}/data/{uuid.uuid4().hex}"
        out, folders = align(df, schema), []
        for name, column, *parameter in self.partitions:
            if column not in schema.names:
                raise ValueError(f"{table}: partition column {column} is missing")
            text = isinstance(schema[column].dataType, T.StringType)
            field = f"_{column}{SUFFIX[name]}"
            out = out.withColumn(field, transform(name, column, parameter[0] if parameter else None, text=text))
            folders.append(field)
        if folders:
            out = out.hint("rebalance", *folders)
        out.write.partitionBy(*folders).parquet(self.store.full(folder))
        files = [n for n, _ in self.store.files(folder) if n.rpartition("/")[2].startswith("part-")]
        rows = self.spark.read.schema(T.StructType([])).parquet(*[self.store.full(n) for n in files]).count() if files else 0
        after = state() if callable(state) else state
        for _ in range(self.tries):
            parent = doc["snapshots"][-1]["id"] if doc["snapshots"] else None
            snapshot = {"id": uuid.uuid4().hex, "parent": parent, "unit": stamp, "files": files, "rows": rows, "state": after}
            new = {**doc, "schema": self.schema_of(doc, df).jsonValue(), "snapshots": [*doc["snapshots"], snapshot]}
            if self.store.create(f"{table}/metadata/v{number + 1}.json", new):
                return True
            number, doc = self.document(table)  # another writer was first
            if any(s["unit"] == stamp for s in doc["snapshots"]):
                return False
        raise RuntimeError(f"{table}: other writers came first {self.tries} times")

    def schema_of(self, doc: dict, df: DataFrame) -> T.StructType:
        wanted = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        live = wanted if doc["schema"] is None else T.StructType.fromJson(doc["schema"])
        grown = evolve(live, wanted)
        if wider := [f.name for f in live.fields if grown[f.name].dataType != f.dataType]:
            raise ValueError(f"{', '.join(wider)} would get a wider type than the files that are there have")
        return grown

    def state(self, table: str):
        """The state that the pipeline's last unit on the table left."""
        mine = [s["state"] for s in self.document(table)[1]["snapshots"] if s["unit"][0] == self.pipeline and s["state"] is not None]
        return mine[-1] if mine else None

    def snapshots(self, table: str) -> list[dict]:
        return self.document(table)[1]["snapshots"]

    def read(self, table: str, snapshot: str | None = None) -> DataFrame:
        """The rows of all snapshots, or of those up to one."""
        doc = self.document(table)[1]
        files = []
        for s in doc["snapshots"]:
            files += s["files"]
            if s["id"] == snapshot:
                break
        else:
            if snapshot is not None:
                raise ValueError(f"{table} has no snapshot {snapshot}")
        schema = T.StructType.fromJson(doc["schema"]) if doc["schema"] else T.StructType([])
        return self.spark.read.schema(schema).parquet(*[self.store.full(f) for f in files]) if files else self.spark.createDataFrame([], schema)
