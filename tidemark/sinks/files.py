"""A destination of part files: append and replace, by partition folders, committed once.

A unit (load, seq) is written by Spark into a staging folder, where parts that came out larger than they may be are dealt
out again, and published by the driver in this order: clear (once a load, for replace), manifest, parts, schema, state,
receipt. Whatever stops it, running the unit again gives the same files: the manifest names what an earlier try published,
and a receipt makes the unit a no-op. Only files whose name has the shape part-<load>-<seq>-<index>.<ext> are deleted, and
on replacement what else lies as *.parquet at the top of a table without partitions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import encode_partition
from ..functions.types import align, check_case, check_session, evolve, ingest
from ..storage import Storage
from .lease import Lease

FORMAT_VERSION = 1
#: Rows that stay together however small part_bytes is.
LEAST_ROWS = 1000
EXTENSIONS = {"parquet": "parquet", "json": "jsonl"}
#: Codecs and the levels they take (fixed values).
CODECS = {"uncompressed": None, "snappy": None, "lz4_raw": None, "gzip": (0, 9), "brotli": (0, 11), "zstd": (1, 22)}
OWN = re.compile(r"part-[A-Za-z0-9_.-]+-\d+-\d+\.(parquet|jsonl)")


class FileDestination:
    def __init__(self, spark: SparkSession, root: str, pipeline: str, kind: str = "parquet", partition_by: str | None = None, codec: str = "snappy", level: int | None = None, part_rows: int = 0, part_bytes: int = 128 << 20, group_rows: int = 0, lease: Lease | None = None, fail_at: Callable[[str], None] = lambda point: None):
        if kind not in EXTENSIONS:
            raise ValueError(f"no file kind {kind}")
        if codec not in CODECS or (level is not None and (CODECS[codec] is None or not CODECS[codec][0] <= level <= CODECS[codec][1])):
            raise ValueError(f"codec {codec} at level {level} isn't offered")
        if part_bytes < 1 or part_rows < 0 or group_rows < 0:
            raise ValueError("part_bytes is at least 1, part_rows and group_rows at least 0")
        self.spark, self.store, self.pipeline, self.kind = spark, Storage(spark, root), pipeline, kind
        self.partition_by, self.codec, self.level, self.part_rows, self.part_bytes, self.group_rows, self.lease, self.fail_at = partition_by, codec, level, part_rows, part_bytes, group_rows, lease, fail_at

    def document(self, name: str, fresh: dict) -> dict:
        found = self.store.read_json(f"_meta/{name}.json")
        if found is None:
            return {"version": FORMAT_VERSION, **fresh}
        if found["version"] > FORMAT_VERSION:
            raise ValueError(f"{name} was written by a newer version: upgrade, do not reset")
        if found["version"] < FORMAT_VERSION:
            raise ValueError(f"{name} has a format that is no longer read")
        return found

    def receipts(self) -> dict:
        return self.document(f"receipts-{self.pipeline}", {"units": []})

    def state(self) -> dict | None:
        """What the last committed unit of this pipeline left."""
        return self.document(f"state-{self.pipeline}", {"state": None})["state"]

    def schema(self, table: str) -> T.StructType | None:
        """The schema that a table's parts have grown to."""
        found = self.document(f"schema-{table}", {"schema": None})["schema"]
        return None if found is None else T.StructType.fromJson(found)

    def grown(self, table: str, df: DataFrame) -> T.StructType:
        """The table's schema with the columns that df adds. Parts aren't written anew, so a column's type stays: a narrower
        type is cast to it, a wider or another one is refused."""
        check_case(table, df.columns)
        live = self.schema(table)
        if live is None:
            return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        out = evolve(live, T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]))
        if wider := [f.name for f in live.fields if out[f.name].dataType != f.dataType]:
            raise ValueError(f"{table}: {', '.join(wider)} would get a wider type than the parts that are there have")
        check_case(table, out.names)
        return out

    def write(self, table: str, df: DataFrame, load: str, seq: int, mode: str = "append", state=None) -> bool:
        """Publish a unit; False if it was committed before. An empty unit still leaves the schema, as a file without rows.
        state may be a function, called once the rows were read."""
        if mode not in ("append", "replace"):
            raise ValueError(f"{mode}: part files can't be merged")
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
            raise ValueError("a load's name has letters, digits, _, . and - only")
        df = ingest(df)
        unit, receipts = [table, load, seq], self.receipts()
        if unit in receipts["units"]:
            return False
        session = self.document(f"session-{self.pipeline}", {"load": load, "tables": {}})
        known = session["tables"] if session["load"] == load else {}
        check_session(table, known.get(table), df.columns)
        schema = self.grown(table, df)
        staged = f"_meta/stage/{table}-{load}-{seq}"
        self.store.delete(staged)
        staged = self.stage(align(df, schema), staged)
        state = state() if callable(state) else state
        if self.lease is not None:
            self.lease.check()
        first_of_load = not any(t == table and loaded == load for t, loaded, _ in receipts["units"])
        names = self.names(table, staged, load, seq)
        if mode == "replace" and first_of_load:
            self.fail_at("clear")
            for name in self.owned(table, replace=True):  # what this very unit published before it was stopped goes as well
                self.store.delete(name)
        self.fail_at("manifest")
        manifest = f"_meta/manifest-{table}-{load}-{seq}.json"
        before = self.store.read_json(manifest) or {"names": []}
        self.store.write_json(manifest, {"version": FORMAT_VERSION, "names": sorted({*before["names"], *names.values()})})
        for name in set(before["names"]) - set(names.values()):
            self.store.delete(name)
        for source, target in names.items():
            self.fail_at("part")
            self.store.rename(source, target)
        self.fail_at("schema")
        self.store.write_json(f"_meta/schema-{table}.json", {"version": FORMAT_VERSION, "schema": schema.jsonValue()})
        self.store.write_json(f"_meta/session-{self.pipeline}.json", {"version": FORMAT_VERSION, "load": load, "tables": {**known, table: df.columns}})
        self.fail_at("state")
        if state is not None:
            self.store.write_json(f"_meta/state-{self.pipeline}.json", {"version": FORMAT_VERSION, "state": state})
        self.fail_at("receipt")
        receipts["units"].append(unit)
        self.store.write_json(f"_meta/receipts-{self.pipeline}.json", receipts)
        for name in (staged, staged.removesuffix("-rolled"), manifest):
            self.store.delete(name)
        return True

    def options(self, rows: int) -> dict[str, str]:
        out = {"maxRecordsPerFile": str(rows)} if rows else {}
        if self.kind != "parquet":
            return out
        out |= {"compression": self.codec, "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(64 << 10)}
        if self.level is not None:
            out[f"parquet.compression.codec.{self.codec}.level"] = str(self.level)
        if self.group_rows:
            out["parquet.block.row.count.limit"] = str(self.group_rows)
        return out

    def stage(self, df: DataFrame, staged: str) -> str:
        """Write parts; where one is larger than part_bytes, all are dealt out again by the rows that fit. The folder of the parts."""
        folders = []
        if self.partition_by:
            if self.partition_by not in df.columns:
                raise ValueError(f"partition column {self.partition_by} is missing")
            df = df.withColumn("_folder", encode_partition(F.col(self.partition_by))).hint("rebalance", "_folder")
            folders = ["_folder"]
        df.write.options(**self.options(self.part_rows)).partitionBy(*folders).format(self.kind).save(self.store.full(staged))
        sizes = [size for name, size in self.store.files(staged) if name.rpartition("/")[2].startswith("part-")]
        if not sizes or max(sizes) <= self.part_bytes:
            return staged
        kind = T.StructType([f for f in df.schema.fields if f.name != "_folder"])
        again = self.spark.read.schema(kind).format(self.kind).option("recursiveFileLookup", "true").load(self.store.full(staged))
        fit = max(LEAST_ROWS, int(self.part_bytes * again.count() / sum(sizes)))
        if self.partition_by:
            again = again.withColumn("_folder", encode_partition(F.col(self.partition_by))).hint("rebalance", "_folder")
        rolled = f"{staged}-rolled"
        self.store.delete(rolled)
        rows = min(fit, self.part_rows) if self.part_rows else fit
        again.write.options(**self.options(rows)).partitionBy(*folders).format(self.kind).save(self.store.full(rolled))
        return rolled

    def names(self, table: str, staged: str, load: str, seq: int) -> dict[str, str]:
        """Staged file -> published name, numbered within each partition."""
        out, count = {}, {}
        for name, size in self.store.files(staged):
            tail = name[len(staged) + 1 :]
            if not tail.rpartition("/")[2].startswith("part-") or (size == 0 and self.kind == "json"):
                continue
            folder = re.sub(r"^_folder=", "", tail.rpartition("/")[0])
            folder = self.jvm_unescape(folder) + "/" if folder else ""
            k = count[folder] = count.get(folder, -1) + 1
            out[name] = f"{table}/{folder}part-{load}-{seq}-{k}.{EXTENSIONS[self.kind]}"
        return out

    @staticmethod
    def jvm_unescape(folder: str) -> str:
        """Spark escapes % in folder names once more."""
        return re.sub(r"%25", "%", folder)

    @staticmethod
    def is_owned(table: str, name: str) -> bool:
        folders = name[len(table) + 1 :].split("/")
        return len(folders) <= 2 and OWN.fullmatch(folders[-1]) is not None

    def owned(self, table: str, replace: bool = False) -> list[str]:
        return [*self.sizes(table, replace)]

    def sizes(self, table: str, replace: bool = False) -> dict[str, int]:
        """Name and bytes of the published files of a table, by the shape of their name, at most one folder deep. For a
        replacement of Parquet without partitions any *.parquet at the top counts as the table's."""
        found, any_top = {}, replace and self.kind == "parquet" and not self.partition_by
        for name, size in self.store.files(table):
            folders = name[len(table) + 1 :].split("/")
            if self.is_owned(table, name) or any_top and len(folders) == 1 and name.endswith(".parquet"):
                found[name] = size
        return found

    def paths(self, table: str) -> list[str]:
        """What Spark is to read: the table's folder where all in it is the table's and lies at the top, else each file."""
        there = [n for n, _ in self.store.files(table)]
        names = [n for n in there if self.is_owned(table, n)]
        flat = names and len(names) == len(there) and all(n.count("/") == table.count("/") + 1 for n in names)
        return [self.store.full(table)] if flat else [self.store.full(n) for n in names]

    def count_rows(self, table: str) -> int:
        paths = self.paths(table)
        return self.spark.read.format(self.kind).load(paths).count() if paths else 0

    def read(self, table: str) -> DataFrame:
        """The published rows in the schema that the table has grown to; older parts give null for newer columns."""
        schema = self.schema(table)
        names = self.paths(table)
        if not names:
            return self.spark.createDataFrame([], schema or T.StructType([]))
        reader = self.spark.read.format(self.kind)
        return (reader.schema(schema) if schema is not None else reader).load(names)
