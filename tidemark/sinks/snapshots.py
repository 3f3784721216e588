"""Merge targets as snapshots: each commit unit writes what it changes of a table beside the old and moves one pointer.

A table lies in buckets by a hash of its key; a keyed merge reads and writes only the buckets that its delivery touches,
all else writes the whole. The pointer, the state, the schema and the receipt are one small document, so a unit is seen
whole or not at all. A unit whose receipt is there is a no-op; folders that no pointer names are left from a stopped try
and are written again. Folders that a unit replaced are deleted by the next one, so readers of the snapshot before go on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import align, check_case, check_session, evolve, ingest
from ..names import DELETED
from ..operators.merge import duplicate_keys
from ..operators.survivors import with_keys
from ..plans.commit import Facts, Table, full_feed, plan_commit, run_commit
from ..plans.options import OptionError, Scd2Options, check_opened, check_parsed
from ..storage import Storage
from .lease import Lease

VERSION = 2
BUCKET = "_bucket"


class SnapshotDestination:
    def __init__(self, spark: SparkSession, root: str, pipeline: str, fail_at: Callable[[str], None] = lambda point: None, buckets: int = 1, lease: Lease | None = None):
        if buckets < 1:
            raise ValueError("buckets are at least 1")
        self.spark, self.store, self.pipeline, self.fail_at, self.buckets, self.lease = spark, Storage(spark, root), pipeline, fail_at, buckets, lease

    def head(self) -> dict:
        """tables: {name: {"buckets", "parts": {bucket: folder}, "schema"}}; old: folders that the last unit replaced."""
        fresh = {"version": VERSION, "tables": {}, "units": [], "cleared": {}, "published": {}, "columns": {}, "unique": [], "old": [], "state": None}
        found = self.store.read_json(f"_head-{self.pipeline}.json") or fresh
        if found["version"] > VERSION:
            raise ValueError("the head was written by a newer version: upgrade, do not reset")
        if found["version"] < VERSION:
            raise ValueError("the head has a format that is no longer read")
        return found

    def state(self):
        """What the last committed unit of this pipeline left."""
        return self.head()["state"]

    def read(self, table: str) -> DataFrame | None:
        return self.content(self.head(), table)

    def content(self, head: dict, table: str, touched: set[int] | None = None) -> DataFrame | None:
        """The rows of a table, or of the touched buckets of it."""
        entry = head["tables"].get(table)
        if entry is None:
            return None
        schema = T.StructType.fromJson(entry["schema"])
        folders = [self.store.full(f) for b, f in sorted(entry["parts"].items()) if touched is None or int(b) in touched]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def check(self, tables: list[Table], stages: dict[str, DataFrame], arrival: str, head: dict, load: str) -> None:
        """All that can be refused before rows are read."""
        names = [t.name for t in tables]
        if twice := {n for n in names if names.count(n) > 1}:
            raise OptionError(f"{', '.join(sorted(twice))}: two streams go to one table")
        for t in tables:
            columns = [c for c in stages[t.name].columns if c != arrival]
            check_parsed(t.name, t.options)
            check_opened(t.name, t.options, columns, t.mode, list(t.key), child=t.parent is not None, keyed=t.keyed and t.parent is None)
            if t.mode == "merge" and t.keyed and t.parent is None and not t.key:
                raise OptionError(f"{t.name}: a merge needs a key")
            check_case(t.name, columns)
            check_session(t.name, head["columns"].get(load, {}).get(t.name), columns)

    def commit(self, tables: list[Table], stages: dict[str, DataFrame], load: str, seq: int, arrival: str, boundary=None, state=None, empty: Callable[[str], DataFrame] | None = None) -> bool:
        """Publish a unit; False if it was committed before. empty gives a target that isn't there yet, without rows; by
        default it has the columns of its stage but the arrival and the engine's flag. Columns that are new come last,
        types widen, and other changes of a type are refused. state may be a function, called once the rows were read."""
        head = self.head()
        if f"{load}/{seq}" in head["units"]:
            return False
        stages = {name: ingest(rows) for name, rows in stages.items()}
        self.check(tables, stages, arrival, head, load)
        stages = {t.name: with_keys(stages[t.name], list(t.key)) if t.mode == "merge" and t.keyed and t.parent is None else stages[t.name] for t in tables}
        cleared, published = set(head["cleared"].get(load, [])), set(head["published"].get(load, []))
        bare = frozenset(t.name for t in tables if full_feed(t) and stages[t.name].isEmpty())
        steps = plan_commit(tables, Facts(load, seq, cleared=frozenset(cleared), published=frozenset(published), empty=bare))
        targets, ready, touched = {}, {}, {}
        for t in tables:
            targets[t.name], ready[t.name], touched[t.name] = self.prepared(t, stages[t.name], head, arrival, empty)
        done = run_commit(steps, tables, targets.__getitem__, ready.__getitem__, arrival, boundary)
        old, live = [], {}
        for t in tables:
            if t.name not in done:
                continue
            entry = self.written(t, done[t.name], touched[t.name], head["tables"].get(t.name), f"{t.name}/snapshot-{load}-{seq}")
            live[t.name] = entry
            self.fail_at("written")
        after = state() if callable(state) else state
        if self.lease is not None:
            self.lease.check()
        for name, entry in live.items():
            before = head["tables"].get(name, {"parts": {}})["parts"].values()
            old += [f for f in before if f not in entry["parts"].values()]
            head["tables"][name] = entry
        gone, head["old"] = head["old"], old
        head["cleared"][load] = sorted(cleared | {s.table for s in steps if s.kind == "clear_target"})
        head["published"][load] = sorted(published | {t.name for t in tables if t.name not in bare})
        columns = head["columns"].get(load, {})
        head["columns"] = {load: {**columns, **{t.name: [c for c in stages[t.name].columns if c != arrival] for t in tables}}}
        head["unique"] = sorted({*head["unique"], *(t.name for t in tables if t.options.strategy == "upsert" and t.mode == "merge")})
        head["units"].append(f"{load}/{seq}")
        head["state"] = after if after is not None else head["state"]
        self.fail_at("head")
        self.store.write_json(f"_head-{self.pipeline}.json", head)
        for folder in gone:
            self.store.delete(folder)
        return True

    def prepared(self, t: Table, stage: DataFrame, head: dict, arrival: str, empty) -> tuple[DataFrame, DataFrame, set[int] | None]:
        """Target and stage of a table in the schema that it grows to, and the buckets that are touched (None: all)."""
        entry, own = head["tables"].get(t.name), [c for c in stage.columns if c not in (arrival, DELETED)]
        touched = None
        if entry is not None and entry["buckets"] > 1 and t.mode == "merge" and t.keyed and t.parent is None and not full_feed(t) and not t.options.merge_scope:
            hashed = stage.select(self.bucket(t, entry["buckets"], T.StructType.fromJson(entry["schema"])).alias(BUCKET))
            touched = {r[BUCKET] for r in hashed.distinct().collect()}  # at most as many as there are buckets
        target = self.content(head, t.name, touched)
        if target is None:
            target = empty(t.name) if empty else stage.select(*[f"`{c}`" for c in own]).limit(0)
        # The columns of validity are the engine's, and a target that was given decides which of the flags it has.
        scd2 = t.options.scd2 or Scd2Options()
        marks = (scd2.valid_from, scd2.valid_to) if t.options.strategy == "scd2" and t.mode == "merge" else ()
        flag = t.options.hard_delete if t.mode == "merge" and t.options.hard_delete not in target.columns and (entry or empty) else None
        wanted = T.StructType([T.StructField(f.name, f.dataType, True) for f in stage.schema.fields if f.name in own and f.name != flag])
        plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in target.schema.fields if f.name not in marks])
        grown = evolve(plain, wanted)
        check_case(t.name, grown.names)
        if touched is not None and [f.dataType for f in plain.fields] != [grown[f.name].dataType for f in plain.fields]:
            touched, target = None, self.content(head, t.name)  # a wider type is written into every bucket
        if marks and not entry and not empty:
            target = target.withColumn(marks[0], F.lit(None).cast("timestamp_ntz")).withColumn(marks[1], F.lit(None).cast("timestamp_ntz"))
        live = T.StructType([*grown.fields, *[target.schema[m] for m in marks]])
        extra = [F.col(f"`{c}`") for c in stage.columns if c not in grown.names]
        cast = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in stage.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in grown.fields]
        target = align(target, live)
        if t.mode == "merge" and t.options.strategy == "upsert" and t.name not in head["unique"] and entry is not None and not duplicate_keys(target, list(t.key)).isEmpty():
            raise OptionError(f"{t.name}: an upsert needs a unique key, and the table holds keys more than once")
        return target, stage.select(*cast, *extra), touched

    def bucket(self, t: Table, buckets: int, schema: T.StructType):
        """The bucket of a row: of the key's values in the types that the table has."""
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast(schema[c].dataType) for c in t.key]), F.lit(buckets)).cast("int")

    def written(self, t: Table, df: DataFrame, touched: set[int] | None, entry: dict | None, folder: str) -> dict:
        buckets = entry["buckets"] if touched is not None else self.buckets if t.mode == "merge" and t.keyed and t.parent is None else 1
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        out = {"buckets": buckets, "parts": dict(entry["parts"]) if touched is not None else {}, "schema": schema.jsonValue()}
        if buckets == 1:
            df.write.mode("overwrite").parquet(self.store.full(folder))
            out["parts"] = {"0": folder}
            return out
        rows = df.withColumn(BUCKET, self.bucket(t, buckets, schema))
        rows.repartition(min(buckets, len(touched or range(buckets)) or 1), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.store.full(folder))
        found = {name.split(f"{BUCKET}=", 1)[1].split("/")[0] for name, _ in self.store.files(folder) if f"{BUCKET}=" in name}
        for b in touched if touched is not None else range(buckets):
            out["parts"].pop(str(b), None)
        out["parts"] |= {b: f"{folder}/{BUCKET}={b}" for b in found}
        return out
