"""A pipeline as a document: where rows come from, how they are written, and where to; read strictly and run in commit units.

A document is a mapping, or the YAML or JSON text of one. Fields that aren't known are refused wherever they stand. A run
reads each stream from the state that the destination holds (nothing of it under replace, which mirrors the source), cuts
what it reads into units by the commit policy, and commits each unit together with the state after its rows.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import apply_hints
from ..names import ARRIVAL
from ..operators.incremental import State, Window, advance, resume
from ..sinks.files import FileDestination
from ..sinks.lake import LakeDestination
from ..sinks.lease import Lease
from ..sinks.snapshots import SnapshotDestination
from ..sources import database, files, rest
from ..sources.query import query_stream, select_columns
from ..storage import Files, new_folder
from .commit import Table
from .options import OptionError, Scd2Options, TableOptions

MODES = ("append", "replace", "merge")


class DocumentError(ValueError):
    """Names the place in the document and what is wrong with it."""


def part(where: str, doc, needed: tuple[str, ...], allowed: tuple[str, ...]) -> dict:
    """doc, which must be a mapping with the needed fields and none but these and the allowed ones."""
    if not isinstance(doc, dict):
        raise DocumentError(f"{where} is a mapping of fields")
    if unknown := [k for k in doc if k not in (*needed, *allowed)]:
        raise DocumentError(f"{where} has no field {unknown[0]}; known: {', '.join((*needed, *allowed))}")
    if lost := [k for k in needed if doc.get(k) in (None, "", [], {})]:
        raise DocumentError(f"{where} needs {lost[0]}")
    return doc


def record(where: str, kind: type, doc):
    """An object of a dataclass from the fields of doc."""
    names = tuple(f.name for f in fields(kind))
    try:
        return kind(**part(where, doc, (), names))
    except (TypeError, ValueError) as e:
        raise e if isinstance(e, DocumentError) else DocumentError(f"{where}: {e}") from e


@dataclass(frozen=True)
class CommitPolicy:
    """A unit ends at the first checkpoint (a file, or a stream's end) where a threshold is reached; neither is split."""

    every_checkpoints: int | None = None
    every_bytes: int | None = None
    every_seconds: float | None = None

    def __post_init__(self):
        given = [v for v in (self.every_checkpoints, self.every_bytes, self.every_seconds) if v is not None]
        if not given:
            raise ValueError("a commit policy names a threshold: without one nothing would be committed until the end")
        if any(v <= 0 for v in given):
            raise ValueError("thresholds are above 0")

    def units(self, sizes: list[int], clock: Callable[[], float] = time.monotonic) -> Iterator[tuple[int, int]]:
        """(first, stop) of the checkpoints of each unit, whose sizes in bytes are given."""
        begin, total, since = 0, 0, clock()
        for k, size in enumerate(sizes, 1):
            total += size
            full = (self.every_checkpoints is not None and k - begin >= self.every_checkpoints) or (self.every_bytes is not None and total >= self.every_bytes)
            if full or (self.every_seconds is not None and clock() - since >= self.every_seconds):
                yield begin, k
                begin, total, since = k, 0, clock()
        if begin < len(sizes):
            yield begin, len(sizes)


@dataclass(frozen=True)
class BatchPolicy:
    """How many rows or bytes a write takes at least, whichever is reached first; a batch of the source isn't split. Without
    a threshold every batch is a write."""

    every_rows: int | None = None
    every_bytes: int | None = None

    def __post_init__(self):
        if any(v is not None and v <= 0 for v in (self.every_rows, self.every_bytes)):
            raise ValueError("thresholds are above 0")

    def writes(self, batches: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """(first, stop) of the source's batches, of (rows, bytes), that each write takes."""
        out, begin, rows, size = [], 0, 0, 0
        for k, (n, b) in enumerate(batches, 1):
            rows, size = rows + n, size + b
            bare = self.every_rows is None and self.every_bytes is None
            if bare or (self.every_rows is not None and rows >= self.every_rows) or (self.every_bytes is not None and size >= self.every_bytes):
                out.append((begin, k))
                begin, rows, size = k, 0, 0
        return out if begin == len(batches) else [*out, (begin, len(batches))]

    def stream_options(self) -> dict[str, str]:
        """The options by which a file stream's micro-batches follow the policy."""
        return {} if self.every_bytes is None else {"maxBytesPerTrigger": str(self.every_bytes)}


@dataclass(frozen=True)
class StreamSpec:
    """One stream of a source, and the table it goes to."""

    name: str
    path: str | None = None
    table: str | None = None
    sql: str | None = None
    format: str | None = None
    csv: dict = field(default_factory=dict)
    schema: str | None = None
    type_hints: dict = field(default_factory=dict)
    include: list | None = None
    exclude: list | None = None
    primary_key: list = field(default_factory=list)
    cursor: dict | str | None = None
    growing: bool = False
    rest: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Pipeline:
    name: str
    mode: str
    key: tuple[str, ...]
    options: TableOptions
    kind: str
    source: dict
    streams: tuple[StreamSpec, ...]
    target: str
    destination: dict
    commit: CommitPolicy | None
    batch: BatchPolicy


SOURCES = {"files": (), "tables": (), "query": ("tables",), "database": ("conn", "db_schema"), "rest": ("base_url",)}
TARGETS = {"files": ("path", "format", "partition_by", "codec", "level", "part_rows", "part_bytes", "group_rows"), "snapshots": ("path", "buckets"), "lake": ("path", "partitions")}


def parse(doc) -> Pipeline:
    """The pipeline of a document, checked in full before anything is read."""
    if isinstance(doc, str):
        import yaml

        doc = yaml.safe_load(doc)
    doc = part("the document", doc, ("pipeline", "write_mode", "source", "destination"), ("workdir", "commit_policy", "batch_policy"))
    mode, key, options = doc["write_mode"], (), TableOptions()
    if isinstance(mode, dict):
        merge = part("write_mode", mode, ("merge",), ())["merge"]
        merge = dict(part("write_mode.merge", merge, ("key",), tuple(f.name for f in fields(TableOptions))))
        mode, key = "merge", tuple(merge.pop("key"))
        if isinstance(merge.get("scd2"), dict):
            merge["scd2"] = record("write_mode.merge.scd2", Scd2Options, merge["scd2"])
        options = record("write_mode.merge", TableOptions, {k: tuple(v) if isinstance(v, list) else v for k, v in merge.items()})
    if mode not in MODES or (mode == "merge" and not key):
        raise DocumentError("write_mode is append, replace, or merge with a key")
    source = part("source", doc["source"], ("kind", "streams"), tuple({x for v in SOURCES.values() for x in v}))
    if source["kind"] not in SOURCES:
        raise DocumentError(f"source.kind {source['kind']} is none of {', '.join(SOURCES)}")
    if foreign := [k for k in source if k not in ("kind", "streams", *SOURCES[source["kind"]])]:
        raise DocumentError(f"source of kind {source['kind']} has no field {foreign[0]}")
    streams = tuple(record(f"source.streams[{k}]", StreamSpec, s) for k, s in enumerate(source["streams"]))
    names = [s.name.lower() for s in streams]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise DocumentError(f"two streams go to table {twice[0]}")
    destination = part("destination", doc["destination"], ("kind", "path"), tuple({x for v in TARGETS.values() for x in v}))
    if destination["kind"] not in TARGETS:
        raise DocumentError(f"destination.kind {destination['kind']} is none of {', '.join(TARGETS)}")
    if foreign := [k for k in destination if k not in ("kind", *TARGETS[destination["kind"]])]:
        raise DocumentError(f"destination of kind {destination['kind']} has no field {foreign[0]}")
    if mode == "merge" and destination["kind"] != "snapshots":
        raise DocumentError(f"a destination of kind {destination['kind']} can't merge")
    if mode == "replace" and destination["kind"] == "lake":
        raise DocumentError("a destination of kind lake only appends")
    policy = record("commit_policy", CommitPolicy, doc["commit_policy"]) if "commit_policy" in doc else None
    return Pipeline(doc["pipeline"], mode, key, options, source["kind"], source, streams, destination["kind"], destination, policy, record("batch_policy", BatchPolicy, doc.get("batch_policy") or {}))


def to_json(value):
    """A cursor's value as JSON, by its kind."""
    if isinstance(value, (datetime, date)):
        return {"kind": type(value).__name__, "text": value.isoformat()}
    if isinstance(value, Decimal):
        return {"kind": "Decimal", "text": str(value)}
    return {"kind": "plain", "text": value}


def from_json(doc):
    return {"datetime": datetime.fromisoformat, "date": date.fromisoformat, "Decimal": Decimal, "plain": lambda v: v}[doc["kind"]](doc["text"])


@dataclass
class Unit:
    """Rows to commit at once, and what gives the stream's state after them."""

    rows: DataFrame
    settle: Callable[[], dict | None]


def file_units(spark: SparkSession, s: StreamSpec, state: dict | None, policy: CommitPolicy | None) -> Iterator[Unit]:
    """A unit for as many files as the policy takes; a stream that has no file yet gives one without rows, for its columns,
    and one whose files are all known gives none."""
    paths = files.list_files(spark, s.path)
    kind = s.format or next((k for k in ("parquet", "csv", "jsonl") if f".{k}" in s.path.rpartition("/")[2]), None)
    look = Files(spark)
    known = files.progress_of(state)
    sizes = [look.stat(p)[0] for p in paths]
    new = [k for k, p in enumerate(paths) if p not in known or known[p]["size"] != sizes[k]]
    if state is not None and not new:
        for path in paths:  # nothing to read, but what was read must be as it was
            files.check_history(path, *look.stat(path), known[path])
        return
    chosen = [paths] if policy is None or not new else [[paths[k] for k in new[lo:hi]] for lo, hi in policy.units([sizes[k] for k in new])]
    at = state
    for own in chosen:
        if kind == "jsonl":
            if not s.schema:
                raise DocumentError(f"stream {s.name}: JSON lines need a schema")
            rows, settle = files.read_jsonl(spark, own, T.StructType.fromDDL(s.schema), at, s.growing)
        elif kind == "parquet":
            rows, settle = files.read_parquet(spark, own, at, s.type_hints or None, T.StructType.fromDDL(s.schema) if s.schema else None)
        elif kind == "csv":
            rows, settle = files.read_csv(spark, own, at, hints=s.type_hints, columns=list(T.StructType.fromDDL(s.schema).names) if s.schema else None, **s.csv)
        else:
            raise DocumentError(f"stream {s.name}: its format is jsonl, parquet or csv")
        box = {}

        def after(settle=settle, box=box) -> dict:
            box["state"] = settle()
            return box["state"]

        yield Unit(rows, after)
        at = box.get("state", at)


def cursor_unit(spark: SparkSession, s: StreamSpec, rows: DataFrame, state: dict | None, folder: str, fixed: bool) -> Unit:
    """The rows past the stream's cursor, and the state that has its watermark and a table of the keys at it."""
    if s.cursor is None:
        return Unit(rows, lambda: None)
    c = {"column": s.cursor} if isinstance(s.cursor, str) else dict(s.cursor)
    w = record(f"stream {s.name}.cursor", Window, c)
    before = State(from_json(state["watermark"]), state["keys"]) if state else None
    key = s.primary_key or None
    new = resume(rows, w, before, key)
    if not fixed:  # what is committed and what the state tells must be the same rows, though the source goes on
        held = new_folder(spark, f"unit-{s.name}")
        new.write.parquet(held)
        new = spark.read.schema(new.schema).parquet(held)

    def after() -> dict | None:
        now = advance(new, w.column, key, before, w.direction, f"{folder}/keys-{uuid.uuid4().hex}")
        return None if now.watermark is None else {"watermark": to_json(now.watermark), "keys": now.keys}

    return Unit(new, after)


def rest_rows(spark: SparkSession, s: StreamSpec, base: str) -> DataFrame:
    doc = dict(s.rest)
    for name, kind in (("pages", rest.Pages), ("auth", rest.Auth)):
        if name in doc:
            doc[name] = record(f"stream {s.name}.rest.{name}", kind, doc[name])
    doc["actions"] = [record(f"stream {s.name}.rest.actions[{k}]", rest.Action, a) for k, a in enumerate(doc.get("actions", []))]
    stream = record(f"stream {s.name}.rest", rest.Stream, {"base_url": base, "path": s.path, **doc})
    if not s.schema:
        raise DocumentError(f"stream {s.name}: records need a schema")
    name = f"rest_{uuid.uuid4().hex}"
    spark.dataSource.register(rest.rest_source(stream, None, name))
    return spark.read.format(name).load().select(F.from_json("value", s.schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def run(spark: SparkSession, doc, load: str | None = None, owner: str = "", tries: int = 3, tables: dict[str, DataFrame] | None = None) -> dict:
    """Run a pipeline once; a report of the units of each stream. A load's name lets a stopped run go on: units that it
    committed are no-ops. What fails in passing is tried again, what can't succeed stops the run."""
    p = parse(doc)
    root, load = p.destination["path"], load or uuid.uuid4().hex
    report = {"pipeline": p.name, "load": load, "streams": {}}
    with Lease(spark, root, p.name, owner or f"{p.name} {load}") as lease:
        rest_of = {k: v for k, v in p.destination.items() if k not in ("kind", "path")}
        if p.target == "files":
            kind = {"parquet": "parquet", "jsonl": "json"}[rest_of.pop("format", "parquet")]
            target = FileDestination(spark, root, p.name, kind=kind, lease=lease, **rest_of)
        elif p.target == "snapshots":
            target = SnapshotDestination(spark, root, p.name, lease=lease, **rest_of)
        else:
            target = LakeDestination(spark, root, p.name, [tuple(x) for x in rest_of.get("partitions", [])])
        held = lambda s: (target.state(s.name) if p.target == "lake" else target.state()) or {"streams": {}, "last": {}}
        for s in p.streams:
            committed = skipped = 0
            whole = held(s)
            # A mirror is made from all there is: a cursor would leave out what it had before.
            state = None if p.mode == "replace" else whole["streams"].get(s.name)
            last = whole["last"].get(s.name)
            seq = last[1] + 1 if last and last[0] == load else 0
            if seq and (p.kind != "files" or p.mode == "replace"):  # one unit is all, and this load has it
                report["streams"][s.name] = {"units": 0, "already": seq, "resumed": state is not None}
                continue
            for unit in units(spark, p, s, state, root, tables):
                rows = select_columns(unit.rows, s.include, s.exclude)
                if s.type_hints and p.kind != "files":
                    rows = apply_hints(rows, s.type_hints)

                def after(unit=unit, s=s, seq=seq) -> dict:
                    old, now = held(s), unit.settle()
                    streams = old["streams"] if now is None else {**old["streams"], s.name: now}
                    return {"streams": streams, "last": {**old["last"], s.name: [load, seq]}}

                done = retried(lambda rows=rows, after=after, seq=seq, s=s: publish(target, p, s, rows, load, seq, after), tries)
                committed, skipped, seq = committed + done, skipped + (not done), seq + 1
            report["streams"][s.name] = {"units": committed, "already": skipped, "resumed": state is not None}
    return report


def units(spark: SparkSession, p: Pipeline, s: StreamSpec, state: dict | None, root: str, tables: dict[str, DataFrame] | None) -> Iterator[Unit]:
    if p.kind == "files":
        yield from file_units(spark, s, state, p.commit)
        return
    if p.kind == "tables":
        rows = tables[s.table or s.name] if tables else spark.read.parquet(s.path) if s.path else spark.table(s.table or s.name)
    elif p.kind == "query":
        rows = query_stream(spark, s.sql or "", tables if tables is not None else {n: spark.read.parquet(f) for n, f in (p.source.get("tables") or {}).items()})
    elif p.kind == "database":
        db = database.parse_connection(p.source["conn"])
        rows = database.query_rows(spark, db, s.sql) if s.sql else database.scan(spark, db, p.source.get("db_schema", ""), s.table or s.name)
    else:
        rows = rest_rows(spark, s, p.source["base_url"])
    yield cursor_unit(spark, s, rows, state, f"{root.rstrip('/')}/_cursors/{s.name}", p.kind == "tables" and s.path is not None)


def publish(target, p: Pipeline, s: StreamSpec, rows: DataFrame, load: str, seq: int, after) -> bool:
    if isinstance(target, SnapshotDestination):
        t = Table(s.name, p.mode, p.key if p.mode == "merge" else (), p.options)
        if p.mode == "merge" and (lost := [k for k in p.key if k not in rows.columns]):
            raise OptionError(f"{s.name}: key column {lost[0]} is missing")
        return target.commit([t], {s.name: rows.withColumn(ARRIVAL, F.monotonically_increasing_id())}, f"{load}-{s.name}", seq, ARRIVAL, boundary=datetime.now(), state=after)
    return target.write(s.name, rows, load, seq, p.mode, after)


def retried(work: Callable[[], bool], tries: int, wait: float = 0.2) -> bool:
    """Work done again while it fails in passing: a source that says so, or a rate limit, whose wait is kept."""
    for k in range(tries):
        try:
            return work()
        except Exception as e:  # noqa: BLE001
            passing = getattr(e, "kind", "fatal") in ("transient", "rate_limited")
            if not passing or k + 1 == tries:
                raise
            time.sleep(e.wait if getattr(e, "wait", None) is not None else wait * 2**k)
    raise AssertionError
