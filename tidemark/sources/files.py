"""Files read once: listing, checks, and an index of what was read of each file.

The state is {"version", "files": {file: progress}}. Plain JSON lines resume at the byte after what was read, Parquet at
the row group, once a digest of what goes before shows that it is the same; CSV and compressed files are read whole.
Every reader gives rows and a function that gives the state after them. It is called when the rows were read, as the
destinations do, and refuses if a file changed meanwhile, so a unit never holds rows that its state doesn't.
"""

from __future__ import annotations

import csv
import glob
import hashlib
import io
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import hint_type, hinted, survey
from ..storage import Files

STATE_VERSION = 1
#: First bytes of a compressed file, by extension (fixed values).
MAGIC = {".gz": b"\x1f\x8b", ".zst": b"\x28\xb5\x2f\xfd"}
CHECKED = 4096
Settle = Callable[[], dict]


class SourceError(ValueError):
    """Names the file and what is wrong with it."""


@dataclass(frozen=True)
class Task:
    """Units (bytes, or row groups) from start to stop of a file."""

    path: str
    size: int
    changed: int
    start: int
    stop: int


def progress_of(state: dict | None) -> dict:
    """The files of a state; a state of another format is refused, as starting over would deliver rows again."""
    if not state:
        return {}
    if state["version"] > STATE_VERSION:
        raise SourceError("the state of the files was written by a newer version: upgrade, do not reset")
    if state["version"] < STATE_VERSION:
        raise SourceError("the state of the files has a format that is no longer read")
    return state["files"]


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """A path that is there stands for itself; else a glob, sorted, whose wildcards skip dot-names. A missing file is an
    error, a glob without a match is empty, a folder is an error."""
    files = Files(spark)
    if files.is_folder(pattern):
        raise SourceError(f"{pattern} is a folder")
    if files.stat(pattern):
        return [pattern]
    if not glob.has_magic(pattern):
        raise SourceError(f"{pattern} is missing")
    folder = pattern[: re.search(r"[*?\[]", pattern).start()].rpartition("/")[0]
    fits = re.compile(glob.translate(pattern, recursive=True, include_hidden=False, seps="/")).match
    return [p for p in files.below(folder or ".") if fits(p if folder else p.removeprefix("./"))]


def check_codec(files: Files, path: str) -> str | None:
    """The compression that the name tells, which the file's first bytes must bear out; and none that isn't told."""
    told = next((e for e in MAGIC if path.endswith(e)), None)
    head = files.read(path, 0, 4)
    real = next((e for e, magic in MAGIC.items() if head.startswith(magic)), None)
    if head and told != real:
        raise SourceError(f"{path}: named {told or 'plain'}, but it is {real or 'plain'}")
    return told


def tail_digest(files: Files, path: str, done: int) -> str:
    """A digest of the last CHECKED bytes before done."""
    return hashlib.sha256(files.read(path, max(0, done - CHECKED), min(done, CHECKED))).hexdigest()


def group_digest(files: Files, path: str, done: int) -> str:
    """A digest of a Parquet file's schema and of its first row groups."""
    schema, groups = files.row_groups(path)
    return hashlib.sha256(repr((schema, groups[:done])).encode()).hexdigest()


def check_history(path: str, size: int, changed: int, old: dict) -> None:
    if size < old["size"]:
        raise SourceError(f"{path} shrank from {old['size']} to {size} bytes")
    if size == old["size"] and changed != old["changed"]:
        raise SourceError(f"{path} was rewritten: it has its size, but it changed since it was read")


def plan_whole(files: Files, paths: list[str], state: dict | None) -> list[Task]:
    """All of new files; any change of a file that was read is refused."""
    out, known = [], progress_of(state)
    for path in paths:
        (size, changed), old = stat(files, path), known.get(path)
        if old is None:
            out.append(Task(path, size, changed, 0, size))
            continue
        check_history(path, size, changed, old)
        if size != old["size"]:
            raise SourceError(f"{path} changed from {old['size']} to {size} bytes after it was read whole")
    return out


def plan_lines(files: Files, paths: list[str], state: dict | None) -> list[Task]:
    """All of new files and the growth of known ones. A file that shrank, was rewritten, or grew after a line that had no end
    is refused: the last line was read, and what was added may belong to it."""
    out, known = [], progress_of(state)
    for path in paths:
        (size, changed), old = stat(files, path), known.get(path)
        if old is None:
            out.append(Task(path, size, changed, 0, size))
            continue
        check_history(path, size, changed, old)
        if size == old["done"]:
            continue
        if not old["ended"]:
            raise SourceError(f"{path} grew after a line that wasn't ended: byte {old['done']} is within a record")
        if tail_digest(files, path, old["done"]) != old["digest"]:
            raise SourceError(f"{path} was rewritten: the bytes before {old['done']} changed")
        out.append(Task(path, size, changed, old["done"], size))
    return out


def plan_groups(files: Files, paths: list[str], state: dict | None) -> list[Task]:
    """All row groups of new Parquet files, and those that known files have more; the groups before them must be the same."""
    out, known = [], progress_of(state)
    for path in paths:
        (size, changed), old = stat(files, path), known.get(path)
        if old is not None:
            check_history(path, size, changed, old)
            if size == old["size"]:
                continue
        groups = len(files.row_groups(path)[1])
        if old is not None and (groups < old["done"] or group_digest(files, path, old["done"]) != old["digest"]):
            raise SourceError(f"{path} was rewritten: its first {old['done']} row groups changed")
        out.append(Task(path, size, changed, old["done"] if old else 0, groups))
    return out


def stat(files: Files, path: str) -> tuple[int, int]:
    found = files.stat(path)
    if found is None:
        raise SourceError(f"{path} is missing")
    return found


def settle(files: Files, tasks: list[Task], state: dict | None, digest, exact: frozenset[str] = frozenset()) -> Settle:
    """Gives the state after the tasks. Files in exact were read up to their stop and may have grown; others must be as listed."""

    def after() -> dict:
        out = dict(progress_of(state))
        for t in tasks:
            size, changed = stat(files, t.path)
            if size < t.size or (t.path not in exact and (size, changed) != (t.size, t.changed)):
                raise SourceError(f"{t.path} changed while it was read")
            ended = digest is not tail_digest or t.stop == 0 or files.read(t.path, t.stop - 1, 1) == b"\n"
            out[t.path] = {"size": t.size, "changed": changed if size == t.size else t.changed, "done": t.stop, "ended": ended, "digest": digest(files, t.path, t.stop)}
        return {"version": STATE_VERSION, "files": out}

    return after


def whole(rows: DataFrame, bad: Column, why: Column) -> DataFrame:
    """rows, failing with why at the first that is bad, whatever columns are read."""
    return rows.filter(F.when(bad, F.raise_error(why).cast("boolean")).otherwise(True))


def read_jsonl(spark: SparkSession, paths: list[str], schema: T.StructType, state: dict | None = None, growing: bool = False) -> tuple[DataFrame, Settle]:
    """Rows of JSON lines that weren't read before, and the state after them. Blank lines are skipped; a malformed one fails,
    naming the file, and the byte where parts of files are read. New files go to Spark's reader whole; a grown file, or with
    growing every plain file, is read line by line up to the size it was listed with, so it may grow meanwhile."""
    files, corrupt = Files(spark), "_malformed"
    packed = [p for p in paths if check_codec(files, p)]
    plain, packed_tasks = plan_lines(files, [p for p in paths if p not in packed], state), plan_whole(files, packed, state)
    parts = [t for t in plain if t.start or growing]
    fast = [t.path for t in plain if t not in parts] + [t.path for t in packed_tasks]
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])

    def parsed(lines: DataFrame) -> DataFrame:
        """The records of lines (value, place)."""
        read = lines.filter("trim(value) <> ''").select("value", "place", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r"))
        why = F.concat(F.lit("malformed line in "), "place", F.lit(": "), "value")
        return whole(read, F.col(f"r.{corrupt}").isNotNull(), why).select(*[F.col(f"r.`{f.name}`") for f in schema.fields])

    rows = spark.createDataFrame([], schema)
    if fast:
        rows = parsed(spark.read.text(fast).select("value", F.col("_metadata.file_path").alias("place")))
    for t in parts:
        # The one reader of Spark's that tells the byte at which a line begins; splits are read side by side.
        lines = spark.sparkContext.newAPIHadoopFile(t.path, "org.apache.hadoop.mapreduce.lib.input.TextInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.Text")
        mine = lines.filter(lambda line, lo=t.start, hi=t.stop: lo <= line[0] < hi).map(lambda line, hi=t.stop: (line[0], line[1].encode()[: hi - line[0]].decode(errors="replace")))
        new = spark.createDataFrame(mine, "at long, value string")
        rows = rows.unionByName(parsed(new.select("value", F.concat(F.lit(f"{t.path} at byte "), F.col("at").cast("string")).alias("place"))))
    exact = frozenset(t.path for t in parts)
    of_lines, of_whole = settle(files, plain, state, tail_digest, exact), settle(files, packed_tasks, None, tail_digest)
    return rows, lambda: {"version": STATE_VERSION, "files": {**of_lines()["files"], **of_whole()["files"]}}


def read_parquet(spark: SparkSession, paths: list[str], state: dict | None = None, hints: dict | None = None, schema: T.StructType | None = None) -> tuple[DataFrame, Settle]:
    """Rows of the row groups that weren't read before; types come from the files, so hints are refused. Where nothing is to
    be read the rows are none, of the files' schema, or of the one given where there are no files."""
    if hints:
        raise SourceError("Parquet files carry their own types")
    if packed := [p for p in paths if p.endswith(tuple(MAGIC))]:
        raise SourceError(f"{packed[0]}: a Parquet file isn't compressed as a whole")
    files = Files(spark)
    tasks = plan_groups(files, paths, state)
    if not paths and schema is None:
        raise SourceError("no Parquet file, and no schema for an empty table")
    out = spark.read.parquet(paths[0]).limit(0) if paths else spark.createDataFrame([], schema)
    if new := [t.path for t in tasks if not t.start]:
        out = spark.read.parquet(*new)
    for t in (t for t in tasks if t.start):
        before = sum(n for n, _ in files.row_groups(t.path)[1][: t.start])
        out = out.unionByName(spark.read.parquet(t.path).filter(F.col("_metadata.row_index") >= before), allowMissingColumns=True)
    return out, settle(files, tasks, state, group_digest)


def header_of(files: Files, path: str, delimiter: str, quote: str) -> list[str]:
    """The first record of a file, of which no more is read than it takes."""
    at, size, text = 0, stat(files, path)[0], b""
    if path.endswith(".zst"):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompressobj().decompress
    else:
        unpack = zlib.decompressobj(31).decompress if path.endswith(".gz") else bytes
    while at < size:
        text += unpack(files.read(path, at, 1 << 16))
        at += 1 << 16
        if b"\n" in text and text.count(quote.encode()) % 2 == 0 or text.rpartition(b"\n")[0].count(quote.encode()) % 2 == 0 and b"\n" in text:
            break
    return next(csv.reader(io.StringIO(text.decode("utf-8", "replace"), newline=""), delimiter=delimiter, quotechar=quote), [])


def read_csv(spark: SparkSession, paths: list[str], state: dict | None = None, delimiter: str = ",", quote: str = '"', header: bool = True, hints: dict[str, str] | None = None, columns: list[str] | None = None) -> tuple[DataFrame, Settle]:
    """Rows of CSV files that weren't read before, typed by a survey of all cells; hints decide over it. A ragged row, a
    name that comes twice, and a cell that doesn't fit its type fail, the cell with its file and column; an empty cell is
    null. Where there is no file, columns name those of the empty table."""
    for name, value in (("delimiter", delimiter), ("quote", quote)):
        if len(value) != 1 or not value.isascii():
            raise SourceError(f"{name} is one ASCII character")
    files = Files(spark)
    for p in paths:
        check_codec(files, p)
    tasks = plan_whole(files, paths, state)
    if not paths and not columns:
        raise SourceError("no CSV file, and no columns for an empty table")
    names = columns or []
    for k, p in enumerate([t.path for t in tasks] or paths[:1]):
        own = header_of(files, p, delimiter, quote)
        own = own if header else [f"c{i}" for i in range(len(own))]
        if len(set(own)) < len(own):
            raise SourceError(f"{p}: a column name comes twice")
        if k and own != names:
            raise SourceError(f"{p}: its columns are {', '.join(own)}, not {', '.join(names)}")
        names = own
    if unknown := [n for n in hints or {} if n not in names]:
        raise SourceError(f"hint for {unknown[0]}, which isn't a column")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"sep": delimiter, "quote": quote, "escape": quote, "header": str(header).lower(), "mode": "FAILFAST", "enforceSchema": "false" if header else "true", "multiLine": "true"}
    if tasks:
        text = spark.read.schema(schema).options(**options).csv([t.path for t in tasks]).withColumn("_file", F.col("_metadata.file_path"))
    else:
        text = spark.createDataFrame([], schema).withColumn("_file", F.lit(""))
    cells = text.drop("_file")
    shapes = survey(cells).first().asDict() if tasks else {n: "text" for n in names}
    kinds = {"bool": "bool", "int": "int64", "float": "float64", "text": "utf8"}
    out = []
    for n in names:
        hint = (hints or {}).get(n, kinds[shapes[n]])
        cell = F.when(F.col(f"`{n}`") != "", F.col(f"`{n}`"))
        where = F.concat(F.col("_file"), F.lit(f", column {n}: "))
        out.append(hinted(cell, hint, where).cast(hint_type(hint)).alias(n))
    return text.select(*out), settle(files, tasks, state, tail_digest)
