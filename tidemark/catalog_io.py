"""The registered queries of sources, destinations, feeds and whole pipelines: each writes and reads through the operator
as its user does, in folders of its own below the shared one, and gives rows that its SQL gives too."""

from __future__ import annotations

import atexit
import io
import json
import os
import shutil
import tempfile
import threading
from concurrent.futures import ThreadPoolExecutor
from socketserver import StreamRequestHandler, ThreadingTCPServer
from urllib.parse import parse_qs, urlsplit

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import _APPLIED, DAY, LAST, STAGE, TARGET, TOP, UNTOUCHED, E, applied, change_log, clicks, days, events, query, stage, target
from .functions import types
from .operators import changes, incremental, shred
from .plans import pipeline
from .plans.commit import Table
from .plans.options import OptionError, Scd2Options, TableOptions, check_opened, check_parsed
from .session import table
from .sinks.database import DatabaseDestination
from .sinks.files import FileDestination
from .sinks.lake import LakeDestination
from .sinks.lease import Lease, LeaseError
from .sinks.snapshots import SnapshotDestination
from .sources import database, files, rest
from .sources.query import select_columns
from .storage import Storage, drop, new_folder
from .streaming.publish import catch_up, publish_stream

FILES = 6
UPSERT = TableOptions(strategy="upsert")
BY_USER = Table("t", "merge", ("user_id",), UPSERT)


def only(s, rows: list[tuple], schema: str) -> DataFrame:
    return s.createDataFrame(rows, schema)


# Files
def in_files(df: DataFrame, folder: str, kind: str, **options) -> None:
    """df in FILES files of a folder, dealt out by event_id."""
    df.withColumn("_n", F.pmod("event_id", F.lit(FILES))).repartition(FILES, "_n").drop("_n").write.options(**options).format(kind).mode("append").save(folder)


@query("SELECT event_id, user_id, event_type FROM events")
def parquet_scan(s, d):
    folder = new_folder(s, "q")
    in_files(events(s, d).select("event_id", "user_id", "event_type"), folder, "parquet")
    return files.read_parquet(s, files.list_files(s, f"{folder}/*.parquet"))[0]


@query("SELECT event_id, user_id FROM events WHERE event_id % 2 = 1")
def parquet_new_files(s, d):
    """What a second run reads: files that the first one hasn't."""
    folder, df = new_folder(s, "q"), events(s, d).select("event_id", "user_id")
    in_files(df.filter("event_id % 2 = 0"), folder, "parquet")
    rows, settle = files.read_parquet(s, files.list_files(s, f"{folder}/*.parquet"))
    rows.write.format("noop").mode("overwrite").save()
    state = settle()
    in_files(df.filter("event_id % 2 = 1"), folder, "parquet")
    return files.read_parquet(s, files.list_files(s, f"{folder}/*.parquet"), state)[0]


EVENT = "event_id long, user_id long, event_type string, value double"


def grown_lines(s, d) -> tuple[DataFrame, dict, str]:
    """JSON lines of the even events, read, and then each file with lines of the odd ones after them."""
    store = Storage(s, new_folder(s, "q"))
    line = events(s, d).select((F.col("event_id") % 2).alias("odd"), "event_id", F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"))
    line = line.withColumn("n", F.pmod(F.col("event_id").bitwiseAND(F.lit(~1)), F.lit(FILES)))
    for name, rows in (("one", line.filter("odd = 0")), ("two", line)):
        rows.repartition(FILES, "n").sortWithinPartitions("n", "odd", "event_id").select("n", "value").write.partitionBy("n").text(store.full(name))
    take = lambda name: [store.rename(n, f"in/{n.split('n=')[1].split('/')[0]}.jsonl") for n, _ in store.files(name) if n.endswith(".txt")]
    take("one")
    rows, settle = files.read_jsonl(s, files.list_files(s, store.full("in/*.jsonl")), T.StructType.fromDDL(EVENT))
    kept = new_folder(s, "q")
    rows.write.parquet(kept)
    state = settle()
    take("two")
    return s.read.parquet(kept), state, store.full("in/*.jsonl")


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 2 = 0")
def jsonl_scan(s, d):
    return grown_lines(s, d)[0]


@query("SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 2 = 1")
def jsonl_growth(s, d):
    """What a second run reads of files that have grown."""
    _, state, pattern = grown_lines(s, d)
    return files.read_jsonl(s, files.list_files(s, pattern), T.StructType.fromDDL(EVENT), state)[0]


@query("SELECT path, CAST(sum(n) AS BIGINT) AS done FROM (SELECT (event_id - event_id % 2) % 6 || '.jsonl' AS path, strlen('{\"event_id\":' || event_id || '}') + 1 AS n FROM events) GROUP BY 1")
def jsonl_state(s, d):
    """The bytes that the state says were read of each file."""
    store = Storage(s, new_folder(s, "q"))
    line = events(s, d).select(F.pmod(F.col("event_id").bitwiseAND(F.lit(~1)), F.lit(FILES)).alias("n"), F.to_json(F.struct("event_id")).alias("value"))
    line.repartition(FILES, "n").write.partitionBy("n").text(store.full("one"))
    for n, _ in store.files("one"):
        if n.endswith(".txt"):
            store.rename(n, f"in/{n.split('n=')[1].split('/')[0]}.jsonl")
    rows, settle = files.read_jsonl(s, files.list_files(s, store.full("in/*.jsonl")), T.StructType.fromDDL("event_id long"), growing=True)
    rows.write.format("noop").mode("overwrite").save()
    return only(s, [(p.rpartition("/")[2], f["done"]) for p, f in settle()["files"].items()], "path string, done long")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id + 0.5 ELSE event_id END AS mixed, event_id % 2 = 0 AS flag, CASE WHEN event_id % 5 <> 0 THEN event_type || ', \"x\"' END AS note, CAST(ts AS DATE) AS day FROM events")
def csv_scan(s, d):
    """Packed CSV with quotes, empty cells, integers among floats, and a hinted date."""
    folder = new_folder(s, "q")
    cells = events(s, d).selectExpr("event_id", "IF(event_id % 3 = 0, concat(event_id, '.5'), CAST(event_id AS STRING)) AS mixed", "event_id % 2 = 0 AS flag", "IF(event_id % 5 <> 0, concat(event_type, ', \"x\"'), NULL) AS note", "CAST(ts AS DATE) AS day")
    in_files(cells, folder, "csv", header="true", compression="gzip", escape='"')
    return files.read_csv(s, files.list_files(s, f"{folder}/*.csv.gz"), hints={"day": "date"})[0]


@query("SELECT event_id, user_id FROM events WHERE event_id % 6 < 2")
def glob_listing(s, d):
    folder = new_folder(s, "q")
    for k in range(FILES):
        events(s, d).select("event_id", "user_id").filter(F.pmod("event_id", F.lit(FILES)) == k).write.parquet(f"{folder}/d{k}")
    return files.read_parquet(s, files.list_files(s, f"{folder}/d[01]/**/*.parquet"))[0]


@query("SELECT CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS name WHERE false")
def empty_source(s, d):
    """A source without a file gives its columns, and a destination keeps them."""
    out = FileDestination(s, new_folder(s, "q"), "p")
    rows, settle = files.read_parquet(s, files.list_files(s, f"{new_folder(s, 'q')}/*.parquet"), schema=T.StructType.fromDDL("event_id long, name string"))
    out.write("t", rows, "l", 0, state=settle)
    return out.read("t")


@query("SELECT event_id, event_type FROM events")
def column_selection(s, d):
    return select_columns(select_columns(events(s, d), exclude=["ts"]), include=["event_id", "event_type"])


# Incremental state
@query(f"SELECT * FROM {DAY} WHERE day >= {TOP} AND event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) = {TOP})")
def boundary_dedup_pk(s, d):
    """A run has read the clicks of the last day; the next one reads the rest of it."""
    df = days(s, d)
    top = incremental.watermark(df, "day").first()["watermark"]
    state = incremental.advance(clicks(s, d, top), "day", ["event_id"], folder=new_folder(s, "q"))
    return incremental.resume(df, incremental.Window("day"), state, ["event_id"])


@query(f"SELECT user_id, day FROM {DAY} WHERE day >= {TOP} AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) = {TOP})")
def boundary_dedup_rowhash(s, d):
    df = days(s, d).select("user_id", "day")
    top = incremental.watermark(df, "day").first()["watermark"]
    state = incremental.advance(clicks(s, d, top).select("user_id", "day"), "day", None, folder=new_folder(s, "q"))
    return incremental.resume(df, incremental.Window("day"), state)


@query(f"SELECT event_id, {TOP} AS watermark FROM {DAY} WHERE day = {TOP}")
def watermark_state(s, d):
    """The state after two runs: its watermark, and the keys at it, of the first run and of the second."""
    df, w = days(s, d), incremental.Window("day")
    state = incremental.advance(df.filter("event_id % 2 = 0"), "day", ["event_id"], folder=new_folder(s, "q"))
    again = incremental.resume(df, w, state, ["event_id"])
    state = incremental.advance(again, "day", ["event_id"], state, folder=new_folder(s, "q"))
    return s.read.parquet(state.keys).select("row_key.event_id", F.lit(state.watermark).alias("watermark"))


@query("SELECT v FROM (SELECT CASE WHEN event_id % 9 <> 0 THEN event_id END AS v FROM events) ORDER BY v DESC NULLS FIRST LIMIT (SELECT count(*) // 4 FROM events)")
def cursor_order(s, d):
    rows = events(s, d).selectExpr("CASE WHEN event_id % 9 <> 0 THEN event_id END AS v")
    return incremental.in_order(rows, "v", "min").limit(rows.count() // 4)


@query("SELECT event_id, value FROM (SELECT event_id, value, max(value) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM events) WHERE value < top")
def cursor_violations(s, d):
    """Rows that a source which claims to be in the order of value gave too late."""
    return incremental.out_of_order(events(s, d).select("event_id", "value"), "value", "event_id")


@query("SELECT * FROM (VALUES ('bigint', true), ('string', true), ('date', true), ('timestamp_ntz', true), ('decimal(18,2)', true), ('boolean', false), ('double', false), ('binary', false)) t(type, allowed)")
def cursor_types(s, d):
    df = events(s, d).selectExpr("event_id AS a", "event_type AS b", "CAST(ts AS DATE) AS c", "CAST(ts AS TIMESTAMP_NTZ) AS d", "CAST(value AS DECIMAL(18,2)) AS e", "event_id > 0 AS f", "CAST(value AS DOUBLE) AS g", "CAST(event_type AS BINARY) AS h")
    found = []
    for f in df.schema.fields:
        try:
            incremental.check_cursor(df, f.name)
            found.append((f.dataType.simpleString(), True))
        except ValueError:
            found.append((f.dataType.simpleString(), False))
    return only(s, found, "type string, allowed boolean")


@query("SELECT event_id FROM events WHERE event_id >= 500")
def window_nulls_error(s, d):
    return incremental.window(events(s, d).select("event_id"), incremental.Window("event_id", "max", 500, nulls="error"))


# Types
@query("SELECT event_id, CAST(user_id AS BIGINT) AS small, CAST(CAST(value AS FLOAT) AS DOUBLE) AS real, '{\"k\":' || user_id || '}' AS pairs FROM events")
def ingest_types(s, d):
    raw = events(s, d).select("event_id", F.col("user_id").cast("int").alias("small"), F.col("value").cast("float").alias("real"), F.create_map(F.lit("k"), "user_id").alias("pairs"))
    return types.ingest(raw)


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)"


@query(f"SELECT event_id, {_UUID} AS id, CAST(event_id % 86400 AS BIGINT) * 1000000 + 250000 AS time, event_id % 2 = 0 AS flag, '[' || event_id || ']' AS list FROM (SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS h FROM events)")
def hinted_text(s, d):
    text = events(s, d).selectExpr("event_id", "md5(CAST(event_id AS STRING)) AS h").selectExpr("event_id", f"upper({_UUID}) AS id", "format_string('%02d:%02d:%02d.25', event_id % 86400 div 3600, event_id % 3600 div 60, event_id % 60) AS time", "CAST(event_id % 2 = 0 AS STRING) AS flag", "concat('[', event_id, ']') AS list")
    hints = {"id": "uuid", "time": "time", "flag": "bool", "list": "json"}
    return text.select("event_id", *[types.hinted(F.col(c), h).alias(c) for c, h in hints.items()])


@query("SELECT event_id, event_id % 2 = 0 AS flag, value, CAST(ts AS DATE) AS day, CAST(ts AS TIMESTAMP) AS at_time, md5(event_type) AS raw, CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS BIGINT) END AS small FROM events")
def wire_text(s, d):
    """Values as a change feed writes them in text."""
    from .functions import wire

    text = events(s, d).selectExpr("CAST(event_id AS STRING) AS event_id", "IF(event_id % 2 = 0, 't', 'f') AS flag", "CAST(value AS STRING) AS value", "CAST(CAST(ts AS DATE) AS STRING) AS day", "CAST(ts AS STRING) AS at_time", "concat('\\\\x', md5(event_type)) AS raw", "IF(event_id % 5 <> 0, CAST(user_id AS STRING), NULL) AS small")
    kinds = {"event_id": "int8", "flag": "bool", "value": "float8", "day": "date", "at_time": "timestamp", "raw": "bytea", "small": "int2"}
    out = text.select(*[wire.decode_text(F.col(c), k).alias(c) for c, k in kinds.items()])
    return out.withColumn("raw", F.lower(F.hex("raw")))


@query("SELECT event_id, -event_id AS below, event_id % 2 = 0 AS flag, CAST(DATE '1990-01-01' + CAST(event_id % 20000 AS INTEGER) AS DATE) AS day, event_type, CAST(event_id AS DOUBLE) / 8 AS number FROM events")
def wire_binary(s, d):
    """Values in binary, with numbers below zero and days on either side of 2000-01-01."""
    import struct

    from .functions import wire

    @F.pandas_udf("binary")
    def packed(v, kind):
        return v.index.to_series().map(lambda i: struct.pack(kind[i], v[i] if kind[i] == ">d" else int(v[i])))

    raw = lambda c, kind: packed(F.col(c).cast("double") if kind == ">d" else F.col(c).cast("long"), F.lit(kind))
    rows = events(s, d).select("event_id", (-F.col("event_id")).alias("below"), (F.col("event_id") % 2 == 0).cast("long").alias("flag"), (F.col("event_id") % 20000 - 3652).alias("day"), "event_type", (F.col("event_id") / 8).alias("number"))
    data = rows.select(raw("event_id", ">q").alias("event_id"), raw("below", ">i").alias("below"), raw("flag", ">b").alias("flag"), raw("day", ">i").alias("day"), F.encode("event_type", "UTF-8").alias("event_type"), raw("number", ">d").alias("number"))
    kinds = {"event_id": "int8", "below": "int4", "flag": "bool", "day": "date", "event_type": "text", "number": "float8"}
    return data.select(*[wire.decode_binary(F.col(c), k).alias(c) for c, k in kinds.items()])


# Part files
def written(s, d, **more) -> tuple[FileDestination, DataFrame]:
    out = FileDestination(s, new_folder(s, "q"), "p", **more)
    return out, table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CASE WHEN l_orderkey % 6 <> 0 THEN concat(l_returnflag, '/', l_linestatus) END AS part")


_PART = "CASE WHEN l_orderkey % 6 = 0 THEN '__null__' ELSE l_returnflag || '%2F' || l_linestatus END"


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 6 <> 0 THEN l_returnflag || '/' || l_linestatus END AS part FROM lineitem, (SELECT unnest([1, 2]))")
def parts_appended(s, d):
    """Two units appended, the second one delivered twice."""
    out, rows = written(s, d, kind="json")
    for seq in (0, 1, 1):
        out.write("t", rows, "l", seq)
    return out.read("t")


@query("SELECT l_orderkey * 2 AS l_orderkey, l_linenumber FROM lineitem UNION ALL SELECT l_orderkey * 3, l_linenumber FROM lineitem")
def parts_replaced(s, d):
    """An older load is replaced, once, by two units of a newer one."""
    out, rows = written(s, d, codec="zstd", level=3)
    for load, seq, k in (("a", 0, 1), ("b", 0, 2), ("b", 1, 3)):
        out.write("t", rows.select((F.col("l_orderkey") * k).alias("l_orderkey"), "l_linenumber"), load, seq, "replace")
    return out.read("t")


@query(f"SELECT {_PART} AS folder, count(*) AS n FROM lineitem GROUP BY 1")
def partition_folders(s, d):
    out, rows = written(s, d, partition_by="part")
    out.write("t", rows, "l", 0)
    name = F.element_at(F.split(F.regexp_replace(F.col("_metadata.file_path"), "%25", "%"), "/"), -2)
    return out.read("t").groupBy(name.alias("folder")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT DISTINCT {_PART} AS folder, 'part-l-' || seq || '-0.parquet' AS first, true AS counted FROM lineitem, (SELECT unnest([0, 1]) AS seq)")
def part_names(s, d):
    """The name of the first part of each folder and unit, and whether the names of a folder count up without a gap."""
    out, rows = written(s, d, partition_by="part")
    for seq in range(2):
        out.write("t", rows, "l", seq)
    seen: dict = {}
    for n in out.owned("t"):
        _, folder, name = n.split("/")
        seen.setdefault((folder, name.split("-")[2]), []).append(int(name.split("-")[3].split(".")[0]))
    return only(s, [(f, f"part-l-{seq}-{min(k)}.parquet", sorted(k) == [*range(len(k))]) for (f, seq), k in seen.items()], "folder string, first string, counted boolean")


@query("SELECT count(*) AS n, true AS rolled, true AS within FROM lineitem")
def parts_rolled(s, d):
    """A small bound on parts: several come out, none far over the bound."""
    bound = 16 << 10
    out, rows = written(s, d, part_bytes=bound, codec="uncompressed")
    out.write("t", rows, "l", 0)
    sizes = out.sizes("t").values()
    return only(s, [(out.count_rows("t"), len(sizes) > 1, max(sizes) < 2 * bound)], "n long, rolled boolean, within boolean")


@query("SELECT 'p' AS pipeline, max(event_id) AS reached FROM events UNION ALL SELECT 'q', min(event_id) FROM events UNION ALL SELECT 'r', NULL")
def state_of_each_pipeline(s, d):
    folder = new_folder(s, "q")
    ends = events(s, d).agg(F.max("event_id"), F.min("event_id")).first()
    for name, at in zip("pq", ends, strict=True):
        FileDestination(s, folder, name).write("t", events(s, d).select("event_id"), f"l{name}", 0, state={"at": at})
    return only(s, [(n, (FileDestination(s, folder, n).state() or {"at": None})["at"]) for n in "pqr"], "pipeline string, reached long")


@query("SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type FROM events UNION ALL SELECT event_id, user_id, event_type FROM events")
def parts_grow_a_column(s, d):
    out, rows = FileDestination(s, new_folder(s, "q"), "p"), events(s, d)
    out.write("t", rows.select("event_id", "user_id"), "a", 0)
    out.write("t", rows.select("event_type", "user_id", "event_id"), "b", 0)
    return out.read("t")


@query("SELECT l_orderkey, l_linenumber FROM lineitem, (SELECT unnest([1, 2, 3, 4, 5]))")
def parts_after_stops(s, d):
    """Units stopped at each of their steps and done again."""
    folder, rows = new_folder(s, "q"), written(s, d)[1].select("l_orderkey", "l_linenumber")
    for seq, point in enumerate(("manifest", "part", "schema", "state", "receipt")):
        def fail(at, point=point):
            if at == point:
                raise InterruptedError(at)

        for stop in (fail, lambda at: None):
            try:
                FileDestination(s, folder, "p", fail_at=stop).write("t", rows, "l", seq, state={"seq": seq})
            except InterruptedError:
                pass
    return FileDestination(s, folder, "p").read("t")


@query("SELECT * FROM (VALUES ('notes.txt', true), ('old.parquet', false), ('deep/other.parquet', true), ('part-a-0-0.parquet', false)) t(name, stays)")
def replaced_files(s, d):
    """Which files of a folder a replacement leaves alone."""
    out, rows = written(s, d)
    for name in ("notes.txt", "old.parquet", "deep/other.parquet", "part-a-0-0.parquet"):
        out.store.write(f"t/{name}", "mine")
    out.write("t", rows, "l", 0, "replace")
    return only(s, [(n, out.store.exists(f"t/{n}")) for n in ("notes.txt", "old.parquet", "deep/other.parquet", "part-a-0-0.parquet")], "name string, stays boolean")


@query("SELECT count(*) AS n, true AS bounded, 'zstd' AS codec FROM lineitem")
def row_group_rows(s, d):
    out, rows = written(s, d, codec="zstd", level=5, group_rows=500)
    out.write("t", rows.coalesce(2), "l", 0)
    groups = [g for n in out.owned("t") for g in files.Files(s).row_groups(out.store.full(n))[1]]
    return only(s, [(sum(n for n, _ in groups), max(n for n, _ in groups) <= 500, out.codec)], "n long, bounded boolean, codec string")


@query("SELECT * FROM (VALUES ('newer head', true), ('older head', true), ('newer receipts', true), ('newer state of files', true), ('newer lake', true)) t(document, refused)")
def format_gates(s, d):
    """Documents of another format are refused, never begun anew."""
    snapshots, parts, lakes = (kind(s, new_folder(s, "q"), "p") for kind in (SnapshotDestination, FileDestination, LakeDestination))
    found = []
    for name, act in (
        ("newer head", lambda: (snapshots.store.write_json("_head-p.json", {"version": 99}), snapshots.head())),
        ("older head", lambda: (snapshots.store.write_json("_head-p.json", {"version": 0}), snapshots.head())),
        ("newer receipts", lambda: (parts.store.write_json("_meta/receipts-p.json", {"version": 99}), parts.receipts())),
        ("newer state of files", lambda: files.progress_of({"version": 99, "files": {}})),
        ("newer lake", lambda: (lakes.store.write_json("t/metadata/v1.json", {"version": 99}), lakes.read("t"))),
    ):
        try:
            act()
            found.append((name, False))
        except ValueError:
            found.append((name, True))
    return only(s, found, "document string, refused boolean")


_CHANGED = ["grew, read whole", "shrank", "rewritten at its size", "grew after an unfinished line", "changed while it was read", "named gz, but plain", "missing", "a folder"]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', true)" for c in _CHANGED) + ") t(file, refused)")
def changed_files_refused(s, d):
    store, schema, found = Storage(s, new_folder(s, "q")), T.StructType.fromDDL("a long"), {}

    def case(name, before, after, reader=lambda p, st: files.read_jsonl(s, [p], schema, st)):
        path = f"{len(found)}.jsonl"
        store.write(path, before)
        rows, settle = reader(store.full(path), None)
        rows.collect()
        state = settle()
        store.write(path, after)
        attempt(name, lambda: reader(store.full(path), state))

    def attempt(name, act):
        try:
            act()
            found[name] = False
        except files.SourceError:
            found[name] = True

    case("grew, read whole", "a\n1\n", "a\n1\n2\n", lambda p, st: files.read_csv(s, [p], st))
    case("shrank", '{"a":1}\n{"a":2}\n', '{"a":1}\n')
    case("rewritten at its size", '{"a":1}\n', '{"a":2}\n')
    case("grew after an unfinished line", '{"a":1}', '{"a":1}\n{"a":2}\n')
    store.write("x.jsonl", '{"a":1}\n')
    _, settle = files.read_jsonl(s, [store.full("x.jsonl")], schema)
    store.write("x.jsonl", '{"a":1}\n{"a":2}\n')
    attempt("changed while it was read", settle)
    store.write("y.jsonl.gz", '{"a":1}\n')
    attempt("named gz, but plain", lambda: files.read_jsonl(s, [store.full("y.jsonl.gz")], schema))
    attempt("missing", lambda: files.list_files(s, store.full("none.jsonl")))
    attempt("a folder", lambda: files.list_files(s, store.root))
    return only(s, [(c, found[c]) for c in _CHANGED], "file string, refused boolean")


# Snapshots
@query(f"{UNTOUCHED} UNION ALL SELECT {E} FROM {LAST(STAGE)}")
def snapshot_merge(s, d):
    """A table in buckets, merged with a delivery; the unit delivered again is none."""
    out = SnapshotDestination(s, new_folder(s, "q"), "p", buckets=4)
    rows = lambda df: df.withColumn("arrival", F.col("event_id"))
    for seq, df in ((0, target(s, d)), (1, stage(s, d)), (1, stage(s, d))):
        out.commit([BY_USER], {"t": rows(df)}, "l", seq, "arrival")
    return out.read("t")


@query("SELECT event_id FROM events")
def replay_noop(s, d):
    """A unit that was committed leaves everything as it is, whatever it brings the second time."""
    out, rows = SnapshotDestination(s, new_folder(s, "q"), "p"), events(s, d).select("event_id")
    for times in (1, 7):
        out.commit([Table("t", "append")], {"t": rows.select((F.col("event_id") * times).alias("event_id"))}, "l", 0, "arrival")
    return out.read("t")


@query("SELECT max(event_id) AS reached, 'l/1' AS last, 2 AS units FROM events")
def state_with_receipt(s, d):
    out, rows = SnapshotDestination(s, new_folder(s, "q"), "p"), events(s, d).select("event_id")
    for seq in range(2):
        out.commit([Table("t", "append")], {"t": rows}, "l", seq, "arrival", state=lambda: {"at": rows.agg(F.max("event_id")).first()[0]})
    head = out.head()
    return only(s, [(head["state"]["at"], head["units"][-1], len(head["units"]))], "reached long, last string, units int")


GREW = f"SELECT event_id, user_id, event_type, CAST(NULL AS DOUBLE) AS value FROM {TARGET} WHERE user_id NOT IN (SELECT user_id FROM {STAGE})"


@query(f"{GREW} UNION ALL SELECT event_id, user_id, CAST(NULL AS VARCHAR), value FROM {LAST(STAGE)}")
def evolve_add_column(s, d):
    """The delivery has a column that the table hadn't, and lacks one that it has."""
    out = SnapshotDestination(s, new_folder(s, "q"), "p", buckets=4)
    out.commit([BY_USER], {"t": target(s, d).select("event_id", "user_id", "event_type").withColumn("n", F.col("event_id"))}, "a", 0, "n")
    out.commit([BY_USER], {"t": stage(s, d).select("event_id", "user_id", "value").withColumn("n", F.col("event_id"))}, "b", 0, "n")
    return out.read("t")


@query(f"SELECT user_id, CAST(event_id AS VARCHAR) AS v FROM {TARGET} WHERE user_id NOT IN (SELECT user_id FROM {STAGE}) UNION ALL SELECT user_id, event_type FROM {LAST(STAGE)}")
def evolve_widen(s, d):
    """Numbers become text within a load."""
    out = SnapshotDestination(s, new_folder(s, "q"), "p", buckets=4)
    for seq, (df, v) in enumerate(((target(s, d), "event_id"), (stage(s, d), "event_type"))):
        out.commit([BY_USER], {"t": df.select("user_id", F.col(v).alias("v"), F.col("event_id").alias("n"))}, "a", seq, "n")
    return out.read("t")


@query("SELECT event_id, user_id, CAST(CAST(value AS DECIMAL(30,4)) AS VARCHAR) AS value FROM events UNION ALL SELECT event_id, user_id, user_id || '.0000' FROM events")
def evolve_widen_across_runs(s, d):
    out, t = SnapshotDestination(s, new_folder(s, "q"), "p"), Table("t", "append")
    out.commit([t], {"t": events(s, d).select("event_id", "user_id", F.col("user_id").alias("value"))}, "a", 0, "n")
    out.commit([t], {"t": events(s, d).select("event_id", "user_id", F.col("value").cast("decimal(30,4)").alias("value"))}, "b", 0, "n")
    return out.read("t").withColumn("value", F.col("value").cast("string"))


@query("SELECT * FROM (VALUES ('a null key', true), ('a lost column', true), ('an unknown strategy', true), ('a contradicting type', true), ('a second full unit', true), ('two streams', true)) t(refused, as_it_should)")
def commits_refused(s, d):
    rows = events(s, d).select("user_id", "event_type", F.col("event_id").alias("n"))
    out = SnapshotDestination(s, new_folder(s, "q"), "p")
    out.commit([BY_USER], {"t": rows}, "l", 0, "n")
    scope = Table("t", "merge", ("user_id",), TableOptions(merge_scope=("event_type",)))
    out.commit([scope], {"t": rows}, "scoped", 0, "n")
    cases = {
        "a null key": ([BY_USER], rows.withColumn("user_id", F.when(F.col("user_id") % 2 == 0, F.col("user_id"))), "k"),
        "a lost column": ([BY_USER], rows.drop("event_type"), "scoped"),
        "an unknown strategy": ([Table("t", "merge", ("user_id",), TableOptions(strategy="magic"))], rows, "m"),
        "a contradicting type": ([BY_USER], rows.withColumn("user_id", F.lit(True)), "n"),
        "a second full unit": ([scope], rows, "scoped"),
        "two streams": ([BY_USER, BY_USER], rows, "o"),
    }
    found = []
    for name, (tables, df, load) in cases.items():
        try:
            out.commit(tables, {"t": df}, load, 1, "n")
            found.append((name, False))
        except Exception:  # noqa: BLE001  of several kinds; what is asked is that the unit is refused
            found.append((name, f"{load}/1" not in out.head()["units"]))
    return only(s, found, "refused string, as_it_should boolean")


_REFUSALS = [
    ("strategy magic is none of delete_insert, upsert, scd2", TableOptions(strategy="magic"), "merge"),
    ("hard_delete names no column", TableOptions(hard_delete=""), "merge"),
    ("hard_delete doesn't go with scd2", TableOptions(strategy="scd2", hard_delete="x"), "merge"),
    ("merge_scope names a column twice", TableOptions(merge_scope=("a", "a")), "merge"),
    ("merge_scope with scd2 needs absent: retire", TableOptions(strategy="scd2", merge_scope=("a",)), "merge"),
    ("validity columns share a name", TableOptions(strategy="scd2", scd2=Scd2Options(valid_from="v", valid_to="v")), "merge"),
    ("strategy needs merge, not append", TableOptions(strategy="upsert"), "append"),
    ("dedup_sort can't be a key column", TableOptions(dedup_sort=("event_id", "asc")), "merge"),
    ("merge_scope column nope is missing", TableOptions(merge_scope=("nope",)), "merge"),
    ("hard_delete column nope is missing", TableOptions(hard_delete="nope"), "merge"),
]


@query("SELECT * FROM (VALUES " + ", ".join("('t: " + why.replace("'", "''") + "')" for why, _, _ in _REFUSALS) + ") t(why)")
def options_refused(s, d):
    columns, found = events(s, d).columns, []
    for _, options, mode in _REFUSALS:
        try:
            check_parsed("t", options)
            check_opened("t", options, columns, mode, ["event_id"])
        except OptionError as e:
            found.append((str(e),))
    return only(s, found, "why string")


@query("SELECT user_id, 2 AS n FROM (SELECT DISTINCT user_id * 2 AS user_id FROM events)")
def duplicate_keys(s, d):
    from .operators import merge

    once = target(s, d).select("user_id")
    return merge.duplicate_keys(once.unionByName(once), ["user_id"]).withColumn("n", F.col("n").cast("int"))


@query("SELECT 'the first run' AS holder, true AS refused, true AS taken_over")
def lease_holder(s, d):
    now, folder = [0.0], new_folder(s, "q")
    Lease(s, folder, "p", "the first run", lambda: now[0]).acquire()
    second, refused = Lease(s, folder, "p", "the second run", lambda: now[0]), False
    holder = second.holder()["owner"]
    try:
        second.acquire()
    except LeaseError:
        refused = True
    now[0] = 301.0
    second.acquire()
    return only(s, [(holder, refused, second.holder()["owner"] == "the second run")], "holder string, refused boolean, taken_over boolean")


# A lake of snapshots
def lake(s, d) -> LakeDestination:
    out = LakeDestination(s, new_folder(s, "q"), "p", [("day", "ts"), ("truncate", "event_type", 3)])
    for seq in (0, 1, 1):
        out.write("t", events(s, d).filter(F.col("event_id") % 2 == seq), "l", seq)
    return out


@query(f"SELECT {E} FROM events")
def lake_appended(s, d):
    return lake(s, d).read("t")


@query(f"SELECT {E} FROM events WHERE event_id % 2 = 0")
def lake_snapshot(s, d):
    out = lake(s, d)
    return out.read("t", out.snapshots("t")[0]["id"])


@query("SELECT CAST(ts AS DATE) AS day, substr(event_type, 1, 3) AS start, count(*) AS n FROM events GROUP BY ALL")
def lake_partitions(s, d):
    out = lake(s, d)
    path = F.col("_metadata.file_path")
    part = lambda name: F.regexp_extract(path, f"_{name}=([^/]+)", 1)
    return out.read("t").groupBy(F.substring(part("ts_day"), 1, 10).cast("date").alias("day"), part("event_type_trunc").alias("start")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT seq, n FROM (SELECT event_id % 2 AS seq, count(*) AS n FROM events GROUP BY 1)")
def lake_stamps(s, d):
    return only(s, [(x["unit"][2], x["rows"]) for x in lake(s, d).snapshots("t")], "seq long, n long")


_M = "4294967296"
_ROT = lambda x, r: f"((({x}) << {r}) % {_M} + (({x}) >> {32 - r}))"
_MIX = lambda k: f"({_ROT(f'(({k}) * 3432918353) % {_M}', 15)} * 461845907) % {_M}"  # noqa: E731  murmur3's factors, as elsewhere
_ROUND = lambda h, k: f"({_ROT(f'xor({h}, {_MIX(k)})', 13)} * 5 + 3864292196) % {_M}"


@query(f"""
WITH a AS (SELECT event_id, CAST(event_id % {_M} AS UBIGINT) AS lo, CAST(event_id // {_M} AS UBIGINT) AS hi FROM events),
b AS (SELECT event_id, hi, {_ROUND("CAST(0 AS UBIGINT)", "lo")} AS h FROM a), c AS (SELECT event_id, xor(CAST({_ROUND("h", "hi")} AS UBIGINT), 8) AS h FROM b),
e AS (SELECT event_id, (xor(h, h >> 16) * 2246822507) % {_M} AS h FROM c), f AS (SELECT event_id, (xor(h, h >> 13) * 3266489909) % {_M} AS h FROM e)
SELECT event_id, CAST((xor(h, h >> 16) % 2147483648) % 16 AS INTEGER) AS bucket FROM f""")
def transform_bucket(s, d):
    from .functions import partitions

    return events(s, d).select("event_id", partitions.transform("bucket", "event_id", 16).alias("bucket"))


# Feeds
@query(f"SELECT user_id, event_type, value FROM {TARGET} WHERE user_id NOT IN (SELECT user_id FROM {_APPLIED}) UNION ALL SELECT user_id, event_type, value FROM {LAST(_APPLIED, 'lsn DESC, seq DESC')} WHERE _deleted IS NOT TRUE")
def cdc_catch_up(s, d):
    """A snapshot and two passes over the log, each a unit whose state is where it ended."""
    out = SnapshotDestination(s, new_folder(s, "q"), "p")
    log, commits = change_log(s, d)
    t = Table("t", "merge", ("user_id",), TableOptions(strategy="upsert", hard_delete="_deleted"))
    out.commit([Table("t", "append")], {"t": target(s, d).select("user_id", "event_type", "value")}, "snapshot", 0, "n", state={"lsn": -1})
    for seq, until in enumerate((20, commits.agg(F.max("lsn")).first()[0])):
        catch_up(s, log, commits, ["user_id"], out.state()["lsn"], until, out, t, "l", seq)
    return out.read("t")


@query(f"SELECT user_id, event_type, value FROM {TARGET} WHERE user_id NOT IN (SELECT user_id FROM {_APPLIED}) UNION ALL SELECT user_id, event_type, value FROM {LAST(_APPLIED, 'lsn DESC, seq DESC')} WHERE _deleted IS NOT TRUE")
def cdc_handover(s, d):
    """A snapshot that has seen some of the changes already, and the feed from before it."""
    from .operators import merge

    snapshot = target(s, d).select("user_id", "event_type", "value")
    rows = changes.handover(snapshot, applied(s, d)).withColumn("_arrival", F.struct("lsn", "seq")).drop("lsn", "seq")
    return merge.upsert(snapshot.limit(0), rows, merge.MergeSpec(("user_id",), "_arrival", hard_delete="_deleted"))


@query("SELECT stream, cursor, (SELECT max(event_id // 10) - 1 FROM events) - cursor AS behind FROM (SELECT user_id % 4 AS stream, max(event_id // 10) - user_id % 4 - 1 AS cursor FROM events GROUP BY user_id % 4)")
def cdc_lag(s, d):
    _, commits = change_log(s, d)
    cursors = events(s, d).groupBy((F.col("user_id") % 4).alias("stream")).agg((F.max(F.expr("event_id div 10")) - F.first(F.col("user_id") % 4) - 1).alias("cursor"))
    return changes.lag_report(cursors, commits).select("stream", "cursor", "behind")


@query("SELECT event_id // 10 AS lsn, event_id % 10 * 2 AS seq, user_id, event_type, value, CAST(NULL AS BOOLEAN) AS _deleted FROM events")
def cdc_unchanged_values(s, d):
    """Changes that leave values out take them from the row as it was."""
    row = lambda kind: f"named_struct('user_id', user_id, 'event_type', {kind}, 'value', value)"
    log = events(s, d).selectExpr("event_id div 10 AS lsn", "event_id % 10 AS seq", "'U' AS op", f"{row('event_type')} AS before", f"{row('IF(event_id % 3 = 0, CAST(NULL AS STRING), event_type)')} AS after", "IF(event_id % 3 = 0, array('event_type'), array()) AS kept")
    return changes.apply_changes(log, ["user_id"], unchanged=F.col("kept"))


@query("SELECT * FROM (VALUES ('nothing is lost', CAST(NULL AS VARCHAR)), ('lost', 't: the feed is gone; changes after 10 are lost, so take a new snapshot'), ('anew', 't: the feed was made anew at 11, after 10; take a new snapshot'), ('a gap', 't: changes from 11 to 19 are gone; take a new snapshot'), ('held', 't: the feed is read by other'), ('no key', 't has no primary key: tell rows by a unique index, or by all columns'), ('another key', 't: rows are told by event_id, but the declared key is user_id')) t(state, why)")
def cdc_feed_checks(s, d):
    columns = events(s, d).columns
    cases = {
        "nothing is lost": lambda: changes.check_feed("t", 10, 11), "lost": lambda: changes.check_feed("t", 10, None), "anew": lambda: changes.check_feed("t", 10, 5, 11),
        "a gap": lambda: changes.check_feed("t", 10, 20), "held": lambda: changes.check_feed("t", 10, 5, holder="other"), "no key": lambda: changes.identity("t", columns, ["event_id"]),
        "another key": lambda: changes.identity("t", columns, ["user_id"], ["event_id"]),
    }
    found = []
    for name, case in cases.items():
        try:
            case()
            found.append((name, None))
        except changes.FeedError as e:
            found.append((name, str(e)))
    return only(s, found, "state string, why string")


@query(f"SELECT {E} FROM {LAST('events')}")
def stream_publish(s, d):
    """A stream of files, merged batch by batch; a second run of the stream finds nothing new."""
    folder, check = new_folder(s, "q"), new_folder(s, "q")
    in_files(events(s, d).withColumn("n", F.col("event_id")), folder, "parquet")
    t = Table("t", "merge", ("user_id",), TableOptions(strategy="upsert", dedup_sort=("event_id", "desc")))
    out = SnapshotDestination(s, new_folder(s, "q"), "p", buckets=2)
    schema = s.read.parquet(folder).schema
    rows = s.readStream.schema(schema).parquet(folder)
    for _ in range(2):
        publish_stream(rows, out, t, check, "n", "l").awaitTermination()
    return out.read("t")


# Nested records
@query("SELECT o_orderkey, sha256('{\"o_orderkey\":' || o_orderkey || '}') AS _sys_id FROM orders")
def row_ids(s, d):
    rows = table(s, d, "orders").select("o_orderkey", "o_custkey")
    return shred.shred(rows, "t", ["o_orderkey"])["t"].select("o_orderkey", "_sys_id")


@query('SELECT event_id, user_id AS the_user, event_type AS "kind_of_event__" FROM events')
def normal_names(s, d):
    return shred.normal_names(events(s, d).select("event_id", F.col("user_id").alias("The User"), F.col("event_type").alias("Kind-of.event()")))


_CONNECTIONS = {
    "host=h dbname=d user=u password=x": ("jdbc:postgresql://h:5432/d", "prefer", None), "postgresql://u:x@h:6000/d?sslmode=verify-full": ("jdbc:postgresql://h:6000/d", "verify-full", None),
    "host=h dbname=d sslmode=disable sslrootcert=c": (None, None, "sslrootcert conflicts with sslmode disable"), "host=h dbname=d tty=1": (None, None, "connection parameter tty is not supported"),
}


@query("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in (k, *vs)) + ")" for k, vs in _CONNECTIONS.items()) + ") t(text, url, tls, why)")
def connection_strings(s, d):
    found = []
    for text in _CONNECTIONS:
        try:
            db = database.parse_connection(text)
            found.append((text, db.url, db.properties["sslmode"], None))
        except database.DatabaseError as e:
            found.append((text, None, None, str(e).replace("isn't", "is not")))
    return only(s, found, "text string, url string, tls string, why string")


# A database, embedded
def derby(s) -> database.Database:
    """In a folder of the driver's own, as it can be larger than the driver's memory."""
    folder = tempfile.mkdtemp(prefix="tidemark-db-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return database.Database(f"jdbc:derby:{os.path.realpath(folder)}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver", "user": "APP"})


def stored(s, d) -> tuple[database.Database, DatabaseDestination]:
    db = derby(s)
    out = DatabaseDestination(s, db, "APP", "p")
    out.commit(Table("events", "append"), events(s, d).withColumn("n", F.col("event_id")), "l", 0, "n", {"at": 1})
    return db, out


@query("SELECT event_id, event_type FROM events WHERE event_id >= 100 AND event_id < 700")
def database_scan(s, d):
    db, _ = stored(s, d)
    w = incremental.Window("event_id", "max", 100, True, 700)
    return database.scan(s, db, "APP", "events", include=["event_id", "event_type"], within=w, split="event_id", tasks=4)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def database_query(s, d):
    db, _ = stored(s, d)
    return database.query_rows(s, db, 'SELECT "user_id", COUNT(*) AS "n" FROM APP."events" GROUP BY "user_id"')


@query("SELECT user_id, event_id FROM events WHERE user_id > 5 OR (user_id = 5 AND event_id > 100) ORDER BY user_id, event_id LIMIT 40")
def database_page(s, d):
    db, _ = stored(s, d)
    rows = database.scan(s, db, "APP", "events", include=["user_id", "event_id"])
    return database.scan_page(rows, "user_id", "event_id", 40, 5, 100)


@query("SELECT * FROM (VALUES ('events', 1, 'event_id'), ('events', 2, 'ts'), ('events', 3, 'user_id'), ('events', 4, 'event_type'), ('events', 5, 'value')) t(name, place, col)")
def database_discovery(s, d):
    db, _ = stored(s, d)
    found = database.discover(s, db, "APP", ["events"])
    return only(s, [(t.name, k, c[0]) for t in found for k, c in enumerate(t.columns, 1)], "name string, place int, col string")


@query(f"{UNTOUCHED} UNION ALL SELECT {E} FROM {LAST(STAGE)} WHERE event_type <> 'click'")
def database_merge(s, d):
    """Rows merged within the database, in a transaction that fails once on its way and is done again."""
    db = derby(s)
    stops = ["inserted"]

    def fail(point):
        if point in stops:
            stops.remove(point)
            raise RuntimeError(point)

    out = DatabaseDestination(s, db, "APP", "p", fail)
    t = Table("events", "merge", ("user_id",), TableOptions(strategy="upsert", hard_delete="gone"))
    rows = lambda df: df.withColumn("n", F.col("event_id"))
    for seq, df in enumerate((target(s, d).withColumn("gone", F.lit(False)), stage(s, d).withColumn("gone", F.col("event_type") == "click"))):
        for _ in range(2):
            try:
                out.commit(t, rows(df), "l", seq, "n")
            except RuntimeError:
                pass
    return out.read("events").select(*[c.strip() for c in E.split(",")])


# HTTP
PAGE = 500
#: Bytes of records that go to the driver at once.
AT_ONCE = 32 << 20


class Served:
    """Records as JSON in the order of a key, in files of the driver's own: what a page takes is found by its place."""

    def __init__(self, s, rows: DataFrame, key: str, record):
        folder = new_folder(s, "served")
        placed = rows.orderBy(key).select(F.monotonically_increasing_id().alias("at"), F.coalesce(key, F.lit(self.NONE)).alias("key"), F.concat(record, F.lit(",")).alias("record"))
        placed.write.parquet(folder)
        placed = s.read.schema("at long, key long, record string").parquet(folder)
        parts = [tempfile.TemporaryFile() for _ in range(3)]
        done = 0
        for some in self.pieces(placed):
            if (np.diff(at := some["at"].to_numpy()) < 0).any():  # files are read in any order
                some = some.take(np.argsort(at))
            for batch in some.to_batches():
                text = batch["record"].cast("large_binary")
                ends = np.frombuffer(text.buffers()[1], "i8")[text.offset : text.offset + len(text) + 1]
                for part, data in zip(parts, (batch["key"].to_numpy(), ends[1:] - ends[0] + done, text.buffers()[2][ends[0] : ends[-1]]), strict=True):
                    part.write(data)
                done += int(ends[-1] - ends[0])
        drop(s, folder)
        for part in parts:
            part.flush()
        self.keys, self.ends, self.text = (np.asarray(np.memmap(part, kind, "r")) if done else np.zeros(0, kind) for part, kind in zip(parts, ("i8", "i8", "u1"), strict=True))

    @staticmethod
    def pieces(placed: DataFrame):
        """Stretches of rows as Arrow tables, one after the other by their places; the next is read while one is worked on."""
        blocks = placed.groupBy(F.shiftright("at", 14)).agg(F.min("at"), F.max("at"), F.sum(F.octet_length("record"))).collect()
        spans, held = [], AT_ONCE
        for _, lo, hi, size in sorted(blocks):
            held += size
            if held > AT_ONCE:
                spans.append((lo, hi))
                held = size
            else:
                spans[-1] = (spans[-1][0], hi)
        with ThreadPoolExecutor(1) as reader:
            ready = None
            for span in [*spans, None]:
                now, ready = ready, span and reader.submit(placed.where(F.col("at").between(*span)).toArrow)
                if now:
                    yield now.result()

    #: Stands for a null key.
    NONE = -(2**63)

    def items(self, lo: int, hi: int) -> bytes:
        """A JSON array of the records from place lo up to hi."""
        at = [int(self.ends[k - 1]) if k else 0 for k in (lo, hi)]
        return b"[" + self.text[at[0] : at[1]].tobytes()[:-1] + b"]"


def serve(answer) -> str:
    """The address of a server whose bodies are answer(path, query)."""

    class Handler(StreamRequestHandler):
        wbufsize, timeout, disable_nagle_algorithm = -1, 60, True

        def handle(self):
            """A connection's requests, one after the other; the client may keep it as long as it asks within a minute."""
            try:
                while len(line := self.rfile.readline(1 << 16).split()) == 3:
                    while self.rfile.readline(1 << 16).strip():
                        pass
                    u = urlsplit(line[1].decode())
                    data = answer(u.path, {k: v[0] for k, v in parse_qs(u.query).items()})
                    self.wfile.write(b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(data))
                    self.wfile.write(data)
                    self.wfile.flush()
            except OSError:  # the client has gone, or is idle
                self.wfile = io.BytesIO()  # what it didn't take isn't sent

    server = ThreadingTCPServer(("127.0.0.1", 0), Handler)
    server.daemon_threads = True
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return f"http://127.0.0.1:{server.server_address[1]}"


def record(*columns: str):
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def api(s, d) -> tuple[str, rest.Pages]:
    """The address of a server of events in pages of 500, which lead on by a cursor, the place in the order of ids; its third
    page is under maintenance. And how to page through it, with the number of pages that it has as the bound."""
    rows = Served(s, events(s, d), "event_id", record("event_id", "user_id"))
    n = len(rows.keys)

    def answer(path: str, q: dict) -> bytes:
        lo = int(q["after"]) if "after" in q else int(np.searchsorted(rows.keys, int(q["since"]))) if "since" in q else 0
        hi = min(lo + PAGE, n)
        note = b', "note": "maintenance"' if q.get("broken") and lo == 2 * PAGE else b""
        return b'{"data": {"items": %b}, "next": %b%b}' % (rows.items(lo, hi), b"%d" % hi if hi < n else b"null", note)

    return serve(answer), rest.Pages("cursor", "after", path="next", max_pages=n // PAGE + 1)


def users_api(s, d) -> str:
    """The address of a server of users and, below each, of the user's events."""
    rows = Served(s, events(s, d), "user_id", record("event_id"))
    starts = [0, *(np.flatnonzero(rows.keys[1:] != rows.keys[:-1]) + 1).tolist()] if len(rows.keys) else []
    names = ["null" if k == Served.NONE else str(k) for k in rows.keys[starts]] if starts else []
    spans = dict(zip(names, zip(starts, [*starts[1:], len(rows.keys)], strict=True), strict=True))
    users = b'{"items": [%b]}' % b", ".join(b'{"id": %b}' % u.encode() for u in names)

    def answer(path: str, q: dict) -> bytes:
        return users if path == "/users" else b'{"items": %b}' % rows.items(*spans[path.split("/")[2]])

    return serve(answer)


def read_stream(s, stream: rest.Stream, schema: str) -> DataFrame:
    return rest.read_stream(s, stream, schema)


@query("SELECT event_id, user_id FROM events")
def rest_pages(s, d):
    base, pages = api(s, d)
    return read_stream(s, rest.Stream(base, "/events", records="data.items", pages=pages), "event_id long, user_id long")


@query("SELECT event_id, user_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events ORDER BY event_id LIMIT 500 OFFSET 1000)")
def rest_ignored_page(s, d):
    base, pages = api(s, d)
    stream = rest.Stream(base, "/events", params={"broken": "1"}, records="data.items", pages=pages, actions=[rest.Action("ignore", contains="maintenance")])
    return read_stream(s, stream, "event_id long, user_id long")


@query("SELECT event_id, user_id FROM events WHERE event_id >= 1200")
def rest_incremental(s, d):
    base, pages = api(s, d)
    stream = rest.Stream(base, "/events", records="data.items", pages=pages, start_param="since", start_value="1200", cursor_field="event_id")
    return read_stream(s, stream, "event_id long, user_id long")


@query("SELECT event_id, user_id AS _parent_id FROM events")
def rest_children(s, d):
    base = users_api(s, d)
    parents = read_stream(s, rest.Stream(base, "/users", records="items"), "id long")
    child = rest.Stream(base, "/users/{id}/events", records="items", include=["id"])
    return rest.read_children(parents, child, 4).select(F.from_json("value", "event_id long, _parent_id long").alias("r")).select("r.*")


@query("SELECT event_id, unnest([CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR)]) AS found FROM events")
def json_selector(s, d):
    """A selector of the HTTP source over bodies."""
    steps = rest.parse_selector("a[*].b[0]")

    def run(batches):
        for b in batches:
            found = [(i, str(x)) for i, v in zip(b["event_id"], b["body"], strict=True) for x in rest.select(json.loads(v), steps)[0]]
            yield type(b)(found, columns=["event_id", "found"])

    body = F.to_json(F.struct(F.array(*[F.struct(F.array(F.col(c).cast("long"), F.lit(0).cast("long")).alias("b")) for c in ("event_id", "user_id")]).alias("a")))
    return events(s, d).select("event_id", body.alias("body")).mapInPandas(run, "event_id long, found string")


@query("SELECT event_id, i AS pos, user_id + i AS k FROM events, (SELECT unnest([0, 1, 2]) AS i) WHERE i < event_id % 4")
def json_explode(s, d):
    """The records that a body holds; one without any gives none."""
    def run(batches):
        for b in batches:
            found = [(i, k, r["k"]) for i, v in zip(b["event_id"], b["body"], strict=True) for k, r in enumerate(rest.records_of(json.loads(v), "data.items"))]
            yield type(b)(found, columns=["event_id", "pos", "k"])

    items = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((F.col("user_id") + i).alias("k")))
    items = F.slice(items, F.lit(1), F.least(F.col("event_id") % 4, F.lit(3)).cast("int"))
    body = F.to_json(F.struct(F.struct(items.alias("items")).alias("data")))
    return events(s, d).select("event_id", body.alias("body")).mapInPandas(run, "event_id long, pos int, k long")


@query("SELECT user_id, max(CAST(event_id AS VARCHAR)) AS watermark FROM events GROUP BY user_id")
def rest_cursor_max(s, d):
    """The greatest cursor, as text, of each stream's records, taken page by page as the HTTP source takes it."""
    def run(key, rows):
        top = None
        for lo in range(0, len(rows), 7):
            top = rest.greatest(rows["r"].iloc[lo : lo + 7].map(json.loads).tolist(), "event_id", top)
        return type(rows)([(key[0], top)], columns=["user_id", "watermark"])

    return events(s, d).select("user_id", F.to_json(F.struct("event_id")).alias("r")).groupBy("user_id").applyInPandas(run, "user_id long, watermark string")


# Whole pipelines
def document(s, folder: str, mode, kind: str, more: dict | None = None, **stream) -> dict:
    target = {"kind": kind, "path": new_folder(s, "q")}
    return {"pipeline": "p", "write_mode": mode, "source": {"kind": "files", "streams": [{"name": "t", "path": f"{folder}/*.parquet", **stream}]}, "destination": target, **(more or {})}


@query(f"SELECT {E} FROM {LAST('events')}")
def pipeline_merge(s, d):
    """A document run over files twice: some files come between the runs, and the second reads those only."""
    folder = new_folder(s, "q")
    doc = document(s, folder, {"merge": {"key": ["user_id"], "strategy": "upsert", "dedup_sort": ["event_id", "desc"]}}, "snapshots")
    late = F.col("event_id") > F.lit(events(s, d).agg(F.expr("percentile(event_id, 0.5)")).first()[0])
    for part in (~late, late):
        in_files(events(s, d).filter(part), folder, "parquet")
        pipeline.run(s, doc)
    return SnapshotDestination(s, doc["destination"]["path"], "p").read("t")


@query(f"SELECT {FILES} AS units, 0 AS again, count(*) AS n FROM events")
def pipeline_commit_policy(s, d):
    """A unit for each file; a run after it has nothing but an empty unit."""
    folder = new_folder(s, "q")
    for k in range(FILES):
        events(s, d).filter(F.pmod("event_id", F.lit(FILES)) == k).coalesce(1).write.mode("append").parquet(folder)
    doc = document(s, folder, "append", "files", {"commit_policy": {"every_checkpoints": 1}})
    first, second = pipeline.run(s, doc), pipeline.run(s, doc)
    out = FileDestination(s, doc["destination"]["path"], "p")
    rows = out.count_rows("t")
    return only(s, [(first["streams"]["t"]["units"], second["streams"]["t"]["already"], rows)], "units int, again int, n long")


@query("SELECT event_id FROM events")
def pipeline_replace(s, d):
    """A mirror: run twice, it holds every row once, read anew though all files are known."""
    folder = new_folder(s, "q")
    in_files(events(s, d).select("event_id"), folder, "parquet")
    doc = document(s, folder, "replace", "files")
    for _ in range(2):
        pipeline.run(s, doc)
    return FileDestination(s, doc["destination"]["path"], "p").read("t")


_BAD = [
    ("the document has no field mode; known: pipeline, write_mode, source, destination, workdir, commit_policy, batch_policy", {"mode": 1}),
    ("two streams go to table t", {"source": {"kind": "files", "streams": [{"name": "t"}, {"name": "T"}]}}),
    ("a destination of kind files can't merge", {"write_mode": {"merge": {"key": ["a"]}}}),
    ("write_mode is append, replace, or merge with a key", {"write_mode": "upsert"}),
    ("commit_policy: a commit policy names a threshold: without one nothing would be committed until the end", {"commit_policy": {}}),
]


@query("SELECT * FROM (VALUES " + ", ".join("('" + why.replace("'", "''") + "')" for why, _ in _BAD) + ") t(why)")
def documents_refused(s, d):
    found = []
    for _, more in _BAD:
        try:
            pipeline.parse({**document(s, "x", "append", "files"), **more})
        except pipeline.DocumentError as e:
            found.append((str(e),))
    return only(s, found, "why string")


@query("SELECT write, CAST(sum(n) AS BIGINT) AS n FROM (SELECT k // 3 AS write, count(*) AS n FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS k FROM events) GROUP BY k) GROUP BY write")
def batch_policy_writes(s, d):
    """Writes of 250 rows at least, out of batches of 100 that aren't split."""
    n = events(s, d).count()
    batches = [(min(100, n - lo), 1) for lo in range(0, n, 100)]
    writes = pipeline.BatchPolicy(every_rows=250).writes(batches)
    return only(s, [(k, sum(b[0] for b in batches[lo:hi])) for k, (lo, hi) in enumerate(writes)], "write long, n long")

