"""Files, part-file and snapshot destinations, change logs, streams and HTTP sources."""

import gzip
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.partitions import encode_partition, encode_value, murmur3
from tidemark.functions.types import align, apply_hints, evolve, hinted, is_widening, survey
from tidemark.operators import changes, incremental, shred
from tidemark.plans.commit import Table
from tidemark.plans.options import TableOptions
from tidemark.sinks.files import FileDestination
from tidemark.sinks.snapshots import SnapshotDestination
from tidemark.sources import files, rest
from tidemark.sources.query import select_columns
from tidemark.streaming.publish import catch_up, publish_stream


def test_partition_values(spark):
    values = [None, "", "eu", "us/east", "..", ".x", "_x", "a_b.c", "con", "Aux.txt", "é", "a b", "%", "100%"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(encode_partition(F.col("v"))).collect()]
    assert got == [encode_value(v) for v in values] and len(set(got)) == len(values)
    assert got[3] == "us%2Feast" and not any(g in ("..", ".") or "/" in g for g in got)
    assert murmur3(b"") == 0 and murmur3((34).to_bytes(8, "little")) == 2017239379 and murmur3(b"iceberg") == 1210000089


class Stop(Exception):
    pass


@pytest.mark.parametrize("point", ["clear", "manifest", "part", "state", "receipt"])
def test_part_files_after_a_stop(spark, tmp_path, point):
    df = spark.createDataFrame([(1, "eu"), (2, None), (3, "us/east"), (4, "eu")], "id long, region string")
    plain = FileDestination(spark, f"file://{tmp_path}", "p", partition_by="region")
    assert plain.write("t", df.limit(2), "l0", 0)

    def fail(at):
        if at == point:
            raise Stop

    broken = FileDestination(spark, f"file://{tmp_path}", "p", partition_by="region", fail_at=fail)
    with pytest.raises(Stop):
        broken.write("t", df, "l1", 0, "replace", {"at": 7})
    assert plain.write("t", df, "l1", 0, "replace", {"at": 7})
    assert not plain.write("t", df, "l1", 0, "replace", {"at": 7})
    assert plain.count_rows("t") == 4 and plain.state() == {"at": 7}
    assert sorted(plain.owned("t")) == [f"t/{p}/part-l1-0-0.parquet" for p in ("__null__", "eu", "us%2Feast")]
    assert plain.write("t", df.limit(0), "l1", 1, "replace") and plain.count_rows("t") == 4  # cleared once a load


def test_foreign_files_stay(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "notes.txt").write_text("mine")
    out = FileDestination(spark, f"file://{tmp_path}", "p")
    out.write("t", spark.range(3), "l", 0, "replace")
    assert (tmp_path / "t" / "notes.txt").exists() and out.read("t").count() == 3
    with pytest.raises(ValueError, match="merged"):
        out.write("t", spark.range(3), "l", 1, "merge")


def test_snapshots_and_stream(spark, tmp_path):
    t = Table("t", "merge", ("id",), TableOptions(strategy="upsert"))
    stops = {"head"}

    def fail(at):
        if at in stops:
            stops.clear()
            raise Stop

    out = SnapshotDestination(spark, f"file://{tmp_path}/out", "p", fail)
    stage = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "id long, name string, n int")
    with pytest.raises(Stop):
        out.commit([t], {"t": stage}, "l", 0, "n")
    assert out.read("t") is None
    assert out.commit([t], {"t": stage}, "l", 0, "n") and not out.commit([t], {"t": stage}, "l", 0, "n")
    assert sorted(map(tuple, out.read("t").collect())) == [(1, "c"), (2, "b")]
    folder = tmp_path / "in"
    spark.createDataFrame([(2, "z", 5), (3, "y", 6)], "id long, name string, n int").write.parquet(f"file://{folder}")
    for _ in range(2):  # the second run finds nothing new
        publish_stream(spark.readStream.schema(stage.schema).parquet(f"file://{folder}"), out, t, f"file://{tmp_path}/check", "n", "s").awaitTermination()
    assert sorted(map(tuple, out.read("t").collect())) == [(1, "c"), (2, "z"), (3, "y")]


ROW = "struct<id: long, total: int, note: string>"


def test_change_log(spark, tmp_path):
    log = [(1, 0, "I", None, (4, 1, "d")), (1, 1, "U", (1, 10, "a"), (1, 11, "a")), (1, 2, "D", (2, 20, "b"), None), (2, 0, "U", (3, 30, "c"), (33, 30, "c")), (3, 0, "I", None, (99, 9, "x")), (3, 1, "D", (99, 9, "x"), None), (4, 0, "U", (1, 11, "a"), (1, 12, "a")), (5, 0, "I", None, (7, 7, "open"))]
    df = spark.createDataFrame(log, f"txn int, seq int, op string, before {ROW}, after {ROW}")
    commits = spark.createDataFrame([(i, i * 10) for i in range(1, 5)], "txn int, lsn int")
    out = SnapshotDestination(spark, f"file://{tmp_path}", "p")
    t = Table("t", "merge", ("id",), TableOptions(strategy="upsert", hard_delete="_deleted"))
    snapshot = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], "id long, total int, note string")
    out.commit([Table("t", "append")], {"t": snapshot.withColumn("n", F.lit(0)).drop("n")}, "snap", 0, "n")
    catch_up(spark, df, commits, ["id"], 0, 20, out, t, "l", 0)
    catch_up(spark, df, commits, ["id"], out.head()["state"]["lsn"], 40, out, t, "l", 1)
    assert sorted(map(tuple, out.read("t").collect())) == [(1, 12, "a"), (4, 1, "d"), (33, 30, "c")]
    bad = spark.createDataFrame([(1, 0, "T", None, None)], f"txn int, seq int, op string, before {ROW}, after {ROW}")
    with pytest.raises(Exception, match="can't be applied"):
        changes.apply_changes(changes.committed(bad, commits), ["id"]).collect()


def test_resume(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-02")], "id long, ts string")
    w = incremental.Window("ts")
    state = incremental.advance(df, "ts", ["id"], folder=f"file://{tmp_path}/a")
    more = df.unionByName(spark.createDataFrame([(4, "2026-01-02"), (5, "2026-01-03")], df.schema))
    new = incremental.resume(more, w, state, ["id"])
    assert sorted(r.id for r in new.collect()) == [4, 5]
    state = incremental.advance(new, "ts", ["id"], state, folder=f"file://{tmp_path}/b")
    assert incremental.resume(more, w, state, ["id"]).count() == 0
    assert incremental.advance(df, "ts", ["id"], state).watermark == "2026-01-03"  # never back
    open_end = incremental.advance(df, "ts", ["id"])
    assert open_end.keys is None and [r.id for r in incremental.resume(more, w, open_end, ["id"]).collect()] == [5]
    lagged = incremental.window(df.selectExpr("cast(ts AS timestamp) AS ts"), incremental.Window("ts", lower="2026-01-02 06:00:00", lag="6 hours"))
    assert lagged.count() == 2
    with pytest.raises(ValueError, match="isn't a span"):
        incremental.span("2 days; DROP TABLE x")
    with pytest.raises(ValueError, match="can't be a cursor"):
        incremental.window(spark.range(1).selectExpr("id > 0 AS b"), incremental.Window("b"))
    with pytest.raises(Exception, match="null in cursor"):
        incremental.window(spark.createDataFrame([(None,)], "n long"), incremental.Window("n", nulls="error")).collect()


def test_files(spark, tmp_path):
    plain, schema = tmp_path / "a.jsonl", T.StructType([T.StructField("id", T.LongType())])
    plain.write_text('{"id":1}\n\n{"id":2}\n')
    df, settle = files.read_jsonl(spark, [str(plain)], schema)
    assert df.count() == 2
    state = settle()
    with plain.open("a") as f:
        f.write('{"id":3}\n')
    df, settle = files.read_jsonl(spark, [str(plain)], schema, state)
    assert [r.id for r in df.collect()] == [3]
    state = settle()
    assert files.read_jsonl(spark, [str(plain)], schema, state)[0].count() == 0
    plain.write_text('{"id":9}\n\n{"id":2}\n{"id":3}\n')
    with pytest.raises(files.SourceError, match="rewritten"):
        files.read_jsonl(spark, [str(plain)], schema, state)
    plain.write_text('{"id":1}\n')
    with pytest.raises(files.SourceError, match="shrank"):
        files.read_jsonl(spark, [str(plain)], schema, state)
    plain.write_text('{"id":7}\n\n{"id":2}\n{"id":3}\n{"id":4}\n')
    with pytest.raises(files.SourceError, match="bytes before"):
        files.read_jsonl(spark, [str(plain)], schema, state)
    (tmp_path / "b.jsonl.gz").write_bytes(b'{"id":1}\n')
    with pytest.raises(files.SourceError, match="named .gz"):
        files.read_jsonl(spark, [str(tmp_path / "b.jsonl.gz")], schema)
    with pytest.raises(files.SourceError, match="newer version"):
        files.read_jsonl(spark, [str(plain)], schema, {"version": 99, "files": {}})


def test_listing(spark, tmp_path):
    for name in ("a1.x", "a2.x", ".a3.x", "b[1].x", "d/a4.x", "d/.e/a5.x"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1")
    found = lambda p: [x.removeprefix(f"{tmp_path}/") for x in files.list_files(spark, f"{tmp_path}/{p}")]
    assert found("a*.x") == ["a1.x", "a2.x"] and found("**/a*.x") == ["a1.x", "a2.x", "d/a4.x"]
    assert found("b[1].x") == ["b[1].x"] and found("none*") == []
    assert files.list_files(spark, f"file://{tmp_path}/a?.x") == [f"file://{tmp_path}/a{k}.x" for k in (1, 2)]
    for name, why in (("none", "missing"), ("d", "folder")):
        with pytest.raises(files.SourceError, match=why):
            found(name)


def test_unterminated_line(spark, tmp_path):
    """The last line is read without its end; growth after it is refused, as a row would be lost or read in part."""
    path, schema = tmp_path / "a.jsonl", T.StructType([T.StructField("a", T.LongType())])
    path.write_text('{"a":1}\n{"a":2}')
    df, settle = files.read_jsonl(spark, [str(path)], schema)
    assert sorted(r.a for r in df.collect()) == [1, 2]
    state = settle()
    assert files.read_jsonl(spark, [str(path)], schema, state)[0].count() == 0
    with path.open("a") as f:
        f.write('{"a":3}\n{"a":4}\n')
    with pytest.raises(files.SourceError, match="wasn't ended"):
        files.read_jsonl(spark, [str(path)], schema, state)


def test_growth_while_reading(spark, tmp_path):
    path, schema = tmp_path / "a.jsonl", T.StructType([T.StructField("a", T.LongType())])
    path.write_text('{"a":1}\n{"a":2}\n')
    df, settle = files.read_jsonl(spark, [str(path)], schema)
    with path.open("a") as f:
        f.write('{"a":3}\n')
    with pytest.raises(files.SourceError, match="while it was read"):  # what Spark's reader saw isn't known
        settle()
    df, settle = files.read_jsonl(spark, [str(path)], schema, growing=True)
    with path.open("a") as f:
        f.write('{"a":4}\n{"a":5')
    assert sorted(r.a for r in df.collect()) == [1, 2, 3]
    state = settle()
    with path.open("a") as f:
        f.write("}\n")
    df, settle = files.read_jsonl(spark, [str(path)], schema, state)
    with path.open("a") as f:
        f.write('{"a":6}\n')
    assert sorted(r.a for r in df.collect()) == [4, 5]
    df, _ = files.read_jsonl(spark, [str(path)], schema, settle())
    assert [r.a for r in df.collect()] == [6]


def test_malformed_lines_name_their_place(spark, tmp_path):
    path, schema = tmp_path / "a.jsonl", T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    path.write_text('{"a":1}\n{"a":\n')
    for growing, where in ((False, "a.jsonl"), (True, "at byte 8")):
        df, _ = files.read_jsonl(spark, [str(path)], schema, growing=growing)
        with pytest.raises(Exception, match=f"malformed line in .*{where}"):
            df.select("b").collect()


def test_parquet_row_groups(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = str(tmp_path / "a.parquet")

    def write(*groups):
        with pq.ParquetWriter(path, pa.schema([("a", pa.int64())])) as w:
            for g in groups:
                w.write_table(pa.table({"a": g}))

    write([1, 2], [3])
    df, settle = files.read_parquet(spark, [path])
    assert sorted(r.a for r in df.collect()) == [1, 2, 3]
    state = settle()
    assert files.read_parquet(spark, [path], state)[0].count() == 0
    write([1, 2], [3], [4, 5])
    df, settle = files.read_parquet(spark, [path], state)
    assert sorted(r.a for r in df.collect()) == [4, 5]
    state = settle()
    write([1, 2, 3], [3], [4, 5], [6])
    with pytest.raises(files.SourceError, match="row groups changed"):
        files.read_parquet(spark, [path], state)
    with pytest.raises(files.SourceError, match="own types"):
        files.read_parquet(spark, [path], hints={"a": "utf8"})
    none, _ = files.read_parquet(spark, [], schema=T.StructType([T.StructField("a", T.LongType())]))
    assert none.columns == ["a"] and none.count() == 0


def test_csv(spark, tmp_path):
    path = tmp_path / "o.csv.gz"
    path.write_bytes(gzip.compress(b'id;amount;flag;note;when\n1;2;true;"a; b";2024-01-01\n2;2.5;false;;2024-01-02\n'))
    df, _ = files.read_csv(spark, [str(path)], delimiter=";", hints={"when": "date"})
    assert dict(df.dtypes) == {"id": "bigint", "amount": "double", "flag": "boolean", "note": "string", "when": "date"}
    assert [r.note for r in df.orderBy("id").collect()] == ["a; b", None]
    (tmp_path / "twice.csv").write_text("a,a\n1,2\n")
    with pytest.raises(files.SourceError, match="twice"):
        files.read_csv(spark, [str(tmp_path / "twice.csv")])
    (tmp_path / "ragged.csv").write_text("a,b\n1\n")
    with pytest.raises(Exception):
        files.read_csv(spark, [str(tmp_path / "ragged.csv")])[0].collect()
    (tmp_path / "other.csv").write_text("a,c\n1,2\n")
    with pytest.raises(files.SourceError, match="its columns are"):
        files.read_csv(spark, [str(tmp_path / "ragged.csv"), str(tmp_path / "other.csv")])
    with pytest.raises(Exception, match="path|o.csv.gz, column note: a; b isn't int64"):
        files.read_csv(spark, [str(path)], delimiter=";", hints={"note": "int64"})[0].collect()
    assert files.read_csv(spark, [], columns=["a", "b"])[0].columns == ["a", "b"]


def test_hints(spark):
    good = {"uuid": "6F9619FF-8B86-D011-B42D-00C04FC964FF", "json": '{"a":1}', "time": "12:30:01.5", "binary": "00ff", "int64": "+7", "float64": "1e3", "bool": "true", "decimal(5,2)": "12.30", "date": "2024-01-31"}
    want = {"uuid": "6f9619ff-8b86-d011-b42d-00c04fc964ff", "time": (12 * 60 + 30) * 60_000_000 + 1_500_000, "binary": b"\x00\xff", "int64": 7, "float64": 1000.0, "bool": True}
    bad = {"uuid": "6F96", "json": "{", "time": "25:00", "binary": "0", "int64": "1.5", "float64": "nan", "bool": "1", "decimal(5,2)": "12.345", "date": "2024-02-31"}
    for hint, text in good.items():
        df = spark.createDataFrame([(text,), (None,)], "v string").select(hinted(F.col("v"), hint).alias("v"))
        got = [r.v for r in df.collect()]
        assert got[1] is None and (hint not in want or got[0] == want[hint]), hint
        with pytest.raises(Exception, match="isn't"):
            spark.createDataFrame([(bad[hint],)], "v string").select(hinted(F.col("v"), hint).alias("v")).collect()


def test_types(spark):
    cells = spark.createDataFrame([("1", "1", "true", "TRUE", None), ("2", "x", "false", "1", ""), ("2.5", "", "true", "2", None)], "a string, b string, c string, d string, e string")
    assert survey(cells).first().asDict() == {"a": "float", "b": "text", "c": "bool", "d": "text", "e": "text"}
    text = spark.createDataFrame([("1.234",)], "x string")
    with pytest.raises(Exception, match="not a decimal"):
        apply_hints(text, {"x": "decimal(10,2)"}).collect()
    assert str(apply_hints(text, {"x": "decimal(10,3)"}).first().x) == "1.234"
    with pytest.raises(ValueError, match="can't be hinted"):
        apply_hints(spark.range(1), {"id": "bool"})
    dec = T.DecimalType
    assert is_widening(T.LongType(), dec(21, 2)) and not is_widening(T.LongType(), dec(20, 2)) and not is_widening(T.LongType(), T.DoubleType())
    assert not is_widening(T.BinaryType(), T.StringType()) and is_widening(dec(10, 2), dec(12, 3)) and not is_widening(dec(10, 2), dec(10, 3))
    live = T.StructType([T.StructField("id", T.LongType(), False)])
    grown = evolve(live, T.StructType([T.StructField("id", T.LongType(), False), T.StructField("x", T.DoubleType(), False)]))
    assert grown["x"].nullable and align(spark.range(1), grown).columns == ["id", "x"]
    with pytest.raises(ValueError, match="missing"):
        align(spark.createDataFrame([(1.0,)], "x double"), grown)
    with pytest.raises(ValueError, match="no column"):
        select_columns(spark.range(1), include=["x"])


def test_shred(spark):
    docs = ['{"id":1,"name":"lin","home":{"city":"Warsaw"},"tags":[{"tag":"alpha"},{"tag":"beta"}]}', '{"id":2,"name":"mo","home":{"city":"Oslo"},"tags":[]}']
    schema = "id long, name string, home struct<city: string>, tags array<struct<tag: string>>"
    out = shred.shred(spark.createDataFrame([(d,) for d in docs], "v string").select(F.from_json("v", schema).alias("r")).select("r.*"), "users", ["id"])
    assert out["users"].count() == 2 and out["users"].filter("id = 1").first()["home__city"] == "Warsaw"
    first = out["users__tags"].join(out["users"].selectExpr("_sys_id AS _sys_root_id", "id"), "_sys_root_id").orderBy("_sys_pos").first()
    assert out["users__tags"].count() == 2 and (first.tag, first.id) == ("alpha", 1)
    with pytest.raises(ValueError, match="share the name"):
        shred.normal_names(spark.range(1).selectExpr("id AS `a b`", "id AS a_b"))


class Api(BaseHTTPRequestHandler):
    tries = 0

    def log_message(self, *a):
        pass

    def do_GET(self):
        url, heads, status = urlsplit(self.path), {}, 200
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        page = int(q.get("page", 1))
        if url.path == "/repos":
            body = [{"owner": "o", "name": "one", "stars": 1}, {"owner": "o", "name": "a/b", "stars": 2}] if page == 1 else []
        elif url.path.startswith("/repos/"):
            body = {"items": [{"id": 11}, {"id": 12}] if "one" in url.path else [{"id": 21}]}
        elif url.path == "/cursor":
            c = q.get("after")
            body = {"items": [{"n": c or "0"}], "next": {None: "1", "1": "2", "2": None}[c]}
        elif url.path == "/link":
            body, heads = [{"n": page}], {"Link": f'<http://{self.headers["Host"]}/link?page={page + 1}>; rel="next"'} if page < 3 else {}
        elif url.path == "/away":
            body = {"items": [], "next": "http://elsewhere.example/x"}
        elif url.path == "/loop":
            body = {"items": [{}], "next": "1"}
        elif url.path == "/flaky":
            Api.tries += 1
            status, body, heads = (429, [], {"Retry-After": "0"}) if Api.tries == 1 else (503, [], {}) if Api.tries == 2 else (200, [{"ok": 1}], {})
        else:
            status, body = 404, []
        data = json.dumps(body).encode()
        self.send_response(status)
        for k, v in {**heads, "Content-Length": str(len(data))}.items():
            self.send_header(k, v)
        self.end_headers()
        self.wfile.write(data)


@pytest.fixture(scope="module")
def api():
    server = HTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_rest(spark, api):
    repos = list(rest.read_pages(rest.Stream(api, "/repos", pages=rest.Pages("page"))))
    assert len(repos) == 2
    child = rest.Stream(api, "/repos/{owner}/{name}/issues", records="items", include=["name", "stars"])
    spark.dataSource.register(rest.rest_source(child, repos, "issues"))
    got = spark.read.format("issues").load().select(F.from_json("value", "id long, _parent_name string, _parent_stars int").alias("r")).select("r.*")
    assert sorted(map(tuple, got.collect())) == [(11, "one", 1), (12, "one", 1), (21, "a/b", 2)]
    get = lambda path, **k: list(rest.read_pages(rest.Stream(api, path, **k)))
    assert [r["n"] for r in get("/cursor", records="items", pages=rest.Pages("cursor", "after", path="next"))] == ["0", "1", "2"]
    assert [r["n"] for r in get("/link", pages=rest.Pages("link_header"))] == [1, 2, 3]
    assert get("/flaky") == [{"ok": 1}]
    for path, pages, why in (("/away", rest.Pages("next_url", path="next"), "another origin"), ("/loop", rest.Pages("cursor", "c", path="next"), "read before")):
        with pytest.raises(rest.RestError, match=why):
            get(path, records="items", pages=pages)
    with pytest.raises(rest.RestError, match="404"):
        get("/none")
    assert get("/none", actions=[rest.Action("ignore", status=404)]) == []
    assert "hush" not in repr(rest.Auth("bearer", secret="hush"))
    assert rest.greatest([{"c": 9}, {"c": "10"}], "c") == "9"


class Maintenance(BaseHTTPRequestHandler):
    """Three pages, each leading on by body and headers; the second is under maintenance, or at /text no JSON."""

    def log_message(self, *a):
        pass

    def do_GET(self):
        url = urlsplit(self.path)
        page = int(parse_qs(url.query).get("c", ["1"])[0])
        after = None if page == 3 else str(page + 1)
        body = {"data": [{"id": page}], "next": after, "url": after and f"{url.path}?c={after}", "note": "maintenance" if page == 2 else ""}
        data = b"maintenance" if url.path == "/text" and page == 2 else json.dumps(body).encode()
        self.send_response(200)
        for k, v in {"Content-Length": str(len(data)), **({"X-Next": after, "Link": f'<{url.path}?c={after}>; rel="next"'} if after else {})}.items():
            self.send_header(k, v)
        self.end_headers()
        self.wfile.write(data)


def test_rest_goes_on_after_an_ignored_page():
    server = HTTPServer(("127.0.0.1", 0), Maintenance)
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def get(at, do, *pages, **more):
        stream = rest.Stream(f"http://127.0.0.1:{server.server_port}", at, records="data", pages=rest.Pages(*pages, **more), actions=[rest.Action(do, contains="maintenance")])
        return [r["id"] for r in rest.read_pages(stream)]

    kinds = [(("cursor", "c"), {"path": "next"}), (("next_url",), {"path": "url"}), (("header_cursor", "c"), {"path": "X-Next"}), (("link_header",), {})]
    for pages, more in kinds:
        assert get("/items", "ignore", *pages, **more) == [1, 3]
        assert get("/items", "end_stream", *pages, **more) == [1]
        # Without a body that can be read, only headers lead on.
        assert get("/text", "ignore", *pages, **more) == ([1, 3] if "header" in pages[0] else [1])
    server.shutdown()


def test_selectors():
    assert rest.select({"a": [{"b": 1}, {"b": 2}]}, rest.parse_selector("a[*].b")) == ([1, 2], False)
    assert rest.select({"a": [{"b": 1}, {"b": 2}]}, rest.parse_selector("a[1].b")) == ([2], False)
    assert rest.records_of({"a": {"b": []}}, "a.b") == [] and rest.records_of({"a": []}, "a[*]") == []
    with pytest.raises(rest.RestError, match="leads to nothing"):
        rest.records_of({}, "a")
    for bad in ("", "a..b", "a[x]", "a["):
        with pytest.raises(ValueError):
            rest.parse_selector(bad)


def events_in(spark, tmp_path, rows):
    """A folder of tables with events (event_id, user_id) only."""
    df = spark.createDataFrame(rows, "event_id long, user_id long").selectExpr("event_id", "TIMESTAMP '2024-01-01' AS ts", "user_id", "'click' AS event_type", "1.0D AS value")
    df.write.parquet(f"file://{tmp_path}/events.parquet")
    return f"file://{tmp_path}"


def test_pages_are_found_by_place(spark, tmp_path, monkeypatch):
    import urllib.request

    from tidemark import catalog_io

    # Each id twice, so that a page of 500 ends within a pair; more pages than one bound for all would allow.
    d = events_in(spark, tmp_path, [(k // 2, None if k % 7 == 0 else k % 5) for k in range(1, 2602)])
    made, build = [], urllib.request.build_opener
    monkeypatch.setattr(urllib.request, "build_opener", lambda *a: made.append(a) or build(*a))
    base, pages = catalog_io.api(spark, d)
    read = lambda **k: list(rest.read_pages(rest.Stream(base, "/events", records="data.items", pages=pages, **k)))
    got = read()
    assert [r["event_id"] for r in got] == [k // 2 for k in range(1, 2602)] and sum(r["user_id"] is None for r in got) == 371
    assert len(made) <= 1 and pages.max_pages == 6
    batches = list(rest.RestReader(rest.Stream(base, "/events", records="data.items", pages=pages), None).read(rest._Parent(None)))
    assert [b.num_rows for b in batches] == [2601]


@pytest.fixture
def thrice(spark, tmp_path):
    """Events with each id three times, so that pages end within them."""
    return events_in(spark, tmp_path, [(k // 3, k % 5) for k in range(1, 5001)])


def test_an_ignored_page_among_repeated_ids(spark, thrice):
    from tidemark import catalog_io

    got = sorted(r.event_id for r in catalog_io.rest_ignored_page(spark, thrice).collect())
    assert got == [k // 3 for k in range(1, 5001) if not 1000 < k <= 1500]


def test_an_incremental_stream_of_repeated_ids(spark, thrice):
    from tidemark import catalog_io

    got = sorted(r.event_id for r in catalog_io.rest_incremental(spark, thrice).collect())
    assert got == [k // 3 for k in range(3600, 5001)]


def test_pages_of_repeated_ids(spark, thrice):
    from tidemark import catalog_io

    got = sorted(tuple(r) for r in catalog_io.rest_pages(spark, thrice).collect())
    assert got == sorted((k // 3, k % 5) for k in range(1, 5001))


def test_children_of_a_null_parent(spark, tmp_path, monkeypatch):
    from tidemark import catalog_io

    monkeypatch.setattr(rest, "BATCH", 7)
    rows = [(k, None if k % 3 == 0 else k % 20) for k in range(100)]
    got = catalog_io.rest_children(spark, events_in(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, got)) == rows and sorted({r._parent_id or -1 for r in got})[0] == -1


@pytest.fixture
def connections(monkeypatch):
    """Those that servers of this process have taken."""
    import socketserver

    taken, setup = [], socketserver.StreamRequestHandler.setup
    monkeypatch.setattr(socketserver.StreamRequestHandler, "setup", lambda self: taken.append(self) or setup(self))
    return taken


def test_children_of_a_task_share_a_connection(spark, tmp_path, connections):
    from tidemark import catalog_io

    rows = [(k, k % 50) for k in range(200)]
    got = catalog_io.rest_children(spark, events_in(spark, tmp_path, rows)).collect()
    assert sorted(map(tuple, got)) == rows and len(connections) <= 5  # of four tasks and of that which reads the parents


def test_records_encoded_together(monkeypatch):
    import random

    rows = [{"b": 1, "a": "}, {"}, {}, {"x": [{}, {"y": None}]}, {"é": 1.5}, [{}, {}], 7, None, "}, {", {"n": 2**70, "\x00": "\ud800"}]
    deal = random.Random(1)
    for n in (0, 1, 2, 3, 250):
        some = [deal.choice(rows) for _ in range(n)]
        assert list(rest.as_texts(iter(some))) == [json.dumps(r, sort_keys=True) for r in some]
    calls, dumps = [], json.dumps
    monkeypatch.setattr(rest.json, "dumps", lambda *a, **k: calls.append(a) or dumps(*a, **k))
    assert len(list(rest.as_texts({"k": k} for k in range(1000)))) == 1000 and len(calls) == 1000 // rest.PIECE


def test_an_incremental_stream_over_one_connection(spark, thrice, connections):
    from tidemark import catalog_io

    assert catalog_io.rest_incremental(spark, thrice).count() == 1401 and len(connections) == 1


def test_a_stream_gives_columns_where_from_json_would(spark):
    import random

    from pyspark.sql import functions as F

    from tidemark import catalog_io

    schema = "i long, d double, s string, b boolean"
    odd = {"i": [1, -(2**63), 2**63, True, 1.0, "1", [1]], "d": [0.5, -0.0, 1e308, float("inf"), float("nan"), 1, "x"], "s": ["", "}, {", "\n\u00e9", "\ud800", 7, {"k": 1}], "b": [True, False, 0, "true"]}
    plain = {"i": [1, -(2**63), 2**63 - 1], "d": [0.5, -0.0, 1e-300], "s": ["", "}, {", "\n\u00e9"], "b": [True, False]}
    deal = random.Random(2)
    one = lambda values: {k: deal.choice([*v, None]) for k, v in values.items() if deal.random() < 0.9} | {"more": 1}
    pages = [[one(plain) for _ in range(30)], [], [one(odd) for _ in range(200)], [{}, one(plain)], [7, None, [], "x", one(plain)], *([one(odd)] for _ in range(60))]
    base = catalog_io.serve(lambda path, q: json.dumps({"items": pages[int(q.get("c", 0))], "next": k if (k := int(q.get("c", 0)) + 1) < len(pages) else None}).encode())
    stream = rest.Stream(base, "/e", records="items", pages=rest.Pages("cursor", "c", path="next"))
    fields = {"i": "bigint", "d": "double", "s": "string", "b": "boolean"}
    assert [c.to_pylist() for c in rest.as_columns(pages[3], fields)][0] == [None, pages[3][1].get("i")]
    assert rest.as_columns(pages[0], fields) is not None and rest.as_columns(pages[2], fields) is None and rest.as_columns([{"i": 2**63}], fields) is None
    for types in (schema, "i long, more long", "i int, s string"):
        texts = spark.createDataFrame([(json.dumps(r, sort_keys=True),) for page in pages for r in page], "value string")
        want = texts.select(F.from_json("value", types).alias("r")).select("r.*").collect()
        assert list(map(repr, rest.read_stream(spark, stream, types).collect())) == list(map(repr, want))


def test_an_incremental_stream_is_planned_without_a_data_source(spark, thrice, monkeypatch):
    from tidemark import catalog_io

    monkeypatch.setattr(catalog_io, "AT_ONCE", 1)  # each block of rows goes to the driver by itself
    got = catalog_io.rest_incremental(spark, thrice)
    assert "BatchScan" not in got._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in got.collect()) == sorted((k // 3, k % 5) for k in range(3600, 5001))


def test_a_connection_that_the_server_closes_unsaid(connections):
    asked = []

    class Closing(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def log_message(self, *a):
            pass

        def do_GET(self):
            asked.append(self.path)
            after = int(parse_qs(urlsplit(self.path).query).get("c", ["0"])[0]) + 1
            data = json.dumps({"items": [{"id": after}], "next": after if after < 6 else None}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)
            self.close_connection = after % 2 == 0

    server = HTTPServer(("127.0.0.1", 0), Closing)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    stream = rest.Stream(f"http://127.0.0.1:{server.server_port}", "/e", records="items", pages=rest.Pages("cursor", "c", path="next"), tries=1)
    assert [r["id"] for r in rest.read_pages(stream)] == [1, 2, 3, 4, 5, 6]
    assert len(asked) == 6 and len(connections) == 3
    server.shutdown()


def test_many_parts_are_listed_and_read_as_a_folder(spark, tmp_path):
    out = FileDestination(spark, f"file://{tmp_path}", "p", part_bytes=1000)
    out.write("t", spark.range(9000), "l", 0)
    assert len(out.sizes("t")) >= 8 and [*out.sizes("t").values()] == [(tmp_path / n).stat().st_size for n in out.owned("t")]
    assert out.paths("t") == [f"file://{tmp_path}/t"] and out.count_rows("t") == 9000
    (tmp_path / "t" / "notes.txt").write_text("mine")
    assert len(out.paths("t")) == len(out.owned("t")) and out.count_rows("t") == 9000
    folders = FileDestination(spark, f"file://{tmp_path}/f", "p", partition_by="v")
    folders.write("t", spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS v"), "l", 0)
    assert folders.paths("t") == [f"file://{tmp_path}/f/t/__null__/part-l-0-0.parquet"] and folders.read("t").count() == 1
