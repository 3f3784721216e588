"""Pipeline documents run end to end, policies, leases, snapshots of a lake, and a database target and source."""

import json
import threading
from datetime import date, datetime
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.plans import pipeline
from tidemark.plans.commit import Table
from tidemark.plans.options import OptionError, TableOptions
from tidemark.sinks.database import DatabaseDestination
from tidemark.sinks.files import FileDestination
from tidemark.sinks.lake import LakeDestination
from tidemark.sinks.lease import Lease, LeaseError
from tidemark.sinks.snapshots import SnapshotDestination
from tidemark.sources import database, files
from tidemark.sources.database import Database, DatabaseError, parse_connection

DOC = """
pipeline: p
write_mode: {mode}
source:
  kind: files
  streams:
    - name: orders
      path: {folder}/in/*.jsonl
      schema: id long, at string, amount long
destination: {{kind: {kind}, path: "file://{folder}/out"}}
"""


def lines(path, *rows):
    path.parent.mkdir(exist_ok=True)
    with path.open("a") as f:
        f.writelines(json.dumps(dict(zip(("id", "at", "amount"), r, strict=True))) + "\n" for r in rows)


def test_documents_are_strict():
    doc = {"pipeline": "p", "write_mode": "append", "source": {"kind": "files", "streams": [{"name": "a", "path": "x"}]}, "destination": {"kind": "files", "path": "y"}}
    assert pipeline.parse(doc).mode == "append"
    bad = [
        ({**doc, "mode": 1}, "no field mode"), ({k: v for k, v in doc.items() if k != "source"}, "needs source"), ({**doc, "write_mode": "upsert"}, "write_mode"),
        ({**doc, "source": {**doc["source"], "conn": "x"}}, "no field conn"), ({**doc, "source": {"kind": "files", "streams": [{"name": "a"}, {"name": "A"}]}}, "two streams"),
        ({**doc, "source": {"kind": "files", "streams": [{"name": "a", "pth": "x"}]}}, "no field pth"), ({**doc, "write_mode": {"merge": {"key": ["id"]}}}, "can't merge"),
        ({**doc, "write_mode": {"merge": {"key": ["id"], "strategie": "x"}}}, "no field strategie"), ({**doc, "commit_policy": {}}, "names a threshold"), ({**doc, "commit_policy": {"every_bytes": 0}}, "above 0"),
        ({**doc, "batch_policy": {"every_rows": -1}}, "above 0"), ({**doc, "destination": {"kind": "lake", "path": "y"}, "write_mode": "replace"}, "only appends"), ({**doc, "destination": {"kind": "files", "path": "y", "buckets": 2}}, "no field buckets"),
    ]
    for d, why in bad:
        with pytest.raises(pipeline.DocumentError, match=why):
            pipeline.parse(d)


def test_policies():
    sizes = [100] * 14
    assert [b - a for a, b in pipeline.CommitPolicy(every_checkpoints=6).units(sizes)] == [6, 6, 2]
    assert list(pipeline.CommitPolicy(every_bytes=250).units([100, 200, 10, 300])) == [(0, 2), (2, 4)]
    ticks = iter(range(100))
    assert len(list(pipeline.CommitPolicy(every_seconds=2).units(sizes, lambda: next(ticks)))) > 1
    writes = pipeline.BatchPolicy(every_rows=600).writes([(100, 1)] * 13 + [(51, 1)])
    assert [100 * (b - a) for a, b in writes[:-1]] == [600, 600] and writes[-1] == (12, 14)
    assert pipeline.BatchPolicy().writes([(1, 1)] * 3) == [(0, 1), (1, 2), (2, 3)]


def test_append_resumes(spark, tmp_path):
    doc = DOC.format(mode="append", folder=tmp_path, kind="files") + "commit_policy: {every_checkpoints: 1}\n"
    lines(tmp_path / "in/a.jsonl", (1, "x", 10), (2, "y", 20))
    lines(tmp_path / "in/b.jsonl", (3, "z", 30))
    report = pipeline.run(spark, doc)
    assert report["streams"]["orders"] == {"units": 2, "already": 0, "resumed": False}
    lines(tmp_path / "in/a.jsonl", (4, "w", 40))
    assert pipeline.run(spark, doc)["streams"]["orders"] == {"units": 1, "already": 0, "resumed": True}
    out = FileDestination(spark, f"file://{tmp_path}/out", "p")
    assert sorted(r.id for r in out.read("orders").collect()) == [1, 2, 3, 4]
    assert pipeline.run(spark, doc)["streams"]["orders"]["units"] == 0 and out.count_rows("orders") == 4
    (tmp_path / "in/b.jsonl").write_text('{"id": 3, "at": "z", "amount": 31}\n')
    with pytest.raises(files.SourceError, match="rewritten"):
        pipeline.run(spark, doc)


@pytest.mark.parametrize("point", ["part", "state", "receipt"])
def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch, point):
    doc = DOC.format(mode="append", folder=tmp_path, kind="files") + "commit_policy: {every_checkpoints: 1}\n"
    for k in range(3):
        lines(tmp_path / f"in/{k}.jsonl", (k, "x", k), (k + 10, "x", k))
    stops = {"left": 2}
    real = FileDestination.__init__

    def made(self, *a, **k):
        def fail(at):
            if at == point:
                stops["left"] -= 1
                if stops["left"] == 0:
                    raise KeyboardInterrupt

        real(self, *a, **k, fail_at=fail)

    monkeypatch.setattr(FileDestination, "__init__", made)
    with pytest.raises(KeyboardInterrupt):
        pipeline.run(spark, doc, load="l")
    monkeypatch.setattr(FileDestination, "__init__", real)
    pipeline.run(spark, doc, load="l")
    out = FileDestination(spark, f"file://{tmp_path}/out", "p")
    assert sorted(r.id for r in out.read("orders").collect()) == [0, 1, 2, 10, 11, 12]


def test_replace_ignores_cursors(spark, tmp_path):
    doc = DOC.format(mode="replace", folder=tmp_path, kind="files")
    lines(tmp_path / "in/a.jsonl", (1, "x", 10))
    for _ in range(2):
        pipeline.run(spark, doc)
        lines(tmp_path / "in/a.jsonl", (2, "y", 20))
    out = FileDestination(spark, f"file://{tmp_path}/out", "p")
    assert sorted(r.id for r in out.read("orders").collect()) == [1, 2]


def test_merge_document_with_a_cursor(spark, tmp_path):
    folder = f"file://{tmp_path}/events"
    doc = {"pipeline": "p", "write_mode": {"merge": {"key": ["id"], "strategy": "upsert"}}, "source": {"kind": "tables", "streams": [{"name": "events", "path": folder, "cursor": "day", "primary_key": ["id"]}]}, "destination": {"kind": "snapshots", "path": f"file://{tmp_path}/out", "buckets": 4}}
    schema = "id long, day string, v int"
    spark.createDataFrame([(1, "d1", 1), (2, "d2", 1)], schema).write.parquet(folder)
    pipeline.run(spark, doc)
    spark.createDataFrame([(3, "d2", 3), (1, "d3", 3), (9, "d1", 9)], schema).write.mode("append").parquet(folder)
    report = pipeline.run(spark, doc)
    out = SnapshotDestination(spark, f"file://{tmp_path}/out", "p")
    # The late row of d1 is before the cursor; the one at the cursor that is new comes.
    assert report["streams"]["events"]["resumed"] and sorted(map(tuple, out.read("events").collect())) == [(1, "d3", 3), (2, "d2", 1), (3, "d2", 3)]


def test_snapshot_buckets_and_old_folders(spark, tmp_path):
    t = Table("t", "merge", ("id",), TableOptions(strategy="upsert"))
    out = SnapshotDestination(spark, f"file://{tmp_path}", "p", buckets=8)
    stage = spark.range(200).selectExpr("id", "id * 2 AS v", "id AS n")
    out.commit([t], {"t": stage}, "l", 0, "n")
    first = out.head()["tables"]["t"]["parts"]
    out.commit([t], {"t": spark.createDataFrame([(5, 0, 1)], "id long, v long, n long")}, "l", 1, "n")
    second = out.head()["tables"]["t"]["parts"]
    assert sum(first[b] != second[b] for b in first) == 1 and out.read("t").count() == 200 and out.read("t").filter("id = 5").first().v == 0
    out.commit([t], {"t": spark.createDataFrame([(6, 0, 1)], "id long, v long, n long")}, "l", 2, "n")
    replaced = [f for f in first.values() if f not in second.values()]
    assert all(not (tmp_path / f).exists() for f in replaced) and out.read("t").count() == 200


def test_schemas_grow_in_targets(spark, tmp_path):
    t = Table("t", "merge", ("id",), TableOptions(strategy="upsert"))
    out = SnapshotDestination(spark, f"file://{tmp_path}/s", "p", buckets=2)
    frame = spark.createDataFrame
    out.commit([t], {"t": frame([(1, 10, 0), (2, 20, 1)], "id long, v long, n long")}, "l0", 0, "n")
    out.commit([t], {"t": frame([(2, "x", 5, 0)], "id long, note string, v long, n long")}, "l1", 0, "n")
    assert sorted(map(tuple, out.read("t").collect())) == [(1, 10, None), (2, 5, "x")] and out.read("t").columns == ["id", "v", "note"]
    out.commit([t], {"t": frame([(3, "7.5", 0)], "id long, v string, n long").selectExpr("id", "cast(v AS decimal(25,2)) AS v", "n")}, "l2", 0, "n")
    assert sorted(str(r.v) for r in out.read("t").collect()) == ["10.00", "5.00", "7.50"]
    with pytest.raises(ValueError, match="contradicts"):
        out.commit([t], {"t": frame([(3, True, 0)], "id long, v boolean, n long")}, "l3", 0, "n")
    with pytest.raises(Exception, match="null in merge key id"):
        out.commit([t], {"t": frame([(None, 1, 0)], "id long, v long, n long")}, "l4", 0, "n")
    with pytest.raises(OptionError, match="key column id is missing"):
        out.commit([t], {"t": frame([(1, 0)], "v long, n long")}, "l5", 0, "n")
    with pytest.raises(OptionError, match="strategy"):
        out.commit([Table("t", "merge", ("id",), TableOptions(strategy="x"))], {"t": frame([(1, 0)], "id long, n long")}, "l6", 0, "n")
    out.commit([t], {"t": frame([(4, 1, "y", 0)], "id long, v long, note string, n long")}, "l7", 0, "n")
    for columns, why in (("id long, note string, n long", "missing now"), ("id long, note string, v long, n long", "column 1 was v")):
        with pytest.raises(ValueError, match=why):
            out.commit([t], {"t": frame([], columns)}, "l7", 1, "n")
    with pytest.raises(ValueError, match="differ by case"):
        spark.conf.set("spark.sql.caseSensitive", "true")
        try:
            out.commit([t], {"t": frame([(4, 1, 1, 0)], "id long, v long, V long, n long")}, "l8", 0, "n")
        finally:
            spark.conf.unset("spark.sql.caseSensitive")
    twice = SnapshotDestination(spark, f"file://{tmp_path}/d", "p")
    twice.commit([Table("t", "append")], {"t": frame([(1, 1), (1, 2)], "id long, v long")}, "l", 0, "n")
    with pytest.raises(OptionError, match="unique key"):
        twice.commit([t], {"t": frame([(1, 3, 0)], "id long, v long, n long")}, "l", 1, "n")

    parts = FileDestination(spark, f"file://{tmp_path}/f", "p")
    parts.write("t", frame([(1, 10)], "id long, v long"), "l0", 0)
    parts.write("t", frame([(2, "x")], "id int, note string"), "l1", 0)
    assert sorted(map(tuple, parts.read("t").collect()), key=str) == [(1, 10, None), (2, None, "x")]
    with pytest.raises(ValueError, match="wider type"):
        parts.write("t", frame([(2, "x")], "id long, v string"), "l2", 0)


def test_parts_roll_by_size(spark, tmp_path):
    df = spark.range(100_000).selectExpr("id", "sha2(cast(id AS string), 256) AS text", "id % 3 AS p").coalesce(1)
    for partition in (None, "p"):
        out = FileDestination(spark, f"file://{tmp_path}/{partition}", "p", part_bytes=500_000, partition_by=partition, group_rows=1000)
        out.write("t", df, "l", 0)
        sizes = [out.store.fs.getFileStatus(out.store.path(n)).getLen() for n in out.owned("t")]
        assert len(sizes) > 6 and max(sizes) < 700_000 and out.count_rows("t") == 100_000
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(tmp_path / out.owned("t")[0].replace("t/", "p/t/", 1)).metadata
    assert meta.row_group(0).num_rows <= 1000


def test_lease(spark, tmp_path):
    now = [1000.0]
    root = f"file://{tmp_path}"
    one = Lease(spark, root, "p", "first", lambda: now[0])
    one.acquire()
    with pytest.raises(LeaseError, match="first holds"):
        Lease(spark, root, "p", "second", lambda: now[0]).acquire()
    with Lease(spark, root, "q", "other", lambda: now[0]):
        pass
    now[0] += 100
    one.renew()
    one.check()
    now[0] += 280
    with pytest.raises(LeaseError, match="was lost"):
        one.check()
    now[0] += 30
    two = Lease(spark, root, "p", "second", lambda: now[0])
    two.acquire()
    one.renew()
    with pytest.raises(LeaseError):
        one.check()
    two.check()
    late = FileDestination(spark, root, "p", lease=one)
    with pytest.raises(LeaseError):
        late.write("t", spark.range(3), "l", 0)
    assert not (tmp_path / "t").exists()


def test_lake(spark, tmp_path):
    df = spark.createDataFrame([(k, datetime(2024, 1, 1 + k % 3), f"name{k}") for k in range(30)], "id long, ts timestamp, name string")
    out = LakeDestination(spark, f"file://{tmp_path}", "p", [("day", "ts"), ("bucket", "id", 4), ("truncate", "name", 4)])
    assert out.write("t", df, "l", 0) and not out.write("t", df, "l", 0) and out.write("t", df.withColumn("extra", F.lit(1)), "l", 1, state={"a": 1})
    one, two = out.snapshots("t")
    assert (one["rows"], two["parent"], two["unit"], out.state("t")) == (30, one["id"], ["p", "l", 1], {"a": 1})
    assert out.read("t").count() == 60 and out.read("t", one["id"]).count() == 30 and out.read("t").filter("extra IS NULL").count() == 30
    assert any("_ts_day=" in f and "_id_bucket=" in f and "_name_trunc=name" in f for f in one["files"])
    for mode in ("replace", "merge"):
        with pytest.raises(ValueError, match="only grows"):
            out.write("t", df, "l", 2, mode)
    with pytest.raises(ValueError, match="fixed when it was made"):
        LakeDestination(spark, f"file://{tmp_path}", "p").write("t", df, "l", 3)
    with pytest.raises(ValueError, match="number of at least 1"):
        LakeDestination(spark, f"file://{tmp_path}", "p", [("bucket", "id", 0)])
    # Two writers: both stay.
    a, b = (LakeDestination(spark, f"file://{tmp_path}/x", n) for n in "ab")
    real = b.schema_of

    def first_the_other(doc, frame):
        b.schema_of = real
        a.write("t", frame, "l", 0)
        return real(doc, frame)

    b.schema_of = first_the_other
    assert b.write("t", df, "l", 0) and b.read("t").count() == 60


def derby(tmp_path):
    return Database(f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver", "user": "APP"})


def test_database(spark, tmp_path):
    db = derby(tmp_path)
    out = DatabaseDestination(spark, db, "APP", "p")
    rows = spark.createDataFrame([(k, f"n{k}", k % 7, k) for k in range(50)], "id long, name string, day int, n long")
    t = Table("orders", "append")
    assert out.state() is None
    assert out.commit(t, rows, "l", 0, "n", {"at": 1}) and not out.commit(t, rows, "l", 0, "n", {"at": 2}) and out.state() == {"at": 1}
    found = database.discover(spark, db, "APP", ["orders"])[0]
    assert [c[0] for c in found.columns] == ["id", "name", "day"] and database.discover(spark, db, "APP", []) == []
    assert "orders" in [f.name for f in database.discover(spark, db, "APP")]
    with pytest.raises(DatabaseError, match="no table nope"):
        database.discover(spark, db, "APP", ["nope"])
    read = database.scan(spark, db, "APP", "orders", exclude=["name"], within=database.Window("day", "max", 5), split="id", tasks=4)
    plan = read._jdf.queryExecution().toString()
    assert sorted(r.id for r in read.collect()) == [k for k in range(50) if k % 7 >= 5] and "GreaterThanOrEqual(day,5)" in plan and read.rdd.getNumPartitions() == 4
    assert database.query_rows(spark, db, 'SELECT "day", COUNT(*) AS "n" FROM APP."orders" GROUP BY "day"').count() == 7
    with pytest.raises(DatabaseError, match="one SELECT"):
        database.query_rows(spark, db, "SELECT 1; DELETE FROM x")
    page = database.scan_page(read, "day", "id", 3, 5, 12)
    assert [(r.day, r.id) for r in page.collect()] == [(5, 19), (5, 26), (5, 33)]

    key = Table("orders", "merge", ("id",), TableOptions(strategy="upsert", hard_delete="gone"))
    new = spark.createDataFrame([(1, "new", 0, None, 1), (1, "newer", 0, None, 2), (2, "x", 0, True, 3), (99, "come", 0, None, 4)], "id long, name string, day int, gone boolean, n long")

    def fail(point):
        if point == stop:
            raise RuntimeError("stopped")

    for stop in ("deleted", "inserted", "receipt"):
        with pytest.raises(RuntimeError, match="stopped"):
            DatabaseDestination(spark, db, "APP", "p", fail).commit(key, new, "m", 0, "n", {"at": 3})
        assert out.read("orders").count() == 50 and out.state() == {"at": 1}  # rolled back whole
    assert out.commit(key, new, "m", 0, "n", {"at": 3}) and out.state() == {"at": 3}
    got = {r.id: r.name for r in out.read("orders").collect()}
    assert len(got) == 50 and got[1] == "newer" and 2 not in got and got[99] == "come"
    assert out.commit(Table("orders", "append"), rows.withColumn("extra", F.lit("e")), "m", 1, "n") and out.read("orders").filter("extra IS NOT NULL").count() == 50
    mirror = Table("orders", "replace")
    for seq in range(2):
        out.commit(mirror, rows.limit(5), "r", seq, "n")
    assert out.read("orders").count() == 10  # cleared once a load
    with pytest.raises(Exception, match="null in merge key"):
        out.commit(key, new.withColumn("id", F.lit(None).cast("long")), "m", 9, "n")
    with pytest.raises(OptionError, match="keyed merges"):
        out.commit(Table("orders", "merge", ("id",), TableOptions(strategy="scd2")), rows, "m", 9, "n")


def test_connection_strings():
    db = parse_connection("host=h port=6543 dbname=d user=u password='a b\\'c' sslmode=verify-full")
    assert (db.url, db.properties, db.password) == ("jdbc:postgresql://h:6543/d", {"sslmode": "verify-full", "user": "u"}, "a b'c")
    assert "a b" not in repr(db) and "bytea_output" in db.options()["sessionInitStatement"]
    assert parse_connection("postgresql://u:p%40@h/d?sslmode=disable").password == "p@"
    bad = [("host=h dbname=d tty=1", "tty isn't supported"), ("host=h host=i dbname=d", "given twice"), ("host=h", "host and dbname"), ("host=h dbname=d sslmode=on", "none of"), ("host=h dbname=d sslmode=disable sslrootcert=x", "conflicts"), ("host=h dbname=d sslmode=verify_ca", "needs sslrootcert"), ("host=h dbname=d sslcert=x", "go together"), ("postgres://u@h/d?user=v", "given twice"), ("host=h dbname=d port=x", "isn't a number")]
    for text, why in bad:
        with pytest.raises(DatabaseError, match=why):
            parse_connection(text)
    assert Database("jdbc:x").name('a"b', "c") == '"a""b"."c"'


def test_database_pipeline(spark, tmp_path):
    db = derby(tmp_path)
    spark.range(5).selectExpr("id", "id AS at").write.format("jdbc").options(**db.options(), dbtable='APP."src"').save()
    doc = {"pipeline": "p", "write_mode": "append", "source": {"kind": "database", "conn": f"{db.url};user=APP", "db_schema": "APP", "streams": [{"name": "src", "cursor": "at", "primary_key": ["id"]}]}, "destination": {"kind": "lake", "path": f"file://{tmp_path}/out", "partitions": [["bucket", "id", 2]]}}
    pipeline.run(spark, doc)
    spark.range(5, 8).selectExpr("id", "id AS at").write.format("jdbc").options(**db.options(), dbtable='APP."src"').mode("append").save()
    report = pipeline.run(spark, doc, load="x")
    assert report["streams"]["src"]["resumed"] and pipeline.run(spark, doc, load="x")["streams"]["src"]["already"] == 1
    out = LakeDestination(spark, f"file://{tmp_path}/out", "p", [("bucket", "id", 2)])
    assert sorted(r.id for r in out.read("src").collect()) == [*range(8)]


class Pages(BaseHTTPRequestHandler):
    def log_message(self, *a):
        pass

    def do_GET(self):
        page = int(self.path.rpartition("=")[2]) if "=" in self.path else 1
        data = json.dumps({"items": [{"id": 10 * page + k} for k in range(2)] if page < 4 else []}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)


def test_rest_pipeline(spark, tmp_path):
    server = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    doc = {"pipeline": "p", "write_mode": "replace", "source": {"kind": "rest", "base_url": f"http://127.0.0.1:{server.server_port}", "streams": [{"name": "items", "path": "/items", "schema": "id long", "rest": {"records": "items", "pages": {"kind": "page", "param": "page"}}}]}, "destination": {"kind": "files", "path": f"file://{tmp_path}/out", "format": "jsonl"}}
    for _ in range(2):
        pipeline.run(spark, doc)
    out = FileDestination(spark, f"file://{tmp_path}/out", "p", kind="json")
    assert sorted(r.id for r in out.read("items").collect()) == [10, 11, 20, 21, 30, 31]
    with pytest.raises(pipeline.DocumentError, match="no field recs"):
        doc["source"]["streams"][0]["rest"] = {"recs": "x"}
        pipeline.run(spark, doc)
    server.shutdown()


def test_feed_checks(spark):
    identity, check = changes.identity, changes.check_feed
    assert identity("t", ["a", "b"], ["a"], ["a"]) == ["a"] and identity("t", ["a", "b"], ["a"], full=True) == ["a", "b"] and identity("t", ["a", "b"], ["b"], ["a"], index=["b"]) == ["b"]
    for args, more, why in ((("t", ["a"], ["a"]), {}, "no primary key"), (("t", ["a", "b"], ["b"], ["a"]), {}, "declared key is b"), (("t", ["a"], ["a"], ["c"]), {}, "isn't read"), (("t", ["a"], [], ["a"]), {}, "no key is declared")):
        with pytest.raises(changes.FeedError, match=why):
            identity(*args, **more)
    check("t", None, None)
    check("t", 10, 11, 3)
    for args, why in (((10, None), "is gone"), ((10, 12), "11 to 11 are gone"), ((10, 5, 11), "made anew"), ((10, 5, 1, "other"), "read by other")):
        with pytest.raises(changes.FeedError, match=why):
            check("t", *args)
    commits = spark.createDataFrame([(10, datetime(2024, 1, 1)), (30, datetime(2024, 1, 1, 0, 1))], "lsn long, at timestamp")
    cursors = spark.createDataFrame([("a", 10), ("b", 30), ("c", None)], "stream string, cursor long")
    assert sorted(map(tuple, changes.lag_report(cursors, commits, "at").collect())) == [("a", 10, 20, 60.0), ("b", 30, 0, 0.0), ("c", None, 30, None)]
    row = "struct<id: long, note: string>"
    log = spark.createDataFrame([(1, 0, "U", (1, "old"), (1, None), ["note"])], f"lsn int, seq int, op string, before {row}, after {row}, kept array<string>")
    assert changes.apply_changes(log, ["id"], unchanged=F.col("kept")).first().note == "old"
    with pytest.raises(Exception, match="can't be applied"):
        changes.apply_changes(log.withColumn("before", F.lit(None).cast(row)), ["id"], unchanged=F.col("kept")).collect()
    with pytest.raises(changes.FeedError, match="vanished"):
        changes.check_columns(log, spark.createDataFrame([], "id long, other string").schema)


def test_work_is_tried_again():
    from tidemark.sources.rest import RestError

    tries = []

    def work():
        tries.append(1)
        if len(tries) < 3:
            raise RestError("busy", "rate_limited" if len(tries) == 1 else "transient", 0.0)
        return True

    assert pipeline.retried(work, 3, 0.0) and len(tries) == 3
    for why, most in ((RestError("no"), 3), (RestError("busy", "transient"), 1), (ValueError("no"), 3)):
        def fails(why=why):
            raise why

        with pytest.raises(type(why)):
            pipeline.retried(fails, most, 0.0)


def test_wire_values(spark):
    from tidemark.functions import wire

    text = lambda v, kind: spark.createDataFrame([(v,)], "v string").select(wire.decode_text(F.col("v"), kind).alias("v")).first().v
    binary = lambda v, kind: spark.createDataFrame([(bytearray(v),)], "v binary").select(wire.decode_binary(F.col("v"), kind).alias("v")).first().v
    assert text("t", "bool") is True and text(None, "int4") is None and text("NaN", "float8") != text("NaN", "float8") and text("-Infinity", "float4") == float("-inf")
    assert bytes(text("\\x00ff", "bytea")) == b"\x00\xff" and str(text("12.50", "decimal(6,2)")) == "12.50" and text("2024-02-03 04:05:06.7", "timestamp") == datetime(2024, 2, 3, 4, 5, 6, 700000)
    for v, kind in (("x", "bool"), ("00ff", "bytea"), ("infinity", "timestamp"), ("0044-03-15 BC", "date"), ("1.234", "decimal(6,2)")):
        with pytest.raises(Exception):
            text(v, kind)
    assert binary(b"\xff\xff\xff\xff", "int4") == -1 and binary(b"\x80" + bytes(7), "int8") == -(1 << 63) and binary(b"\x01", "bool") is True
    assert binary(bytes(8), "timestamp") == datetime(2000, 1, 1) and str(binary(b"\xff\xff\xff\xff", "date")) == "1999-12-31" and binary(b"\x3f\xc0\x00\x00", "float4") == 1.5
    assert binary(bytes(range(16)), "uuid") == "00010203-0405-0607-0809-0a0b0c0d0e0f" and binary(b"\x01{}", "jsonb") == "{}"
    with pytest.raises(Exception, match="bytes are needed"):
        binary(b"\x01", "int4")
    for decode in (wire.decode_text, wire.decode_binary):
        with pytest.raises(ValueError, match="aren't read"):
            decode(F.col("v"), "point")


@pytest.fixture
def far(spark, tmp_path, monkeypatch):
    """A database that the executors are taken not to reach."""
    from tidemark.sinks import database as sink

    for module in (database, sink):
        monkeypatch.setattr(module, "apart", lambda *a: True)
    return derby(tmp_path)


def test_database_of_the_driver(spark, far):
    from decimal import Decimal

    texts = [None, "", " a ", 'say "x", y', "two\nlines", "cr\r\nlf", "é😀", "\\", ",", '"']
    rows = [(k, v, None if k == 3 else bytes([k, 0, 255]), datetime(2024, 1, 2, 3, 4, 5, k * 100_001), date(1890, 1, 1 + k), k % 2 == 0, Decimal(k) / 8, k / 3) for k, v in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, name string, raw binary, at timestamp, day date, flag boolean, price decimal(12,3), x double")
    out = DatabaseDestination(spark, far, "APP", "p")
    assert out.commit(Table("t", "append"), df.withColumn("n", F.col("id")), "l", 0, "n", {"at": 1}) and out.state() == {"at": 1}
    assert sorted(map(tuple, out.read("t").collect())) == rows
    assert not out.commit(Table("t", "append"), df.withColumn("n", F.col("id")), "l", 0, "n")


def test_scan_of_the_driver(spark, far):
    DatabaseDestination(spark, far, "APP", "p").commit(Table("t", "append"), spark.range(100).selectExpr("id", "id % 7 AS day", "id AS n"), "l", 0, "n")
    rows = database.scan(spark, far, "APP", "t", include=["id"], within=database.Window("id", "max", 10, True, 20), split="id", tasks=3)
    assert sorted(r.id for r in rows.collect()) == [*range(10, 20)] and rows.columns == ["id"]


def test_query_of_the_driver(spark, far):
    DatabaseDestination(spark, far, "APP", "p").commit(Table("t", "append"), spark.range(100).selectExpr("id", "id % 7 AS day", "id AS n"), "l", 0, "n")
    assert sorted(map(tuple, database.query_rows(spark, far, 'SELECT "day", COUNT(*) AS "n" FROM APP."t" GROUP BY "day"').collect())) == [(k, 15 if k < 2 else 14) for k in range(7)]
    assert database.query_rows(spark, far, 'SELECT "id" FROM APP."t" WHERE "id" < 0').collect() == []


def test_page_of_the_driver(spark, far):
    DatabaseDestination(spark, far, "APP", "p").commit(Table("t", "append"), spark.range(100).selectExpr("id", "id % 7 AS day", "id AS n"), "l", 0, "n")
    page = database.scan_page(database.scan(spark, far, "APP", "t"), "day", "id", 3, 5, 12)
    assert [(r.day, r.id) for r in page.collect()] == [(5, 19), (5, 26), (5, 33)]


def test_discovery_of_the_driver(spark, far):
    out = DatabaseDestination(spark, far, "APP", "p")
    out.commit(Table("t", "append"), spark.range(5).selectExpr("id", "id AS n"), "l", 0, "n")
    assert [(f.name, [c[0] for c in f.columns]) for f in database.discover(spark, far, "APP") if not f.name.startswith("_")] == [("t", ["id"])]


def test_merge_of_the_driver(spark, far):
    out = DatabaseDestination(spark, far, "APP", "p")
    key = Table("t", "merge", ("id",), TableOptions(strategy="upsert", hard_delete="gone"))
    rows = lambda lo, v: spark.range(lo, lo + 10).selectExpr("id", f"'{v}' AS v", f"id % 5 = 0 AND '{v}' = 'b' AS gone", "id AS n")
    for seq, (lo, v) in enumerate(((0, "a"), (5, "b"))):
        out.commit(key, rows(lo, v), "l", seq, "n")
    assert sorted(map(tuple, out.read("t").collect())) == [(k, "a") for k in range(5)] + [(k, "b") for k in range(5, 15) if k % 5]
