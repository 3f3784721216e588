"""Tables of a database over JDBC: connection strings, discovery, and scans whose windows and columns are pushed down."""

from __future__ import annotations

import re
import urllib.parse
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import Window, check_cursor, keyset_resume, window
from ..storage import Storage, new_folder
from .query import select_columns


class DatabaseError(ValueError):
    """Names the parameter, table or column and what is wrong with it."""


#: What each rung of the TLS ladder is called in a connection string, and whether it takes a root certificate (fixed values).
TLS = {"disable": False, "prefer": False, "require": True, "verify_ca": True, "verify_full": True}
#: Statements that pin what a session would else take from its server (fixed values).
PINNED = {
    "postgresql": "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY; SET timezone = 'UTC'; SET datestyle = 'ISO'; SET bytea_output = 'hex'",
    "oracle": "ALTER SESSION SET TIME_ZONE = 'UTC'",
}
_KNOWN = {"host", "port", "dbname", "user", "password", "sslmode", "sslrootcert", "sslcert", "sslkey", "connect_timeout", "application_name"}
_JDBC = {"sslrootcert": "sslrootcert", "sslcert": "sslcert", "sslkey": "sslkey", "connect_timeout": "connectTimeout", "application_name": "ApplicationName"}


@dataclass(frozen=True)
class Database:
    """A JDBC address with its properties; the password doesn't show in its text."""

    url: str
    properties: dict = field(default_factory=dict)
    password: str | None = field(default=None, repr=False)
    quote: str = '"'

    def options(self) -> dict[str, str]:
        out = {"url": self.url, **self.properties}
        if self.password is not None:
            out["password"] = self.password
        if pinned := PINNED.get(self.url.split(":")[1]):
            out["sessionInitStatement"] = pinned
        return out

    def name(self, *parts: str) -> str:
        """A quoted name; the quote sign is doubled within."""
        return ".".join(self.quote + p.replace(self.quote, 2 * self.quote) + self.quote for p in parts if p)

    def connect(self, spark: SparkSession):
        """A connection of the driver, for metadata and transactions."""
        jvm = spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for k, v in {**self.properties, **({"password": self.password} if self.password is not None else {})}.items():
            properties.setProperty(k, str(v))
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)


def _pairs(text: str) -> dict[str, str]:
    """key=value pairs; values may be in single quotes, with \\ before a quote or \\."""
    out, at = {}, 0
    one = re.compile(r"\s*(\w+)\s*=\s*(?:'((?:[^'\\]|\\.)*)'|(\S*))\s*")
    while at < len(text):
        m = one.match(text, at)
        if not m:
            raise DatabaseError(f"the connection string can't be read at {at}")
        if m[1] in out:
            raise DatabaseError(f"{m[1]} is given twice")
        out[m[1]] = re.sub(r"\\(.)", r"\1", m[2]) if m[2] is not None else m[3]
        at = m.end()
    return out


def parse_connection(text: str) -> Database:
    """A PostgreSQL connection string, of key=value pairs or as a URL; or a JDBC address as it is. Unknown and conflicting
    parameters are refused by name."""
    if text.startswith("jdbc:"):
        return Database(text)
    if re.match(r"postgres(ql)?://", text):
        u = urllib.parse.urlsplit(text)
        found = {k: v[-1] for k, v in urllib.parse.parse_qs(u.query, keep_blank_values=True).items()}
        plain = {"host": u.hostname, "port": u.port, "dbname": u.path.lstrip("/"), "user": u.username, "password": u.password}
        for k, v in plain.items():
            if v in (None, ""):
                continue
            v = urllib.parse.unquote(str(v))
            if found.get(k, v) != v:
                raise DatabaseError(f"{k} is given twice, as {v} and {found[k]}" if k != "password" else "password is given twice")
            found[k] = v
    else:
        found = _pairs(text)
    if unknown := sorted(found.keys() - _KNOWN):
        raise DatabaseError(f"connection parameter {unknown[0]} isn't supported")
    if not found.get("host") or not found.get("dbname"):
        raise DatabaseError("host and dbname are needed")
    mode = found.get("sslmode", "prefer").replace("-", "_")
    if mode not in TLS:
        raise DatabaseError(f"sslmode {mode} is none of {', '.join(TLS)}")
    if "sslrootcert" in found and not TLS[mode]:
        raise DatabaseError(f"sslrootcert conflicts with sslmode {mode}")
    if mode == "verify_ca" and "sslrootcert" not in found:
        raise DatabaseError("sslmode verify_ca needs sslrootcert")
    if ("sslcert" in found) != ("sslkey" in found):
        raise DatabaseError("sslcert and sslkey go together")
    properties = {"sslmode": mode.replace("_", "-"), **{_JDBC[k]: found[k] for k in _JDBC if k in found}}
    if "user" in found:
        properties["user"] = found["user"]
    if not str(found.get("port", "5432")).isdigit():
        raise DatabaseError(f"port {found['port']} isn't a number")
    return Database(f"jdbc:postgresql://{found['host']}:{found.get('port', 5432)}/{urllib.parse.quote(found['dbname'])}", properties, found.get("password"))


@dataclass(frozen=True)
class Found:
    """A table of a database: (column, type, whether it takes nulls) in order, and its primary key."""

    name: str
    columns: tuple[tuple[str, str, bool], ...]
    key: tuple[str, ...]


def apart(spark: SparkSession, db: Database) -> bool:
    """Whether the database is embedded in the driver's process, and the executors, being others, can't reach it."""
    return re.match(r"jdbc:derby:(?!//)", db.url) is not None and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None


def load(spark: SparkSession, db: Database, source: str, **more: str) -> DataFrame:
    """The rows of a table or sub-query. Of a database that only the driver reaches, what is there now: the database writes
    it to a file, and that goes to the shared folder."""
    plain = spark.read.format("jdbc").options(**db.options(), dbtable=source, **more).load()
    return exported(spark, db, source, plain.schema) if apart(spark, db) else plain


def local_file(spark: SparkSession) -> str:
    """A name in a new folder of the driver's own."""
    return str(spark.sparkContext._jvm.java.nio.file.Files.createTempDirectory("tidemark", spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.nio.file.attribute.FileAttribute, 0))) + "/rows"


def call(db: Database, spark: SparkSession, sql: str, *values: str) -> None:
    connection = db.connect(spark)
    try:
        ask = connection.prepareCall(sql)
        for k, v in enumerate(values, 1):
            ask.setString(k, v)
        ask.execute()
    finally:
        connection.close()


def exported(spark: SparkSession, db: Database, source: str, schema: T.StructType) -> DataFrame:
    store, here = Storage(spark, new_folder(spark, "db")), local_file(spark)
    call(db, spark, "CALL SYSCS_UTIL.SYSCS_EXPORT_QUERY(?, ?, NULL, NULL, 'UTF-8')", f"SELECT * FROM {source}", here)
    store.fs.mkdirs(store.path(""))
    store.fs.copyFromLocalFile(True, True, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{here}"), store.path("rows.csv"))
    text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType) for f in schema])
    lines = any(isinstance(f.dataType, T.StringType) for f in schema)  # only text can have line ends within
    rows = spark.read.schema(text).csv(store.full("rows.csv"), quote='"', escape='"', nullValue="\x01", emptyValue="", lineSep="\n", multiLine=lines, mode="FAILFAST", timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][.SSSSSS][.SSS][.S]")
    return rows.select(*[(F.unhex(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.BinaryType) else F.col(f"`{f.name}`")).alias(f.name) for f in schema])


def imported(spark: SparkSession, db: Database, schema: str, table: str, df: DataFrame) -> None:
    """Rows into a table, with its columns in their order, of a database that only the driver reaches: Spark's tasks write
    files to the shared folder, and the database reads one after the other."""
    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        text = F.hex(c) if isinstance(f.dataType, T.BinaryType) else c.cast("string")
        return F.coalesce(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')) if isinstance(f.dataType, T.StringType) else text, F.lit(""))

    store = Storage(spark, new_folder(spark, "db"))
    df.select(F.concat_ws(",", *[cell(f) for f in df.schema]).alias("value")).write.text(store.full("rows"))
    for name, size in store.files("rows"):
        if size and name.endswith(".txt"):
            here = local_file(spark)
            store.fs.copyToLocalFile(False, store.path(name), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"file://{here}"), True)
            call(db, spark, "CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(?, ?, ?, NULL, NULL, 'UTF-8', 0)", schema, table, here)
            spark.sparkContext._jvm.java.io.File(here).delete()
    store.delete("")


def discover(spark: SparkSession, db: Database, schema: str, tables: list[str] | None = None, views: bool = False) -> list[Found]:
    """The tables of a schema, views only if asked for. tables None: all but partitions of another table; a list: those,
    partitions too, and one that isn't there is refused; an empty list: none."""
    if tables == []:
        return []
    connection = db.connect(spark)
    try:
        about = connection.getMetaData()
        rows, kinds = about.getTables(None, schema, "%", None), {}
        while rows.next():
            kinds[rows.getString("TABLE_NAME")] = (rows.getString("TABLE_TYPE") or "TABLE").upper()
        wanted = {"TABLE", "BASE TABLE", "PARTITIONED TABLE", *(["VIEW", "MATERIALIZED VIEW"] if views else [])}
        if tables is None:
            leaves = _leaves(connection, schema) if db.url.startswith("jdbc:postgresql") else set()
            names = sorted(n for n, k in kinds.items() if k in wanted and n not in leaves)
        else:
            if lost := [n for n in tables if n not in kinds]:
                raise DatabaseError(f"no table {lost[0]} in {schema}")
            names = list(tables)
        out = []
        for name in names:
            columns, key = [], {}
            rows = about.getColumns(None, schema, name, "%")
            while rows.next():
                if rows.getString("TABLE_NAME") == name:
                    columns.append((rows.getInt("ORDINAL_POSITION"), rows.getString("COLUMN_NAME"), rows.getString("TYPE_NAME"), rows.getInt("NULLABLE") != 0))
            rows = about.getPrimaryKeys(None, schema, name)
            while rows.next():
                key[rows.getInt("KEY_SEQ")] = rows.getString("COLUMN_NAME")
            out.append(Found(name, tuple(c[1:] for c in sorted(columns)), tuple(key[k] for k in sorted(key))))
        return out
    finally:
        connection.close()


def _leaves(connection, schema: str) -> set[str]:
    """Tables that are a part of, or inherit from, another one."""
    ask = connection.prepareStatement("SELECT c.relname FROM pg_inherits i JOIN pg_class c ON c.oid = i.inhrelid JOIN pg_namespace n ON n.oid = c.relnamespace WHERE n.nspname = ?")
    ask.setString(1, schema)
    rows, out = ask.executeQuery(), set()
    while rows.next():
        out.add(rows.getString(1))
    return out


def scan(spark: SparkSession, db: Database, schema: str, table: str, include: list[str] | None = None, exclude: list[str] | None = None, within: Window | None = None, split: str | None = None, tasks: int = 8, fetch: int = 10_000) -> DataFrame:
    """The rows of a table; chosen columns and the window go into the database's query. With split, a column of numbers,
    dates or times, so many tasks read ranges of it side by side. A table without rows still has its columns."""
    options = {**db.options(), "dbtable": db.name(schema, table), "fetchsize": str(fetch)}
    plain = load(spark, db, db.name(schema, table), fetchsize=str(fetch))
    if split is not None:
        if split not in plain.columns:
            raise DatabaseError(f"{table} has no column {split}")
        lo, hi = plain.agg(F.min(split), F.max(split)).first() if not apart(spark, db) else (None, None)
        if lo is not None and lo < hi:
            options |= {"partitionColumn": db.name(split), "lowerBound": str(lo), "upperBound": str(hi), "numPartitions": str(tasks)}
            plain = spark.read.format("jdbc").options(**options).load()
    rows = select_columns(plain, include, exclude)
    if within is None:
        return rows
    check_cursor(rows, within.column)
    return window(rows, within)


def scan_page(rows: DataFrame, column: str, tie: str, n: int, after=None, after_tie=None) -> DataFrame:
    """The next n rows past (after, after_tie) in the order of (column, tie), ties being unique; the limit and its order are
    the database's work. Rows without a cursor aren't in any page."""
    past = rows.filter(F.col(column).isNotNull()) if after is None else keyset_resume(rows, column, tie, after, after_tie)
    return past.orderBy(column, tie).limit(n)


def query_rows(spark: SparkSession, db: Database, sql: str) -> DataFrame:
    """The rows of one SELECT, as a sub-query, so windows on them go into the database too."""
    if re.match(r"\s*\(*\s*(select|with|values)\b", sql, re.I) is None or ";" in sql.rstrip("; \n\t"):
        raise DatabaseError("a query stream takes one SELECT")
    return load(spark, db, f"({sql.rstrip('; ')}) q")
