"""Files of whatever file system Spark's paths name, through Hadoop's client on the driver; and the shared folder."""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.made_path, self.folders = self.jvm.org.apache.hadoop.fs.Path, set()  # each step of a name in the JVM is a call of its own
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.made_path(f"{self.root}/{name}" if name else self.root)

    def full(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Whole or not at all: a file beside it takes its name."""
        beside = self.path(f"{name}.new")
        self.fs.mkdirs(beside.getParent())
        stream = self.fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self.path(name)
        if self.fs.exists(target):
            self.fs.delete(target, False)
        if not self.fs.rename(beside, target):
            raise OSError(f"{name} can't be written")

    def create(self, name: str, value) -> bool:
        """Write a document that isn't there yet; of several at once one succeeds."""
        target = self.path(name)
        self.fs.mkdirs(target.getParent())
        try:
            stream = self.fs.create(target, False)
        except Exception:  # noqa: BLE001  the file system's own error for a file that is there
            if self.fs.exists(target):
                return False
            raise
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        stream.close()
        return True

    def read_json(self, name: str):
        text = self.read(name)
        if text is None and (text := self.read(f"{name}.new")) is None:  # ended between delete and rename
            return None
        return json.loads(text)

    def write_json(self, name: str, value) -> None:
        self.write(name, json.dumps(value, sort_keys=True))

    def rename(self, a: str, b: str) -> None:
        target = self.path(b)
        if (folder := b.rpartition("/")[0]) not in self.folders:
            self.fs.mkdirs(target.getParent())
            self.folders.add(folder)
        if self.fs.exists(target):
            self.fs.delete(target, False)
        if not self.fs.rename(self.path(a), target):
            raise OSError(f"{a} can't become {b}")

    def delete(self, name: str) -> None:
        self.folders.clear()
        self.fs.delete(self.path(name), True)

    def files(self, name: str, deep: bool = True) -> list[tuple[str, int]]:
        """(name below root, bytes) of the files below a folder, sorted. By listStatus, as listFiles asks for the rights of
        each file, for which a local file system runs a program."""
        if not self.exists(name):
            return []
        found, folders = [], [name]
        while folders:
            folder = folders.pop()
            for s in self.fs.listStatus(self.path(folder)):
                at = f"{folder}/{s.getPath().getName()}" if folder else s.getPath().getName()
                if not s.isDirectory():
                    found.append((at, s.getLen()))
                elif deep:
                    folders.append(at)
        return sorted(found)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master gets one made where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", f"tidemark-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder of its own below the shared one, deleted when the driver ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    atexit.register(drop, spark, path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder if the session still lives."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may have ended
        pass


class Files:
    """Single files of any file system that Spark's paths can name, looked at from the driver."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.conf), path

    def stat(self, name: str) -> tuple[int, int] | None:
        """Bytes and time of change; None where there is no file."""
        fs, path = self.at(name)
        if not fs.exists(path):
            return None
        status = fs.getFileStatus(path)
        return status.getLen(), status.getModificationTime()

    def is_folder(self, name: str) -> bool:
        fs, path = self.at(name)
        return fs.exists(path) and fs.getFileStatus(path).isDirectory()

    def below(self, folder: str) -> list[str]:
        """Names of all files below a folder, written as the folder is."""
        fs, path = self.at(folder)
        if not fs.exists(path):
            return []
        base, out, walk = fs.makeQualified(path).toUri().getPath().rstrip("/"), [], fs.listFiles(path, True)
        while walk.hasNext():
            out.append(folder.rstrip("/") + walk.next().getPath().toUri().getPath()[len(base) :])
        return sorted(out)

    def read(self, name: str, start: int, n: int) -> bytes:
        """At most n bytes from start."""
        fs, path = self.at(name)
        n = max(0, min(n, fs.getFileStatus(path).getLen() - start))
        stream = fs.open(path)
        try:
            stream.seek(start)
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n)) if n else b""
        finally:
            stream.close()

    def row_groups(self, name: str) -> tuple[str, list[tuple[int, int]]]:
        """The schema of a Parquet file as text, and (rows, bytes) of its row groups."""
        hadoop, parquet = self.jvm.org.apache.hadoop.fs, self.jvm.org.apache.parquet.hadoop
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(hadoop.Path(name), self.conf))
        try:
            footer = reader.getFooter()
            return footer.getFileMetaData().getSchema().toString(), [(b.getRowCount(), b.getTotalByteSize()) for b in footer.getBlocks()]
        finally:
            reader.close()
