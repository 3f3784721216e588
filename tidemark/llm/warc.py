"""WARC files: written as request, response (or revisit) and metadata records, read back and assembled by transaction.

Records go through Spark's text writer, whose line separator is the two line ends that close a record, so any file
system and commit protocol of the cluster serves, and a file holds whole records only, of PAGES pages at most. Reading
unzips a piece at a time and parses by Content-Length, so beside a file's compressed bytes a worker holds one record and
the rows of HELD bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_folder
from ._ids import named
from ._store import cut

#: Payloads of fewer bytes are always stored whole.
LEAST = 100
#: Pages in a file, bytes unzipped at a time, and bytes of records that a worker gives on together.
PAGES, PIECE, HELD = 5000, 1 << 20, 16 << 20
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, record_id: Column, url: Column, body: Column, content: str, *more: tuple[str, Column]) -> Column:
    """Text of a record without the line ends that close it."""
    head = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:capture:"), record_id, F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), url]
    for name, value in more:
        head += [F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"\r\n{name}: "), value))]
    return F.concat(*head, F.lit(f"\r\nContent-Type: {content}\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END), body)


def first_captures(pages: DataFrame) -> DataFrame:
    """pages with digest, size, tid and first: tid names a row's transaction, first is (id, tid) of a row with the smallest id
    among equal payloads of LEAST bytes or more, where there are several ids.

    The tid is the id; where an id is null or repeats, a number of the row follows, and the rows are cut so that it stays."""
    pages = pages.withColumn("digest", F.sha2("body", 256)).withColumn("size", F.octet_length("body").cast("long"))
    repeats = lambda df: df.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id", F.lit(True).alias("again"))
    if pages.filter("id is null").select("id").union(repeats(pages).select("id")).isEmpty():
        facts, keys = pages.withColumn("tid", F.col("id").cast("string")), ["digest", "size"]
        pages = facts
    else:
        pages, keys = cut(pages.withColumn("number", F.monotonically_increasing_id()), "warc-pages"), ["number"]
        facts = pages.drop("url", "body")
        numbered = F.concat_ws(".", F.coalesce(F.col("id").cast("string"), F.lit("none")), F.col("number").cast("string"))
        facts = facts.join(repeats(facts), "id", "left").withColumn("tid", F.when(F.col("id").isNull() | F.col("again"), numbered).otherwise(F.col("id").cast("string")))
    long = facts.filter(F.col("size") >= LEAST).filter("id is not null")
    firsts = long.groupBy("digest", "size").agg(F.min(F.struct("id", "tid")).alias("first"), F.max("id").alias("last")).filter("first.id < last").drop("last")
    if keys == ["number"]:
        firsts = facts.join(firsts, ["digest", "size"], "left").select("number", "tid", "first")
    return pages.join(firsts, keys, "left")


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write three records of every page. A null payload counts as empty and a null address is written as urn:none. Each row
    is a transaction of its own, also where its id repeats or is null; a null id is left out of its metadata, and such a row
    is always a response. An empty table writes no record."""
    clean = F.regexp_replace(F.coalesce(F.nullif(named(url_col), F.lit("")), F.lit("urn:none")), r"[\r\n]", " ")
    pages = pages.select(named(id_col).cast("long").alias("id"), clean.alias("url"), F.coalesce(named(payload_col), F.lit("")).alias("body"))
    key, pages = F.col("tid"), first_captures(pages)
    revisit = F.coalesce(F.col("first.id") != F.col("id"), F.lit(False))
    main, told = F.concat(key, F.lit(":main")), F.concat(F.lit("<urn:capture:"), key, F.lit(":main>"))
    digest, http = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    response = record("response", main, F.col("url"), F.concat(http, F.col("body")), "application/http; msgtype=response", digest)
    again = record("revisit", main, F.col("url"), http, "application/http; msgtype=response", digest, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", F.concat(F.lit("<urn:capture:"), F.col("first.tid"), F.lit(":main>"))))
    request = record("request", F.concat(key, F.lit(":request")), F.col("url"), F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")), "application/http; msgtype=request", ("WARC-Concurrent-To", told))
    page = F.coalesce(F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit(""))  # absent where null
    facts = F.concat(F.lit("capture: "), key, F.lit("\r\n"), page, F.lit("payload-length: "), F.col("size").cast("string"), F.lit("\r\n"))
    metadata = record("metadata", F.concat(key, F.lit(":metadata")), F.col("url"), facts, "application/warc-fields", ("WARC-Concurrent-To", told))
    three = pages.select(F.concat_ws(END, request, F.when(revisit, again).otherwise(response), metadata).alias("value"))
    three.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", str(PAGES)).text(folder)


def unzipped(content: bytes) -> Iterator[bytes]:
    """The bytes of a file of one or more gzip members, in pieces."""
    reader = zlib.decompressobj(31)
    while content:
        piece = reader.decompress(content, PIECE)
        if piece:
            yield piece
        if reader.eof:
            content, reader = reader.unused_data, zlib.decompressobj(31)
        else:
            content = reader.unconsumed_tail
            if not content and not piece:
                break
    if rest := reader.flush():
        yield rest


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, names in lower case, and block of each record of the bytes that come in pieces."""
    held, done, pieces = bytearray(), 0, iter(pieces)

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while held or more():
        while (stop := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if stop < 0 or not held.startswith(b"WARC/1."):
            raise ValueError(f"no record at byte {done}")
        heads = dict(line.split(": ", 1) for line in held[:stop].decode().split("\r\n")[1:])
        heads = {k.lower(): v for k, v in heads.items()}
        size = int(heads["content-length"])
        end = stop + 4 + size
        while len(held) < end + 4 and more():
            pass
        if held[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record of {size} bytes at byte {done} isn't closed")
        yield heads, bytes(held[stop + 4 : end])
        del held[: end + 4]
        done += end + 4


KIND = "kind string, record_id string, concurrent_to string, refers_to string, url string, digest string, bytes long, fields map<string,string>, payload binary"


def read_records(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """A row for each record. Digests of stored payloads are computed anew and must equal those written."""

    names = [x.split(" ")[0] for x in KIND.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for heads, block in parse(unzipped(content)):
                    kind = heads["warc-type"]
                    body = block.split(b"\r\n\r\n", 1)[1] if kind == "response" else b""
                    told = heads.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    if kind == "response" and hashlib.sha256(body).hexdigest() != told:
                        raise ValueError(f"the payload of {heads['warc-record-id']} doesn't have its digest")
                    fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if x) if kind == "metadata" else None
                    rows.append((kind, heads["warc-record-id"], heads.get("warc-concurrent-to"), heads.get("warc-refers-to"), heads.get("warc-target-uri"), told, len(body), fields, body if payload else None))
                    size += len(block)
                    if size >= HELD:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInPandas(run, KIND)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: its response or revisit record joined to the request and the metadata that name it.
    The records are used three times: give them cut where reading them is dear."""
    part = lambda kind: records.filter(F.col("kind") == kind)
    main = records.filter(F.col("kind").isin("response", "revisit")).select("record_id", F.struct("kind", "record_id", "url", "digest", "bytes", "refers_to", "payload").alias("response"))
    request = part("request").select(F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("request_id"), "url").alias("request"))
    metadata = part("metadata").select(F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("metadata_id"), "fields").alias("metadata"))
    return main.join(request, "record_id", "left").join(metadata, "record_id", "left")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), folder)
    return captured_pages(cut(read_records(spark, folder, payload=False), "warc-records"))


def captured_pages(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, a page_id, of each capture. A response whose stored
    payload hasn't the length that its metadata tells fails."""
    fields, response, told = F.col("metadata.fields"), F.col("response.kind") == "response", F.col("response.refers_to")
    size = fields["payload-length"].cast("long")
    wrong = F.raise_error(F.concat(F.lit("another length than told: "), F.col("response.record_id"))).cast("long")
    return assemble(records).select(
        fields["page-id"].cast("long").alias("page_id"), F.when(~response | (size == F.col("response.bytes")), size).otherwise(wrong).alias("payload_bytes"), F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"), F.when(told.isNotNull(), F.regexp_extract(told, r"<urn:capture:(-?\d+)(\.\d+)?:main>", 1).cast("long")).alias("refers_to"),
    )


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (SELECT page_id, strlen(t) AS payload_bytes, sha256(t) AS payload_digest, min(page_id) OVER (PARTITION BY t) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM q
"""
