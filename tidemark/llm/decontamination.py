"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by their number of shingles. Of an item with n shingles, at least t = ceil(least * n) must be in a
document, so the document has one of the n - t + 1 shingles of least hash: these minima are the item's sketch, whose
length grows with the partition's size and loses no pair. A document's shingle hashes probe the sketches, partitions
whose items are too large for the document are left out, and a candidate is verified by its exact shingles.

A benchmark of up to BLOCK_BYTES goes to every task whole. Of a larger one only a bitmap of the sketches does, of at most
8 * WORDS bytes whatever the benchmark; the hashes of documents that it lets pass are joined to the sketches, and the
candidates to the texts on both sides. Either way the documents are read for candidates once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import SPACES, gram_hashes, range_hashes
from ._ids import mark_of, masked, named, unmasked, without
from ._store import cut, small_batches

SHINGLE, LEAST = 5, 0.8
#: Bytes of items that are sent to the executors whole, and 64-bit words of the bitmap for more.
BLOCK_BYTES, WORDS = 2 << 20, 1 << 22
#: Bytes that part words: white space, control characters and ASCII punctuation (fixed value).
PARTING = SPACES.copy()
PARTING[[*range(0x09, 0x0E), *range(0x20, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(PARTING[data], out=solid[1:-1])
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    return turns[::2], turns[1::2]


def hashed(text: str) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, bounds of words, and the hash of each shingle; fewer words than a shingle are one."""
    data = text.encode().lower()
    view = np.frombuffer(data, dtype=np.uint8)
    starts, ends = bounds(view)
    if not len(starts):
        return data, starts, ends, np.zeros(0, dtype=np.uint64)
    return data, starts, ends, gram_hashes(range_hashes(view, starts, ends), min(SHINGLE, len(starts)))


def shingles(data: bytes, starts: np.ndarray, ends: np.ndarray) -> set[bytes]:
    words = [data[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
    return {b" ".join(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def sketch(hashes: np.ndarray, n: int, least: float) -> tuple[int, np.ndarray]:
    """How many of an item's n shingles a document must have, and the least hashes, of which it then has one."""
    must = math.ceil(least * n - 1e-9)
    return must, np.sort(np.unique(hashes))[: n - must + 1]


class Sketches:
    """The sketches of a block of items."""

    def __init__(self, items: list[tuple[int, str]], least: float):
        self.ids, self.sets, rows = [], [], []
        for key, text in items:
            data, starts, ends, hashes = hashed(text)
            own = shingles(data, starts, ends)
            if not own:
                continue
            k, n = len(self.ids), len(own)
            must, minima = sketch(hashes, n, least)
            self.ids.append(key)
            self.sets.append(own)
            rows += [(n.bit_length(), int(h), k) for h in minima]
        # A table for each partition of sizes: hashes, sorted, and the items they stand for.
        self.tables = []
        for size in sorted({r[0] for r in rows}):
            part = sorted((h, k) for s, h, k in rows if s == size)
            smallest = min(math.ceil(least * len(self.sets[k]) - 1e-9) for _, k in part)
            self.tables.append((smallest, np.array([h for h, _ in part], dtype=np.uint64), np.array([k for _, k in part])))

    def found(self, text: str, least: float) -> list[tuple[int, int, int]]:
        """(item, shared, size) of the items that the text contains."""
        data, starts, ends, hashes = hashed(text)
        candidates: set[int] = set()
        for smallest, table, items in self.tables:
            if len(hashes) < smallest:
                break
            lo = np.searchsorted(table, hashes)
            met = table[np.minimum(lo, len(table) - 1)] == hashes
            for h in np.unique(hashes[met]):
                candidates.update(items[np.searchsorted(table, h) : np.searchsorted(table, h, "right")].tolist())
        if not candidates:
            return []
        own = shingles(data, starts, ends)
        shared = ((k, len(own & self.sets[k])) for k in sorted(candidates))
        return [(self.ids[k], n, len(self.sets[k])) for k, n in shared if n >= least * len(self.sets[k]) - 1e-9]


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id, item, shared, size, containment) of every pair of a document and an item of which it holds at least the share
    least of the distinct 5-word shingles (A-Z lower-cased; white space and ASCII punctuation part words).

    A text of fewer than five words is one shingle, so an item of so few is found only where it is a whole document; a text
    without words, or null, is in no pair. Items without an id give null, as documents without one do. Rows of docs that
    repeat give their pairs again, repeated items don't."""
    return pairs(docs, benchmark, id_col, text_col, item_col, item_text_col, least).select(F.col("id").alias(id_col), F.col("item").alias(item_col), "shared", "size", "containment")


PAIR = "id long, mark long, item long, shared long, size long, containment double"


def pairs(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, least: float) -> DataFrame:
    """(id, mark, item, shared, size, containment)."""
    small_batches(docs.sparkSession)
    rows = docs.select(masked(named(id_col)).alias("id"), mark_of(named(text_col)).alias("mark"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    items = benchmark.select(masked(named(item_col)).alias("item"), mark_of(named(item_text_col)).alias("item_mark"), F.coalesce(named(item_text_col), F.lit("")).alias("item_text")).distinct()
    size = items.agg(F.sum(F.octet_length("item_text").cast("long"))).first()[0] or 0
    found = probed(rows, items, least) if size <= BLOCK_BYTES else joined(rows, items, least)
    return found.withColumn("id", unmasked(F.col("id"))).withColumn("item", unmasked(F.col("item")))


def probed(rows: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """Pairs with items that go to every task; there are at most BLOCK_BYTES of them."""
    block = [(r["item"], r["item_text"]) for r in items.toLocalIterator()]
    sent = rows.sparkSession.sparkContext.broadcast(Sketches(block, least))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(key, mark, *x, x[1] / x[2]) for key, mark, text in batch.itertuples(index=False) for x in sent.value.found(text, least)]
            if found:
                yield pd.DataFrame(found, columns=["id", "mark", "item", "shared", "size", "containment"])

    return rows.mapInPandas(run, PAIR)


def joined(rows: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """Pairs with items of any number."""
    def minima(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, mark, text in batch.itertuples(index=False):
                data, starts, ends, hashes = hashed(text)
                if n := len(shingles(data, starts, ends)):
                    must, least_of = sketch(hashes, n, least)
                    yield pd.DataFrame({"hash": least_of.view(np.int64), "item": item, "item_mark": mark, "must": must})

    sketches = cut(items.mapInPandas(minima, "hash long, item long, item_mark long, must long"), "sketches")
    words = min(WORDS, 1 << max(10, (max(1, sketches.count()) // 4).bit_length()))
    place = F.pmod(F.col("hash"), F.lit(64 * words))
    bits = sketches.groupBy((place / 64).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(hash, {64 * words}) % 64 AS INT))")).alias("bits")).toPandas()
    bitmap = np.zeros(words, dtype=np.int64)
    bitmap[bits["word"].to_numpy(dtype=np.int64)] = bits["bits"].to_numpy(dtype=np.int64)
    sent = rows.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sent.value
        for batch in batches:
            for key, mark, text in batch.itertuples(index=False):
                hashes = hashed(text)[3]
                own = np.unique(hashes)
                at = own & np.uint64(64 * len(table) - 1)
                own = own[(table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
                if len(own):
                    yield pd.DataFrame({"hash": own.view(np.int64), "id": key, "mark": mark, "shingles": len(hashes)})

    met = rows.mapInPandas(probes, "hash long, id long, mark long, shingles long")
    candidates = cut(met.join(sketches, "hash").filter("shingles >= must").select("id", "mark", "item", "item_mark").distinct(), "candidates")
    texts = candidates.join(items, ["item", "item_mark"]).join(rows, ["id", "mark"]).select("id", "mark", "text", "item", "item_text")

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, set()
        for batch in batches:
            out = []
            for key, mark, text, item, item_text in batch.itertuples(index=False):
                if last != (key, mark):
                    last, own = (key, mark), shingles(*hashed(text)[:3])
                wanted = shingles(*hashed(item_text)[:3])
                n = len(own & wanted)
                if n >= least * len(wanted) - 1e-9:
                    out.append((key, mark, item, n, len(wanted), n / len(wanted)))
            if out:
                yield pd.DataFrame(out, columns=["id", "mark", "item", "shared", "size", "containment"])

    return texts.mapInPandas(verified, PAIR)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with its columns, that hold no item of the benchmark; items without an id count too. Items of fewer
    than five words are found only where they are a whole document."""
    return without(docs, pairs(docs, benchmark, id_col, text_col, "item_id", "text", LEAST), id_col, text_col)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SHINGLES = r"""
SELECT DISTINCT key, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
       ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
FROM (SELECT {key} AS key, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM {table})
"""
OP8_SQL = f"""
WITH d AS ({_SHINGLES.format(key="doc_id", table="documents")}), b AS ({_SHINGLES.format(key="item_id", table="benchmark")}),
n AS (SELECT key, count(*) AS size FROM b GROUP BY key),
s AS (SELECT d.key AS doc_id, b.key AS item_id, count(*) AS shared FROM d JOIN b USING (g) GROUP BY ALL)
SELECT doc_id, item_id, shared, size, shared / size AS containment FROM s JOIN n ON n.key = s.item_id WHERE shared >= 0.8 * size - 1e-9
"""
