"""Token ids in block files: each document compressed by itself with one shared zstandard dictionary.

A block holds consecutive documents: a header with the dictionary's SHA-256, an index (id, tokens, offset) and a frame
for each document, so one short document is read without the others. Spark's writer puts blocks into files (one row a
block), sorted by id over the files, beside a manifest with the dictionary and each part's first token position; a lost
executor's part is written anew and committed once.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_folder
from ._chunks import stretches
from ._ids import NO_ID, mark_of, masked, named, unique, unmasked

#: Documents sampled for the dictionary, ids of each that count, and the dictionary's size: fixed bounds at every input size.
SAMPLE_DOCS, SAMPLE_IDS, DICT_BYTES = 1000, 16_384, 65_536
#: Bytes of frames after which a block closes, bytes of input for which there is a part, where these are more than Spark's
#: shuffle partitions, and stretches kept encoded in a worker.
BLOCK_BYTES, PART_BYTES, KEPT = 1 << 20, 256 << 20, 1_200_000
#: Level of the compression.
LEVEL = 3
#: Texts encoded together.
TOGETHER = 128
#: Stretches joined for the library, and how the vocabulary spells a leading space.
JOINED, SPACE = 64, chr(0x120)
MAGIC, HEAD = b"TMID", struct.Struct("<4sHB32sI")


class Slots(dict):
    """A number for each stretch, given out as stretches are asked for; fresh has those of which no ids are known yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, stretch: str) -> int:
        n = self[stretch] = len(self)
        self.fresh.append(stretch)
        return n


class LibraryEncoder:
    """A tokenizers file. Each stretch goes to the library once; the ids of those met lately are kept in one array."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.spaced[[i for x, i in vocabulary.items() if x.startswith(SPACE)]] = True
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.forget()

    def forget(self) -> None:
        self.slots = Slots()
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.ends = np.zeros(1 << 14, dtype=np.int64)  # of slot n: place n + 1

    def learn(self) -> None:
        """Encode the fresh stretches."""
        fresh, known = self.slots.fresh, len(self.slots) - len(self.slots.fresh)
        sizes = np.zeros(len(fresh), dtype=np.int64)
        plain = np.array([" " not in x for x in fresh])
        # Of stretches without a space the first token, and no other, has one: joined ones are told apart by it.
        order = np.append(np.flatnonzero(plain), np.flatnonzero(~plain))
        joined = [fresh[k] for k in order[: plain.sum()]]
        groups = [" " + " ".join(joined[k : k + JOINED]) for k in range(0, len(joined), JOINED)] + [" " + fresh[k] for k in order[plain.sum() :]]
        ids, ends = array("I"), []
        for e in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False):
            ids.extend(e.ids)
            ends.append(len(ids))
        ids = np.frombuffer(ids, dtype=np.uint32)
        n = -(-len(joined) // JOINED)
        stop = ends[n - 1] if n else 0
        begins = np.append(np.flatnonzero(self.spaced[ids[:stop]]), [stop, *ends[n:]][: len(fresh) - len(joined) + 1])
        if len(begins) != len(fresh) + 1:
            raise ValueError("the vocabulary isn't of the byte-level kind")
        sizes[order] = np.diff(begins)
        place = np.empty(len(fresh), dtype=np.int64)
        place[order] = begins[:-1]
        ends = np.cumsum(sizes)
        ids = ids[np.repeat(place - (ends - sizes), sizes) + np.arange(len(ids))]
        start, total = int(self.ends[known]), int(self.ends[known]) + len(ids)
        if total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(total, len(self.ids)), dtype="<u4")))
        if len(self.slots) + 1 > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros(max(len(self.slots) + 1, len(self.ends)), dtype=np.int64)))
        self.ids[start:total] = ids
        self.ends[known + 1 : len(self.slots) + 1] = start + np.cumsum(sizes)
        fresh.clear()

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as little-endian 32-bit numbers."""
        if len(self.slots) > KEPT:
            self.forget()
        heads, places, counts = [], [], []
        for text in texts:
            # A text with the string of an added token goes to the library whole.
            head, *rest = [text] if self.added and self.added.search(text) else stretches(text)
            heads.append(head)
            counts.append(len(rest))
            places.append(np.fromiter(map(self.slots.__getitem__, rest), dtype=np.int64, count=len(rest)))
        firsts = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(heads, add_special_tokens=False)]
        if self.slots.fresh:
            self.learn()
        if not places:
            return firsts
        place = np.concatenate(places)
        start = self.ends[place]
        size = self.ends[place + 1] - start
        ends = np.cumsum(size)
        flat = self.ids[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        return [np.concatenate((first, flat[i:j])) if i < j else first for first, i, j in zip(firsts, bounds.tolist(), bounds[1:].tolist(), strict=False)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]


@functools.cache
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def train_dictionary(docs: DataFrame, path: str, end: int) -> bytes:
    """A dictionary from the ids of SAMPLE_DOCS documents, taken by a hash of their id; empty if there is too little."""
    chosen = docs.select("id").filter(F.col("id") != NO_ID).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    keys = [r.id for r in chosen.collect()]
    own = library_encoder(path)
    kind = "<u4" if own.wide else "<u2"
    # Of an id that repeats one text is taken; a dictionary changes the size of the files only, so beginnings do for it.
    begin = F.substring("text", 1, 4 * SAMPLE_IDS).alias("text")
    rows = docs.filter(F.col("id").isin(keys)).groupBy("id").agg(F.min(begin).alias("text")).collect() if keys else []
    texts = sorted(r.text or "" for r in rows)
    samples = [np.append(own.encode(t)[:SAMPLE_IDS], end).astype(kind).tobytes() for t in texts]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b""


def pack(rows: list[tuple[int | None, int, bytes]], dictionary_hash: bytes, wide: bool) -> bytes:
    """A block of (id, tokens, frame)."""
    index = np.zeros(len(rows), dtype=[("null", "u1"), ("id", "<i8"), ("tokens", "<i8"), ("offset", "<i8")])
    index["null"] = [i is None for i, _, _ in rows]
    index["id"] = [i or 0 for i, _, _ in rows]
    index["tokens"] = [n for _, n, _ in rows]
    index["offset"] = np.cumsum([0, *(len(f) for _, _, f in rows)])[:-1]
    return HEAD.pack(MAGIC, 1, 4 if wide else 2, dictionary_hash, len(rows)) + index.tobytes() + b"".join(f for _, _, f in rows)


class Block:
    """A packed block; ids(k) decompresses one document only."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, version, self.width, own, n = HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("no block of token ids, or one of a newer format: upgrade the reader")
        if own != hashlib.sha256(dictionary).digest():
            raise ValueError("the block was written with another dictionary")
        self.data, self.reader = data, decompressor(dictionary)
        self.index = np.frombuffer(data, dtype=[("null", "u1"), ("id", "<i8"), ("tokens", "<i8"), ("offset", "<i8")], count=n, offset=HEAD.size)
        self.base = HEAD.size + self.index.nbytes
        self.ends = np.append(self.index["offset"][1:], len(data) - self.base)

    def ids(self, k: int) -> np.ndarray:
        frame = self.data[self.base + self.index["offset"][k] : self.base + self.ends[k]]
        return np.frombuffer(self.reader.decompress(frame), "<u4" if self.width == 4 else "<u2").astype("<u4")


@functools.cache
def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


@functools.cache
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=LEVEL)


def write_token_ids(docs: DataFrame, folder: str, path: str, end: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text (null: empty), each followed by end, in ascending id order.

    A null id comes first; rows that repeat an id stay apart, in the order of a hash of the text, then of the text, so
    neither gathers in a task. An empty table writes a manifest only.
    Folder gets blocks/, parts/ (first token of each part) and dictionary/.
    """
    spark = docs.sparkSession
    keys = [F.col("id")] if unique(docs, id_col) else [F.col("id"), mark_of(F.col("text"))]
    docs = docs.select(masked(named(id_col)).alias("id"), named(text_col).alias("text"))
    dictionary = train_dictionary(docs, path, end)
    digest = hashlib.sha256(dictionary).digest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, press, part = library_encoder(path), compressor(dictionary), TaskContext.get().partitionId()
        rows, size, block, start = [], 0, 0, 0

        def close() -> pd.DataFrame:
            ids = [NO_ID if i is None else i for i, _, _ in rows]
            return pd.DataFrame({"part": [part], "block": [block], "first_id": [min(ids)], "last_id": [max(ids)], "start": [start], "tokens": [sum(n for _, n, _ in rows)], "data": [pack(rows, digest, own.wide)]})

        tail = np.array([end], dtype="<u4")
        for batch in batches:
            texts = batch["text"].tolist()
            encoded = (ids for k in range(0, len(texts), TOGETHER) for ids in own.encode_many([t or "" for t in texts[k : k + TOGETHER]]))
            for key, ids in zip(batch["id"].tolist(), encoded, strict=True):
                ids = np.append(ids, tail)
                frame = press.compress((ids if own.wide else ids.astype("<u2")).tobytes())
                rows.append((None if key == NO_ID else int(key), len(ids), frame))
                size += len(frame)
                if size >= BLOCK_BYTES:
                    yield close()
                    start += sum(n for _, n, _ in rows)
                    rows, size, block = [], 0, block + 1
        if rows:
            yield close()

    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # as the planner knows it
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), min(size, 1 << 50) // PART_BYTES)
    dealt = docs.repartitionByRange(parts, *keys).sortWithinPartitions(*keys, F.coalesce("text", F.lit("")))
    blocks = dealt.mapInPandas(run, "part int, block int, first_id long, last_id long, start long, tokens long, data binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    # A row for each part, of PART_BYTES of the input or more.
    sums = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("tokens").alias("tokens")).orderBy("part").collect()
    firsts = np.cumsum([0, *(r.tokens for r in sums)])
    spark.createDataFrame([(r.part, int(n)) for r, n in zip(sums, firsts, strict=False)], "part int, first long").coalesce(1).write.parquet(f"{folder}/parts")
    spark.createDataFrame([(digest.hex(), bytearray(dictionary))], "sha256 string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")


def read_token_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document in the files; ids=False leaves the arrays out."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["data"])
    firsts = {r.part: r.first for r in spark.read.parquet(f"{folder}/parts").collect()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                block = Block(row.data, dictionary)
                own = [block.ids(k) for k in range(len(block.index))]
                counts = np.array([len(x) for x in own], dtype=np.int64)
                out = {
                    "id": np.where(block.index["null"] == 1, NO_ID, block.index["id"]), "start": firsts[row.part] + row.start + np.cumsum(counts) - counts,
                    "n_tokens": counts, "ids_crc32": [zlib.crc32(x.tobytes()) for x in own],
                }
                yield pd.DataFrame(out | ({"ids": [x.astype(np.int64) for x in own]} if ids else {}))

    kind = "id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    return spark.read.parquet(f"{folder}/blocks").select("part", "start", "data").mapInPandas(run, kind).withColumn("id", unmasked(F.col("id")))


def read_document(spark: SparkSession, folder: str, key: int) -> np.ndarray | None:
    """The ids of one document: only blocks whose range of ids has it are read, and of these its frame by their index."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["data"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                block = Block(data, dictionary)
                for k in np.flatnonzero((block.index["id"] == key) & (block.index["null"] == 0))[:1]:
                    yield pd.DataFrame({"ids": [block.ids(int(k)).astype(np.int64)]})

    blocks = spark.read.parquet(f"{folder}/blocks").filter((F.col("first_id") <= key) & (F.col("last_id") >= key))
    row = blocks.select("data").mapInPandas(run, "ids array<long>").first()
    return None if row is None else np.array(row["ids"], dtype=np.int64)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "token-ids")
    write_token_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_ids(spark, folder, ids=False).withColumnRenamed("id", "doc_id")
