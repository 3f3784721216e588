"""Removing bytes of repeated 200-byte strings, by suffix arrays built with bucket-pointer refinement.

Windows that can repeat are found, and dealt out to tasks, as _repeats.py says. A task sorts all suffixes of its segments:
initial buckets hold the suffixes that begin with the same GRAM bytes, and a bucket is refined by sorting on the bucket
pointers of the suffixes that begin GRAM bytes later (and twice as many, where a sort takes two more pointers), then at
offsets grown two- or threefold, and so on. Buckets are refined in TURNS turns a round, and
a turn reads the pointers that the turns before it in the same round have updated, so buckets are told apart sooner than
by doubling. A suffix alone in its bucket has its place and isn't sorted again. In the array neighbours that share 200
bytes, which are compared, are windows that repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import FACTOR, mixed
from ._ids import unmasked
from ._repeats import SPLIT, Unit, keyed, repeats, spans
from .simhash import whole_groups

WINDOW, GRAM, TURNS = 200, 5, 4
#: Bytes of segments sorted at a time; a route isn't parted, and has at most SPLIT classes.
CHUNK = 1 << 15


def ranked(keys: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of tuples of numbers of so many bits, and whether each in that order differs from the one before."""
    if (len(keys) + 1) * bits <= 64:  # the place goes into the number, so numbers are sorted and not places
        whole = keys[0]
        for key in [*keys[1:], np.arange(len(keys[0]), dtype=np.uint64)]:
            whole = whole << np.uint64(bits) | key
        whole.sort()
        order = (whole & np.uint64((1 << bits) - 1)).astype(np.int64)
        whole >>= np.uint64(bits)
        return order, np.append(True, whole[1:] != whole[:-1])
    order = np.lexsort(keys[::-1])
    return order, np.append(True, np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0))


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """The suffixes of text in order, told apart by at least depth bytes."""
    n, bits = len(text), (len(text) + 1).bit_length()
    offsets = 3 if 4 * bits <= 64 else 2  # pointers that a refinement sorts by: as many as fit in a number
    wide = np.frombuffer(text + bytes(8), dtype=np.uint8)
    grams = np.ndarray(n, dtype=">u8", buffer=wide, strides=(1,)).astype(np.uint64) >> np.uint64(64 - 8 * GRAM)
    if 8 * GRAM + bits <= 64:
        grams = grams << np.uint64(bits) | np.arange(n, dtype=np.uint64)
        grams.sort()
        array = (grams & np.uint64((1 << bits) - 1)).astype(np.int64)
        grams >>= np.uint64(bits)
    else:
        array = np.argsort(grams, kind="stable")
        grams = grams[array]
    begin = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    size = np.diff(np.append(begin, n))
    # A pointer is the first place of the suffix's bucket in the array; what lies past the end is below all.
    pointer = np.zeros(n + 3 * depth + 1, dtype=np.uint64)
    pointer[array] = np.repeat(begin, size).astype(np.uint64) + np.uint64(1)
    active, known = np.flatnonzero(np.repeat(size > 1, size)), GRAM
    while known < depth and len(active):
        bucket = pointer[array[active]]
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        turns = np.unique(np.append(edges[np.linspace(0, len(edges) - 1, min(TURNS, len(edges))).astype(np.int64)], [0, len(active)]))
        left = []
        for lo, hi in zip(turns[:-1].tolist(), turns[1:].tolist(), strict=True):
            places = active[lo:hi]
            suffixes = array[places]
            order, new = ranked([pointer[suffixes + k * known] for k in range(offsets)], bits)
            suffixes = suffixes[order]
            array[places] = suffixes
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, hi - lo))
            pointer[suffixes] = np.repeat(places[begin], size).astype(np.uint64) + np.uint64(1)
            left.append(places[np.repeat(size > 1, size)])
        active, known = np.concatenate(left), offsets * known
    return array


def repeated_windows(segments: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the segments in their concatenation, and whether the window at each place of it is met elsewhere in it."""
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    text = b"".join(segments)
    met = np.zeros(len(text), dtype=bool)
    left = np.repeat(begin + sizes, sizes) - np.arange(len(text))  # bytes left in the segment
    array = suffix_array(text, window)
    array = array[left[array] >= window]
    one, other = array[:-1], array[1:]
    wide = np.frombuffer(text + bytes(8), dtype=np.uint8)
    for k in range(0, window, 8):
        if window - k >= 8:
            words = np.ndarray(len(text), dtype="<u8", buffer=wide, strides=(1,))
            same = words[one + k] == words[other + k]
            one, other = one[same], other[same]
        else:
            for j in range(k, window):
                same = wide[one + j] == wide[other + j]
                one, other = one[same], other[same]
    met[one] = met[other] = True
    return begin, met


class Bytes(Unit):
    window, gram, ordered = WINDOW, 32, False

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.gram = max(8, min(32, window // 2 // 8 * 8))

    def cut(self, text: str) -> bytes:
        return text.encode()

    def grams(self, units: bytes) -> np.ndarray:
        words = np.ndarray(len(units) - 7, dtype="<u8", buffer=units, strides=(1,)).copy()
        n = len(units) - self.gram + 1
        out = words[:n] * np.uint64(FACTOR)
        for k in range(8, self.gram, 8):
            out = mixed(out + words[k : k + n]) if k == 8 else (out + words[k : k + n]) * np.uint64(FACTOR)
        return mixed(out)

    def content(self, units: bytes, first: int, stop: int) -> bytes:
        return units[first:stop]

    def units(self, content: bytes) -> bytes:
        return content

    def whole(self, pairs: list[tuple[bytes, bytes]]) -> list[bool]:
        out: list[bool] = []
        for some in chunks(pairs, [len(a) + len(b) for a, b in pairs], np.ones(len(pairs), dtype=bool)):
            begin, met = repeated_windows([x for pair in some for x in pair], self.window)
            out += [bool(met[b : b + len(pair[1]) - self.window + 1].all()) and len(pair[0]) == len(pair[1]) for b, pair in zip(begin[1::2].tolist(), some, strict=True)]
        return out

    def compare(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for rows in whole_groups(batches, ["route"]):
            held.append(rows[~rows.duplicated(["route", "d1", "d2"])])
            if sum(len(c) for r in held for c in r["content"]) >= CHUNK:
                yield from self.sort(held)
                held = []
        if held:
            yield from self.sort(held)

    def sort(self, held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(held, ignore_index=True)
        route = rows["route"].to_numpy()
        sizes = rows["content"].str.len().to_numpy() * rows["copies"].to_numpy()
        columns = [rows[c].tolist() for c in ("route", "d1", "d2", "least", "copies", "open", "content")]
        for some in chunks(list(zip(*columns, strict=True)), sizes, np.append(True, route[1:] != route[:-1])):
            # Every copy of a class has its instance next to it, so the class is met by what it shares with itself as well.
            begin, met = repeated_windows([row[6] for row in some for _ in range(row[4])], self.window)
            out, at = [], 0
            for *key, copies, wanted, content in some:
                b, at = begin[at], at + copies
                flags = met[b : b + len(content) - self.window + 1]
                if wanted and flags.any():
                    turns = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
                    out += [(*key, True, i, j) for i, j in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
            if out:
                yield pd.DataFrame(out, columns=["route", "d1", "d2", "least", "strict", "a", "b"])


def chunks(rows: list, sizes, begins) -> Iterator[list]:
    """Rows in parts of about CHUNK bytes that begin where begins is true."""
    total, at = np.cumsum(sizes), 0
    cuts = [0]
    for k in np.flatnonzero(begins)[1:].tolist():
        if total[k - 1] - at >= CHUNK:
            cuts.append(k)
            at = total[k - 1]
    for lo, hi in zip(cuts, [*cuts[1:], len(rows)], strict=True):
        if hi > lo:
            yield rows[lo:hi]


def suffix_array_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = True, split: int = SPLIT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, removed, kept) of every row.

    Each byte covered by a string of window bytes that also starts elsewhere, in the same or another document, goes.
    Null counts as empty. Rows that repeat an id are documents of their own; rows that repeat all are copies. A null id
    stays null; an empty table gives an empty result. removed holds the spans and kept the bytes left (texts=False
    leaves both out)."""
    own = keyed(docs, id_col, text_col)
    found = repeats(own, Bytes(window), split, "byte-repeats")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, where in batch[["id", "text", "found"]].itertuples(index=False):
                data = text.encode()
                gone = spans(where, window) if where is not None else []
                edges = [0, *(x for span in gone for x in span), len(data)]
                kept = b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True))
                row = (key, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
                out.append((*row, [list(x) for x in gone], kept) if texts else row)
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["removed", "kept"] * texts]
            yield pd.DataFrame(out, columns=names)

    kind = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", removed array<array<long>>, kept binary" * texts
    return own.join(found, ["id", "m1", "m2"], "left").mapInPandas(run, kind).withColumn("id", unmasked(F.col("id"))).withColumnRenamed("id", id_col)


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)


OP4_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, k, md5_number(b[k + 1 : k + 200]) AS h FROM (SELECT r, b, unnest(range(0, octet_length(b) - 199)) AS k FROM d)),
m AS (SELECT r, k FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
t AS (SELECT r, k, CASE WHEN k <= lag(k) OVER o + 200 THEN 0 ELSE 1 END AS first FROM m WINDOW o AS (PARTITION BY r ORDER BY k)),
s AS (SELECT r, min(k) AS a, max(k) + 200 AS z FROM (SELECT r, k, sum(first) OVER (PARTITION BY r ORDER BY k) AS g FROM t) GROUP BY r, g),
p AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS z FROM (SELECT * FROM s UNION ALL SELECT r, octet_length(b), octet_length(b) FROM d)),
n AS (SELECT r, count(*) AS n_spans, sum(z - a) AS n_removed FROM s GROUP BY r),
l AS (SELECT p.r, string_agg(hex(b[p.a + 1 : p.z]), '' ORDER BY p.a, p.z) AS x FROM p JOIN d USING (r) GROUP BY p.r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(x)) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN l USING (r)
"""
