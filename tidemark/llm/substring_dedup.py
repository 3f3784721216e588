"""Removing words of 50-word windows that a document with a smaller id has, by suffix automata of reference shards.

Windows that can repeat are found, and dealt out to tasks, as _repeats.py says. In a route the classes of segments, in
order of their least id, are the reference: shards of SHARD of them are made into suffix automata, and segments of larger
ids, of other classes and of their own, stream through the automata of all shards for matching statistics; where these
reach the window's length, the window is covered. The automata of a route's shards go to the task of that route, not to
every task: an automaton of another route can't match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import gram_hashes, range_hashes, word_bounds
from ._ids import unmasked
from ._repeats import SPLIT, Unit, keyed, repeats, spans
from .simhash import whole_groups

WINDOW, GRAM = 50, 8
#: Segments in an automaton.
SHARD = 256


class Words(Unit):
    window, gram, ordered = WINDOW, GRAM, True

    def __init__(self, window: int = WINDOW):
        self.window, self.gram = window, max(1, min(GRAM, window // 2))

    def cut(self, text: str) -> list[bytes]:
        return text.encode().split()  # of bytes: at 0x20 and 0x09 to 0x0D only

    def grams(self, units: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b" ".join(units), dtype=np.uint8)
        return gram_hashes(range_hashes(data, *word_bounds(data)), self.gram)

    def content(self, units: list[bytes], first: int, stop: int) -> bytes:
        return b" ".join(units[first:stop])

    def units(self, content: bytes) -> list[bytes]:
        return content.split(b" ")

    def whole(self, pairs: list[tuple[bytes, bytes]]) -> list[bool]:
        out = []
        for one, other in pairs:
            shard, words = Automaton(), other.split(b" ")
            shard.add(one.split(b" "))
            out.append(len(shard.reaches(words, self.window)) == len(words) - self.window + 1)
        return out

    def compare(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["route"]):
            rows = rows[~rows.duplicated(["route", "d1", "d2"])]
            route = rows["route"].to_numpy()
            begin = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
            columns = [rows[c].tolist() for c in ("route", "d1", "d2", "least", "last", "content")]
            out: list[tuple] = []
            for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(rows)], strict=True):
                route_of(self.window, list(zip(*(c[lo:hi] for c in columns), strict=True)), out)
            if out:
                yield pd.DataFrame(out, columns=["route", "d1", "d2", "least", "strict", "a", "b"])


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[bytes]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            q = nxt[last].get(w)
            p, now = last, q
            if q is None:
                now = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                while p >= 0 and w not in nxt[p]:
                    nxt[p][w] = now
                    p = link[p]
                q = nxt[p][w] if p >= 0 else None
            if q is not None and length[q] == length[p] + 1:
                if now != q:
                    link[now] = q
            elif q is not None:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = copy
                if now == q:
                    now = copy
                else:
                    link[now] = copy
                while p >= 0 and nxt[p].get(w) == q:
                    nxt[p][w] = copy
                    p = link[p]
            last = now

    def reaches(self, words: list[bytes], least: int) -> list[int]:
        """Starts of the windows of least words that are in the automaton."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        out = []
        for k, w in enumerate(words, 1):
            while (to := nxt[state].get(w)) is None and state:
                state = link[state]
                matched = length[state]
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched >= least:
                out.append(k - least)
        return out


def route_of(window: int, rows: list[tuple], out: list[tuple]) -> None:
    """Adds FOUND of a route's classes (route, d1, d2, least, last, content), which come in order of least."""
    shards: list[Automaton] = []
    filled = SHARD
    k = 0
    while k < len(rows):
        stop = k
        while stop < len(rows) and rows[stop][3] == rows[k][3]:
            stop += 1
        words = [row[5].split(b" ") for row in rows[k:stop]]
        if shards:
            for row, own in zip(rows[k:stop], words, strict=True):
                stretches(row[:4], True, shards, own, window, out)
        if stop < len(rows) or any(row[4] > row[3] for row in rows[k:stop]):
            for own in words:
                if filled == SHARD:
                    shards.append(Automaton())
                    filled = 0
                shards[-1].add(own)
                filled += 1
            for row, own in zip(rows[k:stop], words, strict=True):
                if row[4] > row[3]:  # members of larger ids stream through it too
                    stretches(row[:4], False, shards, own, window, out)
        k = stop


def stretches(key: tuple, strict: bool, shards: list[Automaton], words: list[bytes], window: int, out: list[tuple]) -> None:
    """Adds the stretches of windows of words that the shards hold."""
    hits = sorted({x for shard in shards for x in shard.reaches(words, window)})
    begin = None
    for k, x in enumerate(hits):
        begin = x if begin is None else begin
        if k + 1 == len(hits) or hits[k + 1] > x + 1:
            out.append((*key, strict, begin, x + 1))
            begin = None


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = True, split: int = SPLIT) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, removed, kept) of every row.

    Each word covered by a window whose words also start in a document with a smaller id goes. Null texts have no words.
    A null id is smaller than any other and stays null; rows that repeat an id don't cover one another; an empty table
    gives an empty result. removed holds the spans of words and kept the words left, joined by a space (texts=False
    leaves both out)."""
    own = keyed(docs, id_col, text_col)
    found = repeats(own, Words(window), split, "word-repeats")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, where in batch[["id", "text", "found"]].itertuples(index=False):
                words = text.encode().split()
                gone = spans(where, window) if where is not None else []
                edges = [0, *(x for span in gone for x in span), len(words)]
                left = [w for i, j in zip(edges[::2], edges[1::2], strict=True) for w in words[i:j]] if gone else words
                kept = b" ".join(left)
                row = (key, len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest())
                out.append((*row, [list(x) for x in gone], kept.decode()) if texts else row)
            yield pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept_sha256", "removed", "kept"][: 6 if texts else 4])

    kind = "id long, n_words long, n_removed long, kept_sha256 string" + ", removed array<array<long>>, kept string" * texts
    return own.join(found, ["id", "m1", "m2"], "left").mapInPandas(run, kind).withColumn("id", unmasked(F.col("id"))).withColumnRenamed("id", id_col)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), texts=False)


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775807) AS i, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS v FROM documents),
w AS (SELECT r, i, k, md5_number(array_to_string(v[k + 1 : k + 50], ' ')) AS h FROM (SELECT r, i, v, unnest(range(0, len(v) - 49)) AS k FROM d)),
m AS (SELECT r, k FROM w JOIN (SELECT h, min(i) AS least FROM w GROUP BY h) USING (h) WHERE i > least),
t AS (SELECT r, k, CASE WHEN k <= lag(k) OVER o + 50 THEN 0 ELSE 1 END AS first FROM m WINDOW o AS (PARTITION BY r ORDER BY k)),
s AS (SELECT r, min(k) AS a, max(k) + 50 AS z FROM (SELECT r, k, sum(first) OVER (PARTITION BY r ORDER BY k) AS g FROM t) GROUP BY r, g),
p AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS z FROM (SELECT * FROM s UNION ALL SELECT r, len(v), len(v) FROM d)),
n AS (SELECT r, sum(z - a) AS n_removed FROM s GROUP BY r),
l AS (SELECT p.r, string_agg(array_to_string(v[p.a + 1 : p.z], ' '), ' ' ORDER BY p.a) AS x FROM p JOIN d USING (r) WHERE p.z > p.a GROUP BY p.r)
SELECT doc_id, CAST(len(v) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN l USING (r)
"""
