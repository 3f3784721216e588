"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints that differ in at most FAR bits agree in one of FAR + 1 blocks of bits, so each distinct fingerprint goes
to FAR + 1 buckets (block, value). In a bucket they are sorted by Gray rank, which puts fingerprints of few differences
side by side; runs of RUN form nodes, RUN nodes a node above, and so on. A node keeps the pattern of bits that all below
share, so a bit shared by a whole group is looked at once, in the group's node. A pair of nodes adds the differences in
the bits that it is the first to share to those that the pairs above it have counted; a pair with more than FAR is pruned
with everything below it, and one that can't reach more is linked without looking below. What is emitted are links that span a bucket's components, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import word_bounds
from ._ids import mark_of, masked, named, one_of_each, unmasked, without
from ._store import cut, small_batches
from .components import connected_components

WORDS, FAR, RUN = 4, 4, 8
#: Node pairs looked at at a time; RUN * RUN times as many pairs below them are held for a moment (2 million).
PAIRS = 1 << 15
#: Fingerprints of a bucket above which it is dealt out by its other bits too.
LARGE = 4096


def fingerprint(text: str | None) -> int:
    """64 bits; bit i is 1 if it is set in over half of the hashes of the 4-word shingles, repeats included."""
    data = (text or "").encode().lower()  # bytes: A-Z only
    words = data.split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(joined, 42)
    starts, ends = word_bounds(np.frombuffer(joined, dtype=np.uint8))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[i:j], 42) for i, j in zip(starts.tolist(), ends[WORDS - 1 :].tolist(), strict=False)), dtype=np.uint64, count=len(words) - WORDS + 1)
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 8192):
        counts += np.unpackbits(hashes[k : k + 8192, None].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, fp) of every row: a hash of the text and the fingerprint, both as signed longs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = np.array([fingerprint(t) for t in batch["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"id": batch["id"], "mark": batch["mark"], "fp": own})

    small_batches(docs.sparkSession)
    return docs.select(masked(named(id_col)).alias("id"), mark_of(named(text_col)).alias("mark"), named(text_col).alias("text")).mapInPandas(run, "id long, mark long, fp long").withColumn("id", unmasked(F.col("id")))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each word in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class Sets:
    """Union-find over numbers below n, with whole arrays of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[x]
            if (up == self.root[up]).all():
                return up
            self.root[x] = self.root[up]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.find(a), self.find(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            self.root[np.maximum(ra, rb)] = np.minimum(ra, rb)  # of several claims one wins; the others come again


def bucket_components(fps: np.ndarray, buckets: np.ndarray, far: int = FAR) -> np.ndarray:
    """For distinct fingerprints of one or more buckets (equal numbers adjacent): the index of the first of its component."""
    n = len(fps)
    order = np.lexsort((gray_rank(fps), buckets))
    x, part, sets = fps[order], buckets[order], Sets(n)
    # Levels: nodes are runs of RUN nodes of the level below within a bucket; of each: bits that all have, bits that vary, a member.
    levels = [(x, np.zeros(n, dtype=np.uint64), np.arange(n), part, np.arange(n + 1))]
    while True:
        value, vary, member, own, _ = levels[-1]
        begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        place = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
        first = np.flatnonzero(place % RUN == 0)
        if len(first) == len(own):
            break
        some, every = np.bitwise_or.reduceat(value | vary, first), np.bitwise_and.reduceat(value & ~vary, first)
        levels.append((every, some & ~every, member[first], own[first], np.append(first, len(own))))
    top = len(levels) - 1
    tops = np.arange(len(levels[top][0]))
    # Pairs of nodes with the differences counted so far, and the bits that no pair above has looked at.
    work = [(top, tops, tops, np.zeros(len(tops), dtype=np.uint8), np.full(len(tops), ~np.uint64(0)))]
    while work:
        level, a, b, least, unseen = work.pop()
        if len(a) > PAIRS:
            work += [(level, *(v[k : k + PAIRS] for v in (a, b, least, unseen))) for k in range(0, len(a), PAIRS)]
            continue
        value, vary, member, _, children = levels[level]
        left = vary[a] | vary[b]
        least = least + np.bitwise_count((value[a] ^ value[b]) & unseen & ~left)
        most = least + np.bitwise_count(left)
        near = least <= far
        sure = near & (most <= far)
        sets.join(member[a[sure]], member[b[sure]])
        if level == 0:
            continue
        # All below a sure pair is linked: chain the members of each node once.
        solid = np.unique(np.concatenate((a[sure], b[sure])))
        for node in solid.tolist():
            lo, hi = node, node + 1
            for k in range(level, 0, -1):
                lo, hi = levels[k][4][lo], levels[k][4][hi]
            if hi - lo > 1:
                sets.join(np.full(hi - lo - 1, lo), np.arange(lo + 1, hi))
        a, b, least, left = (v[near & ~sure] for v in (a, b, least, left))
        if len(a):
            na, nb = np.diff(children)[a], np.diff(children)[b]
            ca = np.repeat(children[a], na * nb)
            cb = np.repeat(children[b], na * nb)
            within = np.arange(len(ca)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            width = np.repeat(nb, na * nb)
            ca, cb = ca + within // width, cb + within % width
            keep = ca < cb if level == 1 else ca <= cb
            work.append((level - 1, ca[keep], cb[keep], np.repeat(least, na * nb)[keep], np.repeat(left, na * nb)[keep]))
    out = np.empty(n, dtype=np.int64)
    out[order] = order[sets.find(np.arange(n))]
    return out


def blocks(far: int) -> list[tuple[int, int]]:
    """(shift, mask) of far + 1 blocks of bits that make up a fingerprint."""
    bounds = [64 * k // (far + 1) for k in range(far + 2)]
    return [(i, (1 << (j - i)) - 1) for i, j in zip(bounds, bounds[1:], strict=False)]


def near_links(nodes: DataFrame, far: int = FAR) -> DataFrame:
    """(a, b): links between the ids of (id, fp), ids and fingerprints being distinct, that connect all that are within
    far bits. A bucket of over LARGE fingerprints is dealt out again by far + 1 blocks of its other bits; of those parts
    every pair within far bits shares one, so nothing is lost."""
    cuts = blocks(far)
    value = lambda shift, mask: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(mask))
    keyed = nodes.select("id", "fp", F.posexplode(F.array(*[value(*c) for c in cuts])).alias("block", "value"))
    sizes = keyed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    keyed = keyed.join(sizes, ["block", "value"])
    bounds = [64 * k // (far + 1) for k in range(far + 2)]
    second = []
    for k in range(far + 1):
        rest = [i for i in range(64) if not bounds[k] <= i < bounds[k + 1]]
        masks = [sum(1 << i for i in rest[len(rest) * j // (far + 1) : len(rest) * (j + 1) // (far + 1)]) for j in range(far + 1)]
        second.append(F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks]))
    fine = F.when(F.col("n") <= LARGE, F.array(F.lit(0).cast("long")))
    for k, masks in enumerate(second):
        fine = fine.when(F.col("block") == k, masks)
    dealt = keyed.select("id", "fp", "block", "value", F.posexplode(fine).alias("part", "rest"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["block", "value", "part", "rest"]):
            key = rows[["block", "value", "part", "rest"]].to_numpy()
            bucket = np.cumsum(np.append(False, (key[1:] != key[:-1]).any(axis=1)))
            ids = rows["id"].to_numpy()
            first = bucket_components(rows["fp"].to_numpy().view(np.uint64), bucket, far)
            linked = first != np.arange(len(first))
            if linked.any():
                yield pd.DataFrame({"a": ids[first[linked]], "b": ids[linked]})

    keys = ["block", "value", "part", "rest"]
    return dealt.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long")


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted batches cut so that no group of keys is split over two."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        batch = batch if rest is None else pd.concat((rest, batch), ignore_index=True)
        last = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
        begin = len(batch) - int(np.argmin(last[::-1])) if not last.all() else 0
        if begin:
            yield batch.iloc[:begin].reset_index(drop=True)
        rest = batch.iloc[begin:].reset_index(drop=True)
    if rest is not None:
        yield rest


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", far: int = FAR) -> DataFrame:
    """(id, fingerprint, component_id) of every row: 16 hex digits, and the least id that links lead to, itself included.

    Null and empty texts have fingerprint zero and link like others. A null id stays null and is never a component's
    name unless nothing else is in it. Rows that repeat an id count once for naming; an empty table gives an empty result.
    """
    found = with_components(docs, id_col, text_col, far)
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def with_components(docs: DataFrame, id_col: str, text_col: str, far: int) -> DataFrame:
    """(id, mark, fp, component, component_id) of every row; component is a fingerprint."""
    prints = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = cut(prints.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    # A distinct fingerprint is its own name in links.
    found = connected_components(near_links(nodes.select(F.col("fp").alias("id"), "fp"), far))
    grouped = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(grouped.join(least, "component").select("fp", "component", "component_id"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", far: int = FAR) -> DataFrame:
    """One row of docs, with its columns, of each component: one that has the least id."""
    found = with_components(docs, id_col, text_col, far)
    found = cut(found.select("id", "mark", F.col("component").alias("group"), F.col("component_id").eqNullSafe(F.col("id")).alias("kept")), "simhash-kept")
    left = without(docs, found.filter(~F.col("kept")), id_col, text_col)
    return one_of_each(left, found.filter("kept"), id_col, text_col)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
