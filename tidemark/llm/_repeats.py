"""What the two substring operators share: which windows may repeat, and the way of every window through the operator's structure.

A window is a stretch of fixed length (bytes or words). Its anchor is the gram of least hash in it, so equal windows have
equal anchors at the same place. Windows of a document that share an anchor form a segment, and only segments with the
same anchor gram (the route) can share a window; a route that a single segment has is done. Segments of equal content
are a class, known by a 128-bit digest. A class enters the operator's structure (suffix array or automaton) once, or
twice where several have it, and what the structure finds goes to every member. Nothing is settled by counting.

Three stages keep hot groups apart: copies that meet in a batch go through the structure there, and one stands for them;
counts of a route are aggregated with partial sums; a route of over SPLIT classes is split by deeper keys (the 8 least
grams of a window, then all of its content), which equal windows share too, and its parts go the same way.

Documents are known by their id; where ids are null or repeat, by id and 128 bits of hashes of the text, so rows that
repeat an id stay apart, and rows that repeat both are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import FACTOR, mixed, window_anchors
from ._ids import masked, named, unique
from ._store import cut

DOC = ["id", "m1", "m2"]
CLASS = ["route", "d1", "d2"]
SEGMENTS = "route long, d1 long, d2 long, id long, m1 long, m2 long, first int, stop int, kind int"
#: kind of a row: a segment to be settled; a stretch of windows that are covered; a segment that is covered and stands for its copies.
OPEN, DONE, STANDS = 0, 1, 2
#: A class with its content; the number of instances that the structure takes, and whether a member is open.
PARTS = "route long, d1 long, d2 long, least long, last long, copies int, open boolean, hot boolean, content binary"
#: Windows a to b of a class are covered: for members of the least id (strict), or for those of larger ids.
FOUND = "route long, d1 long, d2 long, least long, strict boolean, a int, b int"
#: Units of a text, and segments, that a task holds at a time.
BLOCK, HELD = 1 << 18, 100_000
#: Copies of a segment in a batch that are settled there.
TOGETHER = 4
#: Classes of a route that are sorted together; more are split by deeper keys: so many least grams of a window, 0 for all of it.
SPLIT = 1000
DEEPER = (8, 0)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, m1, m2, text); null texts count as empty. m1 and m2 are 0 where ids are whole and unique."""
    text = F.coalesce(named(text_col), F.lit(""))
    rows = docs.select(masked(named(id_col)).alias("id"), text.alias("text"))
    if unique(docs, id_col):
        return rows.select("id", F.lit(0).cast("long").alias("m1"), F.lit(0).cast("long").alias("m2"), "text")
    return rows.select("id", F.xxhash64("text").alias("m1"), F.xxhash64(F.lit("again"), F.col("text")).alias("m2"), "text")


def digest(content: bytes) -> bytes:
    return hashlib.blake2b(content, digest_size=16).digest()


def digests(contents: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(digest, contents)), dtype="<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Unit:
    """Bytes or words: how a text is cut, hashed and put together, and the structure that finds windows."""

    window: int
    gram: int
    #: Whether only documents of smaller ids cover a window.
    ordered: bool

    def cut(self, text: str): ...

    def grams(self, units) -> np.ndarray: ...

    def content(self, units, first: int, stop: int) -> bytes: ...

    def units(self, content: bytes): ...

    def whole(self, pairs: list[tuple[bytes, bytes]]) -> list[bool]:
        """Of each pair, whether the structure finds every window of the second in the first."""

    def compare(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """FOUND of whole routes of PARTS, sorted by route, least and digest."""

    def segments(self, units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """route, first and stop (of the window starts) of each segment."""
        if len(units) < self.window:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        grams = self.grams(units)
        first, stop, at = window_anchors(grams, self.window - self.gram + 1)
        return grams[at].view(np.int64), first, stop

    def deeper(self, units, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """route, first and stop of the stretches of windows that share their least grams, or with 0 of each window."""
        count = len(units) - self.window + 1
        if not least:
            route = np.array([int.from_bytes(digest(self.content(units, k, k + self.window))[:8], "little", signed=True) for k in range(count)], dtype=np.int64)
            return route, np.arange(count), np.arange(1, count + 1)
        width = self.window - self.gram + 1
        sets = np.lib.stride_tricks.sliding_window_view(self.grams(units), width)
        least = min(least, width)
        sets = np.sort(np.partition(sets, least - 1, axis=1)[:, :least], axis=1)
        key = np.zeros(count, dtype=np.uint64)
        for k in range(least):
            key = mixed(key * np.uint64(FACTOR) + sets[:, k])
        first = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
        return key[first].view(np.int64), first, np.append(first[1:], count)


def find_segments(docs: DataFrame, unit: Unit) -> DataFrame:
    """SEGMENTS of all documents, copies within a batch already settled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, texts, size = [], [], 0
            for key, m1, m2, text in batch[[*DOC, "text"]].itertuples(index=False):
                units = unit.cut(text)
                for at in range(0, max(1, len(units) - unit.window + 1), BLOCK):
                    block = units[at : at + BLOCK + unit.window - 1] if len(units) > BLOCK else units
                    route, first, stop = unit.segments(block)
                    if not len(route):
                        continue
                    held.append((route, first, stop, len(texts), at, key, m1, m2))
                    texts.append(block)
                    size += len(route)
                    if size >= HELD:
                        yield settle_batch(unit, held, texts)
                        held, texts, size = [], [], 0
            if held:
                yield settle_batch(unit, held, texts)

    return docs.mapInPandas(run, SEGMENTS)


def settle_batch(unit: Unit, held: list[tuple], texts: list) -> pd.DataFrame:
    counts = [len(x[0]) for x in held]
    route, first, stop = (np.concatenate([x[k] for x in held]) for k in range(3))
    text, at, ids, m1, m2 = (np.repeat(np.array([x[k] for x in held], dtype=np.int64), counts) for k in range(3, 8))
    more = unit.window - 1
    content = lambda k: unit.content(texts[text[k]], int(first[k]), int(stop[k]) + more)
    d1, d2 = digests(map(content, range(len(route))))
    order = np.lexsort((first, text, m2, m1, ids, d2, d1, route))
    same = (route[order[1:]] == route[order[:-1]]) & (d1[order[1:]] == d1[order[:-1]]) & (d2[order[1:]] == d2[order[:-1]])
    begin = np.flatnonzero(np.append(True, ~same))
    run_of = np.cumsum(np.append(True, ~same)) - 1
    if unit.ordered:
        met = ids[order] > ids[order[begin]][run_of]
    else:
        met = (np.diff(np.append(begin, len(order))) > 1)[run_of]
    # The first of a run, and the last, which is another place, of a larger id where that is asked for. Short runs wait for
    # the rest of their class, as they would go through the structure twice.
    ends = np.append(begin[1:], len(order)) - 1
    met &= (ends - begin + 1 >= TOGETHER)[run_of]
    several = np.unique(run_of[met])
    sure = unit.whole([(content(order[begin[r]]), content(order[ends[r]])) for r in several.tolist()])
    met &= ~np.isin(run_of, several[~np.array(sure, dtype=bool)]) if len(several) else False
    kind = np.full(len(order), OPEN, dtype=np.int32)
    kind[met] = DONE
    rows = pd.DataFrame({"route": route[order], "d1": d1[order], "d2": d2[order], "id": ids[order], "m1": m1[order], "m2": m2[order], "first": (first + at)[order], "stop": (stop + at)[order], "kind": kind})
    live = rows[kind == OPEN]
    if not unit.ordered:
        stands = rows.iloc[begin[np.isin(run_of[begin], run_of[met])]].assign(kind=STANDS)
        live = pd.concat((live, stands))
    done = rows[kind == DONE]
    if len(done):
        done = done.sort_values([*DOC, "first"], kind="stable")
        joined = (done[DOC].to_numpy()[1:] == done[DOC].to_numpy()[:-1]).all(axis=1) & (done["first"].to_numpy()[1:] <= done["stop"].to_numpy()[:-1])
        start = np.flatnonzero(np.append(True, ~joined))
        last = np.append(start[1:], len(done)) - 1
        done = done.iloc[start].assign(route=0, d1=0, d2=0, stop=done["stop"].to_numpy()[last])
    return pd.concat((live, done), ignore_index=True)


def is_hot(classes: DataFrame, split: int, ordered: bool, deepest: bool) -> DataFrame:
    """classes of routes in which a window can be covered, and whether a route is to be split."""
    sizes = classes.groupBy("route").agg(F.count(F.lit(1)).alias("k"), F.sum("copies").alias("n"), F.bool_or("open").alias("any"), F.min("least").alias("lo"), F.max("last").alias("hi"))
    sizes = sizes.filter("any AND n > 1" + (" AND lo < hi" if ordered else ""))
    hot = F.lit(False) if deepest else F.col("k") > split
    # Cut, so that the join's sides are plain exchanges, of which Spark can split a route with very many classes.
    return classes.join(cut(sizes.select("route", hot.alias("hot")), "routes"), "route")


def compared(parts: DataFrame, unit: Unit) -> DataFrame:
    keys = ["route", "least", "d1", "d2"]
    return parts.repartition("route").sortWithinPartitions(*keys).mapInPandas(unit.compare, FOUND)


def splits(hot: DataFrame, unit: Unit, least: int) -> DataFrame:
    """PARTS of the stretches of windows of hot parts that share a deeper key, with their parent and their place in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*CLASS, "least", "last", "copies", "open", "content", "p", "p1", "p2", "off"]
        for batch in batches:
            out: list[tuple] = []
            for r, e1, e2, lo, hi, copies, wanted, content in batch[[*CLASS, "least", "last", "copies", "open", "content"]].itertuples(index=False):
                units = unit.units(content)
                route, first, stop = unit.deeper(units, least)
                for own, i, j in zip(route.tolist(), first.tolist(), stop.tolist(), strict=True):
                    part = unit.content(units, i, j + unit.window - 1)
                    d = digest(part)
                    out.append((own, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), lo, hi, copies, wanted, part, r, e1, e2, i))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    kind = "route long, d1 long, d2 long, least long, last long, copies int, open boolean, content binary, p long, p1 long, p2 long, off int"
    return hot.mapInPandas(run, kind)


def settled(parts: DataFrame, unit: Unit, split: int, deeper: tuple[int, ...], what: str) -> DataFrame:
    """FOUND of parts, whose routes are whole."""
    out = compared(parts.filter("NOT hot"), unit)
    hot = parts.filter("hot")
    if not deeper or hot.isEmpty():
        return out
    own = cut(splits(hot.dropDuplicates(CLASS), unit, deeper[0]), what)
    classes = own.groupBy(*CLASS).agg(F.min("least").alias("least"), F.max("last").alias("last"), F.least(F.sum("copies"), F.lit(2)).cast("int").alias("copies"), F.bool_or("open").alias("open"), F.min("content").alias("content"))
    classes = cut(is_hot(cut(classes, what), split, unit.ordered, len(deeper) == 1), what)
    found = settled(classes, unit, split, deeper[1:], what).withColumnRenamed("least", "lowest")
    back = own.filter("open").drop("content").join(found, CLASS)
    if unit.ordered:  # a part whose document isn't the least of its class is covered as a larger one
        strict = F.when(F.col("strict"), F.col("least") == F.col("lowest")).otherwise(F.col("least") > F.col("lowest"))
        both = F.filter(F.array(F.when(strict, True), F.when(~F.col("strict") & (F.col("last") > F.col("least")), False)), lambda x: x.isNotNull())
        back = back.withColumn("strict", F.explode(both))
    back = back.select(F.col("p").alias("route"), F.col("p1").alias("d1"), F.col("p2").alias("d2"), "least", "strict", (F.col("off") + F.col("a")).alias("a"), (F.col("off") + F.col("b")).alias("b"))
    return out.unionByName(back)


def contents(docs: DataFrame, chosen: DataFrame, unit: Unit) -> DataFrame:
    """PARTS of the chosen classes, of which rep tells a place. A repeated row may give a part again."""
    names = ["route", "d1", "d2", "first", "stop", "least", "last", "copies", "open", "hot"]
    chosen = chosen.select("*", "rep.id", "rep.m1", "rep.m2", "rep.first", "rep.stop")
    per_doc = chosen.groupBy(*DOC).agg(F.collect_list(F.struct(*names)).alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[~batch.duplicated(DOC)]
            out, size = [], 0
            for text, *own in batch[["text", *names]].itertuples(index=False):
                units = unit.cut(text)
                first, stop = own.pop(3), own.pop(3)
                made = [unit.content(units, i, j + unit.window - 1) for i, j in zip(first.tolist(), stop.tolist(), strict=True)]
                out.append(pd.DataFrame({**dict(zip([*names[:3], *names[5:]], own, strict=True)), "content": made}))
                size += len(made)
                if size > 20_000:
                    yield pd.concat(out)
                    out, size = [], 0
            if out:
                yield pd.concat(out)

    rows = docs.join(per_doc, DOC).select(*DOC, "text", *[F.col(f"parts.{n}").alias(n) for n in names])
    return rows.mapInPandas(run, PARTS)


def repeats(docs: DataFrame, unit: Unit, split: int, what: str) -> DataFrame:
    """(id, m1, m2, found): of each of docs (as keyed() gives them) that has any, the covered windows as (first, stop) of their starts."""
    segments = cut(find_segments(docs, unit), what)
    live = segments.filter(F.col("kind") != DONE)
    shared = live.groupBy("route").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("route")
    members = cut(live.join(shared, "route", "left_semi"), what)
    copies, opened = F.when(F.col("kind") == STANDS, 2).otherwise(1), F.col("kind") == OPEN
    classes = members.groupBy(*CLASS).agg(F.min("id").alias("least"), F.max("id").alias("last"), F.least(F.sum(copies), F.lit(2)).cast("int").alias("copies"), F.bool_or(opened).alias("open"), F.min(F.struct(*DOC, "first", "stop")).alias("rep"))
    chosen = cut(is_hot(cut(classes, what), split, unit.ordered, False), what)
    parts = cut(contents(docs, chosen, unit), what)
    found = settled(parts, unit, split, DEEPER, what)
    if unit.ordered:
        mine: Column = F.when(F.col("strict"), F.col("id") == F.col("least")).otherwise(F.col("id") > F.col("least"))
    else:
        mine = F.lit(True)
    covered = members.filter(opened).join(found, CLASS).filter(mine).select(*DOC, (F.col("first") + F.col("a")).alias("first"), (F.col("first") + F.col("b")).alias("stop"))
    covered = covered.unionByName(segments.filter(F.col("kind") == DONE).select(*DOC, "first", "stop"))
    return covered.groupBy(*DOC).agg(F.collect_set(F.struct("first", "stop")).alias("found"))


def spans(found, window: int) -> list[tuple[int, int]]:
    """Maximal stretches that windows with starts in the (first, stop) of found cover."""
    out: list[list[int]] = []
    for first, stop in sorted((x["first"], x["stop"]) for x in found):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop + window - 1)
        else:
            out.append([first, stop + window - 1])
    return [(a, b) for a, b in out]
