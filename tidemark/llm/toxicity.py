"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A text is cut into windows of WINDOW words, each beginning STEP after the one before, so all but the edges are seen
twice. A word's inputs are an embedding of the word and the scaled sum of embeddings of its character n-grams, both
hashed. Two gated recurrent networks read a window from either end; attention over their states gives the window's
logit, and the largest of a text's windows is its score. Learning alternates: find the highest window of every sampled
text, then take steps of Adam on those windows with the text's label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import range_hashes
from ._sample import sample_ids
from ._store import small_batches
from ._ids import masked, named, unmasked
from .decontamination import PARTING
from .language_id import remainder

WINDOW, STEP = 64, 32
WORD_BUCKETS, CHAR_BUCKETS, WIDTH, HIDDEN = 1 << 14, 1 << 16, 8, 8
NGRAMS = (3, 4, 5)
#: Bounds of what is learned from: texts of each label, and characters of a text (longer ones are taken only for a label
#: that has no shorter one, and then their middle).
TOXIC, CLEAN, LONGEST = 1500, 3000, 12_000
#: Rounds over the sample, more where that makes fewer than STEPS steps.
ROUNDS, STEPS, BATCH, RATE, SEED = 8, 200, 64, 0.01, 7
#: Words kept with their inputs in a worker, and windows scored at a time.
KEPT, WINDOWS = 300_000, 4096
THRESHOLD = 0.7
_TO_SPACE = bytes(0x20 if PARTING[b] else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs between white space and ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each word, the buckets of all their n-grams in order, and the number of n-grams of each word."""
    data = np.frombuffer(b"^" + b"$^".join(words) + b"$", dtype=np.uint8)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    whole = range_hashes(data, starts, ends)
    per, begin, stop, owner = np.zeros(len(words), dtype=np.int64), [], [], []
    for n in NGRAMS:
        count = np.maximum(sizes - n + 1, 0)
        who = np.repeat(np.arange(len(words)), count)
        first = np.repeat(starts, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        begin.append(first), stop.append(first + n), owner.append(who)
        per += count
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    grams = range_hashes(data, np.concatenate(begin)[order], np.concatenate(stop)[order])
    return (whole % np.uint64(WORD_BUCKETS)).astype(np.int64), (grams % np.uint64(CHAR_BUCKETS)).astype(np.int64), per


def starts_of(n: int) -> list[int]:
    """Starts of the windows of n words; the last ends with the text."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STEP), n - WINDOW]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """The parameters, the forward pass and the gradient of windows given as (inputs, mask)."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        init = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "words": init(WORD_BUCKETS, WIDTH, scale=0.05), "chars": init(CHAR_BUCKETS, WIDTH, scale=0.05),
            "in": init(2 * WIDTH, 6 * HIDDEN, scale=0.3), "in0": np.zeros(6 * HIDDEN, dtype=np.float32),
            "f": init(HIDDEN, 3 * HIDDEN, scale=0.3), "b": init(HIDDEN, 3 * HIDDEN, scale=0.3),
            "attend": init(2 * HIDDEN, scale=0.3), "out": init(2 * HIDDEN, scale=0.5), "out0": np.zeros(1, dtype=np.float32),
        }
        self.state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.time = 0
        self.blind = False

    def inputs(self, bucket: np.ndarray, grams: np.ndarray, per: np.ndarray) -> np.ndarray:
        """What words give the network: word and character embeddings."""
        sums = np.add.reduceat(self.p["chars"][grams], np.cumsum(per) - per, axis=0) if len(grams) else np.zeros((0, WIDTH), np.float32)
        return np.concatenate((self.p["words"][bucket], sums / np.sqrt(per, dtype=np.float32)[:, None]), axis=1)

    def project(self, bucket: np.ndarray, grams: np.ndarray, per: np.ndarray) -> np.ndarray:
        return self.inputs(bucket, grams, per) @ self.p["in"] + self.p["in0"]

    def read(self, x: np.ndarray, u: np.ndarray, order: range) -> tuple[np.ndarray, list]:
        """States (time, windows, HIDDEN) of one direction; x: (time, windows, 3 HIDDEN)."""
        h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
        out, kept = np.empty((len(x), x.shape[1], HIDDEN), dtype=np.float32), [None] * len(x)
        for t in order:
            gates = sigmoid(x[t, :, : 2 * HIDDEN] + h @ u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(x[t, :, 2 * HIDDEN :] + (r * h) @ u[:, 2 * HIDDEN :])
            kept[t] = (h, z, r, c)
            h = h + z * (c - h)
            out[t] = h
        return out, kept

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logits of windows. x: (time, windows, 6 HIDDEN); mask: (time, windows), false where a window has no word."""
        n = len(x)
        f, kf = self.read(x[:, :, : 3 * HIDDEN], self.p["f"], range(n))
        b, kb = self.read(x[:, :, 3 * HIDDEN :], self.p["b"], range(n - 1, -1, -1))
        h = np.concatenate((f, b), axis=2)
        e = np.where(mask, h @ self.p["attend"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[:, :, None] * h).sum(axis=0)
        return pooled @ self.p["out"] + self.p["out0"][0], (kf, kb, h, a, pooled)

    def learn(self, words: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, mask: np.ndarray, y: np.ndarray) -> None:
        """A step of Adam. words: features of the step's distinct words; at: (time, windows) places in them."""
        bucket, grams, per = words
        raw = self.inputs(bucket, grams, per)
        proj = raw @ self.p["in"] + self.p["in0"]
        x = proj[at]
        x[~mask] = 0
        logit, (kf, kb, h, a, pooled) = self.forward(x, mask)
        g = {}
        d = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["out"], g["out0"] = pooled.T @ d, d.sum(keepdims=True)
        dp = d[:, None] * self.p["out"]
        da = (h * dp).sum(axis=2)
        de = a * (da - (a * da).sum(axis=0))
        dh = a[:, :, None] * dp + de[:, :, None] * self.p["attend"]
        g["attend"] = (h * de[:, :, None]).sum(axis=(0, 1))
        dx = np.empty_like(x)
        for name, kept, part, order in (("f", kf, 0, range(len(x) - 1, -1, -1)), ("b", kb, 1, range(len(x)))):
            u, du, back = self.p[name], np.zeros_like(self.p[name]), 0
            for t in order:
                h0, z, r, c = kept[t]
                dt = dh[:, :, part * HIDDEN : (part + 1) * HIDDEN][t] + back
                dc = dt * z * (1 - c * c)
                drh = dc @ u[:, 2 * HIDDEN :].T
                dz, dr = dt * (c - h0) * z * (1 - z), drh * h0 * r * (1 - r)
                dg = np.concatenate((dz, dr), axis=1)
                du[:, : 2 * HIDDEN] += h0.T @ dg
                du[:, 2 * HIDDEN :] += (r * h0).T @ dc
                back = dt * (1 - z) + drh * r + dg @ u[:, : 2 * HIDDEN].T
                dx[t, :, part * 3 * HIDDEN : (part + 1) * 3 * HIDDEN] = np.concatenate((dg, dc), axis=1)
            g[name] = du
        dx[~mask] = 0
        dproj = np.zeros_like(proj)
        np.add.at(dproj, at.ravel(), dx.reshape(-1, dx.shape[2]))
        g["in"], g["in0"] = raw.T @ dproj, dproj.sum(axis=0)
        draw = dproj @ self.p["in"].T
        rows, back = np.unique(bucket, return_inverse=True)
        dw = np.zeros((len(rows), WIDTH), dtype=np.float32)
        np.add.at(dw, back, draw[:, :WIDTH])
        spread = np.repeat(draw[:, WIDTH:] / np.sqrt(per, dtype=np.float32)[:, None], per, axis=0)
        crow, cback = np.unique(grams, return_inverse=True)
        dc = np.zeros((len(crow), WIDTH), dtype=np.float32)
        np.add.at(dc, cback, spread)
        self.time += 1
        for name, grad in g.items():
            self.adam(name, slice(None), grad)
        self.adam("words", rows, dw)
        self.adam("chars", crow, dc)

    def adam(self, name: str, where, grad: np.ndarray) -> None:
        m, v = self.state[name]
        m[where] = 0.9 * m[where] + 0.1 * grad
        v[where] = 0.99 * v[where] + 0.01 * grad * grad
        self.p[name][where] -= RATE * (m[where] / (1 - 0.9**self.time)) / (np.sqrt(v[where] / (1 - 0.99**self.time)) + 1e-6)


def window_of(places: np.ndarray, start: int) -> np.ndarray:
    """WINDOW places from start, -1 past the end."""
    own = places[start : start + WINDOW]
    return own if len(own) == WINDOW else np.concatenate((own, np.full(WINDOW - len(own), -1, dtype=own.dtype)))


def layout(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(WINDOW, windows) places of words, -1 where there is none, and the text of each window; texts have words."""
    rows, owner = [], []
    for k, places in enumerate(docs):
        for s in starts_of(len(places)):
            rows.append(window_of(places, s))
            owner.append(k)
    return np.array(rows).T, np.array(owner)


def window_logits(net: Network, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logits of windows from projected inputs; the last row of table is zero and stands for no word."""
    out = np.empty(at.shape[1], dtype=np.float32)
    for k in range(0, at.shape[1], WINDOWS):
        part = at[:, k : k + WINDOWS]
        out[k : k + WINDOWS] = net.forward(table[part], part >= 0)[0]
    return out


def train(texts: list[str], toxic: list[int]) -> Network:
    """A network fitted to whole texts; blind (every score 0) where there aren't texts of both labels."""
    net, rng = Network(), np.random.default_rng(SEED)
    kept = [(words_of(t), y) for t, y in zip(texts, toxic, strict=True)]
    kept = [(w, y) for w, y in kept if w]
    y = np.array([v for _, v in kept], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        net.blind = True
        return net
    place: dict[bytes, int] = {}
    docs = [np.array([place.setdefault(w, len(place)) for w in ws]) for ws, _ in kept]
    bucket, grams, per = features(list(place))
    first = np.cumsum(per) - per
    # The first number of an embedding begins as the log-odds of toxic texts among those that have the bucket.
    for name, of_word, size in (("words", bucket, WORD_BUCKETS), ("chars", grams, CHAR_BUCKETS)):
        hits = np.zeros((2, size))
        for d, v in zip(docs, y, strict=True):
            own = np.unique(d)
            own = of_word[own] if name == "words" else of_word[np.concatenate([np.arange(first[w], first[w] + per[w]) for w in own])]
            hits[int(v), np.unique(own)] += 1
        rate = (hits + 1) / (np.array([len(y) - y.sum(), y.sum()])[:, None] + 2)
        net.p[name][:, 0] = np.clip(np.log(rate[1] / rate[0]), -1, 4) / 4
    at, owner = layout(docs)
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    for _ in range(max(ROUNDS, -(-STEPS * BATCH // len(y)) if len(y) >= BATCH else ROUNDS)):
        table = np.concatenate((net.project(bucket, grams, per), np.zeros((1, 6 * HIDDEN), np.float32)))
        logits = window_logits(net, table, at)
        # The highest window of each text.
        order = np.lexsort((-logits, owner))
        best = order[begin]
        again = rng.permutation(len(best))
        for k in range(0, len(again), BATCH):
            take = again[k : k + BATCH]
            cols = at[:, best[take]]
            used, where = np.unique(np.maximum(cols, 0), return_inverse=True)
            parts = np.concatenate([np.arange(first[w], first[w] + per[w]) for w in used])
            net.learn((bucket[used], grams[parts], per[used]), where.reshape(cols.shape), cols >= 0, y[take])
    net.state = {}
    return net


class Scorer:
    """A network with the projected inputs of the words met so far."""

    def __init__(self, net: Network):
        self.net, self.place = net, {}
        self.table = np.zeros((1 << 12, 6 * HIDDEN), dtype=np.float32)

    def places(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.place.get, words))
        if None in found:
            new = list({w for w, p in zip(words, found, strict=True) if p is None})
            need = len(self.place) + len(new) + 1
            if need > len(self.table):
                grown = np.zeros((max(need, 2 * len(self.table)), 6 * HIDDEN), dtype=np.float32)
                grown[: len(self.place)] = self.table[: len(self.place)]
                self.table = grown
            at = len(self.place)
            self.table[at : at + len(new)] = self.net.project(*features(new))
            self.place.update(zip(new, range(at, at + len(new)), strict=True))
            found = list(map(self.place.__getitem__, words))
        return np.array(found, dtype=np.int32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Of each text; 0 where it has no word."""
        out = np.zeros(len(texts))
        if self.net.blind:
            return out
        held, size = [], 0
        for k, text in enumerate(texts):
            if not (words := words_of(text)):
                continue
            held.append((k, self.places(words)))
            size += len(words)
            if size > WINDOWS * STEP:
                self.settle(held, out)
                held, size = [], 0
        if held:
            self.settle(held, out)
        return out

    def settle(self, held: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        """The highest window of each text; a long text's windows are laid out some at a time."""
        self.table[-1] = 0
        best, block, owner = np.full(len(held), -np.inf), [], []

        def score() -> None:
            if block:
                np.maximum.at(best, owner, window_logits(self.net, self.table, np.array(block).T))
                block.clear()
                owner.clear()

        for k, (_, places) in enumerate(held):
            for s in starts_of(len(places)):
                block.append(window_of(places, s))
                owner.append(k)
                if len(block) == WINDOWS:
                    score()
        score()
        out[[k for k, _ in held]] = sigmoid(best)
        if len(self.place) > KEPT:
            self.place = {}


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network:
    """A network from at most TOXIC and CLEAN labelled texts, taken by a hash of the id. Only rows whose crc32 of the id
    modulo 3 isn't 1 are learned from; null ids, labels and texts aren't."""
    rows = labels.select(named(id_col).alias("id"), named(label_col).cast("int").alias("y")).filter("id is not null AND y in (0, 1)").filter(remainder("id", 3) != 1)
    y = dict(sample_ids(rows.select("id", F.col("y").alias("stratum")).distinct(), lambda label: TOXIC if label else CLEAN))
    texts = docs.select(named(id_col).alias("id"), named(text_col).alias("text")).filter("text is not null")
    # Of an id that repeats one text is taken: as many rows as there are ids in the sample.
    pick = lambda ids, text, which: [(r.id, r.text) for r in texts.filter(F.col("id").isin(ids)).filter(which).groupBy("id").agg(F.min(text).alias("text")).collect()] if ids else []
    found = pick(list(y), F.col("text"), F.length("text") <= LONGEST)
    lacking = {0, 1} - {y[i] for i, _ in found}
    middle = F.substring("text", F.floor((F.length("text") - LONGEST) / 2).cast("int") + 1, F.lit(LONGEST))
    found += pick([i for i, label in y.items() if label in lacking], middle, F.length("text") > LONGEST)
    found.sort()
    return train([t for _, t in found], [y[i] for i, _ in found])


def score_toxicity(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id and score from 0 to 1; whole texts are read. Null texts and texts without a word score 0; rows that
    repeat score alike; a null id stays null; an empty table gives an empty result."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Scorer(sent.value)
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": own.scores(batch["text"].tolist())})

    rows = docs.select(masked(named(id_col)).alias("id"), named(text_col).alias("text"))
    return rows.mapInPandas(run, "id long, score double").withColumn("id", unmasked(F.col("id"))).withColumnRenamed("id", id_col)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = score_toxicity(docs, fit_toxicity(docs, labels))
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
