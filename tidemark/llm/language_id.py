"""Language identification with string kernels.

The kernel of two texts counts the character n-grams, of every length up to SPAN, that are in both (presence, not
frequency), over the root of the product of their own counts. Texts are lower-cased; all characters of the sample are
told apart, those that it lacks are one. LANDMARKS texts give the Nyström map, and one ridge regression for each language
(its texts 1, others -1) is fitted on it. Documents are scored by one matrix product a batch. A text of whose letters the
sample has less than the share LIKENESS is in none of the languages that were learned.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._ids import named, others
from ._sample import sample_ids
from ._store import small_batches

SPAN = 3
#: Characters of the sample up to which n-grams are looked up in a table of their numbers; beyond, they are sorted.
TABLED = 256
LIKENESS = 0.5
#: Bounds of what is learned from: texts of a language, landmarks in all (one a language at least), and characters of a text
#: (the middle of longer ones is taken).
PER_LANGUAGE, LANDMARKS, LONGEST, RIDGE = 300, 96, 8000, 1e-2
#: Texts in all; with more than 64 languages each has less than PER_LANGUAGE, and none has fewer than one.
TEXTS = 64 * PER_LANGUAGE
LETTER = re.compile(r"[^\W\d_]")


class Model:
    """A fitted classifier; it holds the landmarks' n-grams and a weight for each landmark and language."""

    def __init__(self, texts: list[str], langs: list[str]):
        units = np.unique(np.frombuffer("".join(texts).lower().encode("utf-16-le", "replace"), dtype=np.uint16))
        self.letters = np.zeros(1 << 16, dtype=np.int64)
        self.letters[units] = np.arange(1, len(units) + 1)
        self.base = len(units) + 1
        self.offsets = np.cumsum([0, *(self.base**n for n in range(1, SPAN + 1))])
        self.tabled = self.base <= TABLED
        self.seen = np.zeros(self.base**SPAN if self.tabled else 0, dtype=np.int32)
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        # Landmarks: as many of each language, in the order of the sample.
        seen: Counter = Counter()
        chosen = []
        for k, lang in enumerate(langs):
            seen[lang] += 1
            if seen[lang] <= -(-LANDMARKS // len(self.langs)):
                chosen.append(k)
        marks = [self.grams(texts[k]) for k in chosen]
        self.used = np.unique(np.concatenate(marks))
        self.place = np.full(self.offsets[-1] if self.tabled else 0, -1, dtype=np.int32)
        if self.tabled:
            self.place[self.used] = np.arange(len(self.used))
        self.lands = np.zeros((len(self.used), len(chosen)), dtype=np.float32)
        for j, own in enumerate(marks):
            self.lands[np.searchsorted(self.used, own), j] = 1 / np.sqrt(max(1, len(own)))
        k_nm = np.concatenate([self.kernel(texts[lo : lo + 1024]) for lo in range(0, len(texts), 1024)]).astype(np.float64)
        k_mm = k_nm[chosen]
        values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])
        x = np.column_stack((k_nm @ root, np.ones(len(texts))))
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        weight = 1 / (len(self.langs) * np.array([langs.count(v) for v in langs]))[:, None]  # languages weigh the same
        fit = np.linalg.solve(x.T @ (weight * x) + RIDGE / len(self.langs) * np.eye(x.shape[1]) / 10, x.T @ (weight * y))
        self.weights, self.bias = (root @ fit[:-1]).astype(np.float32), fit[-1].astype(np.float32)

    def grams(self, text: str) -> np.ndarray:
        """The numbers of the n-grams that are in the text, each once."""
        one = self.letters[np.frombuffer(text.lower().encode("utf-16-le", "replace"), dtype=np.uint16)]
        own, part = [], one
        for n in range(1, SPAN + 1):
            if len(one) < n:
                break
            if n > 1:
                part = part[:-1] * self.base + one[n - 1 :]
            if self.tabled:  # of equal n-grams the one that was noted last stands for them
                turn = np.arange(len(part), dtype=np.int32)
                self.seen[part] = turn
                once = part[self.seen[part] == turn]
            else:
                once = np.unique(part)
            own.append(once + self.offsets[n - 1])
        return np.concatenate(own) if own else np.zeros(0, dtype=np.int64)

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Normalised kernel of each text with each landmark."""
        seen = np.zeros((len(texts), len(self.used)), dtype=np.float32)
        for k, text in enumerate(texts):
            own = self.grams(text)
            if self.tabled:
                at = self.place[own]
                at = at[at >= 0]
            else:
                at = np.minimum(np.searchsorted(self.used, own), len(self.used) - 1)
                at = at[self.used[at] == own]
            seen[k, at] = 1 / np.sqrt(max(1, len(own)))
        return seen @ self.lands

    def known(self, text: str) -> float:
        """The share of a text's letters, each counted once, that the sample has."""
        units = np.frombuffer("".join(c for c in {*text.lower()} if c.isalpha()).encode("utf-16-le", "replace"), dtype=np.uint16)
        return float((self.letters[units] > 0).mean()) if len(units) else 0.0

    def predict(self, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """The language, a score from 0 to 1, and the share of its letters that are known, of each text; und and 0 where it is
        null or has no letter, None and 0 where it has one but no language was learned."""
        langs: list[str | None] = ["und"] * len(texts)
        scores, likeness = np.zeros(len(texts)), np.zeros(len(texts))
        real = [k for k, t in enumerate(texts) if t and LETTER.search(t)]
        if not self.langs:
            for k in real:
                langs[k] = None
        for lo in range(0, len(real) if self.langs else 0, 256):
            part = real[lo : lo + 256]
            found = self.kernel([texts[k] for k in part]) @ self.weights + self.bias
            best = found.argmax(axis=1)
            odds = 1 / np.exp(4 * (found - found.max(axis=1, keepdims=True))).sum(axis=1)
            likeness[part] = [self.known(texts[k]) for k in part]
            for k, b, s in zip(part, best.tolist(), odds.tolist(), strict=True):
                langs[k], scores[k] = self.langs[b], s
        return langs, scores, likeness


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo by; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(named(id_col).cast("string"), F.lit(""))), F.lit(by))


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of every language, from at most PER_LANGUAGE documents of each, taken by a hash of the id, or of the text
    where the id is null. Of an id that repeats one text of a language is taken."""
    text = named(text_col)
    rows = docs.filter(remainder(id_col, 4) != 2).filter(text.isNotNull() & named(lang_col).isNotNull())
    middle = F.substring(text, F.greatest(F.lit(0), F.floor((F.length(text) - LONGEST) / 2).cast("int")) + 1, F.lit(LONGEST))
    rows = rows.select(F.coalesce(named(id_col).cast("long"), F.xxhash64(text)).alias("id"), middle.alias("text"), named(lang_col).alias("lang"))
    keys = [i for i, _ in sample_ids(rows.select("id", F.col("lang").alias("stratum")).distinct(), lambda _: PER_LANGUAGE, TEXTS)]
    found = rows.filter(F.col("id").isin(keys)).groupBy("lang", "id").agg(F.min("text").alias("text")).orderBy("lang", F.xxhash64("id"), "id").collect() if keys else []
    return Model([r.text for r in found], [r.lang for r in found])


def identify_language(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs, whole, with lang_pred, score and likeness. Null texts, and texts without a letter, are und with
    score 0; rows that repeat get the same answer; without anything to learn from, other texts have lang_pred null and
    score 0. Columns of docs named like an added one, in whatever case, are replaced."""
    own = others(docs, ("lang_pred", "score", "likeness"), (id_col, text_col))
    rest = docs.select(F.struct(*own).alias("row"), named(text_col).alias("text"))
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, likeness double")
    def run(texts: pd.Series) -> pd.DataFrame:
        langs, scores, likeness = sent.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": langs, "score": scores, "likeness": likeness})

    return rest.withColumn("found", run(F.col("text"))).select("row.*", "found.lang_pred", "found.score", "found.likeness")


def keep_known(docs: DataFrame, learn: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: list[str] | None = None, least: float = LIKENESS) -> DataFrame:
    """The rows of docs, with its columns, whose predicted language is one of languages (None: any that was learned) and
    whose likeness to what was learned is at least least. Where none can be learned and no languages are named, all that
    have a letter stay."""
    model = fit_language_model(docs if learn is None else learn, id_col, text_col, lang_col)
    found = identify_language(docs.select(F.struct(*[named(c) for c in docs.columns]).alias("_row"), named(text_col).alias("_text")), model, "_row", "_text")
    wanted = F.col("lang_pred").isin(languages) if languages is not None else F.coalesce(F.col("lang_pred") != "und", F.lit(True))
    if model.langs:
        wanted = wanted & (F.col("likeness") >= least)
    return found.filter(wanted).select("_row.*")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify_language(docs.select("doc_id", "text"), fit_language_model(docs))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
