"""A corpus pipeline: language, exact copies, near copies, benchmark passages, tokens.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents, and every stage works on all
that its predecessor kept. Nulls, empty texts, ties, repeated rows, empty tables and further columns are handled as the
operators' docstrings say; rows that repeat an id share the decision on that id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontamination, exact_dedup, language_id, simhash
from tidemark.llm._store import cut


#: Predicted languages that stay; None: all that were learned.
LANGUAGES: list[str] | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted language is one of LANGUAGES; null texts, those without a letter, and those of whose letters
    the learned texts have less than half, go."""
    return language_id.keep_known(docs, languages=LANGUAGES)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the largest doc_id, of each text."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document that is left."""
    return bpe.bpe_digests(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("simhash", near), ("decontamination", benchmark), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over documents; the results of the others are cut in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = cut(docs, f"pipeline-{name}")
    return docs


#: Language and near-duplicate decisions can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
