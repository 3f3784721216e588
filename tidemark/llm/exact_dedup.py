"""Exact deduplication with DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Copies are combined in three stages, and every stage groups by
the digest and the full text: within a task (Spark's partial aggregation), within a salt of a digest, and over the salts.
A group of copies that holds a third of all rows so reaches the last stage as at most SALTS rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._ids import mark_of, named, one_of_each, others, without
from ._store import cut

#: Parts that the copies of one text are dealt to before they meet.
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Null counts as empty; A-Z become a-z, nothing else changes."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """(digest, body, keep_id, group_size) of each distinct text."""
    rows = docs.select(named(id_col).alias("id"), normalised(named(text_col)).alias("body"))
    rows = rows.select("id", "body", F.sha2("body", 256).alias("digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "body", "salt").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return salted.groupBy("digest", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the largest id stays. A null text equals the empty text. A null id is smaller than any
    other, so a group of null ids only keeps them (keep_id null). Rows that repeat an id and a text count in group_size
    and share their answer. Other columns are left as they are; an empty table gives an empty result. Columns of docs
    named like an added one, in whatever case, are replaced.
    """
    found = groups(docs, id_col, text_col, salts)
    # Only texts that occur more than once need a partner. Digests that two texts share, if ever, are matched by text too.
    per_digest = found.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    several = cut(per_digest.filter("texts > 1 OR group_size > 1"), "exact-dedup")
    added = ("keep_id", "group_size", "kept", "text_sha256")
    own = others(docs, added, (id_col, text_col))
    # The row travels as one struct, so no name of its columns can clash.
    rest = docs.select(F.struct(*own).alias("row"), F.sha2(normalised(named(text_col)), 256).alias("sha"))
    same = ["digest", "keep_id", "group_size"]
    if several.filter("texts > 1").isEmpty():
        out = rest.join(several.select(*same), F.col("sha") == F.col("digest"), "left")
    else:
        clash = several.filter("texts > 1").select("digest")
        whole = found.join(clash, "digest", "left_semi").select(*same, "body")
        whole = several.filter("texts = 1").select(*same, F.lit(None).cast("string").alias("body")).unionByName(whole)
        equal = F.col("body").isNull() | (F.col("body") == normalised(F.col(f"row.`{text_col}`")))
        out = rest.join(whole, (F.col("sha") == F.col("digest")) & equal, "left")
    row_id = F.col(f"row.`{id_col}`")
    keep = F.when(F.col("digest").isNull(), row_id).otherwise(F.col("keep_id"))
    return out.select("row.*", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), keep.eqNullSafe(row_id).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs, with its columns, of each text: one that has the largest id."""
    rows = docs.select(named(id_col), named(text_col), mark_of(named(text_col)).alias("mark"))
    found = exact_dedup(rows, id_col, text_col).filter("group_size > 1")
    found = cut(found.select(named(id_col).cast("long").alias("id"), "mark", "kept", F.col("text_sha256").alias("group")), "exact-dedup")
    left = without(docs, found.filter(~F.col("kept")), id_col, text_col)
    return one_of_each(left, found.filter("kept"), id_col, text_col)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
