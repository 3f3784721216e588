import pytest
from pyspark.sql import functions as F

#: Ids with a null and a repeat, texts null, empty, blank, equal but for case, long, and columns named like inner ones.
ROWS = [(5, "The cat sat on the mat today and purred"), (3, "the CAT sat on the mat today and purred"), (None, "the cat"), (None, None), (7, ""), (7, ""), (9, " \t\n "), (11, "word " * 30_000), (12, "123 456 !!"), (13, "é日本 <|endoftext|> ﬁ")]
NAMES = ["id", "fp", "digest", "body", "row", "sha", "keep_id", "kept", "group_size", "text_sha256", "found", "_gone", "_row", "_text", "score", "lang_pred", "component_id", "mark", "route"]


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame([(i, t, "xx") for i, t in ROWS], "doc_id long, text string, lang string").repartition(3)
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
