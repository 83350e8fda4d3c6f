import pytest
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20000

ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),  # repeated row
    (2, "The quick brown fox jumps over the lazy dog near the river bank today."),  # copy
    (None, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (3, None), (4, ""), (5, "  \n\t "), (6, "one"), (7, "Ünïcödé ß 中文 😀 text."),
    (8, LONG), (9, LONG + "x"), (None, None), (3, "another text under a used id"),
]
# Names that the operators use inside.
CLASHES = ("fp", "first", "root", "key", "row", "token", "run", "start", "stop", "n", "bin",
           "length", "score", "found", "bucket", "guest", "label", "slots", "spans", "block",
           "text_key", "no_id", "salt", "rank", "piece", "hits", "component_id", "kept")


def with_clashes(df):
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})


@pytest.fixture(scope="package")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing extra columns."""
    return with_clashes(spark.createDataFrame(ODD_ROWS, "doc_id long, text string"))


@pytest.fixture(scope="package")
def empty(spark):
    return with_clashes(spark.createDataFrame([], "doc_id long, text string"))


@pytest.fixture(scope="package")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="package")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
