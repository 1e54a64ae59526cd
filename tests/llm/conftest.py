import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
EDGE = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, shard int, key string, id string"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, odd characters and clashing columns."""
    line = "This very line is shared by a number of documents here."
    long = " ".join(f"word{k % 977}x{k % 31}" for k in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, "One two three four five six"), (5, "One two three four five six"),
        (6, "one TWO three four five six"), (None, "a row without an id"), (None, None), (7, "a b éÉ 日本 \x1c 😀"),
        (8, "a\n\n" + line), (9, line + "\n" + line), (10, "  " + line.upper() + "\t\nmore"), (11, line), (12, line + "\nx\n"), (13, line),
        (14, "same"), (14, "other"), (15, "<|endoftext|> <|startoftext|>"), (16, "x" * 5000),
    ]
    full = [(i, t, None, None, None, 1, 2, "k", "i") for i, t in rows]
    return spark.createDataFrame(full, EDGE).repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.where(F.lit(False))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
