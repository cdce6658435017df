import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int, id int, fp string, kept string, shard string, Spans string, __bad string"


def odd_rows():
    """Nulls in every column, empty and blank texts, one long text, repeats and ties."""
    long = " ".join(f"word{i % 977} number {i}" for i in range(60_000))
    texts = ["", None, " \n\t ", "One two", "One two", "a b c d e f g h", "Ünïcödé \U0001f600 text", long]
    rest = [7, "x", "y", "z", "s", "b"]
    rows = [(i, t, "en", "web", len(t or ""), *rest) for i, t in enumerate(texts)]
    none = [None] * 6
    return [*rows, rows[3], (50, "token = abcdef123456", None, None, None, *none), (None, "One two", "en", None, 7, *none)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
