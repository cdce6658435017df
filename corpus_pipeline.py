"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, secrets, tokens.

Each stage takes what the one before kept. All but the last return the columns
of ``documents``. Nulls, empty texts, repeated rows, empty tables and further
columns pass as the operators' docstrings say: null texts are judged as empty
ones, rows with a null id are never dropped as duplicates or leaks, and
further columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusprep.llm import decontaminate, quality, secrets, sentencepieces, simhash
from corpusprep.llm.common import table, tokenizer_file
from corpusprep.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id."""
    return simhash.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage or a re-parameterised question of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` follows the text."""
    return secrets.redact_secrets(docs, length="n_chars" if "n_chars" in docs.columns else None)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, the source bytes of each token, and whether they decode to the text."""
    return sentencepieces.encode_checked(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("simhash", one_of_each),
    ("decontaminate", no_benchmark),
    ("secrets", no_secrets),
    ("tokens", tokens),
]

#: The stages learn a model, follow links and tokenize, which SQL cannot say; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
