"""Nulls, empty and long texts, repeats, empty tables and columns with clashing names."""

from collections import Counter

import pytest
from odd_runs import COUNTED, run_all


@pytest.mark.parametrize("name", COUNTED)
def test_every_row_comes_back(spark, odd, name):
    rows = run_all(spark, name, odd)
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.select("doc_id").collect())


@pytest.mark.parametrize("name", [*COUNTED, "op6"])
def test_empty_table(spark, none, name):
    assert run_all(spark, name, none) == []


def test_blank_texts_and_null_ids_match_no_item(spark, odd):
    assert run_all(spark, "op6", odd) == []


def test_empty_embeddings(spark):
    from corpusprep.llm import embeddings

    assert embeddings.op1(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []
