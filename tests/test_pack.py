"""Packing against the serial buffer loop."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpusprep.operators import order as O
from corpusprep.operators.pack import pack
from corpusprep.operators.shuffle import repeat_epochs, shuffle


def serial(lists, length):
    buffer, out = [], []
    for ids in lists:
        buffer.extend(ids)
        while len(buffer) >= length:
            out.append(buffer[:length])
            buffer = buffer[length:]
    return out


def packed(spark, lists, length):
    df = spark.createDataFrame(list(enumerate(lists)), "k bigint, ids array<int>")
    rows = pack(df, ["k"], F.col("ids"), length).collect()
    assert sorted(r["seq_id"] for r in rows) == list(range(len(rows)))
    return [r["ids"] for r in sorted(rows, key=lambda r: r["seq_id"])]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    sizes=st.lists(st.integers(0, 23), min_size=1, max_size=40),
    length=st.sampled_from([1, 2, 7, 16, 1000]),
    rows_per_bucket=st.sampled_from([1, 3, 1000]),
)
def test_pack_equals_loop(spark, sizes, length, rows_per_bucket):
    old, O.ROWS_PER_BUCKET = O.ROWS_PER_BUCKET, rows_per_bucket
    try:
        token = iter(range(10**6))
        lists = [[next(token) for _ in range(n)] for n in sizes]
        assert packed(spark, lists, length) == serial(lists, length)
    finally:
        O.ROWS_PER_BUCKET = old


@pytest.mark.parametrize("sizes", [[0, 1, 15, 16, 17, 50], [16] * 4, [0, 0, 0], [500, 1, 1, 1]])
def test_pack_edges(spark, sizes):
    token = iter(range(10**6))
    lists = [[next(token) for _ in range(n)] for n in sizes]
    out = packed(spark, lists, 16)
    assert out == serial(lists, 16)
    flat = [t for ids in lists for t in ids]
    assert [t for ids in out for t in ids] == flat[: len(flat) // 16 * 16]


def test_one_row_holds_most_of_the_tokens(spark):
    lists = [[1, 2, 3], list(range(20_000)), [4, 5], []]
    assert packed(spark, lists, 64) == serial(lists, 64)


def test_shuffle_is_a_permutation_that_changes_with_the_epoch(spark):
    df = spark.range(1000)
    first, again, second = (
        [r["id"] for r in shuffle(df, ["id"], 7, e).orderBy("pos").collect()] for e in (0, 0, 1)
    )
    assert first == again != second
    assert sorted(first) == sorted(second) == list(range(1000)) != first


def test_epochs_restart_and_stop_at_the_cap(spark):
    rows = repeat_epochs(spark.range(103), ["id"], 10, 3, 15, seed=1).collect()
    assert len(rows) == 150 and {r["step"] for r in rows} == set(range(15))
    assert {r["epoch"] for r in rows if r["step"] < 10} == {0}
    assert len({r["id"] for r in rows if r["epoch"] == 0}) == 100
