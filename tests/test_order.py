"""Running sums, positions and look-backs against plain loops, with hot keys and odd spreads."""

import random
from datetime import datetime
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import order as O
from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.metrics import trailing_mean


def _rows(n, seed, spread):
    rng = random.Random(seed)
    keys = {
        "dense": range(n),
        "clustered": [i if i < n - 5 else 10**15 + i for i in range(n)],
        "negative": [i * i - n for i in range(n)],
        "extreme": [-(2**63) + i if i % 2 else 2**63 - 1 - i for i in range(n)],
    }[spread]
    keys = sorted(keys)
    rows = []
    for k in keys:
        run = rng.choice([None, 1, 1, 1, 2, 3])
        rows.append((k, run, rng.randint(0, 9)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("spread", ["dense", "clustered", "negative", "extreme"])
def test_running_equals_loop(spark, monkeypatch, spread):
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 7)
    rows = _rows(500, 1, spread)
    df = spark.createDataFrame(rows, "k bigint, run int, w int")
    got = O.running(
        df,
        ["k"],
        {"before": F.col("w").cast("bigint"), "pos": F.lit(1).cast("bigint")},
        by=["run"],
        totals={"n": (F.count(F.lit(1)), "sum"), "low": (F.min("k"), "min")},
    )
    seen, count, expect = defaultdict(int), defaultdict(int), {}
    for k, run, w in sorted(rows):
        expect[k] = (seen[run], count[run])
        seen[run] += w
        count[run] += 1
    result = {r["k"]: r for r in got.collect()}
    assert {k: (r["before"], r["pos"]) for k, r in result.items()} == expect
    assert all(r["n"] == count[r["run"]] for r in result.values())


@pytest.mark.parametrize("second", ["int", "string", "timestamp_ntz"])
@pytest.mark.parametrize("hot", [5, None, 2**63 - 1])
def test_a_hot_first_key_is_cut_by_the_next(spark, second, hot):
    rows = [(hot if i % 3 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, i bigint").withColumn(
        "s",
        {
            "int": F.col("i").cast("int"),
            "string": F.format_string("%06d", "i"),
            "timestamp_ntz": F.timestamp_seconds(F.col("i") * 7).cast("timestamp_ntz"),
        }[second],
    )
    bucket = O.order_bucket(df, [F.col("k"), F.col("s")], rows_per_bucket=50)
    sizes = [r["count"] for r in df.groupBy(bucket).count().collect()]
    assert max(sizes) <= 300
    got = {r["i"]: r["pos"] for r in O.global_index(df, ["k", "s"]).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == {i: at for at, (_, i) in enumerate(order)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_micros_in_any_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = "2024-03-10 02:30:07.123456"
        got = spark.range(1).select(O.micros(F.lit(text).cast("timestamp_ntz"))).first()[0]
        assert got == int(datetime.fromisoformat(text + "+00:00").timestamp()) * 10**6 + 123456
        early = spark.range(1).select(O.micros(F.lit("1969-12-31 23:59:59.5").cast("timestamp_ntz"))).first()[0]
        assert early == -500_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("partitions", ["1", "4", "37"])
def test_index_does_not_depend_on_partitions(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(k,) for k, _, _ in _rows(300, 2, "clustered")]
        df = spark.createDataFrame(rows, "k bigint").repartition(int(partitions))
        got = {r["k"]: r["pos"] for r in O.global_index(df, ["k"]).collect()}
        assert got == {k: i for i, (k,) in enumerate(sorted(rows))}
        ranged = {r["k"]: r["pos"] for r in O.ranged_index(df, [F.desc("k")]).collect()}
        assert ranged == {k: len(rows) - 1 - i for k, i in got.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def _sizes(df, keys, rows_per_bucket):
    bucket = O.order_bucket(df, [F.col(k) for k in keys], rows_per_bucket=rows_per_bucket)
    return [r["count"] for r in df.groupBy(bucket).count().collect()]


def test_buckets_are_balanced_when_keys_cluster(spark):
    rows = [(i,) for i in range(5000)] + [(10**17 + i,) for i in range(5000)]
    sizes = _sizes(spark.createDataFrame(rows, "k bigint"), ["k"], 100)
    assert len(sizes) > 80 and max(sizes) <= 500


def test_a_hot_run_is_cut_and_short_runs_stay_whole(spark):
    hot = spark.range(20_000).select(F.lit(7).cast("bigint").alias("run"), F.col("id").alias("k"))
    short = spark.range(20_000).select((F.col("id") % 5000 + 10).alias("run"), F.col("id").alias("k"))
    df = hot.unionByName(short).cache()
    assert max(_sizes(df, ["run", "k"], 500)) <= 2500
    bucket = O.order_bucket(df, [F.col("run"), F.col("k")], rows_per_bucket=500)
    totals = df.select("run", bucket.alias("b")).distinct().count()
    buckets = df.select(bucket.alias("b")).distinct().count()
    assert totals <= 5001 + buckets
    got = O.global_index(df, ["k"], by=["run"]).filter("run = 7").agg(F.sum((F.col("pos") != F.col("k")).cast("int")))
    assert got.first()[0] == 0


TUPLES = {
    "several hot values with a rare neighbour": [(k, i) for i, k in enumerate([0, 3, 6] * 2991 + [4] * 27)],
    "text with one long prefix": [(f"https://host/a/long/path/doc-{i % 50:07d}", i) for i in range(9000)],
    "a hot id above 2 ** 53": [(2**60 + 1 if i % 2 else 2**60 + i, i) for i in range(9000)],
    "nulls": [(None if i % 3 else i, i) for i in range(3000)],
}


@pytest.mark.parametrize("case", list(TUPLES))
def test_positions_equal_a_sort(spark, case):
    rows = TUPLES[case]
    kind = "string" if isinstance(rows[0][0], str) else "bigint"
    df = spark.createDataFrame(rows, f"a {kind}, b bigint").repartition(5)
    got = {r["b"]: r["pos"] for r in O.global_index(df, ["a", "b"]).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0 if kind == "bigint" else r[0], r[1]))
    assert got == {b: at for at, (_, b) in enumerate(order)}
    assert max(_sizes(df, ["a", "b"], 100)) <= 800


@pytest.mark.parametrize("share", [0.0, 0.5, 0.9, 1.0])
def test_cut_key(spark, share):
    rows = _rows(211, 3, "negative")
    df = spark.createDataFrame([(k,) for k, _, _ in rows], "k bigint")
    keys = sorted(k for k, _, _ in rows)
    cut = O.cut_key(df, "k", share)
    assert sum(k < cut for k in keys) == int(share * len(keys)) if cut is not None else share == 1.0


@pytest.mark.parametrize("block", [3, 10, 65_536])
def test_halo_window_equals_plain_window(spark, block):
    df = spark.range(100).select(F.lit("a").alias("run"), "id", (F.col("id") % 7).alias("v"))
    mean = {"m": lambda w: F.sum("v").over(w.rowsBetween(-3, 0))}
    got = {r["id"]: r["m"] for r in O.halo_window(df, ["run"], "id", 3, mean, block).collect()}
    assert got == {i: sum(j % 7 for j in range(max(0, i - 3), i + 1)) for i in range(100)}


def test_trailing_mean_of_fewer_rows_than_the_window(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0)], "run string, pos bigint, v double")
    got = [r["trailing_mean"] for r in trailing_mean(df, ["run"], "pos", "v", 25).orderBy("pos").collect()]
    assert got == [1.0, 1.5]


@pytest.mark.parametrize("row_bytes", [64, 1 << 40])
def test_lookup_join_small_and_large(spark, row_bytes):
    facts = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = lookup_join(facts, dim, "k", row_bytes=row_bytes)
    assert sorted(got.columns) == ["id", "k", "v"]
    result = {r["id"]: r["v"] for r in got.collect()}
    assert result == {i: (0 if i % 3 == 0 else 2 * i if i < 500 else None) for i in range(1000)}
