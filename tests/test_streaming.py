"""Streams against the batch operators, also across a restart."""

import os

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.text import is_blank
from corpusprep.operators.metrics import cumulative_rate, trailing_mean
from corpusprep.streaming.metrics import metrics_stream
from corpusprep.streaming.packer import pack_stream
from corpusprep.streaming.run import for_each_batch, start, stream_corpus

SCHEMA = "source string, seq bigint, ids array<bigint>"


def add_file(spark, folder, number, rows, schema):
    """One Parquet file, named and dated so that streams read it in order."""
    df = spark.createDataFrame(rows, schema).coalesce(1)
    df.toPandas().to_parquet(f"{folder}/{number:03d}.parquet")
    os.utime(f"{folder}/{number:03d}.parquet", (1_700_000_000 + number * 60,) * 2)


def id_rows(first, n):
    return [(f"s{i % 2}" if i % 5 else "s0", i, list(range(i * 10, i * 10 + i % 7))) for i in range(first, first + n)]


@pytest.mark.parametrize("lanes", [1, 3])
def test_packer_with_a_restart(spark, tmp_path, lanes):
    folder = tmp_path / "in"
    folder.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        sdf = stream_corpus(spark, str(folder), max_files=1, schema=SCHEMA)
        start(pack_stream(sdf, "source", "seq", "ids", 8, lanes), out, checkpoint).awaitTermination()

    add_file(spark, folder, 0, id_rows(0, 20), SCHEMA)
    run()
    add_file(spark, folder, 1, id_rows(20, 15), SCHEMA)
    add_file(spark, folder, 2, id_rows(35, 30), SCHEMA)
    run()
    rows = spark.read.parquet(out).orderBy("seq_id").collect()
    lane_of = {
        r["seq"]: r["lane"]
        for r in spark.range(65).select(
            F.col("id").alias("seq"), F.pmod(F.xxhash64("id"), F.lit(lanes)).cast("int").alias("lane")
        ).collect()
    }
    for source in ("s0", "s1"):
        for lane in range(lanes):
            stream = [t for s, i, ids in id_rows(0, 65) if s == source and lane_of[i] == lane for t in ids]
            got = [t for r in rows if r["source"] == source and r["lane"] == lane for t in r["ids"]]
            assert got == stream[: len(stream) // 8 * 8]
    assert all(len(r["ids"]) == 8 for r in rows)


def test_metrics_equal_batch_with_a_restart(spark, tmp_path):
    schema = "run string, event_id bigint, ts bigint, loss double"
    rows = [(f"r{i % 3 and 1}", i, i * 1_000_000 + 7, float(i * i % 11)) for i in range(60)]
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        sdf = stream_corpus(spark, str(folder), max_files=1, schema=schema)
        live = metrics_stream(sdf, "run", "ts", "event_id", "loss", F.lit(127), k=5)
        start(live, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    add_file(spark, folder, 0, rows[:25], schema)
    run()
    add_file(spark, folder, 1, rows[25:27], schema)
    add_file(spark, folder, 2, rows[27:], schema)
    run()
    live = {(r["run"], r["step"]): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    log = spark.createDataFrame(rows, schema)
    batch = trailing_mean(cumulative_rate(log, F.lit(127)), ["run"], "pos", "loss", 5).collect()
    assert len(live) == len(batch) == 60
    for r in batch:
        same = live[r["run"], r["pos"] + 1]
        assert same["tokens_seen"] == r["tokens_seen"] and same["loss"] == r["loss"]
        assert same["trailing_mean"] == pytest.approx(r["trailing_mean"])
        assert same["rate"] == pytest.approx(r["rate"])


def test_text_stream_and_batches_with_leftovers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.txt").write_text("".join(f"{i * 100 + j}\n" for j in range(7)) + " \n")
        os.utime(folder / f"{i}.txt", (1_700_000_000 + i * 60,) * 2)
    seen = []

    def consume(df, micro_batch):
        seen.extend((micro_batch, r["batch_id"], r["row_in_batch"], r["shard_id"], r["n"]) for r in df.collect())

    sdf = stream_corpus(spark, str(folder), max_files=1).filter(~is_blank(F.col("value")))
    numbered = sdf.select(F.col("value").cast("bigint").alias("n"))
    for_each_batch(numbered, consume, str(tmp_path / "cp"), "n", 4, 2).awaitTermination()
    expect = [i * 100 + j for i in range(3) for j in range(7)][:20]
    assert [s[-1] for s in sorted(seen)] == expect
    assert all(s[3] == s[2] // 2 for s in seen)
