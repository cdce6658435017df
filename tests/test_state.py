"""Sorting through the state: order, memory, and large groups in one micro-batch."""

import random
import tracemalloc

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_streaming import SCHEMA, add_file

from corpusprep.operators.metrics import cumulative_rate, trailing_mean
from corpusprep.sources.arrow_stream import stream_pretokenized
from corpusprep.streaming.metrics import metrics_stream
from corpusprep.streaming.packer import _Packer, pack_stream
from corpusprep.streaming.run import for_each_batch, start, stream_corpus
from corpusprep.streaming.sorted_state import SortedRows


class FakeMap(dict):
    """A map state on disk, as far as memory is concerned: what it holds is not counted."""

    def __init__(self, folder=None):
        self.folder, self.most = folder, 0

    def updateValue(self, key, value):
        if self.folder:
            pd.to_pickle(value, f"{self.folder}/{key[0]}-{key[1]}.pkl")
            value = None
        self[key] = value
        self.most = max(self.most, len(self))

    def getValue(self, key):
        return pd.read_pickle(f"{self.folder}/{key[0]}-{key[1]}.pkl") if self.folder else self[key]

    def removeKey(self, key):
        del self[key]


@pytest.mark.parametrize("chunk, piece", [(1, 1), (7, 3), (50, 8), (1000, 10)])
def test_rows_come_back_in_order(chunk, piece):
    rng = random.Random(chunk)
    rows = [(rng.randrange(40), f"r{i}") for i in range(300)]
    state = FakeMap()
    ordered = SortedRows(state, ["order", "name"], ["order"], piece)
    for begin in range(0, len(rows), chunk):
        ordered.add(pd.DataFrame(rows[begin : begin + chunk], columns=["order", "name"]))
    got = [r for block in ordered.blocks(13) for r in block]
    assert sorted(map(str, got)) == sorted(map(str, rows))
    keys = [r[0] for r in got]
    assert keys == sorted(keys)
    ordered.clear()
    assert not state


class FakeList(list):
    def get(self):
        return iter(list(self))

    def appendValue(self, value):
        self.append(value)


class FakeValue:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_ten_million_tokens_of_one_source_in_fixed_memory(tmp_path):
    """One key, one micro-batch: memory stays far below what the group holds."""
    packer = _Packer("", 64)
    packer.pieces, packer.rest, packer.next = FakeMap(str(tmp_path)), FakeList(), FakeValue()
    chunks, rows, tokens = 40, 500, 500

    def chunk(c):
        # Chunks overlap in their order, so that every run is merged with all others.
        order = [r * chunks + c for r in range(rows)]
        return pd.DataFrame({"order_missing": False, "order": order, "ids": [[o] * tokens for o in order]})

    tracemalloc.start()
    n = 0
    for out in packer.handleInputRows(("s", 0), (chunk(c) for c in range(chunks)), None):
        first, last = out["ids"].iloc[0], out["ids"].iloc[-1]
        assert first[0] == out["seq_id"].iloc[0] * 64 // tokens and last[-1] == (out["seq_id"].iloc[-1] * 64 + 63) // tokens
        n += len(out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = chunks * rows * tokens
    assert whole == 10_000_000 and n == whole // 64 and packer.next.value == (n,)
    assert peak < 0.25 * whole * 8 * 4, f"{peak >> 20} MB"


@pytest.fixture
def small_chunks(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.transformWithStateInPySpark.maxStateRecordsPerBatch"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "50")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_packer_with_many_chunks_in_one_micro_batch(spark, tmp_path, small_chunks):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [("s", i, [i] * (i % 5)) for i in range(1500)] + [("s", None, [9])]
    random.Random(1).shuffle(rows)
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.list_(pa.int64())))]
    pq.write_table(pa.table(columns, names=["source", "seq", "ids"]), folder / "0.parquet")
    sdf = stream_corpus(spark, str(folder), schema=SCHEMA)
    start(pack_stream(sdf, "source", "seq", "ids", 8), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = [t for r in spark.read.parquet(str(tmp_path / "out")).orderBy("seq_id").collect() for t in r["ids"]]
    whole = [i for i in range(1500) for _ in range(i % 5)] + [9]
    assert got == whole[: len(whole) // 8 * 8]


def test_metrics_of_a_large_run_equal_batch(spark, tmp_path, small_chunks):
    schema = "run string, event_id bigint, ts bigint, loss double"
    rows = [("r", i, (i // 3) * 1_000_000 + 7, float(i * i % 11)) for i in range(1200)]
    folder = tmp_path / "in"
    folder.mkdir()
    mixed = rows[:700]
    random.Random(2).shuffle(mixed)
    add_file(spark, folder, 0, mixed, schema)
    add_file(spark, folder, 1, rows[700:], schema)
    sdf = stream_corpus(spark, str(folder), max_files=1, schema=schema)
    start(metrics_stream(sdf, "run", "ts", "event_id", "loss", F.lit(3), k=7), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    live = {r["step"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = trailing_mean(cumulative_rate(spark.createDataFrame(rows, schema), F.lit(3)), ["run"], "pos", "loss", 7).collect()
    assert len(live) == len(batch) == 1200
    for r in batch:
        same = live[r["pos"] + 1]
        assert (same["tokens_seen"], same["loss"]) == (r["tokens_seen"], r["loss"])
        assert same["trailing_mean"] == pytest.approx(r["trailing_mean"]) and same["rate"] == pytest.approx(r["rate"])


def grow(path, first, batches, known=None):
    """Write an Arrow stream that is not closed: what was there, and further batches of three rows."""
    schema = pa.schema([("input_ids", pa.list_(pa.int32()))])
    rows = [*(known or []), *[[first + 3 * b + i for _ in range(2)] for b in range(batches) for i in range(3)]]
    with pa.OSFile(str(path), "wb") as sink:
        writer = pa.ipc.new_stream(sink, schema)
        writer.write_table(pa.table({"input_ids": pa.array(rows, schema.field(0).type)}), max_chunksize=3)
    return rows


def test_arrow_stream_goes_on_inside_a_file(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()

    def run():
        start(stream_pretokenized(spark, str(folder), split_bytes=1), out, checkpoint).awaitTermination()
        return sorted(r["input_ids"][0] for r in spark.read.schema("input_ids array<bigint>").parquet(out).collect())

    first = grow(folder / "000.arrow", 0, 2)
    assert run() == list(range(6))
    # The file has grown by three batches, and half of a fourth one.
    grow(folder / "000.arrow", 6, 3, first)
    whole = (folder / "000.arrow").read_bytes()
    grow(folder / "tmp", 6, 4, first)
    (folder / "000.arrow").write_bytes((folder / "tmp").read_bytes()[: len(whole) + 40])
    assert run() == list(range(15))
    assert run() == list(range(15))
    grow(folder / "000.arrow", 6, 4, first)
    grow(folder / "001.arrow", 18, 5)
    assert run() == list(range(33))


def test_arrow_stream_repeats_a_failed_micro_batch(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")
    folder.mkdir()
    grow(folder / "000.arrow", 0, 4)
    seen = []

    def run(fail):
        def consume(df, micro_batch):
            if fail:
                raise RuntimeError("killed")
            seen.extend((micro_batch, r["file_no"], r["row_no"]) for r in df.collect())

        sdf = stream_pretokenized(spark, str(folder), position=True)
        query = sdf.writeStream.foreachBatch(consume).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run(True)
    grow(folder / "001.arrow", 12, 1)
    # The first run repeats the micro-batch as it was planned, the second one sees the new file.
    run(False)
    assert sorted((f, r) for _, f, r in seen) == [(0, i) for i in range(12)]
    run(False)
    assert sorted((f, r) for _, f, r in seen) == [(0, i) for i in range(12)] + [(1, i) for i in range(3)]


def test_batches_leave_nothing_behind(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        add_file(spark, folder, i, [("s", i * 10 + j, [j]) for j in range(7)], SCHEMA)
    from corpusprep.session import _stage_dir
    from corpusprep.sources.files import children

    before = set(children(spark, _stage_dir(spark)))
    sdf = stream_corpus(spark, str(folder), max_files=1, schema=SCHEMA).select("seq")
    seen = []
    for_each_batch(sdf, lambda df, m: seen.extend(df.collect()), str(tmp_path / "cp"), "seq", 4).awaitTermination()
    assert len(seen) == 32
    assert set(children(spark, _stage_dir(spark))) == before
    assert sorted(children(spark, str(tmp_path / "cp-rest"))) == ["3", "4"]
