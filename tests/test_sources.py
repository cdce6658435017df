"""Text, Arrow, packed and snapshot sources against plain Python readers."""

import os
import random
import re
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusprep.functions.text import words
from corpusprep.operators.tokens import append_eos
from corpusprep.sources import snapshot
from corpusprep.sources.arrow_stream import read_pretokenized, require_length, write_pretokenized
from corpusprep.sources.corpus import pack_corpus, read_corpus, split_corpus, with_byte_offsets
from corpusprep.sources.packed import read_packed, write_packed
from corpusprep.sources.snapshot import (
    commit_snapshot,
    latest_snapshot,
    load_snapshot,
    prepare_snapshot,
    remove_abandoned,
    save_snapshot,
    snapshot_steps,
)


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def make_text(seed, n, final_newline=True):
    rng = random.Random(seed)
    pieces = [b"alpha", b"beta", b"\xff\xfe", "é".encode(), b" ", "　".encode(), b"x1", b"a+b", b""]
    lines = [b" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    return b"\n".join(lines) + (b"\n" if final_newline else b"")


def split_by_reading(path, share=0.9):
    """The two sides of one file, read the serial way: seek, skip a line, count bytes."""
    size = os.path.getsize(path)
    cut = int(size * share)
    train, val = [], []
    with open(path, "rb") as f:
        at = 0
        for raw in f:
            at += len(raw)
            if at > cut:
                break
            train.append(raw)
    with open(path, "rb") as f:
        f.seek(cut)
        f.readline()
        val = f.readlines()
    clean = lambda raws: [r.decode("utf-8", "replace").removesuffix("\n") for r in raws]
    return clean(train), clean(val)


def in_order(df):
    return [r["line"] for r in df.orderBy("block_no", "id").select("line").collect()]


@pytest.mark.parametrize("final_newline", [True, False])
def test_one_file_in_many_blocks(spark, tmp_path, small_blocks, final_newline):
    path = tmp_path / "one.txt"
    path.write_bytes(make_text(1, 300, final_newline))
    corpus = read_corpus(spark, str(path))
    lines = corpus.lines
    assert lines.select("block_no").distinct().count() > 5
    raw = path.read_bytes().split(b"\n")
    raw = raw[:-1] if final_newline else raw
    located = with_byte_offsets(lines).orderBy("start").collect()
    assert located == with_byte_offsets(lines, moved=True).select(*located[0].__fields__).orderBy("start").collect()
    plan = with_byte_offsets(lines)._jdf.queryExecution().executedPlan().toString()
    text_side = plan.split("BroadcastExchange")[0]
    assert "FileScan text" in text_side and "Exchange" not in text_side and "Window" not in text_side
    assert [r["line"] for r in located] == [b.decode("utf-8", "replace") for b in raw]
    at = 0
    for r, b in zip(located, raw):
        assert (r["start"], r["end"]) == (at, min(at + len(b) + 1, path.stat().st_size))
        at += len(b) + 1
    split = split_corpus(corpus)
    train, val = split_by_reading(path)
    assert in_order(split.filter("split = 'train'")) == train
    assert in_order(split.filter("split = 'val'")) == val


@pytest.mark.parametrize("cut_on_boundary", [True, False])
def test_line_at_and_across_the_cut(spark, tmp_path, cut_on_boundary):
    path = tmp_path / "cut.txt"
    body = b"123456789\n" * 10 if cut_on_boundary else b"1234567890123456789\n" * 5
    path.write_bytes(body)
    split = split_corpus(read_corpus(spark, str(path)))
    train, val = split_by_reading(path)
    assert in_order(split.filter("split = 'train'")) == train
    assert in_order(split.filter("split = 'val'")) == val


@pytest.mark.parametrize("files", [2, 10])
def test_folder_split_and_packing(spark, tmp_path, small_blocks, files):
    for i in range(files):
        folder = tmp_path / f"d {i % 3}" / "deep+er"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{i}%.txt").write_bytes(make_text(i, 40, i % 2 == 0) if i != 1 else b"only words here\n")
    (tmp_path / "skipped.md").write_text("no")
    found = sorted(str(p) for p in tmp_path.rglob("*.txt"))
    corpus = split_corpus(read_corpus(spark, str(tmp_path)))
    sides = {"train": found[: int(0.9 * files)], "val": found[int(0.9 * files) :]}
    for side, paths in sides.items():
        texts = [open(p, "rb").read().decode("utf-8", "replace") for p in paths]
        lines = [line for t in texts for line in t.split("\n")[: -1 if t.endswith("\n") else None]]
        part = corpus.filter(F.col("split") == side)
        assert in_order(part) == lines
        import re

        stream = [t for line in lines if line.strip() for t in [*re.findall("[a-z0-9]+", line.lower()), "<eos>"]]
        packed = pack_corpus(part, append_eos(words(F.col("line")), "<eos>"), 8).orderBy("seq_id").collect()
        assert [t for r in packed for t in r["ids"]] == stream[: len(stream) // 8 * 8]


def test_missing_corpus(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for path in (tmp_path / "nowhere", tmp_path / "empty"):
        with pytest.raises(FileNotFoundError):
            read_corpus(spark, str(path))


def test_empty_file(spark, tmp_path):
    (tmp_path / "e.txt").write_bytes(b"")
    assert read_corpus(spark, str(tmp_path)).lines.count() == 0


@pytest.mark.parametrize("kind", ["stream", "file"])
def test_arrow_folder(spark, tmp_path, kind):
    expect = []
    for i in range(3):
        rows = [[i, j, i * j] for j in range(5)]
        expect += rows
        table = pa.table({"other": ["x"] * 5, "input_ids": pa.array(rows, pa.list_(pa.int32()))})
        with pa.OSFile(str(tmp_path / f"p{i}.arrow"), "wb") as sink:
            make = pa.ipc.new_stream if kind == "stream" else pa.ipc.new_file
            with make(sink, table.schema) as writer:
                writer.write_table(table, max_chunksize=2)
    df = read_pretokenized(spark, str(tmp_path))
    assert df.dtypes == [("input_ids", "array<bigint>")]
    assert sorted(r["input_ids"] for r in df.collect()) == sorted(expect)
    assert df.rdd.getNumPartitions() == 3
    cut = read_pretokenized(spark, str(tmp_path), split_bytes=1)
    assert cut.rdd.getNumPartitions() == 9 and sorted(r["input_ids"] for r in cut.collect()) == sorted(expect)
    placed = read_pretokenized(spark, str(tmp_path), position=True).orderBy("file_no", "row_no").collect()
    assert [r["input_ids"] for r in placed] == expect
    assert [(r["file_no"], r["row_no"]) for r in placed] == [(i, j) for i in range(3) for j in range(5)]
    assert df.select(require_length(F.col("input_ids"), 3)).count() == 15
    assert read_pretokenized(spark, str(tmp_path), length=3).count() == 15
    with pytest.raises(Exception, match="expected 4 ids"):
        read_pretokenized(spark, str(tmp_path), length=4).collect()
    with pytest.raises(Exception, match="expected 4 ids"):
        df.select(require_length(F.col("input_ids"), 4)).collect()


def write_arrow(path, columns, kind="stream", rows=2, end=True):
    table = pa.table(columns)
    sink = pa.OSFile(str(path), "wb")
    writer = (pa.ipc.new_stream if kind == "stream" else pa.ipc.new_file)(sink, table.schema)
    writer.write_table(table, max_chunksize=rows)
    if end:
        writer.close()
    sink.close()


def lists(n, first=0, kind=pa.int32()):
    return pa.array([[i, i + 1] for i in range(first, first + n)], pa.list_(kind))


@pytest.mark.parametrize("kind", ["stream", "file"])
def test_one_arrow_file_is_read_by_many_tasks(spark, tmp_path, kind):
    write_arrow(tmp_path / "a.arrow", {"x": pa.array(range(1000)), "input_ids": lists(1000, kind=pa.int64())}, kind, 10)
    df = read_pretokenized(spark, str(tmp_path), position=True, split_bytes=1500)
    assert 10 < df.rdd.getNumPartitions() < 100
    rows = df.orderBy("row_no").collect()
    assert [r["row_no"] for r in rows] == list(range(1000)) and [r["input_ids"][0] for r in rows] == list(range(1000))
    spread = df.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in spread) <= 100


@pytest.mark.parametrize("kind", ["stream", "file"])
def test_arrow_file_with_dictionaries(spark, tmp_path, kind):
    words = pa.array(["a", "b", "a", "c"] * 5).dictionary_encode()
    write_arrow(tmp_path / "a.arrow", {"w": words, "input_ids": lists(20)}, kind, 3)
    df = read_pretokenized(spark, str(tmp_path), position=True, split_bytes=1)
    assert [r["input_ids"][0] for r in df.orderBy("row_no").collect()] == list(range(20))


@pytest.mark.parametrize(
    "columns, message",
    [
        ({"ids": lists(2), "tail": lists(2)}, "b.arrow has no column 'input_ids'"),
        ({"input_ids": pa.array([1, 2])}, "column 'input_ids' of .*b.arrow is int64"),
        ({"input_ids": pa.array([["x"], []])}, "column 'input_ids' of .*b.arrow is list"),
    ],
)
def test_arrow_file_without_the_column(spark, tmp_path, columns, message):
    write_arrow(tmp_path / "a.arrow", {"input_ids": lists(2)})
    write_arrow(tmp_path / "b.arrow", columns)
    with pytest.raises(ValueError, match=message):
        read_pretokenized(spark, str(tmp_path))


def test_arrow_files_without_rows(spark, tmp_path):
    write_arrow(tmp_path / "a.arrow", {"input_ids": lists(0)})
    assert read_pretokenized(spark, str(tmp_path)).collect() == []


def test_arrow_nulls_and_large_lists(spark, tmp_path):
    rows = [[1, 2], None, [], [3]]
    for i, kind in enumerate((pa.list_(pa.int16()), pa.large_list(pa.uint32()))):
        write_arrow(tmp_path / f"{i}.arrow", {"input_ids": pa.array(rows, kind)})
    found = read_pretokenized(spark, str(tmp_path), position=True).orderBy("file_no", "row_no").collect()
    assert [r["input_ids"] for r in found] == rows * 2


def test_arrow_written_and_overwritten(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).select(F.array("id", F.col("id") * 2).alias("input_ids"))
    write_pretokenized(df.repartition(3), path)
    write_pretokenized(df.limit(10), path)
    assert read_pretokenized(spark, path).count() == 110
    write_pretokenized(df.repartition(2), path, "overwrite")
    assert sorted(r["input_ids"][0] for r in read_pretokenized(spark, path).collect()) == list(range(100))
    assert all(name.endswith(".arrow") for name in os.listdir(path))


def test_arrow_folder_without_files(spark, tmp_path):
    with pytest.raises(ValueError):
        read_pretokenized(spark, str(tmp_path))


def test_packed_round_trip(spark, tmp_path):
    df = spark.range(100).select(
        F.col("id").alias("seq_id"),
        F.array("id", F.col("id") + 1).alias("ids"),
        F.when(F.col("id") < 90, "train").otherwise("val").alias("split"),
        (F.col("id") % 4).cast("int").alias("shard_id"),
    )
    write_packed(df, str(tmp_path / "out"), target_bytes=200)
    back = read_packed(spark, str(tmp_path / "out"), 2)
    assert sorted(map(tuple, back.select(df.columns).collect())) == sorted(map(tuple, df.collect()))
    shard = back.filter("split = 'val' AND shard_id = 1")
    assert "PartitionFilters: [isnotnull" in shard._jdf.queryExecution().executedPlan().toString()
    assert shard.count() == 2


def test_packed_files_have_similar_sizes(spark, tmp_path):
    """A shard with most of the rows is many files, a small one is one; each is in order."""
    shard = F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 10)
    df = spark.range(20_000).select(
        F.col("id").alias("seq_id"), F.array_repeat("id", 32).alias("ids"), F.lit("train").alias("split"), shard.alias("shard_id")
    )
    target = 400_000
    write_packed(df, str(tmp_path / "out"), target_bytes=target)
    files = list((tmp_path / "out").rglob("*.parquet"))
    rows = {f: [r.as_py() for r in pq.ParquetFile(f).read()["seq_id"]] for f in files}
    per_shard = {s: [len(r) for f, r in rows.items() if f"shard_id={s}/" in str(f)] for s in (0, 8, 9)}
    assert {s: len(n) for s, n in per_shard.items()} == {0: 11, 8: 2, 9: 2}
    assert all(target / 2 < n * 32 * 8 < target * 2 for sizes in per_shard.values() for n in sizes)
    assert all(r == sorted(r) for r in rows.values())
    write_packed(df.limit(0), str(tmp_path / "none"))


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snaps")
    assert latest_snapshot(spark, root) is None
    with pytest.raises(FileNotFoundError):
        load_snapshot(spark, root)
    save_snapshot(spark.range(1), root, 0)
    assert latest_snapshot(spark, root) == 0
    for step in (5, 10, 15, 20):
        save_snapshot(spark.range(step), root, step)
    assert snapshot_steps(spark, root) == [10, 15, 20]
    assert load_snapshot(spark, root).count() == 20 and load_snapshot(spark, root, 10).count() == 10
    with pytest.raises(FileNotFoundError):
        load_snapshot(spark, root, 5)
    assert len(os.listdir(f"{root}/data")) == 3
    save_snapshot(spark.range(7), root, 20)
    assert load_snapshot(spark, root).count() == 7 and len(os.listdir(f"{root}/data")) == 3


def test_a_killed_save_is_never_the_latest(spark, tmp_path):
    root = str(tmp_path / "snaps")
    save_snapshot(spark.range(3), root, 1)
    prepare_snapshot(spark.range(9), root, 2)  # all files are there, the manifest is not
    broken = spark.range(8).select(F.when(F.col("id") == 5, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        save_snapshot(broken, root, 3)
    assert snapshot_steps(spark, root) == [1] and load_snapshot(spark, root).count() == 3
    # A new attempt at the step commits its own folder; the abandoned ones can be cleared.
    commit_snapshot(spark, root, prepare_snapshot(spark.range(4), root, 2))
    assert latest_snapshot(spark, root) == 2 and load_snapshot(spark, root).count() == 4
    assert len(remove_abandoned(spark, root)) == 2
    assert load_snapshot(spark, root, 1).count() == 3 and load_snapshot(spark, root).count() == 4


def test_a_replaced_save_that_was_killed_keeps_the_old_one(spark, tmp_path):
    root = str(tmp_path / "snaps")
    save_snapshot(spark.range(3), root, 1)
    prepare_snapshot(spark.range(50), root, 1)
    assert load_snapshot(spark, root, 1).count() == 3


def test_a_snapshot_that_lost_a_file_is_an_error(spark, tmp_path):
    root = str(tmp_path / "snaps")
    path = save_snapshot(spark.range(100).repartition(4), root, 1)
    os.unlink(sorted(Path(path).glob("*.parquet"))[0])
    with pytest.raises(OSError, match="lacks"):
        load_snapshot(spark, root)


def test_dropping_takes_the_manifest_first(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "snaps")
    save_snapshot(spark.range(3), root, 1)
    gone = []
    monkeypatch.setattr(snapshot, "remove", lambda spark, path: gone.append(path))
    snapshot.drop_snapshot(spark, root, 1)
    assert [("manifests" in p, "data" in p) for p in gone] == [(True, False), (False, True)]


def test_empty_snapshot_keeps_its_columns(spark, tmp_path):
    save_snapshot(spark.range(0).toDF("k"), str(tmp_path / "s"), 1)
    assert load_snapshot(spark, str(tmp_path / "s")).dtypes == [("k", "bigint")]


def test_a_corpus_is_written_by_as_many_tasks_as_its_table_has(spark, sf, tmp_path, monkeypatch):
    from corpusprep.plans import files

    kept = spark.read.parquet(f"{sf}/documents.parquet").limit(120).repartition(40)
    kept.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        place = []
        made = files.stage_path
        monkeypatch.setattr(files, "stage_path", lambda spark, label: place.append(made(spark, label)) or place[-1])
        files.corpus_lines(spark, str(tmp_path)).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    names = {p.name.split("-")[1] for p in Path(place[0].removeprefix("file:")).rglob("part-*.txt")}
    assert len(names) > 8


def test_sequences_are_packed_once_for_counting_planning_and_writing(spark, sf, monkeypatch):
    from corpusprep.plans import files

    plans = []
    monkeypatch.setattr(files, "write_packed", lambda df, *a, **b: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write_packed(df, *a, **b))
    files.packed_files(spark, sf).count()
    assert "documents" not in plans[0] and "Generate" not in plans[0]


def test_packed_files_make_tokens_once_and_move_them_as_text(spark, sf, tmp_path, monkeypatch):
    """Null, empty, blank and repeated rows; the texts are tokenized below the shuffle that the packer reads."""
    from corpusprep.plans import files
    from test_plans import final_plan

    texts = [None, "", " \n\t\n", "!!\n", "One two, THREE\nfour\n\nfive", "é x\u2003y <eos> \u212a"]
    rows = [(i, texts[i % len(texts)]) for i in range(600)]
    rows = [*rows, *rows[:80], (None, "null id"), (None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    flat = []
    for _, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for line in (text or "").split("\n"):
            if line.strip():
                flat += [*re.findall("[a-z0-9]+", line.lower()), "<eos>"]
    size, batch = files.SEQ_LEN, files.BATCH
    sequences = [flat[i : i + size] for i in range(0, len(flat) - size + 1, size)]
    kept = [i for i in range(len(sequences) // batch * batch) if i // batch % 10 < 9]

    plans, moved, keep = [], [], files.stage
    monkeypatch.setattr(files, "stage", lambda df, label: plans.append(final_plan(df)) or keep(df, label))
    monkeypatch.setattr(files, "write_packed", lambda df, path, *a, **b: moved.append((df, path)) or write_packed(df, path, *a, **b))
    got = files.packed_files(spark, str(tmp_path))
    shard = batch // files.SHARDS
    assert sorted(map(tuple, got.collect())) == [(i, i % batch // shard, " ".join(sequences[i])) for i in kept] != []
    assert plans[0].count("regexp_extract_all") == 1
    df, path = moved[0]
    assert df.schema["ids"].dataType.simpleString() == "string"
    back = read_packed(spark, path)
    assert back.schema["ids"].dataType.simpleString() == "array<string>" and set(back.columns) == set(df.columns)
    assert back.filter(F.size("ids") != size).count() == 0


def test_ids_moved_as_text_give_the_same_files(spark, tmp_path):
    words = F.transform(F.sequence(F.lit(1), F.col("id") % 7 + 1), lambda i: F.concat(F.lit("w"), (i * i).cast("string")))
    df = spark.range(3000).select(F.col("id").alias("seq_id"), words.alias("ids"), F.lit("train").alias("split"), (F.col("id") % 3).alias("shard_id"))
    text = df.withColumn("ids", F.array_join("ids", " "))
    write_packed(df, str(tmp_path / "a"), target_bytes=5000)
    write_packed(text, str(tmp_path / "b"), target_bytes=5000, unpack=F.split("ids", " "))
    write_packed(text.limit(0), str(tmp_path / "c"), unpack=F.split("ids", " "))
    a, b = (sorted(str(pq.ParquetFile(f).read().to_pylist()) for f in (tmp_path / x).rglob("*.parquet")) for x in "ab")
    assert a == b and len(a) > 3
