"""The composed jobs, end to end."""

import re

from pyspark.sql import functions as F

from corpusprep.functions.text import words
from corpusprep.operators.tokens import append_eos
from corpusprep.plans.prepare import PrepareConfig, prepare_pretokenized, prepare_text


def test_text_to_shards(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    texts = [f"file{i} " + " ".join(f"w{i}x{j}" for j in range(60)) + "\n\nlast line\n" for i in range(10)]
    for i, text in enumerate(texts):
        (folder / f"{i}.txt").write_text(text)
    cfg = PrepareConfig(seq_len=8, batch_size=4, shards=2, shuffle_buffer=20)
    prepare_text(spark, str(folder), str(tmp_path / "out"), append_eos(words(F.col("line")), "<eos>"), cfg)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    for split, part in {"train": texts[:9], "val": texts[9:]}.items():
        lines = [line for t in part for line in t.splitlines() if line.strip()]
        stream = [t for line in lines for t in [*re.findall("[a-z0-9]+", line), "<eos>"]]
        full = len(stream) // 8
        mine = sorted((r for r in rows if r["split"] == split), key=lambda r: r["pos"])
        assert len(mine) == full // 4 * 4
        assert all(r["ids"] == stream[r["seq_id"] * 8 : r["seq_id"] * 8 + 8] for r in mine)
        assert [(r["batch_id"], r["row_in_batch"], r["shard_id"]) for r in mine] == [
            (p // 4, p % 4, p % 4 // 2) for p in range(len(mine))
        ]
        order = [r["seq_id"] for r in mine]
        assert (order != sorted(order)) == (split == "train")
        assert all(abs(s - r["pos"]) < 20 for s, r in zip(order, mine))


def test_pretokenized_epoch(spark):
    df = spark.range(103).select(F.col("id").alias("k"), F.array("id").alias("input_ids"))
    cfg = PrepareConfig(batch_size=5, grad_accum=8)
    rows = prepare_pretokenized(df, ["k"], cfg).collect()
    assert len(rows) == 100 and len({r["k"] for r in rows}) == 100
    assert {r["batch_id"] for r in rows} == set(range(20))
    assert {r["batch_id"] for r in rows if r["complete"]} == set(range(16))
    other = prepare_pretokenized(df, ["k"], cfg, epoch=1).collect()
    place = lambda rs: {r["k"]: (r["batch_id"], r["row_in_batch"]) for r in rs}
    assert place(rows) != place(other)


def test_a_run_of_several_epochs(spark):
    from corpusprep.plans.prepare import plan_pretokenized, prepare_run

    df = spark.range(103).select(F.col("id").alias("k"), F.array("id").alias("input_ids"))
    cfg = PrepareConfig(batch_size=5, grad_accum=8)
    assert plan_pretokenized(df, cfg, epochs=3) == 6 and plan_pretokenized(df, cfg, max_steps=7) == 7
    rows = prepare_run(df, ["k"], cfg, epochs=3).collect()
    assert {r["step"] for r in rows} == set(range(48)) and {r["optimizer_step"] for r in rows} == set(range(6))
    assert all(r["step"] == r["optimizer_step"] * 8 + r["micro"] for r in rows)
    longer = prepare_run(df, ["k"], cfg, max_steps=7).collect()
    assert len(longer) == 7 * 8 * 5 and {r["epoch"] for r in longer} == {0, 1, 2}


def test_steps_planned_from_bytes(spark, tmp_path):
    from corpusprep.plans.prepare import plan_text

    (tmp_path / "a.txt").write_text("x" * 34_999 + "\n")
    row = plan_text(spark, str(tmp_path), PrepareConfig(seq_len=8, batch_size=4)).first()
    assert (row["total_bytes"], row["est_tokens"], row["steps_per_epoch"], row["total_steps"]) == (35_000, 9_000, 281, 562)
