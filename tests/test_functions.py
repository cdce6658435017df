"""Column functions against Python, at their edges."""

import math
import sys

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import arrays as A, schedule as S, text as T
from corpusprep.functions.sql import register_sql
from corpusprep.operators.batch import accum_groups, assign_shards, estimate_steps, every, plan_steps
from corpusprep.operators.loss import eval_loss, masked_mean, mean_loss, pad_mask, score_with
from corpusprep.operators.sample import mixture_weights, sample_categorical
from corpusprep.operators.tokens import JsonTokenizer, decode_with, encode_with, special_ids
from corpusprep.operators.vectors import causal_mask


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def ids(*values):
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def test_blank_is_what_python_strips_to_nothing(spark):
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    blank = {r["c"] for r in df.filter(T.is_blank(F.col("c"))).collect()}
    assert blank == {c for c in chars if not c.strip()}


@pytest.mark.parametrize("text", ["", "a", "a\n", "a\nb", "\n", "\n\na", "é\n　\n"])
def test_lines_and_bytes(spark, text):
    row = one(spark, T.lines_of(F.lit(text)).alias("l"), T.byte_ids(F.lit(text)).alias("b"), T.byte_len(F.lit(text)))
    assert row["l"] == [line.removesuffix("\n") for line in text.splitlines(keepends=True)]
    assert row["b"] == list(text.encode()) and row[2] == len(text.encode())


def test_repair(spark):
    raw = b"ok \xff\xfe\xc3( \xe2\x82 end"
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    got = df.select(T.repair_utf8(F.col("b").cast("string"))).first()[0]
    assert got == raw.decode("utf-8", "replace")


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_slices_of_short_arrays(spark, n):
    values = list(range(10, 10 + n))
    row = one(
        spark,
        A.inputs_of(ids(*values)),
        A.labels_of(ids(*values)),
        A.truncate_context(ids(*values), 3),
        A.stop_at_eos(ids(*values), F.lit(11), 3),
        A.drop_special(ids(*values), [10, 12]),
    )
    assert list(row) == [
        values[:-1],
        values[1:],
        values[-3:],
        values[: min(3, values.index(11) + 1 if 11 in values else n)],
        [v for v in values if v not in (10, 12)],
    ]


def test_drop_special_keeps_repeats(spark):
    assert one(spark, A.drop_special(ids(5, 1, 5, 5), [1]))[0] == [5, 5, 5]


@pytest.mark.parametrize("logits", [[1e4, -1e4, 0.0], [0.0, 0.0], [-3.5, 2.25, 1.0, 0.5]])
def test_losses_at_extremes(spark, logits):
    z = F.array(*[F.lit(x) for x in logits])
    top = max(logits)
    lse = top + math.log(sum(math.exp(x - top) for x in logits))
    row = one(spark, A.cross_entropy(z, F.lit(1)), A.softmax(z, 2.0))
    assert row[0] == pytest.approx(lse - logits[1])
    assert sum(row[1]) == pytest.approx(1.0) and all(p >= 0 for p in row[1])


def test_rms_with_weight(spark):
    v, w = [3.0, -4.0], [2.0, 0.5]
    rms = math.sqrt((9 + 16) / 2 + 1e-6)
    row = one(spark, A.rms_normalize(F.array(*map(F.lit, v)), F.array(*map(F.lit, w))))
    assert row[0] == pytest.approx([x / rms * y for x, y in zip(v, w)])


@pytest.mark.parametrize("key", [-1, 0, 3, 5, 6, 99])
def test_search_sorted(spark, key):
    values = [0, 3, 3, 5, 9]
    got = one(spark, A.search_sorted(ids(*values), F.lit(key)))[0]
    assert got == sum(v <= key for v in values)


def test_schedules(spark):
    steps = [0, 9, 10, 25, 40, 60]
    df = spark.createDataFrame([(s,) for s in steps], "s int")
    a = [r[0] for r in df.select(S.lr_cosine(F.col("s"), 2.0, 10, 40)).collect()]
    b = [r[0] for r in df.select(S.lr_cosine_clamped(F.col("s"), 2.0, 10, 40)).collect()]
    cosine = lambda p: 0.1 + 0.45 * (1 + math.cos(math.pi * p))
    assert a == pytest.approx([0.2, 2.0, *[2 * cosine((s - 10) / 30) for s in steps[2:]]])
    assert b == pytest.approx([0.0, 1.8, *[2 * cosine(min(1, (s - 10) / 30)) for s in steps[2:]]])
    assert a[-1] != pytest.approx(a[-2]) and b[-1] == b[-2] == pytest.approx(0.2)


@pytest.mark.parametrize("x", [0, 1, 127, 128, 129])
def test_round_up(spark, x):
    row = one(spark, S.round_up(F.lit(x), 128), S.pad_amount(F.lit(x), 128))
    assert row[0] == -(-x // 128) * 128 and row[1] == row[0] - x


def test_sql_functions_equal_the_column_functions(spark):
    register_sql(spark)
    row = spark.sql("""
        SELECT lr_cosine(25, 2, 10, 40) a, lr_cosine_clamped(99, 2, 10, 40) b, round_up(129, 128) c,
               cross_entropy(array(1D, 2D, 3D), 0) d, softmax(array(1D, 2D), 1) e, rms_normalize(array(3D, 4D)) f,
               masked_mean(array(1D, 5D), array(1D, 0D)) g, is_blank('\t ') h, is_blank('x') i, byte_len('é') j,
               pad_amount(1, 8) k, repair_utf8('x') l""").first()
    z = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    mine = one(
        spark,
        S.lr_cosine(F.lit(25), 2, 10, 40),
        S.lr_cosine_clamped(F.lit(99), 2, 10, 40),
        A.cross_entropy(z, F.lit(0)),
        A.softmax(F.array(F.lit(1.0), F.lit(2.0))),
        A.rms_normalize(F.array(F.lit(3.0), F.lit(4.0))),
    )
    assert [row["a"], row["b"], row["d"]] == pytest.approx([mine[0], mine[1], mine[2]])
    assert row["e"] == pytest.approx(mine[3]) and row["f"] == pytest.approx(mine[4])
    assert (row["c"], row["h"], row["i"], row["j"], row["k"], row["l"]) == (256, True, False, 2, 7, "x")
    assert row["g"] == pytest.approx(1.0, abs=1e-5)


def test_masks_and_means(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 0), (2.0, 7)], "loss double, label int")
    row = df.agg(
        masked_mean(F.col("loss"), pad_mask(F.col("label"), 0)),
        masked_mean(F.col("loss"), pad_mask(F.col("label"), -1)),
        mean_loss(F.col("loss")),
        masked_mean(F.col("loss"), F.lit(0.0)),
    ).first()
    assert row[0] == pytest.approx(1.5, abs=1e-5) and row[1] == pytest.approx(row[2], abs=1e-5) and row[3] == 0


@pytest.mark.parametrize("batches", [0, 5, 20, 25])
def test_eval_loss(spark, batches):
    rows = [(b, float(b * i), float(i != 0)) for b in range(batches) for i in range(4)]
    df = spark.createDataFrame(rows, "batch_id bigint, loss double, mask double")
    got = eval_loss(df, "loss", "mask").collect()
    if not batches:
        assert got == []
    else:
        used = min(batches, 20)
        assert got[0]["batches"] == used
        assert got[0]["val_loss"] == pytest.approx(sum(2.0 * b for b in range(used)) / used, abs=1e-4)


def test_planning(spark):
    assert plan_steps(spark.range(1000), 10, 8, epochs=3).first()["total_steps"] == 36
    assert plan_steps(spark.range(5), 10, 8).first()["total_steps"] == 1
    assert plan_steps(spark.range(5), 10, 8, max_steps=7).first()["total_steps"] == 7
    df = spark.createDataFrame([("x" * 3500,)], "text string")
    row = estimate_steps(df, "text", 10, 2).first()
    assert (row["est_tokens"], row["steps_per_epoch"], row["total_steps"]) == (900, 45, 100)
    with pytest.raises(ValueError):
        assign_shards(spark.range(1), 10, 3)


def test_intervals_and_groups(spark):
    df = spark.range(10).select((F.col("id") + 1).alias("step"))
    assert [r[0] for r in df.filter(every(F.col("step"), 4, F.lit(10))).collect()] == [4, 8, 10]
    rows = df.select(*[c.alias(n) for n, c in accum_groups(F.col("step") - 1, F.lit(10), 4).items()]).collect()
    assert [r["accum_step"] for r in rows] == [0] * 4 + [1] * 4 + [2] * 2
    assert [r["complete"] for r in rows] == [True] * 8 + [False] * 2
    assert one(spark, causal_mask(F.lit(2), F.lit(2)), causal_mask(F.lit(1), F.lit(2)))[:] == (True, False)


def test_special_ids(spark):
    df = spark.createDataFrame([("<eos>", 1), ("a", 2)], "token string, id int")
    assert special_ids(df).first()[:] == (1, 1)
    padded = df.union(spark.createDataFrame([("<pad>", 9)], "token string, id int"))
    assert special_ids(padded).first()[:] == (1, 9)


def test_draws_follow_the_weights(spark):
    items = spark.range(4000).select("id", F.posexplode(F.array(*map(F.lit, [0.0, 1.0, 2.0]))).alias("item", "z"))
    drawn = sample_categorical(items, ["id"], "item", F.col("z"), 5, temperature=2.0)
    counts = {r["item"]: r["count"] for r in drawn.groupBy("item").count().collect()}
    weights = [math.exp(z / 2) for z in (0, 1, 2)]
    for i, w in enumerate(weights):
        assert counts[i] / 4000 == pytest.approx(w / sum(weights), abs=0.03)


def test_mixture(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",)], "s string")
    got = {r["s"]: r["weight"] for r in mixture_weights(df, "s", 3.0).collect()}
    assert got == pytest.approx({"a": 2 / 3, "b": 1 / 3})


class Letters:
    """A user's tokenizer: one id for each character."""

    eos_id = 0

    def load(self):
        self.ready = True

    def encode_batch(self, texts):
        assert self.ready
        return [[ord(c) for c in t] for t in texts]

    def decode_batch(self, rows):
        return ["".join(map(chr, r)) for r in rows]


def test_user_tokenizers(spark, sf, tmp_path):
    from pyspark import cloudpickle
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    bpe = Tokenizer(models.BPE())
    bpe.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    bpe.decoder = decoders.ByteLevel()
    alphabet = pre_tokenizers.ByteLevel.alphabet()
    trainer = trainers.BpeTrainer(
        vocab_size=400, initial_alphabet=alphabet, special_tokens=["<eos>"], show_progress=False
    )
    bpe.train_from_iterator(texts, trainer)
    bpe.save(str(tmp_path / "bpe.json"))
    trained = JsonTokenizer.open(str(tmp_path / "missing.json"), fallback=str(tmp_path / "bpe.json"))
    assert (trained.eos_id, trained.pad_id, trained.vocab_size) == (0, 0, 400)
    with pytest.raises(OSError):
        JsonTokenizer.open(str(tmp_path / "missing.json"))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for tokenizer in (Letters(), trained):
        back = df.select("text", encode_with(tokenizer, F.col("text")).alias("ids"))
        back = back.select("text", "ids", decode_with(tokenizer, F.col("ids")).alias("back"))
        rows = back.collect()
        tokenizer.load()
        assert all(r["text"] == r["back"] for r in rows)
        assert [r["ids"] for r in rows] == tokenizer.encode_batch([r["text"] for r in rows])


def test_user_model(spark):
    def loader():
        weight = 3

        def run(batches):
            for pdf in batches:
                yield pdf.assign(score=pdf["id"] * weight)

        return run

    got = score_with(spark.range(10), loader, "id bigint, score bigint").collect()
    assert {(r["id"], r["score"]) for r in got} == {(i, 3 * i) for i in range(10)}


@pytest.mark.parametrize("batches", [0, 1, 3, 4, 8, 9])
def test_moving_evaluation_equals_an_iterator_that_starts_over(spark, batches):
    """The reference order: n batches an evaluation, fewer when the batches run out, then from the start."""
    from corpusprep.operators.loss import moving_eval_loss

    n, evaluations = 4, 7
    rows = [(b, float(b * 3 + i), float(i != 1)) for b in range(batches) for i in range(3)]
    mean = {b: sum(l * m for x, l, m in rows if x == b) / (2 + 1e-6) for b in range(batches)}
    expect, left = [], iter(range(batches))
    for e in range(evaluations):
        seen = []
        for _ in range(n):
            try:
                seen.append(mean[next(left)])
            except StopIteration:
                left = iter(range(batches))
                break
        if seen:
            expect.append((e, pytest.approx(sum(seen) / len(seen)), len(seen)))
    df = spark.createDataFrame(rows, "batch_id bigint, loss double, mask double")
    got = moving_eval_loss(df, "loss", "mask", evaluations, n).orderBy("evaluation").collect()
    assert [tuple(r) for r in got] == expect
