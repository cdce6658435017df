"""Hot keys, dense vocabularies and what they replace."""

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.dense import dense_head, dense_vocabulary, recode
from corpusprep.operators.lookup import hot_keys, lookup_join
from corpusprep.operators.pack import pack_tokens
from corpusprep.operators.tokens import build_vocab, count_tokens, pad_vocab, to_ids
from corpusprep.plans import all_queries
from test_plans import final_plan


@pytest.fixture
def many_partitions(spark):
    new = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield 100
    for k, v in old.items():
        spark.conf.set(k, v)


def skewed(spark, n=20_000):
    key = F.when(F.col("id") % 5 < 2, 7).when(F.col("id") % 5 == 2, F.lit(None)).otherwise(F.col("id") % 3000)
    return spark.range(n).select(key.cast("bigint").alias("k"), F.col("id").alias("fact"))


def test_hot_keys_are_found(spark):
    hot = hot_keys(skewed(spark), ["k"], 0.1)
    expect = spark.createDataFrame([(7,), (None,)], "k bigint").select(F.xxhash64("k")).collect()
    assert sorted(hot) == sorted(r[0] for r in expect)
    assert hot_keys(spark.range(0).toDF("k"), ["k"], 0.1) == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_lookup_equals_a_plain_join_without_a_hot_task(spark, many_partitions, how):
    facts = skewed(spark)
    dim = spark.range(0, 2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"), F.lit("x").alias("tag"))
    got = lookup_join(facts, dim, "k", how, row_bytes=1 << 40)
    assert got.columns == ["k", "fact", "twice", "tag"]
    plain = facts.join(dim, ["k"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    # How many rows of the joined result each task of the join holds.
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.05 * sum(sizes)
    plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain_sizes) > 0.3 * sum(plain_sizes)


def test_two_keys_and_a_dimension_of_keys_only(spark):
    facts = skewed(spark, 2000).withColumn("j", F.lit(1))
    dim = spark.createDataFrame([(7, 1), (3, 1)], "k bigint, j int")
    got = lookup_join(facts, dim, ["k", "j"], "inner", row_bytes=1 << 40)
    assert got.count() == facts.filter("k in (3, 7)").count()


WORDS = ["b", "a", "ünï", "a", "c", "b", "a", "<eos>"]


def test_dense_encoding_and_decoding(spark):
    vocab = build_vocab(count_tokens(spark.createDataFrame([(WORDS[:-1],)], "t array<string>"), F.col("t")))
    dense = dense_vocabulary(vocab)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    rows = [(0, WORDS), (1, []), (2, None), (3, ["zzz", "<eos>", "a"]), (4, ["zzz"]), (5, ["a", None])]
    df = spark.createDataFrame(rows, "k int, t array<string>").repartition(2)
    got = {r["k"]: r for r in df.select("k", dense.encode(F.col("t")).alias("ids")).withColumn("text", dense.decode(F.col("ids"))).collect()}
    for k, tokens in rows:
        expect = None if tokens is None else [1 if t == "<eos>" else ids.get(t, 0) for t in tokens]
        assert got[k]["ids"] == expect
        assert got[k]["text"] == (None if tokens is None else " ".join(t for t in tokens if t in ids))
    odd = spark.createDataFrame([([2, 99, -1, None, 3],)], "ids array<bigint>")
    assert odd.select(dense.decode(F.col("ids"))).first()[0] == "a b"


def test_a_large_vocabulary_is_not_collected(spark):
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "token string, id int")
    assert dense_vocabulary(vocab, most_bytes=10) is None
    assert dense_vocabulary(vocab.limit(0)).tokens.value.to_pylist() == []


def test_packing_is_the_same_by_either_lookup(spark):
    rows = spark.createDataFrame([(i, [f"w{j % 9}" for j in range(i % 13)]) for i in range(200)], "k int, t array<string>")
    vocab = build_vocab(count_tokens(rows, F.col("t")), 6)
    dense = pack_tokens(rows, ["k"], F.col("t"), vocab, 7)
    joined = pack_tokens(rows, ["k"], F.col("t"), vocab, 7, bound=1 << 40)
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, joined.collect())) != []


def test_decoding_moves_no_lines(spark, sf):
    plan = final_plan(all_queries()["decode"](spark, sf))
    assert "Exchange" not in plan.replace("REPARTITION_BY_NUM", "") or "line_no" not in "".join(
        line for line in plan.splitlines() if "Exchange" in line
    )
    assert "explode" not in plan.replace("posexplode", "").lower() or "collect_list" not in plan


def test_unknown_words_only_where_the_vocabulary_is_capped(spark, sf):
    assert all_queries()["token_ids"](spark, sf).filter("id = 0").count() == 0


@pytest.mark.parametrize("words, multiple, pads", [(3, 8, 3), (6, 8, 0), (0, 8, 6), (126, 128, 0), (127, 128, 127)])
def test_padded_vocabulary_counts_the_special_ids(spark, words, multiple, pads):
    vocab = spark.createDataFrame([(f"w{i}", i + 2) for i in range(words)], "token string, id int")
    got = pad_vocab(vocab, multiple).collect()
    assert sorted(r["id"] for r in got) == list(range(2, words + 2 + pads))
    assert (words + 2 + pads) % multiple == 0 and sum(r["token"].startswith("<pad_") for r in got) == pads


def test_ids_by_shuffle_equal_ids_by_broadcast(spark, sf):
    rows = spark.createDataFrame([(i, "the" if i % 3 else f"t{i % 50}") for i in range(3000)], "i int, token string")
    vocab = build_vocab(rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    small, large = to_ids(rows, vocab), to_ids(rows, vocab, bound=1 << 40)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_only_rare_tokens_are_moved_to_a_large_vocabulary(spark, monkeypatch):
    from corpusprep.operators import tokens as T

    word = F.when(F.col("i") % 7 == 0, "<eos>").when(F.col("i") % 11 == 0, F.concat(F.lit("rare"), F.col("i") % 90))
    rows = spark.range(5000).withColumnRenamed("id", "i").coalesce(1)
    rows = rows.withColumn("token", word.when(F.col("i") % 13 == 0, "unseen").when(F.col("i") % 17 != 0, F.concat(F.lit("w"), F.col("i") % 5)))
    vocab = build_vocab(rows.filter("token NOT IN ('<eos>', 'unseen')").groupBy("token").agg(F.count(F.lit(1)).alias("n"))).localCheckpoint()
    whole = to_ids(rows, vocab).collect()
    monkeypatch.setattr(T, "BROADCAST_BYTES", 7 * 64, raising=False)
    parted = to_ids(rows, vocab, bound=1 << 40)
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parted.collect()))
    assert parted.filter("id BETWEEN 1 AND 6").select(F.spark_partition_id()).distinct().count() == 1


def test_a_head_of_one_size_is_sent_and_the_other_rows_are_made_once(spark, monkeypatch):
    """The rows beyond the head are staged, so their hot keys and the join do not make all tokens again."""
    from corpusprep.operators import tokens as T

    word = F.when(F.col("i") % 5 == 0, "unseen").when(F.col("i") % 7 != 0, F.concat(F.lit("w"), F.col("i") % 90))
    rows = spark.range(4000).selectExpr("id div 2 AS i")  # each row comes twice, some tokens are null
    rows = rows.withColumn("token", F.when(F.col("i") % 9 == 0, "<eos>").otherwise(word)).localCheckpoint()
    vocab = build_vocab(rows.filter("token LIKE 'w%'").groupBy("token").agg(F.count(F.lit(1)).alias("n"))).localCheckpoint()
    expect = sorted(map(str, to_ids(rows, vocab).collect()))
    moved, lookup = [], T.lookup_join

    def seen(facts, *args, **named):
        moved.append((facts.count(), facts._jdf.queryExecution().optimizedPlan().toString()))
        return lookup(facts, *args, **named)

    monkeypatch.setattr(T, "_HEAD_ROWS", 22, raising=False)  # ids 2 to 21
    monkeypatch.setattr(T, "lookup_join", seen)
    assert sorted(map(str, to_ids(rows, vocab).collect())) == expect
    head = [r["token"] for r in vocab.filter("id < 22").collect()]
    others = rows.filter(F.coalesce(~F.col("token").isin([*head, "<eos>"]), F.lit(True))).count()
    assert [n for n, _ in moved] == [others] and 0 < others < 3000
    assert "Join" not in moved[0][1]


def test_recoding_by_any_cut_equals_the_whole_vocabulary(spark):
    words = [[f"w{(i * j) % 23}" for j in range(i % 9)] for i in range(120)]
    odd = [None, [], ["<eos>"], ["zzz"], [None], ["w1", None, "<eos>", "zzz", "w22", "w22", "zzz"]]
    rows = [(i // 2, t) for i, t in enumerate([*words, *odd, *words])]  # keys repeat, and so do whole rows
    df = spark.createDataFrame([*rows, *rows[:40], (None, ["w3", "w20"]), (None, ["w3", "w20"])], "k int, t array<string>").repartition(3)
    vocab = build_vocab(count_tokens(spark.createDataFrame([(t,) for t in words], "t array<string>"), F.col("t"))).localCheckpoint()
    dense = dense_vocabulary(vocab)
    expect = sorted(map(str, df.select("k", dense.decode(dense.encode(F.col("t"))).alias("text")).collect()))
    cuts = set()
    for most in (0, 40, 100, 200, 1 << 20):
        cuts.add(dense_head(vocab, most)[1])
        assert sorted(map(str, recode(df, F.col("t"), vocab, most).drop("t").collect())) == expect
    assert len(cuts) == 5 and 0 in cuts


def test_only_rare_words_of_lines_are_moved_to_a_large_vocabulary(spark, tmp_path, monkeypatch):
    from corpusprep.operators import tokens as T
    from corpusprep.plans import text as P

    lines = [" ".join([f"w{j % 40}" for j in range(i, i + 30)] + [f"rare{i}"] * (i % 5 == 0)) for i in range(400)]
    rows = [(i // 4 if i < 396 else None, "\n".join(lines[i : i + 3]) + "\n \n") for i in range(400)]
    spark.createDataFrame([*rows, *rows[:9]], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expect = sorted(map(str, P.decode_lines(spark, str(tmp_path)).collect()))
    moved, lookup = [], T.lookup_join

    def counted(facts, *args, **named):
        moved.append(facts.count())
        return lookup(facts, *args, **named)

    monkeypatch.setattr(P, "dense_vocabulary", lambda vocab: None)
    monkeypatch.setattr(P, "recode", lambda *args: recode(*args, most_bytes=60 * 15), raising=False)
    monkeypatch.setattr(T, "lookup_join", counted)
    assert sorted(map(str, P.decode_lines(spark, str(tmp_path)).collect())) == expect
    rare = sum(r["text"].count("rare") for r in P.docs(spark, str(tmp_path)).collect())
    assert len(moved) == 2 and all(0 < n <= rare for n in moved)
