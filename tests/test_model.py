"""The pair-count model against plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import bigram as B

ROWS = ["a b a b a c e", "b c e", "a a a b e", "d", "z e"]


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame([(i, r.split()) for i, r in enumerate(ROWS)], "k int, ids array<string>")


def counts(rows):
    return Counter(p for r in rows for p in zip(r.split(), r.split()[1:]))


def test_fit_and_score(spark, tokens):
    model = B.fit_bigram(tokens.filter("k < 3"), F.col("ids"))
    train = counts(ROWS[:3])
    assert {(r["prev"], r["next"]): r["n"] for r in model.pairs.collect()} == train
    size = len({t for p in train for t in p})
    context = Counter()
    for (a, _), n in train.items():
        context[a] += n
    held = counts(["a b c q", "q a a"])
    test = spark.createDataFrame([("a b c q".split(),), ("q a a".split(),)], "ids array<string>")
    row = B.score_bigram(test, F.col("ids"), model).first()
    loss = sum(n * -math.log((train[p] + 1) / (context[p[0]] + size)) for p, n in held.items()) / sum(held.values())
    assert row["tokens"] == 5 and row["loss"] == pytest.approx(loss) and row["perplexity"] == pytest.approx(math.exp(loss))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20])
def test_greedy(spark, tokens, n):
    pairs = B.pair_counts(tokens, F.col("ids"))
    follow = {}
    for (a, b), c in sorted(counts(ROWS).items(), key=lambda x: (-x[1], x[0][1])):
        follow.setdefault(a, b)
    prompts = spark.createDataFrame([("a",), ("x b",), ("d",), ("",), ("e",)], "p string")
    asked = prompts.withColumn("ids", F.filter(F.split("p", " "), lambda t: t != ""))
    for r in B.generate_greedy(asked, F.col("ids"), pairs, n, "e").collect():
        out, last = [], (r["ids"] or [None])[-1]
        while len(out) < n and last in follow:
            last = follow[last]
            out.append(last)
            if last == "e":
                break
        assert r["generated"] == out


def test_sampled_equals_a_serial_draw(spark, tokens, monkeypatch):
    monkeypatch.setattr(B, "CHUNK_SIZE", 1)
    monkeypatch.setattr(B, "LEAST_CHUNKS", 3)
    monkeypatch.setattr(B, "STEPS_PER_STAGE", 4)
    import hashlib

    pairs, n, temperature, seed = counts(ROWS), 10, 0.7, 3
    prompts = spark.range(200).select("id", F.array(F.lit("q"), F.lit("a")).alias("ids"))
    got = B.generate_sampled(
        prompts, "id", F.col("ids"), B.pair_counts(tokens, F.col("ids")), n, "e", temperature, seed
    )
    for r in got.collect():
        out, last = [], "a"
        for step in range(n):
            after = sorted((b, c ** (1 / temperature)) for (a, b), c in pairs.items() if a == last)
            if not after or last == "e":
                break
            digest = hashlib.md5(f"{seed}:{step}:{r['id']}".encode()).hexdigest()
            target = (int(digest[:12], 16) + 0.5) / 16**12 * sum(w for _, w in after)
            for last, weight in after:
                target -= weight
                if target < 0:
                    break
            out.append(last)
        assert r["generated"] == out
    assert len({tuple(r["generated"]) for r in got.collect()}) > 20


def test_followers_of_a_hot_token_lie_in_many_tasks(spark):
    """Two fifths of all pairs begin with one token that very many tokens follow; no window holds its line."""
    hot = spark.range(40_000).select(F.lit("the").alias("prev"), F.format_string("w%06d", "id").alias("next"), F.lit(1).cast("bigint").alias("n"))
    rest = spark.range(60_000).select(F.format_string("p%05d", F.col("id") % 9000).alias("prev"), F.format_string("q%d", "id").alias("next"), F.lit(1).cast("bigint").alias("n"))
    pairs = hot.unionByName(rest)
    states, chunks = B.draw_tables(pairs, 1.0)
    row = states.filter("state = 'the'").first()
    assert row["total"] == pytest.approx(40_000) and row["chunks"] == -(-40_000 // B.CHUNK_SIZE)
    line = [t for r in chunks.filter("state = 'the'").orderBy("chunk").collect() for t in r["nexts"]]
    assert list(dict.fromkeys(line)) == [f"w{i:06d}" for i in range(40_000)]
    laid = B.stage(B.running(pairs, ["next"], {"low": F.col("n")}, by=["prev"]))
    assert laid.groupBy("prev").agg(F.max("low").alias("m")).filter("prev = 'the' AND m = 39999").count() == 1
    from corpusprep.operators.order import ranged

    spread = ranged(pairs, ["prev", "next"]).groupBy("__bucket").count().collect()
    assert max(r["count"] for r in spread) < 0.2 * 100_000


def test_large_tables_are_not_joined_again_for_each_token(spark, tokens, monkeypatch):
    """Beyond what is broadcast, the result of the last token is staged, so no join of an earlier one is repeated."""
    from corpusprep.operators import lookup as L

    prompts = spark.range(60).select("id", F.array(F.lit("a")).alias("ids"))
    pairs = B.pair_counts(tokens, F.col("ids"))
    args = ("id", F.col("ids"), pairs, 5, "e", 0.7, 3)
    expect = sorted(map(tuple, B.generate_sampled(prompts, *args).collect()), key=str)
    monkeypatch.setattr(B, "BROADCAST_BYTES", 64)
    monkeypatch.setattr(L, "BROADCAST_BYTES", 64)
    few = B.generate_sampled(prompts, *args)
    assert sorted(map(tuple, few.collect()), key=str) == expect
    assert "Join" not in few._jdf.queryExecution().optimizedPlan().toString()


def test_only_the_chunks_asked_for_are_joined(spark):
    chunks = spark.createDataFrame([("a", 0, ["x"]), ("a", 1, ["y"]), ("b", 0, ["z"])], "state string, chunk int, nexts array<string>")
    aimed = spark.createDataFrame([("a", 1), ("a", 1), (None, None), ("q", None)], "state string, chunk int")
    assert [tuple(r)[:2] for r in B._asked(chunks, aimed).collect()] == [("a", 1)]


def test_contexts_and_known_pairs_are_worked_out_once(spark, tokens, monkeypatch):
    staged = []
    keep = B.stage
    monkeypatch.setattr(B, "stage", lambda df, label="stage": staged.append(label) or keep(df, label))
    model = B.fit_bigram(tokens, F.col("ids"))
    assert "Aggregate" not in model.contexts._jdf.queryExecution().optimizedPlan().toString()
    assert B.score_bigram(tokens, F.col("ids"), model).first()["tokens"] == sum(counts(ROWS).values())
    assert staged == ["pairs", "contexts", "known"]


def test_pairs_are_read_once_for_contexts_and_tokens_and_scored_by_their_counts(spark, monkeypatch):
    """Null tokens, null, short and repeated rows; the lookup sees one row for each first token and count."""
    odd = [None, [], ["a"], ["a", None, "b"], [None, "a"], ["z", None]]
    train = [*odd, *[r.split() for r in ROWS], *[r.split() for r in ROWS]]
    held = [*odd, *[["b", f"new{i}"] for i in range(30)], *[r.split() for r in ROWS[1:]], ["q", "a", "b"]]
    tables, keep = {}, B.stage

    def kept(df, label="stage"):
        tables[label] = keep(df, label)
        return tables[label]

    monkeypatch.setattr(B, "stage", kept)

    def rows(lists):
        return spark.createDataFrame([(i // 2, r) for i, r in enumerate(lists)], "k int, ids array<string>")

    def pairs(lists):
        return Counter(p for r in lists for p in zip(r or [], (r or [])[1:]))

    model = B.fit_bigram(rows(train), F.col("ids"))
    n, context = pairs(train), Counter()
    for (a, _), c in n.items():
        context[a] += c
    assert {(r["prev"], r["next"]): r["n"] for r in model.pairs.collect()} == n
    assert {r["prev"]: r["total"] for r in model.contexts.collect()} == context
    sized = spark.range(1).select(model.vocab_size.alias("v"))
    size = len({t for p in n for t in p})
    assert sized.first()["v"] == size
    # The table of totals has a row for each token, those without a total among them.
    assert tables["contexts"].count() == size > len(context)
    assert sized._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1

    row = B.score_bigram(rows(held), F.col("ids"), model).first()
    seen = pairs(held)
    # A null matches nothing.
    found = {p: n[p] if None not in p else 0 for p in seen}
    total = {p: context[p[0]] if p[0] is not None else 0 for p in seen}
    loss = sum(c * -math.log((found[p] + 1) / (total[p] + size)) for p, c in seen.items()) / sum(seen.values())
    assert row["tokens"] == sum(seen.values()) and row["loss"] == pytest.approx(loss, abs=1e-12)
    assert tables["known"].count() == len({(p[0], found[p]) for p in seen}) < len(seen)
    none = B.score_bigram(rows([]), F.col("ids"), B.fit_bigram(rows([["a", "b"]]), F.col("ids"))).first()
    assert none["tokens"] is None and none["loss"] is None
