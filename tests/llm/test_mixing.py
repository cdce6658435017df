"""The mix against SQL and plain Python; its splitting tree against sums and moments."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from corpusprep.functions.sampling import uniform
from corpusprep.llm import mixing
from corpusprep.llm.queries import QUERIES, SQL

ROW = "doc_id bigint, source string, text string, size int, No string, pass string"


def water_fill(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Targets by sharing the excess again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap = {s: repeats * sizes[s] for s in names}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        target = {s: left * weight[s] / w for s in free}
        over = [s for s in free if target[s] > cap[s]]
        if not over:
            return {**fixed, **target}
        fixed |= {s: cap[s] for s in over}


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, shards=5, block=40):
    """A mix whose parts are looked at one by one."""
    sized = mixing.sized_documents(docs)
    targets = mixing.source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    placed = mixing.place_documents(sized, targets, block)
    copies = mixing.block_copies(placed)
    mix = mixing.mix_placed(placed, copies, shards).collect()
    rows = placed.collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += words(r["text"])
    want = water_fill(sizes)
    longest = defaultdict(int)
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        longest[r["no"]] = max(longest[r["no"]], r["size"])
    # No copy twice, no document more than twice, sources near their targets.
    assert max(Counter((m["no"], m["place"], m["pass"]) for m in mix).values(), default=0) <= 1
    taken = Counter()
    for m in mix:
        taken[m["no"]] += m["size"]
    for r in {r["no"]: r for r in rows}.values():
        assert abs(taken[r["no"]] - r["target"]) <= longest[r["no"]] / 2 + 1
    # Slots of a shard are gapless.
    slots = defaultdict(list)
    for m in mix:
        slots[m["shard"]].append(m["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows, copies, mix


def make(spark, n=600):
    text = lambda i: " ".join(["w"] * (i * 7 % 23))
    return spark.createDataFrame([(i, "hot" if i % 3 else f"s{i % 5}" if i % 7 else None, text(i), 1, "x", "y") for i in range(n)], ROW)


def test_a_mix_part_by_part(spark):
    rows, copies, mix = check(make(spark))
    assert len(rows) == 600 and {m["shard"] for m in mix} == set(range(5))


def test_quotas_of_the_tree_are_exact(spark):
    counts = {0: 1000, 1: 7, 2: 0, 3: 333, 4: 1}
    quotas = spark.createDataFrame(list(counts.items()), "no bigint, k bigint")
    for shards in (1, 2, 5, 24):
        got = mixing.split_quotas(quotas, shards).collect()
        per_source, per_shard = Counter(), Counter()
        for r in got:
            assert r["k"] >= 0
            per_source[r["no"]] += r["k"]
            per_shard[r["shard"]] += r["k"]
        assert {n: per_source[n] for n in counts} == counts
        total = sum(counts.values())
        assert [per_shard[s] for s in range(shards)] == [total * (s + 1) // shards - total * s // shards for s in range(shards)]


@pytest.mark.parametrize("k, n, m", [(30, 100, 20), (5000, 20_000, 10_000), (1, 2, 1), (3, 1_000_000, 500_000)])
def test_hypergeometric_moments(spark, k, n, m):
    draws = 4000
    u = uniform(1, F.col("id"))
    x = mixing.hypergeometric(F.lit(k).cast("bigint"), F.lit(n).cast("bigint"), F.lit(m).cast("bigint"), u)
    got = np.array([r[0] for r in spark.range(draws).select(x).collect()])
    mean, var = m * k / n, m * k / n * (1 - k / n) * (n - m) / (n - 1)
    assert got.min() >= max(0, m - (n - k)) and got.max() <= min(k, m)
    assert abs(got.mean() - mean) < 5 * math.sqrt(var / draws) + 1e-9
    assert 0.85 * var < got.var() < 1.15 * var


def test_hypergeometric_inverts_the_distribution_function(spark):
    k, n, m = 6, 15, 7
    pmf = [math.comb(k, x) * math.comb(n - k, m - x) / math.comb(n, m) for x in range(k + 1)]
    edges = np.cumsum(pmf)
    us = [(i + 0.5) / 500 for i in range(500)]
    df = spark.createDataFrame([(u,) for u in us], "u double")
    x = mixing.hypergeometric(F.lit(k).cast("bigint"), F.lit(n).cast("bigint"), F.lit(m).cast("bigint"), F.col("u"))
    assert [r[0] for r in df.select(x).collect()] == [int(np.searchsorted(edges, u, side="right")) for u in us]


def test_null_ids_repeats_and_long_texts(spark, odd):
    found = mixing.op12(odd).collect()
    want = Counter((r["doc_id"], words(r["text"])) for r in odd.collect())
    assert Counter((r["doc_id"], r["size"]) for r in found) == want
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in found)


def test_tables_without_words_and_rows(spark, none):
    assert mixing.op12(none).collect() == []
    blank = spark.createDataFrame([(1, "a", ""), (2, None, None), (3, "a", " \n")], "doc_id bigint, source string, text string")
    assert sorted(tuple(r) for r in mixing.op12(blank).collect()) == [(i, 0, 0, 0.0, 0) for i in (1, 2, 3)]


def test_query_equals_its_sql_and_itself(spark, sf):
    df = QUERIES["op12_mixture"](spark, sf)
    assert oracle.differences(df, oracle.connect(sf), SQL["op12_mixture"]) == []
    again = QUERIES["op12_mixture"](spark, sf)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))


def test_no_python_in_any_plan(spark, sf, monkeypatch):
    """Native: neither the result's plan nor those of the staged tables leave the JVM."""
    seen = []
    real = mixing.stage

    def spy(df, label="stage"):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(mixing, "stage", spy)
    monkeypatch.setattr("corpusprep.operators.order.stage", spy)
    seen.append(QUERIES["op12_mixture"](spark, sf)._jdf.queryExecution().executedPlan().toString())
    assert len(seen) > 5 and not any(word in plan for plan in seen for word in ("Python", "Arrow", "InPandas"))
