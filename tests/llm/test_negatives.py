"""Hard negatives against exact Python integers and SQL."""

import math

import numpy as np
import oracle
import pytest

from corpusprep.llm import negatives
from corpusprep.llm.queries import QUERIES, SQL

ROW = "vec_id bigint, embedding array<double>, label int, v string, Norm int"


def plain(rows):
    kept = []
    for r in rows:
        i, x, label = r[0], r[1], r[2]
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * c) for c in x]
        if sum(c * c for c in v) < 1 << 58:
            kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, v))
    out = []
    anchors = {}
    for i, label, v in kept:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, other) for i, other, w in kept)
        positives = [(i, -s) for s, i, other in scored if other == label and i != a][:5]
        for p, ps in positives:
            inside = [(i, -s) for s, i, other in scored if other != label and 80 * ps <= -100 * s <= 100 * ps]
            out += [(a, p, rank + 1, i, ps, s) for rank, (i, s) in enumerate(inside[:5])]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def rows_of(n, dims, scale, seed=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dims)
    return [(i, ((centre + rng.normal(0, 0.6, dims)) * scale).tolist(), int(rng.integers(0, 4)), "x", 1) for i in range(n)]


@pytest.mark.parametrize("dims, scale", [(3, 1.0), (64, 0.1), (200, 1.0), (64, 1e4), (130, 1e5)])
def test_scores_of_any_width_and_size_are_exact(spark, dims, scale):
    rows = rows_of(450, dims, scale)
    assert found(negatives.op13(spark.createDataFrame(rows, ROW))) == plain(rows) != []


def test_ties_odd_vectors_and_odd_rows(spark):
    rows = [(i, [1.0, 0.25 * (i % 3), -0.5], i % 2, "x", 1) for i in range(240)]
    rows += [(300, None, 1), (301, [1.0, None, 0.0], 1), (302, [float("nan"), 1.0, 1.0], 0), (303, [float("inf"), 1.0, 1.0], 0),
             (304, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (305, [], 0), (400, [], 1), (500, [2.0], 0),
             (306, [1e9, 1e9, 1.0], 0), (-700, [1.0, 0.5, 0.0], 3), (700, [-1.0, -1.0, 0.0], 0)]
    rows = [(*r[:3], "x", 1) for r in rows]
    assert found(negatives.op13(spark.createDataFrame(rows, ROW))) == plain(rows) != []


def test_repeated_anchor_counts_once(spark):
    rows = rows_of(210, 8, 1.0) + [rows_of(210, 8, 1.0)[100]]
    assert found(negatives.op13(spark.createDataFrame(rows, ROW))) == plain(rows)


def test_cells_of_many_blocks_give_the_same(spark):
    rows = rows_of(900, 16, 1.0)
    staged = negatives.stage(negatives.integer_rows(spark.createDataFrame(rows, ROW), "vec_id", "embedding", negatives.F.col("label"), 256))
    anchors = staged.filter("vec_id % 10 = 0")
    whole = found(negatives.mine(staged, anchors))
    assert found(negatives.mine(staged, anchors, block_rows=64, block_anchors=7)) == whole != []


def test_empty_and_unusable_tables(spark):
    assert negatives.op13(spark.createDataFrame([], ROW)).collect() == []
    assert negatives.op13(spark.createDataFrame([(100, None, 1, "x", 1)], ROW)).collect() == []
    assert negatives.op13(spark.createDataFrame([(100, [1.0], 1, "x", 1)], ROW)).collect() == []


def test_remainders_meet_in_one_number():
    rng = np.random.default_rng(1)
    for dims, most in ((64, 256), (100, 1 << 20), (64, 1 << 25)):
        a, b = rng.integers(-most, most, (7, dims)), rng.integers(-most, most, (9, dims))
        norm = max(int((m.astype(object) ** 2).sum(1).max()) for m in (a, b))
        primes = negatives.primes_for(norm)
        got = np.array(list(negatives.Scorer(b, a, primes).scores()))
        assert (got == (a.astype(object) @ b.T.astype(object))).all()


def test_extreme_residues_stay_exact_in_float32():
    for p in negatives.PRIMES:
        a = np.full((1, 3 * negatives.DEPTH), p // 2, np.int64)
        r = negatives._residues(np.vstack([a, -a]), p)
        expect = np.array([[1, -1], [-1, 1]]) * int(p // 2) ** 2 * 3 * negatives.DEPTH % p
        assert (negatives.residue_product(r, r, p) == expect).all()


def test_the_largest_norm_has_a_range():
    assert negatives.primes_for(float(negatives.LIMIT)) == negatives.PRIMES
    with pytest.raises(ValueError):
        negatives.primes_for(2.0**62)


def test_query_equals_its_sql(spark, sf):
    found_ = oracle.differences(QUERIES["op13_hard_negatives"](spark, sf), oracle.connect(sf), SQL["op13_hard_negatives"])
    assert found_ == []
