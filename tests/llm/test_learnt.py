"""Held-out accuracy of what is learnt."""

from zlib import crc32

import numpy as np
import pytest

from corpusprep.llm import langid, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def large(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_on_held_out_documents(large):
    truth = {r["doc_id"]: r["lang"] for r in large.select("doc_id", "lang").collect()}
    rows = [r for r in langid.op8(large).collect() if r["held_out"] and truth[r["doc_id"]]]
    assert all(0 <= r["score"] <= 1 for r in rows)
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows)
    assert right / len(rows) > 0.9


def test_quality_on_held_out_documents(spark, large):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in quality.op9(large, labels).collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    good = [r["score"] for r in rows if truth[r["doc_id"]] == 1]
    bad = [r["score"] for r in rows if truth[r["doc_id"]] == 0]
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.85
    assert sum(g >= 0.7 for g in good) / len(good) > 0.8


def test_quality_without_labels_is_even(spark, large):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.op9(large.limit(5), none).collect()} == {0.5}


def test_quality_from_positives_only(spark, large):
    """Negative labels taken away: what is left still ranks held-out documents, and the prior is found."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    model, staged = quality.fit_documents(large, labels.filter("quality = 1"))
    share = sum(q == 1 for q in truth.values()) / sum(q is not None for q in truth.values())
    assert abs(model.prior - share) < 0.2
    scored = staged.select("id", model.score(quality.F.col("features")).alias("score")).collect()
    rows = [r for r in scored if truth.get(r["id"]) is not None and crc32(str(r["id"]).encode()) % 4 == 2]
    good = [r["score"] for r in rows if truth[r["id"]] == 1]
    bad = [r["score"] for r in rows if truth[r["id"]] == 0]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.85


def test_risk_and_gradient_equal_plain_sums(spark):
    rng = np.random.default_rng(3)
    n, d = 300, len(quality.NAMES)
    x, p = rng.normal(size=(n, d)).astype(np.float32), rng.random(n) < 0.3
    rows = spark.createDataFrame([(v.tolist(), bool(q)) for v, q in zip(x, p)], "features array<float>, positive boolean")
    mean, scale, w = x.mean(0).astype(float), np.full(d, 2.0), rng.normal(size=d + 1)
    s = quality._sums(rows.repartition(3), mean, scale, w)
    z1 = np.column_stack([(x - mean) / scale, np.ones(n)])
    z = z1 @ w
    sig = 1 / (1 + np.exp(-z))
    assert s[0] == n and s[1] == p.sum()
    assert s[2] == pytest.approx(np.log1p(np.exp(z)).sum()) and s[3] == pytest.approx(np.log1p(np.exp(z))[p].sum())
    assert s[4] == pytest.approx(np.log1p(np.exp(-z))[p].sum())
    k = d + 1
    assert np.allclose(s[6 + 2 * k : 6 + 3 * k], z1[p].sum(0)) and np.allclose(s[6 + 3 * k : 6 + 4 * k], (sig[:, None] * z1).sum(0))
    assert np.allclose(s[6 + 4 * k :].reshape(k, k), (z1 * (sig * (1 - sig))[:, None]).T @ z1)
    assert np.allclose(quality._p_gradient_of_negatives(rows, mean, scale, w), (z1 * sig[:, None])[p].mean(0))
