"""Quality classifier learnt from trusted positives and unlabelled text (positive-unlabelled learning).

The risk of a linear model with logistic loss l is, with class prior p,

    p E_P[l(z)] + max(0, E_U[l(-z)] - p E_P[l(-z)])

The first mean is over trusted positives, E_U over all unlabelled text of the
learning fold. The term in the maximum estimates the loss on negatives without
a negative example; a model that drives it below zero is overfitting, and then
steps go up that term instead. Since l(z) - l(-z) = -z the plain risk is convex
and its Newton steps need one pass of sums over the staged features each:
every row counts, nothing is sampled, and only sums of fixed size reach the driver.

The prior is the share of positives among the labelled rows of the learning
fold; negative labels are used for nothing else. Without them it is estimated
from the positives and all rows (``estimate_prior``).

Scores are probabilities in [0, 1]. A null or empty text has the features of an
empty text. Labels that contradict each other for one id are ignored. Without
any positive label every score is the prior, or one half if no label is known.
Rows with a null id are scored and count as unlabelled. Repeated rows count each.
Texts are read whole, however long. Further columns are ignored, and stay in
``keep_good``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusprep.llm.common import held_out
from corpusprep.session import stage

FOLDS = 4
THRESHOLD = 0.7
_RIDGE = 1e-3
_ROUNDS = 25
_BINS = 1000
_PLAIN, _MARKS = b".,;:'\"?-()", b"#$%&*|<>{}[]^~\\/=_+@"
NAMES = (
    "length", "upper", "digits", "plain", "marks", "shouts", "bars", "blanks", "wide", "distinct", "top_word",
    "echoes", "word_length", "same_lines", "marked_words",
)


def features(text: str | None) -> list[float]:
    """Shares of kinds of characters, words and lines of a text; square roots bring out small shares."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    words = raw.split()
    m = max(1, len(words))
    kinds = set(words)
    codes = {w: i for i, w in enumerate(kinds)}
    order = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marked = sum(w[-1] < 128 and not w[-1:].isalnum() for w in words)
    shares = [
        upper / max(1, upper + lower),
        count[48:58].sum() / n,
        sum(count[c] for c in _PLAIN) / n,
        sum(count[c] for c in _MARKS) / n,
        count[33] / n,
        count[124] / n,
        (count[32] + count[10]) / n,
        count[128:].sum() / n,
        len(kinds) / m,
        (np.bincount(order).max() if words else 0) / m,
        (order[1:] == order[:-1]).sum() / m,
        (len(raw) / m) / 100,
        1 - len(set(lines)) / max(1, len(lines)),
        marked / m,
    ]
    return [float(np.log1p(len(raw)) / 10), *np.sqrt(np.minimum(shares, 4.0)).tolist()]


def text_features(text: Column) -> Column:
    """``features`` of a text column."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return run(text)


@dataclass(frozen=True)
class Model:
    """Score = 1 / (1 + exp(-(bias + weights . features)))."""

    weights: tuple[float, ...]
    bias: float
    prior: float

    def score(self, found: Column) -> Column:
        weights = F.array(*[F.lit(w) for w in self.weights])
        z = F.aggregate(
            F.zip_with(found.cast("array<double>"), weights, lambda x, w: x * w), F.lit(self.bias), lambda a, x: a + x
        )
        return 1 / (1 + F.exp(-z))


def _sums(staged: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over the learning fold, for the model ``w`` over standardised features.

    Each task adds up its rows; the sums of the tasks are added by position, so
    what comes back has a fixed size.
    """
    d = len(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(6 + 4 * d + d * d)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            p = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            x = np.column_stack([(x - mean) / scale, np.ones(len(x))])
            z = x @ w
            s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            soft = np.logaddexp(0, z)
            part = [len(x), p.sum(), soft.sum(), soft[p].sum(), np.logaddexp(0, -z[p]).sum(), 0.0]
            total += np.concatenate(
                [part, x.sum(0), (x * x).sum(0), x[p].sum(0), (s[:, None] * x).sum(0), ((s * (1 - s))[:, None] * x).T.dot(x).ravel()]
            )
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    rows = staged.select("features", "positive").mapInArrow(run, "k int, v double")
    found = dict(rows.groupBy("k").agg(F.sum("v").alias("v")).collect())
    return np.array([found.get(k, 0.0) for k in range(6 + 4 * d + d * d)])


def _p_gradient_of_negatives(staged: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Mean gradient of l(-z) over positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(w)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            x = np.column_stack([(x - mean) / scale, np.ones(len(x))])
            total += (x / (1 + np.exp(-np.clip(x @ w, -500, 500)))[:, None]).sum(0)
            n += len(x)
        values = np.append(total, n)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["k", "v"])

    rows = staged.filter("positive").select("features").mapInArrow(run, "k int, v double")
    found = dict(rows.groupBy("k").agg(F.sum("v").alias("v")).collect())
    return np.array([found.get(k, 0.0) for k in range(len(w))]) / max(1.0, found.get(len(w), 0.0))


def _moments(staged: DataFrame, n: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of each feature."""
    first = _sums(staged, np.zeros(d - 1), np.ones(d - 1), np.zeros(d))
    mean = first[6 : 6 + d - 1] / n
    scale = np.sqrt(np.maximum(first[6 + d : 6 + 2 * d - 1] / n - mean**2, 1e-12))
    return mean, np.where(scale < 1e-5, 1.0, scale)


def estimate_prior(staged: DataFrame, mean: np.ndarray, scale: np.ndarray, d: int) -> float:
    """Share of positives among all rows, from positives and unlabelled rows alone.

    A classifier tells positives from all rows. Where positives lie, all rows
    are at least the prior times as frequent: the least ratio of the shares
    above a score bounds the prior, and reaches it where no others lie. Shares
    are taken with their sampling error, so that a thin end cannot bound it.
    """
    w = np.zeros(d)
    for _ in range(_ROUNDS):
        s = _sums(staged, mean, scale, w)
        away = _p_gradient_of_negatives(staged, mean, scale, w)
        up = (s[6 + 3 * d : 6 + 4 * d] / s[0] - s[6 + 2 * d : 6 + 3 * d] / s[1] + away) / 2 + _RIDGE * w
        step = np.linalg.solve(s[6 + 4 * d :].reshape(d, d) / s[0] + _RIDGE * np.eye(d), up)
        size = np.abs(step).max()
        w = w - step * min(1.0, 1.0 / max(size, 1e-12))
        if size < 1e-3:
            break
    model = Model(tuple((w[:-1] / scale).tolist()), float(w[-1] - (w[:-1] / scale * mean).sum()), 0.5)
    at = F.floor(model.score(F.col("features")) * _BINS).cast("int").alias("bin")
    found = staged.groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("positive").cast("int")).alias("p")).collect()
    every, known = np.zeros(_BINS + 1), np.zeros(_BINS + 1)
    for r in found:
        every[r["bin"]], known[r["bin"]] = r["n"], r["p"]
    u, p = (np.cumsum(x[::-1]) / x.sum() for x in (every, known))
    above = p > 2 / np.sqrt(known.sum())
    if not above.any():
        return 0.5
    bounds = (u[above] + 1 / np.sqrt(every.sum())) / (p[above] - 1 / np.sqrt(known.sum()))
    return float(np.clip(bounds.min(), 0.01, 0.99))


def fit(rows: DataFrame) -> Model:
    """A model from ``(features, quality)`` of the learning fold; ``quality`` is null where unlabelled.

    The prior is the share of positives among the labelled rows. Where only
    positives are labelled, it is estimated from them and all rows.
    """
    d = len(NAMES) + 1
    counts = rows.agg(
        F.count(F.lit(1)), F.count("quality"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0))
    ).first()
    n, labelled, positive = (x or 0 for x in counts)
    prior = positive / labelled if labelled else 0.5
    if not positive or n == positive:
        level = min(max(prior, 1e-6), 1 - 1e-6)
        return Model((0.0,) * len(NAMES), float(np.log(level / (1 - level))), prior)
    staged = rows.select("features", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("positive"))
    mean, scale = _moments(staged, n, d)
    if positive == labelled:
        prior = estimate_prior(staged, mean, scale, d)
    w = np.zeros(d)
    for _ in range(_ROUNDS):
        s = _sums(staged, mean, scale, w)
        of_p, of_u = s[6 + 2 * d : 6 + 3 * d] / s[1], s[6 + 3 * d : 6 + 4 * d] / s[0]
        curve = s[6 + 4 * d :].reshape(d, d) / s[0] + _RIDGE * np.eye(d)
        negatives = s[2] / s[0] - prior * s[3] / s[1]
        if negatives < 0:
            up = of_u - prior * _p_gradient_of_negatives(staged, mean, scale, w)
            step = np.linalg.solve(curve, -up)
        else:
            step = np.linalg.solve(curve, of_u - prior * of_p + _RIDGE * w)
        size = np.abs(step).max()
        w = w - step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-4:
            break
    return Model(tuple((w[:-1] / scale).tolist()), float(w[-1] - (w[:-1] / scale * mean).sum()), prior)


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``quality`` where the labels of the id agree."""
    known = labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("__of"))
    agreed = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("__most"))
    agreed = agreed.filter(F.col("quality") == F.col("__most")).drop("__most")
    return rows.join(agreed, rows[id_col] == F.col("__of"), "left").drop("__of")


def fit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the staged ``(id, features)`` of all documents."""
    found = docs.select(F.col(id_col).alias("id"), text_features(F.col(text)).alias("features"))
    staged = stage(found, "features")
    learn = with_labels(staged.filter(~held_out(F.col("id"), FOLDS)), labels.select("doc_id", "quality"), "id")
    return fit(stage(learn.select("features", "quality"), "learn")), staged


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that score below ``THRESHOLD``. Columns stay; texts are scored where they lie."""
    model, _ = fit_documents(docs, labels, id_col, text)
    return docs.filter(model.score(text_features(F.col(text))) >= THRESHOLD)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    model, staged = fit_documents(docs, labels)
    scored = staged.select(F.col("id").alias("doc_id"), held_out(F.col("id"), FOLDS).alias("held_out"), model.score(F.col("features")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
