"""Loss aggregation, evaluation and perplexity."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.functions.arrays import EPS, inputs_of, labels_of
from corpusprep.operators.batch import EVAL_BATCHES, head_batches


def shift_tokens(df: DataFrame, ids: Column, *keep: str) -> DataFrame:
    """``(…, pos, input, label)``: every token with the one that follows it in its row."""
    rows = df.select(*keep, ids.alias("__ids"))
    pairs = F.arrays_zip(inputs_of(F.col("__ids")), labels_of(F.col("__ids")))
    long = rows.select(*keep, F.posexplode(pairs).alias("pos", "pair"))
    return long.select(*keep, "pos", F.col("pair")["0"].alias("input"), F.col("pair")["1"].alias("label"))


def pad_mask(label: Column, pad_id) -> Column:
    """1.0 where the label counts, 0.0 where it is padding."""
    return (label != F.lit(pad_id)).cast("double")


def masked_mean(loss: Column, mask: Column) -> Column:
    return F.sum(loss * mask) / (F.sum(mask) + F.lit(EPS))


def mean_loss(loss: Column) -> Column:
    return F.avg(loss)


def perplexity(loss: Column) -> Column:
    return F.exp(F.avg(loss))


def eval_loss(df: DataFrame, loss: str, mask: str, n: int = EVAL_BATCHES) -> DataFrame:
    """Plain mean over the first ``n`` batches of each batch's masked mean; no row without batches."""
    per_batch = head_batches(df, n).groupBy("batch_id").agg(masked_mean(F.col(loss), F.col(mask)).alias("__mean"))
    return (
        per_batch.agg(F.avg("__mean").alias("val_loss"), F.count(F.lit(1)).alias("batches"))
        .filter(F.col("batches") > 0)
    )


def moving_eval_loss(
    df: DataFrame, loss: str, mask: str, evaluations: int, n: int = EVAL_BATCHES
) -> DataFrame:
    """``(evaluation, val_loss, batches)`` of evaluations that go on through the batches.

    Evaluation 0 takes the first ``n`` batches, each later one the next ``n``.
    The one that reaches the end takes fewer, and the next starts over; one
    that finds no batch left gives no row and starts over all the same. So the
    windows recur every ``floor(batches / n) + 1`` evaluations. Each batch's
    mean is taken once, however often its window recurs.
    """
    means = df.groupBy("batch_id").agg(masked_mean(F.col(loss), F.col(mask)).alias("__mean"))
    # One row for each window: what a batch contributes is summed before it is repeated.
    window = F.floor(F.col("batch_id") / n).alias("__window")
    sums = means.groupBy(window).agg(F.sum("__mean").alias("__sum"), F.count(F.lit(1)).alias("batches"))
    cycle = F.floor(means.agg(F.count(F.lit(1))).scalar() / n) + 1
    last = F.lit(evaluations - 1).cast("bigint")
    due = F.when(F.col("__window") <= last, F.sequence(F.col("__window"), last, cycle))
    return sums.withColumn("evaluation", F.explode(due)).select(
        "evaluation", (F.col("__sum") / F.col("batches")).alias("val_loss"), "batches"
    )


def val_delta(val: DataFrame, train: DataFrame, on: Sequence[str], loss: str = "loss") -> DataFrame:
    """Validation loss minus training loss of the same step."""
    left = val.select(*on, F.col(loss).alias("val_loss"))
    right = train.select(*on, F.col(loss).alias("train_loss"))
    return left.join(right, list(on)).withColumn("delta", F.col("val_loss") - F.col("train_loss"))


ModelLoader = Callable[[], Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]]


def score_with(df: DataFrame, loader: ModelLoader, schema: str) -> DataFrame:
    """Run a user's model over the rows; ``loader`` is called once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from loader()(batches)

    return df.mapInPandas(run, schema)
