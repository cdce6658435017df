"""Batches, accumulation groups, shards and step planning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.functions.text import byte_len
from corpusprep.operators.order import global_index
from corpusprep.operators.split import TRAIN_SHARE

# Bytes that one token stands for, fewest steps, passes planned.
BYTES_PER_TOKEN = 3.5
LEAST_STEPS = 100
PLANNED_PASSES = 2
EVAL_BATCHES = 20


def batch(
    df: DataFrame, order: Sequence[str | Column], size: int, by: Sequence[str] = (), bucket: Column | None = None
) -> DataFrame:
    """``batch_id`` and ``row_in_batch`` along ``order``; the incomplete last batch is dropped."""
    at = global_index(df, order, by=by, out="__at", total="__n", bucket=bucket)
    return _batches(at, size)


def _batches(df: DataFrame, size: int) -> DataFrame:
    return (
        df.withColumns(
            {"batch_id": F.floor(F.col("__at") / size), "row_in_batch": (F.col("__at") % size).cast("int")}
        )
        .filter(F.col("batch_id") < F.floor(F.col("__n") / size))
        .drop("__at", "__n")
    )


def batch_at(df: DataFrame, pos: str, size: int) -> DataFrame:
    """:func:`batch` for rows that carry their position already: moves nothing."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return _batches(df.withColumns({"__at": F.col(pos), "__n": n}), size)


def leading_batches(df: DataFrame, order: Sequence[str | Column], size: int, n: int = EVAL_BATCHES) -> DataFrame:
    """``head_batches(batch(df, order, size), n)`` by a distributed top-k: only ``n * size`` rows are moved."""
    top = df.orderBy(*order).limit(n * size)
    # At most n * size rows are left.
    ranked = top.withColumns(
        {
            "__at": F.row_number().over(W.orderBy(*order)).cast("bigint") - 1,
            "__n": F.count(F.lit(1)).over(W.partitionBy(F.lit(0))),
        }
    )
    return _batches(ranked, size)


def head_batches(df: DataFrame, n: int = EVAL_BATCHES) -> DataFrame:
    """The first ``n`` batches."""
    return df.filter(F.col("batch_id") < n)


def assign_shards(df: DataFrame, batch_size: int, shards: int) -> DataFrame:
    """``shard_id``: contiguous blocks of a batch, equal for every shard."""
    if batch_size % shards:
        raise ValueError(f"a batch of {batch_size} rows cannot be cut into {shards} equal shards")
    return df.withColumn("shard_id", F.floor(F.col("row_in_batch") / (batch_size // shards)).cast("int"))


def accum_groups(index: Column, total: Column, size: int) -> dict[str, Column]:
    """Optimizer step of a micro-batch, its place in the step, and whether the step fills up.

    ``index`` and ``total`` count the micro-batches of an epoch, or of the
    whole run when the accumulation goes on across epochs.
    """
    group = F.floor(index / size)
    return {
        "accum_step": group,
        "micro": (index % size).cast("int"),
        "complete": group < F.floor(total / size),
    }


def every(step: Column, k: int, last: Column | None = None) -> Column:
    """True on every ``k``-th step, and on the ``last`` one where given."""
    due = step % k == 0
    return due if last is None else due | (step == last)


def estimate_steps(df: DataFrame, text: str, length: int, batch_size: int) -> DataFrame:
    """Token and step estimates from the bytes of a text column, one row."""
    total = df.agg(F.coalesce(F.sum(byte_len(F.col(text))), F.lit(0)).cast("bigint").alias("total_bytes"))
    tokens = F.floor(F.col("total_bytes") * F.lit(TRAIN_SHARE) / F.lit(BYTES_PER_TOKEN))
    per_epoch = F.floor(F.floor(F.col("est_tokens") / length) / batch_size)
    return (
        total.withColumn("est_tokens", tokens)
        .withColumn("steps_per_epoch", per_epoch)
        .withColumn(
            "total_steps",
            F.greatest(F.lit(LEAST_STEPS).cast("bigint"), PLANNED_PASSES * F.col("steps_per_epoch")),
        )
    )


def plan_steps(df: DataFrame, batch_size: int, accumulate: int, epochs: int = 1, max_steps: int = 0) -> DataFrame:
    """Optimizer steps of a run over ``df``, one row."""
    batches = F.floor(F.col("samples") / batch_size)
    planned = epochs * F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("batches") / accumulate))
    return (
        df.agg(F.count(F.lit(1)).alias("samples"))
        .withColumn("batches", batches)
        .withColumn("total_steps", F.lit(max_steps).cast("bigint") if max_steps > 0 else planned)
    )


def corpus_stats(df: DataFrame, file: str, tokens: Column, batch_size: int, accumulate: int) -> DataFrame:
    """Files, samples, tokens and effective batch of a corpus, one row."""
    per_file = df.groupBy(file).agg(F.count(F.lit(1)).alias("n"), F.sum(tokens.cast("bigint")).alias("t"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("n").alias("samples"),
        F.sum("t").alias("tokens"),
        F.lit(batch_size * accumulate).cast("bigint").alias("effective_batch"),
    )
