"""Reproducible shuffles, epochs and batches over rows with a unique id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.functions.sampling import seeded_key
from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.order import global_index, running

BUFFER = 2000  # fixed value: rows that a bounded shuffle mixes


def shuffle(df: DataFrame, ids: Sequence[str], seed: int, epoch: int | Column = 0, by: Sequence[str] = ()) -> DataFrame:
    """A permutation of the rows: ``pos`` is the place of each row in it.

    ``ids`` identify a row. With ``by`` each group is permuted on its own.
    """
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    digest = seeded_key(seed, epoch, *[F.col(c) for c in ids])
    return global_index(df, [digest, *ids], by=by)


def file_shuffle(df: DataFrame, file: str, order: Sequence[str], seed: int, epoch: int = 0) -> DataFrame:
    """Files in a random order, the rows of each file in their own order."""
    digest = seeded_key(seed, F.lit(epoch), F.col(file))
    files = df.groupBy(file).agg(F.count(F.lit(1)).alias("__rows")).withColumn("__digest", digest)
    starts = running(files, ["__digest", file], {"__start": F.col("__rows")}).select(file, "__start")
    inner = global_index(df, order, by=[file], out="__at")
    joined = lookup_join(inner, starts, file, "inner")
    return joined.select(*df.columns, (F.col("__start") + F.col("__at")).alias("pos"))


def block_shuffle(df: DataFrame, pos: str, seed: int, buffer: int = BUFFER, out: str = "shuffled_pos") -> DataFrame:
    """Permute inside consecutive blocks of ``buffer`` rows."""
    block = F.floor(F.col(pos) / buffer)
    inside = W.partitionBy("__block").orderBy(seeded_key(seed, F.col(pos)), pos)
    return (
        df.withColumn("__block", block)
        .withColumn(out, F.col("__block") * buffer + F.row_number().over(inside) - 1)
        .drop("__block")
    )


def repeat_epochs(
    df: DataFrame,
    ids: Sequence[str],
    batch_size: int,
    epochs: int,
    max_steps: int,
    seed: int,
) -> DataFrame:
    """Batches of ``epochs`` passes, each freshly shuffled, cut off after ``max_steps``.

    Adds ``epoch``, ``step`` (over all epochs) and ``row_in_batch``; the
    incomplete last batch of an epoch is dropped.
    """
    per_epoch = F.floor(df.agg(F.count(F.lit(1))).scalar() / batch_size)
    copies = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    begun = copies.filter(F.col("epoch") * per_epoch < max_steps)
    mixed = shuffle(begun, ids, seed, F.col("epoch"), by=["epoch"])
    in_epoch = F.floor(F.col("pos") / batch_size)
    return (
        mixed.filter(in_epoch < per_epoch)
        .withColumn("step", F.col("epoch") * per_epoch + in_epoch)
        .withColumn("row_in_batch", F.col("pos") % batch_size)
        .filter(F.col("step") < max_steps)
        .drop("pos")
    )
