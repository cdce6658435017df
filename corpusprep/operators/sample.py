"""Categorical draws and temperature mixtures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.functions.sampling import gumbel

TEMPERATURE = 0.7  # fixed value


def sample_categorical(
    df: DataFrame,
    group: Sequence[str],
    item: str,
    logit: Column,
    seed: int,
    temperature: float = TEMPERATURE,
    draw: int = 0,
) -> DataFrame:
    """One ``item`` per group, drawn with probability proportional to ``exp(logit / temperature)``."""
    noise = gumbel(seed, F.lit(draw), *[F.col(c) for c in group], F.col(item))
    scored = df.withColumn("__score", logit / F.lit(float(temperature)) + noise)
    return scored.groupBy(*group).agg(F.max_by(item, F.struct("__score", item)).alias(item))


def sample_logits(logits: Column, key: Column, seed: int, temperature: float = TEMPERATURE, draw: int = 0) -> Column:
    """The same draw over a logit array: the index drawn, without moving rows."""
    scored = F.transform(
        logits.cast("array<double>"),
        lambda x, i: F.struct((x / F.lit(float(temperature)) + gumbel(seed, F.lit(draw), key, i)).alias("s"), i.alias("i")),
    )
    return F.array_max(scored)["i"]


def mixture_weights(df: DataFrame, stratum: str, temperature: float = TEMPERATURE) -> DataFrame:
    """``(stratum, n, weight)`` with weights proportional to ``n ** (1 / temperature)``."""
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    power = F.pow(F.col("n"), F.lit(1.0 / temperature))
    return counts.withColumn("weight", power / counts.agg(F.sum(power)).scalar())
