"""Run metrics over a log of micro-batches ``(run, event_id, ts, loss)``, ``ts`` in microseconds.

A run may hold a large share of the log, so nothing groups a whole run in one
task: positions and totals come from bucketed running sums, look-backs from
blocks of consecutive steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.operators.batch import every
from corpusprep.operators.order import halo_window, running

# Seconds that an elapsed time is at least, steps between log lines.
LEAST_SECONDS = 1e-9
LOG_INTERVAL = 25
RATE_INTERVAL = 20
_MICROS = 1e6


def number_steps(
    log: DataFrame, by: Sequence[str] = ("run",), order: Sequence[str] = ("ts", "event_id"), tokens: Column | None = None
) -> DataFrame:
    """Adds ``pos`` (from 0), ``n`` and ``t0`` of the run, and ``tokens_before`` where tokens are given."""
    sums = {"pos": F.lit(1).cast("bigint")}
    if tokens is not None:
        sums["tokens_before"] = tokens.cast("bigint")
    totals = {"n": (F.count(F.lit(1)), "sum"), "t0": (F.min("ts"), "min")}
    return running(log, list(order), sums, by, totals)


def last_of_group(df: DataFrame, by: Sequence[str], micro: str = "micro", loss: str = "loss") -> DataFrame:
    """The loss a step records: the one of its last micro-batch."""
    return df.groupBy(*by).agg(F.max_by(loss, micro).alias(loss))


def trailing_mean(
    df: DataFrame, by: Sequence[str], pos: str, value: str, k: int = LOG_INTERVAL, out: str = "trailing_mean"
) -> DataFrame:
    """Mean of the last ``k`` values, of fewer at the start; ``pos`` has no gaps."""
    mean = {out: lambda w: F.avg(value).over(w.rowsBetween(-(k - 1), W.currentRow))}
    return halo_window(df, by, pos, k - 1, mean)


def _seconds(since: Column, until: Column) -> Column:
    return F.greatest(F.lit(LEAST_SECONDS), (until - since) / F.lit(_MICROS))


def cumulative_rate(log: DataFrame, tokens: Column) -> DataFrame:
    """Tokens seen so far in the run and tokens per second since its start."""
    numbered = number_steps(log.withColumn("__tokens", tokens.cast("bigint")), tokens=F.col("__tokens"))
    seen = F.col("tokens_before") + F.col("__tokens")
    return (
        numbered.withColumn("tokens_seen", seen)
        .withColumn("rate", F.col("tokens_seen") / _seconds(F.col("t0"), F.col("ts")))
        .drop("__tokens", "tokens_before")
    )


def interval_rate(log: DataFrame, tokens_per_step: int, k: int = RATE_INTERVAL) -> DataFrame:
    """Tokens per second over each full interval of ``k`` steps; the first counts from the run's start."""
    due = number_steps(log).filter(every(F.col("pos") + 1, k)).withColumn("interval", F.floor(F.col("pos") / k))
    previous = {"__prev": lambda w: F.lag("ts").over(w)}
    timed = halo_window(due, ["run"], "interval", 1, previous)
    elapsed = _seconds(F.coalesce("__prev", "t0"), F.col("ts"))
    return timed.withColumn("rate", F.lit(float(k * tokens_per_step)) / elapsed).drop("__prev")


def run_summary(log: DataFrame, tokens: Column) -> DataFrame:
    """Hours, average tokens per second and final step of each run."""
    seconds = (F.col("t1") - F.col("t0")) / F.lit(_MICROS)
    return (
        log.groupBy("run")
        .agg(
            F.min("ts").alias("t0"),
            F.max("ts").alias("t1"),
            F.count(F.lit(1)).alias("final_step"),
            F.sum(tokens.cast("bigint")).alias("tokens"),
        )
        .select(
            "run",
            "final_step",
            "tokens",
            (seconds / F.lit(3600.0)).alias("hours"),
            (F.col("tokens") / F.greatest(F.lit(LEAST_SECONDS), seconds)).alias("rate"),
        )
    )


def retain_latest(df: DataFrame, keep: int = 3, step: str = "step", by: Sequence[str] = ()) -> DataFrame:
    """The newest ``keep`` snapshots (of each ``by``); older rows are dropped before the shuffle."""
    newest = W.partitionBy(*by).orderBy(F.desc(step))
    return df.withColumn("__rank", F.row_number().over(newest)).filter(F.col("__rank") <= keep).drop("__rank")
