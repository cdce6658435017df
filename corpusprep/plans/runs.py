"""Run metrics over ``events`` read as a training log."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.schedule import lr_cosine, lr_cosine_clamped
from corpusprep.operators.batch import accum_groups, every
from corpusprep.operators.metrics import (
    RATE_INTERVAL,
    cumulative_rate,
    interval_rate,
    last_of_group,
    number_steps,
    retain_latest,
    run_summary,
    trailing_mean,
)
from corpusprep.operators.vectors import causal_mean, causal_visibility
from corpusprep.plans.common import SQL_LOG, r6, run_log

ACCUMULATE = 4
TRAILING = 5
SEQ_LEN = 128
BATCH = 8
EVERY = 10
WARMUP, TOTAL, BASE_A, BASE_B = 10, 40, 7e-4, 4e-4


def _steps(spark, sf):
    return number_steps(run_log(spark, sf))


def _groups(spark, sf):
    steps = _steps(spark, sf)
    return steps.withColumns(accum_groups(F.col("pos"), F.col("n"), ACCUMULATE))


def groups_per_epoch(spark, sf):
    grouped = _groups(spark, sf)
    return grouped.select("run", "event_id", "accum_step", "micro", F.col("complete").cast("int").alias("complete"))


def groups_global(spark, sf):
    """The counter goes on from run to run: one index over the whole log."""
    log = number_steps(run_log(spark, sf), by=())
    grouped = log.withColumns(accum_groups(F.col("pos"), F.col("n"), ACCUMULATE))
    return grouped.select("run", "event_id", "accum_step", "micro", F.col("complete").cast("int").alias("complete"))


def _recorded(spark, sf):
    return last_of_group(_groups(spark, sf).filter("complete"), ["run", "accum_step"])


def last_micro_loss(spark, sf):
    return _recorded(spark, sf)


def trailing_mean_loss(spark, sf):
    means = trailing_mean(_recorded(spark, sf), ["run"], "accum_step", "loss", TRAILING)
    return means.withColumn("trailing_mean", r6(F.col("trailing_mean")))


def cumulative_throughput(spark, sf):
    rated = cumulative_rate(run_log(spark, sf), F.lit(SEQ_LEN - 1))
    return rated.select("run", "event_id", "tokens_seen", r6(F.col("rate")).alias("rate"))


def interval_throughput(spark, sf):
    rated = interval_rate(run_log(spark, sf), BATCH * SEQ_LEN)
    return rated.select("run", "event_id", "interval", r6(F.col("rate")).alias("rate"))


def summaries(spark, sf):
    summed = run_summary(run_log(spark, sf), F.lit(SEQ_LEN - 1))
    return summed.select("run", "final_step", "tokens", r6(F.col("hours")).alias("hours"), r6(F.col("rate")).alias("rate"))


def every_k_steps(spark, sf):
    due = every(F.col("pos") + 1, EVERY, last=F.col("n"))
    return _steps(spark, sf).filter(due).select("run", "event_id", (F.col("pos") + 1).alias("step"))


def newest_snapshots(spark, sf):
    saved = _steps(spark, sf).select(
        "run", (F.col("pos") + 1).alias("step"), F.format_string("run=%d/step=%d", "run", F.col("pos") + 1).alias("path")
    )
    return retain_latest(saved, 3, by=["run"])


def schedule_a(spark, sf):
    rate = lr_cosine(F.col("pos"), BASE_A, WARMUP, TOTAL)
    return _steps(spark, sf).select("run", "event_id", F.round(rate * 1e6, 4).alias("lr_millionths"))


def schedule_b(spark, sf):
    rate = lr_cosine_clamped(F.col("pos"), BASE_B, WARMUP, TOTAL)
    return _steps(spark, sf).select("run", "event_id", F.round(rate * 1e6, 4).alias("lr_millionths"))


def running_mean(spark, sf):
    means = causal_mean(run_log(spark, sf), ["run"], ["ts", "event_id"], "loss")
    return means.select("run", "event_id", "pos", F.round("causal_mean", 9).alias("causal_mean"))


def visibility(spark, sf):
    return _steps(spark, sf).withColumns(causal_visibility(F.col("pos"))).select(
        "run", "event_id", "first_visible", "last_visible", "visible"
    )


QUERIES = {
    "accum_groups": groups_per_epoch,
    "accum_groups_global": groups_global,
    "last_micro_loss": last_micro_loss,
    "trailing_mean_loss": trailing_mean_loss,
    "cumulative_rate": cumulative_throughput,
    "interval_rate": interval_throughput,
    "run_summary": summaries,
    "every_k_steps": every_k_steps,
    "retain_latest": newest_snapshots,
    "lr_schedule_a": schedule_a,
    "lr_schedule_b": schedule_b,
    "causal_mean": running_mean,
    "causal_visibility": visibility,
}

_D = "CAST({} AS DOUBLE)".format
_RECORDED = f"""{SQL_LOG},
recorded AS (
  SELECT run, pos // {ACCUMULATE} AS accum_step, arg_max(loss, pos) AS loss
  FROM steps WHERE pos // {ACCUMULATE} < n // {ACCUMULATE} GROUP BY run, pos // {ACCUMULATE}
)"""

SQL = {
    "accum_groups": f"""WITH {SQL_LOG}
        SELECT run, event_id, pos // {ACCUMULATE} AS accum_step, CAST(pos % {ACCUMULATE} AS INTEGER) AS micro,
               CASE WHEN pos // {ACCUMULATE} < n // {ACCUMULATE} THEN 1 ELSE 0 END AS complete FROM steps""",
    "accum_groups_global": f"""WITH {SQL_LOG},
        indexed AS (SELECT run, event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM log)
        SELECT run, event_id, pos // {ACCUMULATE} AS accum_step, CAST(pos % {ACCUMULATE} AS INTEGER) AS micro,
               CASE WHEN pos // {ACCUMULATE} < n // {ACCUMULATE} THEN 1 ELSE 0 END AS complete FROM indexed""",
    "last_micro_loss": f"WITH {_RECORDED} SELECT run, accum_step, loss FROM recorded",
    "trailing_mean_loss": f"""WITH {_RECORDED}
        SELECT run, accum_step, loss,
               round(avg(loss) OVER (PARTITION BY run ORDER BY accum_step
                                     ROWS BETWEEN {TRAILING - 1} PRECEDING AND CURRENT ROW), 6) AS trailing_mean
        FROM recorded""",
    "cumulative_rate": f"""WITH {SQL_LOG}
        SELECT run, event_id, {SEQ_LEN - 1} * (pos + 1) AS tokens_seen,
               round({SEQ_LEN - 1} * (pos + 1) / greatest({_D('1e-9')}, (ts - t0) / {_D('1e6')}), 6) AS rate
        FROM steps""",
    "interval_rate": f"""WITH {SQL_LOG},
        due AS (SELECT *, pos // {RATE_INTERVAL} AS interval_no FROM steps WHERE (pos + 1) % {RATE_INTERVAL} = 0),
        timed AS (SELECT *, lag(ts) OVER (PARTITION BY run ORDER BY interval_no) AS before FROM due)
        SELECT run, event_id, interval_no AS interval,
               round({_D(RATE_INTERVAL * BATCH * SEQ_LEN)}
                     / greatest({_D('1e-9')}, (ts - coalesce(before, t0)) / {_D('1e6')}), 6) AS rate
        FROM timed""",
    "run_summary": f"""WITH {SQL_LOG}
        SELECT run, count(*) AS final_step, count(*) * {SEQ_LEN - 1} AS tokens,
               round((max(ts) - min(ts)) / {_D('1e6')} / {_D('3600')}, 6) AS hours,
               round(count(*) * {SEQ_LEN - 1} / greatest({_D('1e-9')}, (max(ts) - min(ts)) / {_D('1e6')}), 6) AS rate
        FROM log GROUP BY run""",
    "every_k_steps": f"""WITH {SQL_LOG}
        SELECT run, event_id, pos + 1 AS step FROM steps WHERE (pos + 1) % {EVERY} = 0 OR pos + 1 = n""",
    "retain_latest": f"""WITH {SQL_LOG}
        SELECT run, pos + 1 AS step, 'run=' || run || '/step=' || (pos + 1) AS path FROM steps WHERE pos + 1 > n - 3""",
    "lr_schedule_a": f"""WITH {SQL_LOG}
        SELECT run, event_id, round({_D(BASE_A)} * CASE WHEN pos < {WARMUP} THEN (pos + 1) / {_D(WARMUP)}
          ELSE {_D('0.1')} + {_D('0.45')} * (1 + cos(pi() * ((pos - {WARMUP}) / {_D(TOTAL - WARMUP)}))) END * {_D('1e6')}, 4)
          AS lr_millionths FROM steps""",
    "lr_schedule_b": f"""WITH {SQL_LOG}
        SELECT run, event_id, round({_D(BASE_B)} * CASE WHEN pos < {WARMUP} THEN pos / {_D(WARMUP)}
          ELSE {_D('0.1')} + {_D('0.45')} * (1 + cos(pi() * least({_D('1')}, (pos - {WARMUP}) / {_D(TOTAL - WARMUP)}))) END
          * {_D('1e6')}, 4) AS lr_millionths FROM steps""",
    "causal_mean": f"""WITH {SQL_LOG}
        SELECT run, event_id, pos, round(avg(loss) OVER (PARTITION BY run ORDER BY pos), 9) AS causal_mean FROM steps""",
    "causal_visibility": f"""WITH {SQL_LOG}
        SELECT run, event_id, CAST(0 AS BIGINT) AS first_visible, pos AS last_visible, pos + 1 AS visible FROM steps""",
}
