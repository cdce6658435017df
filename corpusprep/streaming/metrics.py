"""Run metrics over a live log of steps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusprep.operators.metrics import LEAST_SECONDS, LOG_INTERVAL
from corpusprep.streaming.sorted_state import PIECE_KEY, SortedRows, keep_state_on_disk, ordered, piece_schema

_OUT = "run string, step bigint, loss double, trailing_mean double, tokens_seen bigint, rate double"
_ROW = ["ts_missing", "ts", "order_missing", "order", "loss", "tokens"]


class _Metrics(StatefulProcessor):
    """State of a run: its last losses as a list, its totals as a value."""

    def __init__(self, pieces: str, k: int):
        self.schema, self.k = pieces, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pieces = handle.getMapState("pieces", PIECE_KEY, self.schema)
        self.recent = handle.getListState("recent", "loss double")
        self.totals = handle.getValueState("totals", "tokens bigint, t0 bigint, step bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        in_order = SortedRows(self.pieces, _ROW, _ROW[:4])
        for chunk in rows:
            in_order.add(chunk)
        recent = [loss for (loss,) in self.recent.get()]
        seen, t0, step = self.totals.get() if self.totals.exists() else (0, None, 0)
        for block in in_order.blocks():
            log = pd.DataFrame(block, columns=_ROW)
            t0 = int(log["ts"].iloc[0]) if t0 is None else t0
            losses = pd.Series([*recent, *log["loss"]], dtype="float64")
            total = seen + log["tokens"].cumsum()
            elapsed = ((log["ts"] - t0) / 1e6).clip(lower=LEAST_SECONDS)
            yield pd.DataFrame(
                {
                    "run": key[0],
                    "step": range(step + 1, step + 1 + len(log)),
                    "loss": log["loss"].to_numpy(),
                    "trailing_mean": losses.rolling(self.k, min_periods=1).mean().iloc[len(recent) :].to_numpy(),
                    "tokens_seen": total.to_numpy(),
                    "rate": (total / elapsed).to_numpy(),
                }
            )
            recent = losses.iloc[-(self.k - 1) :].tolist() if self.k > 1 else []
            seen, step = int(total.iloc[-1]), step + len(log)
        self.recent.clear()
        if recent:
            self.recent.appendList([(loss,) for loss in recent])
        self.totals.update((seen, t0, step))
        in_order.clear()


def metrics_stream(
    sdf: DataFrame, run: str, ts: str, order: str, loss: str, tokens: Column, k: int = LOG_INTERVAL
) -> DataFrame:
    """Trailing mean of the last ``k`` losses and tokens per second since the run's first row.

    ``ts`` is in microseconds. Counts steps, not time: rows are taken in order of
    ``(ts, order)`` inside a micro-batch, nulls last, and by arrival across them. Rows of a
    micro-batch are sorted through the state, so a run may send any number.
    """
    keep_state_on_disk(sdf.sparkSession)
    rows = sdf.select(
        F.col(run).cast("string").alias("run"),
        *ordered(F.col(ts), sdf.schema[ts].dataType, "ts"),
        *ordered(F.col(order), sdf.schema[order].dataType, "order"),
        F.col(loss).cast("double").alias("loss"),
        F.coalesce(tokens.cast("bigint"), F.lit(0)).alias("tokens"),
    )
    pieces = piece_schema(rows.select(*_ROW).schema)
    return rows.groupBy("run").transformWithStateInPandas(_Metrics(pieces, k), _OUT, "Append", "None")
