"""The packer as a stream: sequences come out as lines arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusprep.streaming.sorted_state import PIECE_KEY, SortedRows, keep_state_on_disk, ordered, piece_schema

_OUT = "source string, lane int, seq_id bigint, ids array<bigint>"
_ROW = ["order_missing", "order", "ids"]


class _Packer(StatefulProcessor):
    """State of a key: the ids left over, as a list of chunks, and the next sequence's number."""

    def __init__(self, pieces: str, length: int):
        self.schema, self.length = pieces, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pieces = handle.getMapState("pieces", PIECE_KEY, self.schema)
        self.rest = handle.getListState("rest", "ids array<bigint>")
        self.next = handle.getValueState("next", "seq_id bigint")

    def _cut(self, rows: SortedRows, held: np.ndarray) -> Iterator[np.ndarray]:
        """Full sequences, a block of rows at a time; what is left over is put into the state."""
        for block in rows.blocks():
            stream = np.concatenate([held, *[np.asarray(r[2], np.int64) for r in block if r[2] is not None]])
            full = len(stream) // self.length * self.length
            held = stream[full:]
            if full:
                yield stream[:full].reshape(-1, self.length)
        self.rest.clear()
        if len(held):
            self.rest.appendValue((held.tolist(),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        run = SortedRows(self.pieces, _ROW, _ROW[:2])
        for chunk in rows:
            run.add(chunk)
        held = np.array([i for (ids,) in self.rest.get() for i in ids], np.int64)
        seq = self.next.get()[0] if self.next.exists() else 0
        for sequences in self._cut(run, held):
            n = len(sequences)
            yield pd.DataFrame({"source": key[0], "lane": key[1], "seq_id": range(seq, seq + n), "ids": list(sequences)})
            seq += n
        self.next.update((seq,))
        run.clear()


def pack_stream(sdf: DataFrame, source: str, order: str, ids: str, length: int, lanes: int = 1) -> DataFrame:
    """``(source, lane, seq_id, ids)`` from a stream of id arrays.

    Rows of a source are packed in arrival order of the micro-batches and by
    ``order`` inside one, nulls last; null arrays are empty. What is left over
    stays in the state. Rows of a micro-batch are sorted through the state, a
    chunk at a time, so memory does not grow with what a source sends at once.
    A busy source can be cut into ``lanes``, each with a buffer of its own.
    """
    keep_state_on_disk(sdf.sparkSession)
    lane = F.pmod(F.xxhash64(order), F.lit(lanes)).cast("int")
    rows = sdf.select(
        F.col(source).cast("string").alias("source"),
        lane.alias("lane"),
        *ordered(F.col(order), sdf.schema[order].dataType, "order"),
        F.col(ids).cast("array<bigint>").alias("ids"),
    )
    pieces = piece_schema(rows.select(*_ROW).schema)
    return rows.groupBy("source", "lane").transformWithStateInPandas(_Packer(pieces, length), _OUT, "Append", "None")
