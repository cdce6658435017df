"""Rows of one key and micro-batch in order, sorted through the state store in bounded memory."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.types import DataType, StructType

#: Values of a run held at once while merging, and values handed on at once; an array counts its items.
PIECE, BLOCK = 4096, 1 << 16
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Let queries started from now on hold their state in RocksDB, which list and map states need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)


def piece_schema(rows: StructType) -> str:
    """Schema of a piece: each column of the rows as an array."""
    return ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in rows)


PIECE_KEY = "run int, piece int"


def ordered(column: Column, kind: DataType, name: str) -> list[Column]:
    """Two columns to sort by, nulls last: a null among integers would turn them into floats on the way to Python."""
    return [column.isNull().alias(f"{name}_missing"), F.coalesce(column, F.lit("0").cast(kind)).alias(name)]


class SortedRows:
    """Sorts what arrives chunk by chunk, without holding it.

    A chunk is sorted and put into a map state in pieces, as a run; the last
    chunk stays in memory, so a key with one chunk touches no state. Merging
    holds one piece of each run. ``by`` are the columns to sort by; ``ordered``
    gives columns without nulls for that.
    """

    def __init__(self, pieces, columns: Sequence[str], by: Sequence[str], piece: int = PIECE):
        self.pieces, self.columns, self.piece = pieces, list(columns), piece
        self.by = [self.columns.index(c) for c in by]
        self.runs: list[int] = []  # pieces of each stored run
        self.last: list[tuple] = []

    def _rank(self, row: tuple) -> tuple:
        return tuple(row[i] for i in self.by)

    def add(self, chunk: pd.DataFrame) -> None:
        if self.last:
            self._store(self.last)
        self.last = sorted(zip(*(chunk[c].tolist() for c in self.columns)), key=self._rank)

    def _store(self, rows: list[tuple]) -> None:
        run, count = len(self.runs), 0
        for count, part in enumerate(_cut(rows, self.piece), 1):
            self.pieces.updateValue((run, count - 1), tuple([_plain(r[i]) for r in part] for i in range(len(self.columns))))
        self.runs.append(count)

    def _run(self, run: int) -> Iterator[tuple]:
        for piece in range(self.runs[run]):
            yield from zip(*self.pieces.getValue((run, piece)))

    def blocks(self, size: int = BLOCK) -> Iterator[list[tuple]]:
        """All rows in order, some at a time."""
        runs = [self._run(i) for i in range(len(self.runs))]
        merged = heapq.merge(*runs, self.last, key=self._rank) if runs else self.last
        yield from _cut(merged, size)

    def clear(self) -> None:
        for run, count in enumerate(self.runs):
            for piece in range(count):
                self.pieces.removeKey((run, piece))


def _cut(rows: Iterable[tuple], most: int) -> Iterator[list[tuple]]:
    """Rows in lists of at most about ``most`` values."""
    part, weight = [], 0
    for row in rows:
        part.append(row)
        weight += sum(len(v) if hasattr(v, "__len__") and not isinstance(v, str) else 1 for v in row)
        if weight >= most:
            yield part
            part, weight = [], 0
    if part:
        yield part


def _plain(value):
    return value.tolist() if hasattr(value, "tolist") else value
