"""What the operators share: folds, fresh names, native array helpers and sorted groups in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusprep.sources.documents import read_table

#: Bytes that part words in the contracts; ``bytes.split()`` parts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds))


def held_out(doc_id: Column, folds: int, left_out: int = 2) -> Column:
    """Whether the row is kept from learning; rows without an id are learnt from."""
    return F.coalesce(fold(doc_id, folds) == left_out, F.lit(False))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(values: Column) -> Column:
    """Exclusive running sums of an ``array<int>``.

    Sums inside blocks of about sqrt(n) entries are shifted by the running
    sums of the blocks, so a long array costs n ** 1.5 rather than n ** 2.
    """

    def running(items: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def add(state: Column, x: Column) -> Column:
            return F.struct(
                (state["at"] + x).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")
            )

        return F.aggregate(items, start, add, lambda state: state["out"])

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), lambda a, x: a + x)

    def by_blocks(items: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(items))).cast("int")

        def blocked(blocks: Column) -> Column:
            shifts = running(F.transform(blocks, total))
            return F.flatten(
                F.zip_with(blocks, shifts, lambda b, at: F.transform(running(b), lambda x: x + at))
            )

        firsts = F.sequence(F.lit(1), F.size(items), width)
        return let(F.transform(firsts, lambda i: F.slice(items, i, width)), blocked)

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(by_blocks(v)))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; white space is that of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def sorted_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], most: int
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Pieces of a partition sorted by ``keys``, with the row each group starts at.

    Groups of up to ``most`` rows come whole. A larger one may come in several
    pieces, each of more than ``most`` rows, so that no group is held in memory.
    """
    rest: pa.Table | None = None

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        whole = pa.concat_tables([rest, now]) if rest is not None else now
        at = starts(whole)
        open_ = int(at[-1])
        if whole.num_rows - open_ > 2 * most + 2:
            # Of a large group a piece of most + 1 rows is kept, for the next piece must be large too.
            cut = whole.num_rows - most - 1
            yield whole.slice(0, cut), at
        else:
            cut = open_
            if cut:
                yield whole.slice(0, cut), at[:-1]
        rest = whole.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest, starts(rest)
