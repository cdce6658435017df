"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into ``2 ** bits`` cells of similar row count: a
number by quantiles of all rows, any other value by its place among all values
in order, weighted by how many rows have it. Rows are put in order of the cell
on the Hilbert curve and the order is cut into runs. Rows of a run are near
each other in every dimension, so the minimum and maximum of each dimension
prune whole shards.

Law of the cut: ``rows``. Shard counts are at most one apart.

Nulls count as the smallest value of their dimension. Ties on the curve are
ordered by the tie columns; rows equal in those too are interchangeable. Of a
text only its size and checksum are used, however long it is. Further columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.order import global_index, running
from corpusprep.session import stage

BITS = 6


def hilbert_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates below ``2 ** bits``.

    From the top bit down, every coordinate either reflects or swaps with the
    first one's lower bits; a Gray code and interleaving end it.
    """
    x = [np.array(c, np.int64) for c in cells]
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for axis in x:
            set_ = (axis & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(set_, low, swap)
            if axis is not x[0]:
                axis ^= swap
        bit >>= 1
    for before, axis in zip(x, x[1:]):
        axis ^= before
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            out = (out << 1) | (((axis ^ turn) >> b) & 1)
    return out


def _ordered_cells(df: DataFrame, dim: str, bits: int) -> tuple[DataFrame, int]:
    """``(dim, cell)``: values in order, cells of similar row count; and how many values there are."""
    counts = stage(df.groupBy(dim).agg(F.count(F.lit(1)).alias("n")), "values")
    rows = counts.agg(F.sum("n")).first()[0] or 1
    before = running(counts.withColumn("at", F.col("n")), [dim], {"at": F.col("n")})
    cell = F.floor(F.col("at") * (1 << bits) / rows).cast("int")
    return before.select(dim, cell.alias("cell")), counts.count()


def hilbert_cells(df: DataFrame, dims: Sequence[str], out: str, bits: int = BITS) -> DataFrame:
    """``df`` with the Hilbert index of ``dims`` as ``out``.

    Quantiles come from one pass over all rows, the cells of other values from
    counts over all rows; their table is broadcast only when it is small.
    """
    numbers = [d for d in dims if isinstance(df.schema[d].dataType, T.NumericType)]
    cuts: dict[str, np.ndarray] = {}
    if numbers:
        shares = [i / (1 << bits) for i in range(1, 1 << bits)]
        wanted = [F.percentile_approx(F.col(d).cast("double"), shares, 10_000).alias(d) for d in numbers]
        cuts = {d: np.unique(v or []) for d, v in df.agg(*wanted).first().asDict().items()}
    placed, cells = df, []
    for i, d in enumerate(dims):
        if d in cuts:
            cells.append(F.col(d).cast("double"))
            continue
        codes, n = _ordered_cells(df, d, bits)
        name = f"__cell_{i}"
        found = codes.filter(F.col(d).isNotNull()).withColumnRenamed("cell", name)
        placed = lookup_join(placed, found, d, bound=n)
        cells.append(F.coalesce(name, F.lit(0)).cast("double"))
    edges = [cuts.get(d) for d in dims]

    @F.pandas_udf("bigint")
    def index(*columns: pd.Series) -> pd.Series:
        at = []
        for values, cut in zip(columns, edges):
            v = values.to_numpy(np.float64, na_value=-np.inf)
            v = np.where(np.isnan(v), -np.inf, v)
            at.append(v.astype(np.int64) if cut is None else np.searchsorted(cut, v, side="right"))
        return pd.Series(hilbert_index(at, bits))

    return placed.select(*[F.col(f"`{c}`") for c in df.columns], index(*cells).alias(out))


def hilbert_shards(
    df: DataFrame, dims: Sequence[str], ties: Sequence[str], shards: int, bits: int = BITS
) -> DataFrame:
    """``df`` (narrow rows) with ``curve``, ``shard`` and ``slot``, its place in the shard.

    ``df`` is staged once with its curve index; positions along the curve are
    counted over sampled cuts of the whole ordering tuple, so a cell that holds
    a third of the rows is cut by the tie columns.
    """
    placed = stage(hilbert_cells(df, dims, "curve", bits), "curve")
    n = placed.count()
    at = global_index(placed, ["curve", *ties], out="__at")
    # Whole-number division: exact for any count.
    shard = F.expr(f"(__at * {shards}L) div {max(n, 1)}L")
    first = F.expr(f"(shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return (
        at.withColumn("shard", shard)
        .withColumn("slot", F.col("__at") - first)
        .withColumn("shard", F.col("shard").cast("int"))
        .drop("__at")
    )


def shard_ranges(sharded: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Least and greatest value of each dimension in each shard: what pruning reads."""
    ends = [f(d).alias(f"{name}_{d}") for d in dims for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)


def write_shards(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write rows that carry ``shard`` and ``slot``: a folder for each shard, files cut along the curve."""
    run = F.floor(F.col("slot") / rows_per_file)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartition(parts, "shard", run)
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str, ranges: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Rows of written shards with every dimension of ``bounds`` between its two values, both included.

    ``ranges`` (of ``shard_ranges``) has a row for each shard: shards outside
    the bounds are never listed, and inside the others the same filter reaches
    the files' own statistics.
    """
    inside, meets = F.lit(True), F.lit(True)
    for d, (low, high) in bounds.items():
        inside &= F.col(d).between(F.lit(low), F.lit(high))
        meets &= (F.col(f"max_{d}") >= F.lit(low)) & (F.col(f"min_{d}") <= F.lit(high))
    due = [r["shard"] for r in ranges.filter(meets).select("shard").collect()]
    return spark.read.parquet(path).filter(F.col("shard").isin(due) & inside)


def text_size(text: Column) -> Column:
    """Bytes of the text in UTF-8, and eight for its row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


def op2(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The contract's columns: one row per document, sharded by language, source, size and id."""
    narrow = docs.select(
        "doc_id",
        "lang",
        "source",
        text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    staged = stage(narrow, "sizes")
    found = hilbert_shards(staged, ["lang", "source", "size", "doc_id"], ["doc_id", "text_crc32", "size"], shards)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
