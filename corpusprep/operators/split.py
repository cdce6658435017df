"""Train and validation splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.functions.text import byte_len, lines_of
from corpusprep.operators.order import cut_key

TRAIN_SHARE = 0.9  # fixed value


def split_by_rank(df: DataFrame, key: str, share: float = TRAIN_SHARE) -> DataFrame:
    """First ``floor(share * n)`` rows along the unique ``key`` are ``train``, others ``val``.

    Adds no shuffle: the key at the cut is found first and the rest is a comparison.
    """
    cut = cut_key(df, key, share)
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    return df.withColumn("split", F.when(F.col(key) < F.lit(cut), "train").otherwise("val"))


def byte_cut(size: Column, share: float = TRAIN_SHARE) -> Column:
    return F.floor(size * F.lit(share))


def split_at_byte(start: Column, end: Column, size: Column, share: float = TRAIN_SHARE) -> Column:
    """``train`` when the line ends by the cut, ``val`` when it starts after it, else null."""
    cut = byte_cut(size, share)
    return F.when(end <= cut, "train").when(start > cut, "val")


def split_by_bytes(df: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """Keep the lines on either side of the byte cut of their file, labelled in ``split``.

    Needs ``start``, ``end`` and ``size`` in bytes; the line across the cut is dropped.
    """
    return df.withColumn("split", split_at_byte(F.col("start"), F.col("end"), F.col("size"), share)).filter(
        F.col("split").isNotNull()
    )


def document_lines(df: DataFrame, key: str = "doc_id", text: str = "text", offsets: bool = False) -> DataFrame:
    """One row per line of each document, numbered from 0; optionally with byte offsets.

    A document is one row, so its lines are bounded by what a row can hold;
    the documents are spread before they are cut up.
    """
    rows = df.select(key, text)
    if offsets:
        rows = rows.repartition(key)
    size = byte_len(F.col(text)).alias("size")
    lines = rows.select(key, size, F.posexplode(lines_of(F.col(text))).alias("line_no", "line"))
    if not offsets:
        return lines.select(key, "line_no", "line")
    along = W.partitionBy(key).orderBy("line_no")
    length = byte_len(F.col("line")) + 1
    end = F.sum(length).over(along.rowsBetween(W.unboundedPreceding, 0))
    return lines.select(
        key,
        "line_no",
        "line",
        (end - length).alias("start"),
        F.least(end, F.col("size")).alias("end"),
        F.col("size").cast("bigint"),
    )
