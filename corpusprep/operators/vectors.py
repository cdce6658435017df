"""Vector tables: lookup by id, norms, clipping and causal means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.functions.arrays import EPS, add_vectors, sum_of_squares
from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.order import running


def lookup_vectors(
    df: DataFrame, token: str, pos: str, table: DataFrame, positions: DataFrame, dims: int, out: str = "vector"
) -> DataFrame:
    """Vector of each token plus the vector of its position.

    ``table`` and ``positions`` are ``(vec_id, embedding)``.
    """
    by_token = table.select(F.col("vec_id").alias(token), F.col("embedding").alias("__token"))
    by_pos = positions.select(F.col("vec_id").alias(pos), F.col("embedding").alias("__pos"))
    size = 64 + 8 * dims
    joined = lookup_join(lookup_join(df, by_token, token, row_bytes=size), by_pos, pos, row_bytes=size)
    return joined.withColumn(out, add_vectors(F.col("__token"), F.col("__pos"))).drop("__token", "__pos")


def global_norm(df: DataFrame, vector: str) -> DataFrame:
    """L2 norm over all vectors of a table, one row."""
    return df.agg(F.sqrt(F.sum(sum_of_squares(F.col(vector)))).alias("norm"))


def clip_by_global_norm(df: DataFrame, vector: str, max_norm: float) -> DataFrame:
    """Scale every vector by ``min(1, max_norm / (norm + eps))``."""
    norm = global_norm(df, vector).scalar()
    scaled = df.withColumn("__scale", F.least(F.lit(1.0), F.lit(float(max_norm)) / (norm + F.lit(EPS))))
    return scaled.withColumn(
        vector, F.transform(F.col(vector).cast("array<double>"), lambda x: x * F.col("__scale"))
    ).drop("__scale")


def causal_visibility(pos: Column) -> dict[str, Column]:
    """What position ``pos`` may see, as a range: itself and everything before."""
    return {"first_visible": F.lit(0).cast("bigint"), "last_visible": pos, "visible": pos + 1}


def causal_mask(i: Column, j: Column) -> Column:
    """True when position ``i`` may see position ``j``."""
    return i >= j


def causal_mean(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str, out: str = "causal_mean"
) -> DataFrame:
    """Mean of ``value`` over each row and all rows before it in its sequence.

    A running total: no pairs are built, and a long sequence is cut into buckets.
    """
    summed = running(df, order, {"pos": F.lit(1).cast("bigint"), "__sum": F.col(value)}, by)
    return summed.withColumn(out, (F.col("__sum") + F.col(value)) / (F.col("pos") + 1)).drop("__sum")
