"""Joining a large table to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_BYTES = 128 << 20
UNBOUNDED = 1 << 62  # rows of a table that is never broadcast
_HOT_KEYS, _TRACKED = 4096, 65_536  # most keys that are called hot, keys that the sketch follows
_SPREAD = 1 << 20


def hot_keys(facts: DataFrame, on: Sequence[str], share: float) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows.

    A frequent-items sketch: every task keeps a bounded table of counts, and
    tables merge on the way to the result. It finds every key above the share,
    as long as that is more than a few in ``_TRACKED``; it may add some below.
    """
    top = F.expr(f"approx_top_k(h, {_HOT_KEYS}, {_TRACKED})")
    row = facts.select(F.xxhash64(*on).alias("h")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] > share * row["n"]]


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    bound: int | None = None,
    row_bytes: int = 64,
    skewed: bool = True,
) -> DataFrame:
    """Add the columns of ``dim`` (unique on ``on``) to ``facts``.

    ``dim`` is broadcast only when it is small: its row count is ``bound`` if
    the caller knows one, else it is counted; ``row_bytes`` is the size of a
    row. A larger ``dim`` is shuffled. Keys that more than half a partition's
    share of ``facts`` has are found first: their rows of ``dim`` are few and
    broadcast, and their facts are spread over all tasks. With ``skewed`` false
    the caller knows that there are none.
    """
    on = [on] if isinstance(on, str) else list(on)
    most = BROADCAST_BYTES // row_bytes
    if bound is None:
        bound = dim.limit(most + 1).count()
    if bound <= most:
        return facts.join(F.broadcast(dim), on, how)
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, on, 0.5 / parts) if skewed else []
    return _join_hot(facts, dim, on, how, hot) if hot else facts.join(dim, on, how)


def _join_hot(facts: DataFrame, dim: DataFrame, on: list[str], how: str, hot: list[int]) -> DataFrame:
    """The join in one pass over ``facts``: hot keys against a broadcast, the others against a shuffle."""
    names = [c for c in dim.columns if c not in on]
    found = F.struct(F.lit(True).alias("__is"), *[F.col(c) for c in names])

    def is_hot() -> Column:
        return F.xxhash64(*on).isin(hot)

    few = dim.filter(is_hot()).select(*on, found.alias("__hot"))
    # Zero, but not as a constant: that would be taken out of the join's keys, and with it the spread.
    zero = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int").alias("__spread")
    rest = dim.filter(~is_hot()).select(*on, zero, found.alias("__cold"))
    # Facts with a hot key look for nothing in the shuffled table, from wherever they are sent.
    away = F.when(is_hot(), F.pmod(F.xxhash64(*facts.columns), F.lit(_SPREAD)).cast("int") + 1).otherwise(0)
    first = facts.join(F.broadcast(few), on, "left").withColumn("__spread", away)
    both = first.join(rest, [*on, "__spread"], "left").withColumn("__found", F.coalesce("__hot", "__cold"))
    kept = both.filter(F.col("__found").isNotNull()) if how == "inner" else both
    ordered = [*on, *[c for c in facts.columns if c not in on]]
    return kept.select(*[F.col(f"`{c}`") for c in ordered], *[F.col("__found")[c].alias(c) for c in names])
