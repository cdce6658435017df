"""Running totals and positions over ordered data, without one-task sorts.

Spark's own range partitions are the buckets. Rows are range-partitioned by
the whole key tuple, sorted and staged once with their partition and their
place in it; a small table of partition totals gives every partition its
start. Positions then need no window at all, running sums one window inside
each partition. A hot first key is cut by the next ones, since the whole tuple
is partitioned by.

Rows too wide to be staged (whole texts) are cut by explicit key tuples
instead (``cut_rows``): the rows are then shuffled once, as they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from corpusprep.functions.arrays import search_sorted
from corpusprep.operators.lookup import lookup_join
from corpusprep.session import stage

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 65_536  # cuts are part of the plan, so their number is bounded
_OVERSAMPLE = 8
_SEED = 42
_BUCKET, _KEY, _PLACE = "__bucket", "__key", "__place"


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp without time zone, whatever the session's zone."""
    seconds = F.unix_date(F.to_date(ts)) * F.lit(86_400).cast("bigint") + F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return seconds * 1_000_000 + fraction


@dataclass(frozen=True)
class Cuts:
    """Ascending key tuples that part the rows, as JSON of their type."""

    tuples: tuple[str, ...]
    kind: str

    def bucket(self, keys: Sequence[Column]) -> Column:
        """How many cuts are at or below the row's keys; nulls come before all values."""
        if not self.tuples:
            return F.lit(0)
        cuts = F.from_json(F.lit(f"[{','.join(self.tuples)}]"), f"array<{self.kind}>")
        # Never null, so that no reader of the bucket adds a filter of its own below the shuffle.
        return F.coalesce(search_sorted(cuts, _tuple(keys), len(self.tuples)), F.lit(0))


def _tuple(keys: Sequence[Column]) -> Column:
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])


def cut_rows(df: DataFrame, keys: Sequence[Column], rows_per_bucket: int | None = None) -> Cuts:
    """Cuts into buckets of similar row count, a few for each core at least.

    One job over the keys keeps the rows with the smallest hashes: a uniform
    sample, whose largest hash tells how many rows there are. A second job
    draws more only if more buckets are due. Cuts balance the work; what is
    computed with them does not depend on which rows were drawn.
    """
    spark = df.sparkSession
    keyed = df.select(_tuple(keys).alias("k"))
    floor = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # The row number is hashed along, or all repeats of a key would be drawn together.
    hashed = keyed.select("k", F.xxhash64("k", F.monotonically_increasing_id(), F.lit(_SEED)).alias("h"))

    def draw(most: int) -> list:
        sample = hashed.orderBy("h").limit(most)
        return sample.orderBy("k").select(F.to_json("k").alias("k"), "h").collect()

    def rows_in(sample: list, most: int) -> float:
        if len(sample) < most:
            return len(sample)
        return most * 2.0**64 / max(1.0, max(r["h"] for r in sample) + 2.0**63)

    wanted, per = floor, rows_per_bucket or ROWS_PER_BUCKET
    sample = draw(_OVERSAMPLE * wanted)
    due = min(MAX_BUCKETS, math.ceil(rows_in(sample, _OVERSAMPLE * wanted) / per))
    if due > wanted:
        wanted = due
        sample = draw(_OVERSAMPLE * wanted)
    n = len(sample)
    picked = dict.fromkeys(sample[i * n // wanted]["k"] for i in range(1, wanted) if n)
    return Cuts(tuple(picked), keyed.schema["k"].dataType.simpleString())


def order_bucket(df: DataFrame, order: Sequence[Column], rows_per_bucket: int | None = None) -> Column:
    """A bucket that follows ``order`` and holds a bounded share of the rows."""
    return cut_rows(df, order, rows_per_bucket).bucket(order)


def ranged(df: DataFrame, order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` staged in range partitions along ``order``: adds ``__bucket``, the partition, and ``__place`` in it."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    staged = stage(rows.withColumn("__id", F.monotonically_increasing_id()), "ranged")
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.select(
        *[F.col(f"`{c}`") for c in df.columns], F.shiftright("__id", 33).cast("int").alias(_BUCKET), place.alias(_PLACE)
    )


def _key(by: Sequence[str]) -> Column:
    """The group of a row; a struct compares null-safely."""
    return F.struct(*[F.col(c) for c in by]) if by else F.lit(0)


def running(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    totals: Mapping[str, tuple[Column, str]] | None = None,
    bucket: Column | None = None,
    span: str | None = None,
    derive: Mapping[str, Column] | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Exclusive running sums of ``sums`` along ``order``, restarted per ``by``.

    ``order`` must identify a row (within ``by``); its entries are of any
    comparable type. ``bucket`` may name a bucket that follows the order, of at
    most ``MAX_BUCKETS`` values.
    ``totals`` adds per-``by`` aggregates as ``name -> (aggregate, merge)`` with
    merge one of ``sum``, ``min``, ``max``.

    ``span`` names a sum: ``__bucket`` is kept, and ``__low`` and ``__high`` are
    that sum's value at the start and the end of the row's bucket.

    ``derive`` adds columns that ``sums`` may use and that are costly to
    compute or to move. Rows are then shuffled to their bucket as they are,
    and both the totals and the windows read that one shuffle.
    """
    totals = dict(totals or {})
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    along = [*[F.col(c) for c in by], *order]
    key = _key(by)
    if derive:
        if bucket is None:
            # Cuts hold the groups' keys too: short groups stay whole, long ones are cut.
            bucket = order_bucket(df, along, rows_per_bucket)
        # The bucket is named above the shuffle, so that both readers need the
        # same columns below it and the shuffle is reused.
        tagged = df.repartition(*([key] if by else []), bucket).withColumns({_KEY: key, _BUCKET: bucket, **derive})
    elif bucket is not None:
        tagged = df.withColumns({_KEY: key, _BUCKET: bucket})
    else:
        tagged, order = ranged(df, along).withColumn(_KEY, key), [F.col(_PLACE)]

    part = tagged.groupBy(_KEY, _BUCKET).agg(
        *[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()],
        *[agg.alias(f"__t_{n}") for n, (agg, _) in totals.items()],
    )
    whole = W.partitionBy(_KEY)
    before = whole.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    starts = part.select(
        F.col(_KEY).alias("__k"),
        F.col(_BUCKET).alias("__b"),
        *[F.sum(f"__s_{n}").over(before).alias(f"__p_{n}") for n in sums],
        *([F.col(f"__s_{span}").alias("__width")] if span else []),
        *[getattr(F, merge)(f"__t_{n}").over(whole).alias(n) for n, (_, merge) in totals.items()],
    )
    if not by:
        # At most one row per bucket, and the number of buckets is bounded.
        starts = F.broadcast(starts)

    inside = W.partitionBy(_KEY, _BUCKET).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = tagged.withColumns({f"__l_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    joined = local.join(starts, (F.col(_KEY) == F.col("__k")) & (F.col(_BUCKET) == F.col("__b")))
    low = F.coalesce(f"__p_{span}", F.lit(0)) if span else None
    kept = [c for c in [*df.columns, *(derive or {})] if c not in sums and c not in totals]
    return joined.select(
        *kept,
        *([_BUCKET, low.alias("__low"), (low + F.col("__width")).alias("__high")] if span else []),
        *[
            (F.coalesce(f"__l_{n}", F.lit(0)) + F.coalesce(f"__p_{n}", F.lit(0))).alias(n)
            for n in sums
        ],
        *totals,
    )


def global_index(
    df: DataFrame,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    out: str = "pos",
    total: str | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Zero-based position of each row along ``order``, within its ``by`` group; ``total`` adds the row count.

    A position is the place in the range partition plus the partition's start.
    ``order`` may mix directions and types; it should identify a row, else
    equal rows are numbered in any order.
    """
    if bucket is not None:
        totals = {total: (F.count(F.lit(1)), "sum")} if total else None
        return running(df, order, {out: F.lit(1).cast("bigint")}, by, totals, bucket)
    kept = [c for c in df.columns if c not in (out, total)]
    rows = ranged(df, [*by, *order]).withColumn(_KEY, _key(by))
    # One row for each partition that a group reaches into: the group's rows there, and those before.
    here = rows.groupBy(_KEY, _BUCKET).agg(F.count(F.lit(1)).alias("__n"), F.min(_PLACE).alias("__first"))
    group = W.partitionBy(_KEY)
    before = F.sum("__n").over(group.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1))
    starts = here.select(
        F.col(_KEY),
        F.col(_BUCKET),
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__start"),
        *([F.sum("__n").over(group).alias(total)] if total else []),
    )
    bound = None if by else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = lookup_join(rows.select(*kept, _KEY, _BUCKET, _PLACE), starts, [_KEY, _BUCKET], "inner", bound, skewed=False)
    return joined.select(*kept, (F.col(_PLACE) + F.col("__start")).alias(out), *([total] if total else []))


def ranged_index(df: DataFrame, order: Sequence[str | Column], out: str = "pos") -> DataFrame:
    """``global_index`` of the whole table, for any order."""
    return global_index(df, order, out=out)


def cut_key(df: DataFrame, key: str, fraction: float) -> int | None:
    """The key at rank ``floor(fraction * n)``: keys below it are the first part.

    Only bucket counts and one bucket of keys are looked at, so the caller can
    split with a plain filter on ``key`` that reaches the scan.
    """
    keys = df.select(F.col(key).cast("bigint").alias("k"))
    bucketed = keys.withColumn("b", order_bucket(keys, [F.col("k")]))
    counts = sorted(bucketed.groupBy("b").count().collect())  # bounded by MAX_BUCKETS
    rank = math.floor(fraction * sum(r["count"] for r in counts))
    for r in counts:
        if rank < r["count"]:
            row = bucketed.filter(F.col("b") == r["b"]).select("k").orderBy("k").offset(rank).first()
            return row["k"]
        rank -= r["count"]
    return None


def halo_window(
    df: DataFrame,
    by: Sequence[str],
    pos: str,
    behind: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    block: int = 65_536,
) -> DataFrame:
    """Window functions that look back at most ``behind`` rows, in bounded groups.

    ``pos`` is the row's position within ``by``. Rows are grouped in blocks of
    consecutive positions, and the last ``behind`` rows of a block are also
    given to the next one. Each value of ``columns`` maps the window (ordered by
    ``pos``) to an expression.
    """
    block = max(block, behind)
    own = F.floor(F.col(pos) / block)
    homes = F.when(F.col(pos) % block >= block - behind, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("__own", own).withColumn("__block", F.explode(homes))
    spec = W.partitionBy(*by, "__block").orderBy(pos)
    return (
        spread.withColumns({n: make(spec) for n, make in columns.items()})
        .filter(F.col("__block") == F.col("__own"))
        .drop("__own", "__block")
    )
