"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has 64 bits: bit j is set when it is set in over half the
hashes of the text's word shingles. Fingerprints within three bits of each
other are linked, and components of links are found.

The fingerprint is cut into two segments. Of three differing bits one segment
holds at most one, so linked fingerprints agree on some segment with one bit
left out. Each distinct fingerprint is indexed under every segment with one bit
wildcarded (64 signatures); rows with equal signatures meet by an equality
shuffle and are verified by counting differing bits.

A signature shared by more than ``MOST`` fingerprints is cut again in the same
way: its free bits, at most 33, then 18, then 10, form two halves, one of
which differs in at most one bit. After three cuts a group cannot hold more
than 1,024 distinct fingerprints. So no group is large, none is dropped, and a
group sends out a spanning forest rather than its pairs.

Equal fingerprints are one node, whatever their number. A null or blank text
has fingerprint zero and is linked like any other. A null id takes no part in
linking and gets a null component. Rows that share an id are one node for all
their fingerprints. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.llm.common import fresh, sorted_groups, words_of
from corpusprep.llm.components import connected_components
from corpusprep.operators.lookup import UNBOUNDED, lookup_join
from corpusprep.session import stage

BITS, SEED = 64, 42
MOST = 1024
_STEP = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text's word shingles, repeats included; fewer words make one shingle."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    set_ = np.zeros(BITS, np.int64)
    for at in range(0, n, _STEP):
        columns = [words[at + k : min(at + k + _STEP, n + k)] for k in range(shingle)]
        joined = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*columns))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), "<u8")
        set_ += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, np.int32)
    return int(np.packbits(set_ * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` of each row; ``fp`` is the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=[id_col, "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer_masks(mask: int) -> list[int]:
    """Masks that keep ``mask``, and one half of the other bits but for one bit."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    halves = free[: len(free) // 2], free[len(free) // 2 :]
    return [mask | sum(half) - bit for half in halves for bit in half]


def _signatures(fps: DataFrame, masks: Column) -> DataFrame:
    return fps.select("fp", F.explode(masks).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def _forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each fingerprint of a group to the first one of its component in the group."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(len(fps))
    while True:
        least = np.where(near, label[None, :], len(fps)).min(1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    own = label != np.arange(len(fps))
    return fps[own], fps[label[own]]


def _verify(signatures: DataFrame, distance: int, most: int) -> DataFrame:
    """``(a, b, mask)``: links of small groups, or with a null ``b`` the rows of groups that need finer signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, ["mask", "key"], most):
            fps, masks = rows.column("fp").to_numpy(), rows.column("mask").to_numpy()
            sizes = np.diff(np.append(starts, len(fps)))
            two = starts[sizes == 2]
            close = two[np.bitwise_count(fps[two].view("u8") ^ fps[two + 1].view("u8")) <= distance]
            a, b, m = [fps[close]], [fps[close + 1]], [np.zeros(len(close), np.int64)]
            large = np.zeros(len(fps), bool)
            for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if n > most:
                    large[at : at + n] = True
                    continue
                # In order, so that edges lead to the least number, which components are named by.
                x, y = _forest(np.sort(fps[at : at + n]).view("u8"), distance)
                a, b, m = [*a, x.view("i8")], [*b, y.view("i8")], [*m, np.zeros(len(x), np.int64)]
            a, m = np.concatenate([*a, fps[large]]), np.concatenate([*m, masks[large]])
            b = np.concatenate([*b, fps[large]])
            hot = np.concatenate([np.zeros(len(a) - large.sum(), bool), np.ones(large.sum(), bool)])
            if len(a):
                columns = [pa.array(a), pa.array(b, mask=hot), pa.array(m)]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "mask"])

    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = signatures.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key")
    return grouped.select("mask", "key", "fp").mapInArrow(run, "a bigint, b bigint, mask bigint")


def _finer(mask: Column) -> Column:
    """The finer masks of a mask, worked out where the row is: there are too many for a plan."""

    @F.arrow_udf("array<bigint>")
    def run(masks: pa.Array) -> pa.Array:
        coded = masks.dictionary_encode()
        lists = [[_signed(f) for f in finer_masks(m % (1 << 64))] for m in coded.dictionary.to_pylist()]
        return pa.array(lists, pa.list_(pa.int64())).take(coded.indices)

    return run(mask)


def links(fps: DataFrame, distance: int = 3, most: int = MOST) -> DataFrame:
    """``(a, b)``: links that join all fingerprints (distinct, in ``fp``) that chains of links join."""
    if distance > 3:
        raise ValueError("two segments hold at most one differing bit for distances up to three")
    first = [_signed(m) for m in finer_masks(0)]
    found = stage(_verify(_signatures(fps, F.array(*[F.lit(m) for m in first])), distance, most), "links")
    out = found.filter(F.col("b").isNotNull()).select("a", "b")
    hot = found.filter(F.col("b").isNull())
    while hot.limit(1).count():
        rows = hot.select(F.col("a").alias("fp"), _finer(F.col("mask")).alias("finer"))
        found = stage(_verify(_signatures(rows, F.col("finer")).distinct(), distance, most), "links")
        out = out.unionByName(found.filter(F.col("b").isNotNull()).select("a", "b"))
        hot = found.filter(F.col("b").isNull())
    return out


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """``(id, fp, component_id)`` of each row; the component is named by its least id."""
    rows = stage(fingerprints(df, id_col, text, shingle), "fingerprints")
    nodes = rows.filter(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("rep"))
    same_id = rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    joins = links(nodes.select("fp"), distance).unionByName(_repeats(rows, same_id, id_col))
    roots = connected_components(joins).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    # A component may have any share of the fingerprints, a fingerprint any share of the rows.
    found = lookup_join(rooted, names, "root", "inner", bound=UNBOUNDED).select("fp", "component_id")
    named = lookup_join(rows, found, "fp", bound=UNBOUNDED)
    component = F.when(F.col(id_col).isNotNull(), F.col("component_id"))
    return named.select(id_col, "fp", component.alias("component_id"))


def _repeats(rows: DataFrame, same_id: DataFrame, id_col: str) -> DataFrame:
    """Edges between the fingerprints of rows that share an id."""
    several = same_id.filter(F.col("a") != F.col("b")).select(id_col, "a")
    return rows.join(several, id_col).select("a", F.col("fp").alias("b"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``df`` with one row of each component: that of the least id. Columns stay; rows without an id stay.

    Of rows that share the kept id, the first by content stays.
    """
    found = near_duplicates(df, id_col, text, shingle, distance)
    kept, place = fresh(df, "__kept"), fresh(df, "__place")
    stays = found.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias(kept)).distinct()
    joined = df.join(stays, df[id_col] == F.col(kept))
    content = [F.xxhash64(F.col(f"`{c}`").cast("string")) for c in df.columns]
    first = W.partitionBy(kept).orderBy(*content)
    one = joined.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1)
    names = [F.col(f"`{c}`") for c in df.columns]
    return one.select(*names).unionByName(df.filter(F.col(id_col).isNull()).select(*names))


def op10(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
