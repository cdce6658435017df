"""Near-duplicate vectors: random-hyperplane signatures in several tables, exact cosines, components.

Every vector gets one signature of ``bits`` hyperplane signs in each of
``tables`` tables; vectors that share a signature are compared exactly. Bits
and tables follow from the number of distinct vectors, the threshold and the
recall wanted at the threshold (higher cosines are found more surely).

A pair is counted in the first table where it meets, so no pair is shuffled to
remove repeats. A signature shared by more than ``BLOCK`` vectors is cut into
blocks by hash, and every two blocks are one group: groups stay small, and each
sends out counts for its vectors and a spanning forest of its links, not pairs.

Equal vectors are one class with a multiplicity. Vectors that are null, empty or zero,
or hold null or non-finite components, link with nothing, as do rows with a
null id (their component is null). Vectors of different lengths do not link.
Rows that share an id are one node of the graph. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusprep.llm.common import sorted_groups
from corpusprep.llm.components import connected_components
from corpusprep.operators.lookup import UNBOUNDED, lookup_join
from corpusprep.session import stage

BLOCK = 1024
BUCKET = 256  # vectors that share a signature, on average
RECALL = 0.999
_GROUP = ["dim", "tbl", "sig", "lo", "hi"]


def plan_tables(n: int, threshold: float, recall: float = RECALL, bucket: int = BUCKET) -> tuple[int, int]:
    """Bits of a signature and number of tables for ``n`` vectors.

    Two vectors at the threshold agree in a sign with p = 1 - arccos(threshold) / pi,
    and in some of T tables of b signs with 1 - (1 - p ** b) ** T.
    """
    bits = min(32, max(4, math.ceil(math.log2(max(1, n / bucket)))))
    p = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - p**bits))


def signatures(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """``(n, tables)`` signatures; hyperplanes depend on seed and length only."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(2).astype("<u4")


def usable(vector):
    """Condition for a vector that can link."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    v = flat.astype(np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _signed_rows(classes: DataFrame, kind: str, bits: int, tables: int, seed: int) -> DataFrame:
    """Each class with its vector as bytes and its signatures as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            dims = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
            ends = np.cumsum(dims)
            vec, sig = [None] * len(dims), [None] * len(dims)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                own = flat[(ends[rows] - dim)[:, None] + np.arange(dim)]
                for i, v, s in zip(rows.tolist(), own, signatures(_unit(own, dim), bits, tables, seed)):
                    vec[i], sig[i] = v.tobytes(), s.tobytes()
            columns = [*batch.columns[:3], pa.array(dims, pa.int32()), pa.array(vec, pa.binary()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "h", "mult", "dim", "vec", "sigs"])

    kept = classes.select("node", "h", "mult", "vector")
    return kept.mapInArrow(run, "node bigint, h bigint, mult bigint, dim int, vec binary, sigs binary")


def _dealt(rows: DataFrame, tables: int, block: int) -> DataFrame:
    """Rows copied to the groups in which they are compared."""
    each = F.transform(
        F.sequence(F.lit(0), F.lit(tables - 1)),
        lambda t: F.struct(
            t.alias("tbl"), F.conv(F.hex(F.substring(F.col("sigs"), t * 4 + 1, F.lit(4))), 16, 10).cast("bigint").alias("sig")
        ),
    )
    narrow = rows.select("dim", F.explode(each).alias("s")).select("dim", "s.*")
    large = stage(narrow.groupBy("dim", "tbl", "sig").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block), "large")
    at = rows.select("*", F.explode(each).alias("s")).select("*", "s.*").drop("s")
    cut = lookup_join(at, large, ["dim", "tbl", "sig"])
    blocks = F.coalesce(F.ceil(F.col("n") / block).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("node", "h"), blocks).cast("int")
    placed = cut.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return placed.select(
        "dim", "tbl", "sig", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "node", "h", "mult", "vec", "sigs",
    )


def _compare(dealt: DataFrame, kind: str, tables: int, threshold: float, block: int) -> DataFrame:
    """Counts ``(node, h, n)`` with a null ``peer``, and links ``(node, peer)`` with a null ``n``."""

    def pairs(v: np.ndarray, sigs: np.ndarray, blocks: np.ndarray, table: int, lo: int, hi: int):
        a = np.flatnonzero(blocks == lo)
        b = a if lo == hi else np.flatnonzero(blocks == hi)
        cos = v[a] @ v[b].T
        i, j = np.nonzero(cos >= threshold - 1e-9)
        if lo == hi:
            i, j = i[i < j], j[i < j]
        edge = np.flatnonzero(np.abs(cos[i, j] - threshold) <= 1e-9)
        i, j = a[i], b[j]
        keep = np.ones(len(i), bool)
        keep[edge] = np.einsum("nd,nd->n", v[i[edge]], v[j[edge]]) >= threshold
        for at in range(0, len(i), 1 << 18):
            part = slice(at, at + (1 << 18))
            keep[part] &= ~(sigs[i[part], :table] == sigs[j[part], :table]).any(1)
        return i[keep], j[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in sorted_groups(batches, _GROUP, 8 * block):
            out = [[], [], [], []]
            ends = np.append(starts[1:], rows.num_rows)
            for at, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
                group = rows.slice(at, end - at)
                dim, table, lo, hi = (group.column(k)[0].as_py() for k in ("dim", "tbl", "lo", "hi"))
                v = _unit(np.frombuffer(b"".join(group.column("vec").to_pylist()), kind), dim)
                sigs = np.frombuffer(b"".join(group.column("sigs").to_pylist()), "<u4").reshape(-1, tables)
                i, j = pairs(v, sigs, group.column("block").to_numpy(), table, lo, hi)
                if not len(i):
                    continue
                node, h, mult = (group.column(k).to_numpy() for k in ("node", "h", "mult"))
                n = np.bincount(i, mult[j], len(v)) + np.bincount(j, mult[i], len(v))
                some = np.flatnonzero(n)
                tree_a, tree_b = _spanning(i, j, len(v))
                out[0] += [node[some], node[tree_a]]
                out[1] += [h[some], h[tree_a]]
                out[2] += [n[some].astype(np.int64), np.zeros(len(tree_a), np.int64)]
                out[3] += [node[some], node[tree_b]]
            if out[0]:
                node, h, n, peer = (np.concatenate(x).astype(np.int64) for x in out)
                columns = [pa.array(node), pa.array(h), pa.array(n), pa.array(peer, mask=n > 0)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "h", "n", "peer"])

    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = dealt.repartition(parts, *_GROUP).sortWithinPartitions(*_GROUP, "node")
    return grouped.mapInArrow(run, "node bigint, h bigint, n bigint, peer bigint")


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each row to the first row of its component among the pairs ``(i, j)``."""
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, i, label[j])
        np.minimum.at(least, j, label[i])
        least = least[least]
        if (least == label).all():
            break
        label = least
    own = np.flatnonzero(label != np.arange(n))
    return own, label[own]


def near_vectors(
    df: DataFrame, id_col: str, vector: str, threshold: float = 0.9, seed: int = 42, block: int = BLOCK
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of each row of ``df``."""
    element = df.schema[vector].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    can = usable(F.col("vector")) & F.col("id").isNotNull()
    # Whole and decimal numbers are compared as doubles.
    typed = rows.withColumn("vector", F.col("vector").cast(f"array<{'float' if kind == '<f4' else 'double'}>"))
    classes = typed.filter(can).groupBy("vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("mult"))
    classes = stage(classes.withColumn("h", F.xxhash64("vector")), "classes")
    bits, tables = plan_tables(classes.count(), threshold)
    signed = stage(_signed_rows(classes, kind, bits, tables, seed), "signed")
    found = stage(_compare(_dealt(signed, tables, block), kind, tables, threshold, block), "found")
    counts = found.filter(F.col("peer").isNull()).groupBy("node", "h").agg(F.sum("n").alias("n"))
    parts = connected_components(found.filter(F.col("peer").isNotNull()), "node", "peer")
    known = (
        classes.join(counts, ["node", "h"], "left")
        .join(parts, "node", "left")
        .select(
            F.col("vector").alias("same"),
            (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    # Copies of one vector may be any share of the rows.
    # Keys are hashed there, so a negative zero must be the zero that it equals.
    zero = F.lit(0).cast("float" if kind == "<f4" else "double")
    same = F.when(can, F.transform("vector", lambda x: x + zero))
    joined = lookup_join(typed.withColumn("same", same), known, "same", bound=UNBOUNDED)
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op1(vectors: DataFrame) -> DataFrame:
    """The contract's columns, one row per vector."""
    return near_vectors(vectors, "vec_id", "embedding")


SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (
  SELECT a, b FROM links
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.a = vec_id LEFT JOIN least ON least.a = vec_id
"""
