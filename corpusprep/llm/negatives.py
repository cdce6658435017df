"""Hard negatives by exact integer scores: matrix products in a residue number system.

Vectors become integers, ``floor(scale * x)``. Scores are inner products of
anchors with all rows, in blocks: a cell holds one block of rows and one of
anchors, and both blocks have a bounded number of rows. Inside a cell the
components are reduced modulo several primes below 1024. A product of 64
centred residues stays below 2 ** 24, so float32 matrix products are exact;
each modulus gives the score's residue, and Chinese remaindering gives the
signed score. The number of primes follows from the largest squared norm, which
bounds every score.

Two passes over the cells select: first the best rows of the anchor's label,
then, for each of these positives, the best rows of other labels whose scores
lie in the positive's window. A cell returns a few rows for each anchor, so what
meets across cells is bounded by the number of cells.

Rows with a null id or label, a null vector, or any null or non-finite component
take no part; neither do rows whose integer vector has a squared norm of
2 ** 58 or more, whose scores could leave the exact range. Missing components of
shorter vectors count as zero; an empty vector scores 0 with every row. Anchors
that share an id are one, the least by label and components, and no row of its
own id is its positive. Other rows that share an id count each; equal scores are
ordered by id. An anchor without positives, or a positive without rows in its
window (always so for negative scores), gives no rows. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import ceil, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.session import stage

#: The largest primes below 1024; their product exceeds twice ``LIMIT``.
PRIMES = (1021, 1019, 1013, 1009, 997, 991)
LIMIT = 1 << 58
DEPTH = 64  # components whose product of centred residues float32 sums without error
_PAIRS = 1 << 22  # scores held at once
ROWS, ANCHORS = 1 << 17, 1 << 15  # most rows and anchors of a cell


def primes_for(norm: float) -> tuple[int, ...]:
    """As many primes as scores of absolute value up to ``norm`` need."""
    for n in range(1, len(PRIMES) + 1):
        if prod(PRIMES[:n]) > 2 * norm + 1:
            return PRIMES[:n]
    raise ValueError(f"scores of {norm} have no exact range")


def _residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    r = matrix % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def residue_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """Residues of ``a @ b.T`` for matrices of centred residues, by exact float32 products of ``DEPTH`` components."""
    out = np.zeros((len(a), len(b)), np.int64)
    for c in range(0, a.shape[1], DEPTH):
        out += (a[:, c : c + DEPTH] @ b[:, c : c + DEPTH].T).astype(np.int64)
    return out % prime


def reconstruct(residues: Sequence[np.ndarray], primes: Sequence[int]) -> np.ndarray:
    """Signed numbers from their residues, digit by digit of the mixed radix."""
    value, radix = residues[0].copy(), primes[0]
    for r, p in zip(residues[1:], primes[1:]):
        digit = (r - value % p) * pow(radix, -1, p) % p
        value += digit * radix
        radix *= p
    value[value > radix // 2] -= radix
    return value


class Scorer:
    """Exact scores of anchors with a block of rows, some anchors at a time."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, primes: Sequence[int]):
        width = max(rows.shape[1], anchors.shape[1])
        rows, anchors = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, anchors))
        self.primes = primes
        self.rows = [_residues(rows, p) for p in primes]
        self.anchors = [_residues(anchors, p) for p in primes]

    def scores(self) -> Iterator[np.ndarray]:
        """One array of scores for each anchor."""
        n, step = len(self.anchors[0]), max(1, _PAIRS // max(1, len(self.rows[0])))
        for begin in range(0, n, step):
            found = [residue_product(a[begin : begin + step], b, p) for a, b, p in zip(self.anchors, self.rows, self.primes)]
            yield from reconstruct(found, self.primes)


def best(scores: np.ndarray, among: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` of the places ``among``: by score, then by place."""
    if len(among) > most:
        s = scores[among]
        least = np.partition(s, len(s) - most)[len(s) - most]
        among = among[s >= least]
    return among[np.argsort(-scores[among], kind="stable")[:most]]


def matrix_of(lists: pa.ChunkedArray) -> np.ndarray:
    """Lists of integers as rows, shorter ones filled with zeros."""
    flat = lists.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    sizes = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def integer_rows(
    vectors: DataFrame, id_col: str, vector: str, label: Column, scale: float
) -> DataFrame:
    """``(vec_id, label, v, norm)`` of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    usable = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN is above infinity
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("double"))
    rows = vectors.filter(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(id_col).cast("bigint").alias("vec_id"), label.cast("int").alias("label"), whole.alias("v")
    )
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    return rows.withColumn("norm", norm).filter(F.col("norm") < float(LIMIT)).withColumn("v", F.col("v").cast("array<bigint>"))


def _cells(
    rows: DataFrame, anchors: DataFrame, blocks: int, groups: int, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``run`` on each cell of a block of rows and a group of anchors; both are sorted by id."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)).cast("int")
    left = rows.select("vec_id", "label", "v", own.alias("block")).withColumn("group", every(groups))
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    right = anchors.withColumn("group", mine).withColumn("block", every(blocks))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return run(a.sort_by("vec_id"), b.sort_by("vec_id"))

    keys = ["block", "group"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, schema)


_POSITIVES = "anchor_id bigint, positive_id bigint, score bigint"
_NEGATIVES = "anchor_id bigint, nth int, negative_id bigint, negative_score bigint"


def _table(schema: str, columns: Sequence[Sequence]) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def mine(
    rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, window: tuple[int, int] = (80, 100),
    block_rows: int = ROWS, block_anchors: int = ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` and ``anchors`` are as of ``integer_rows``, staged. A negative's
    score lies between ``window[0] / window[1]`` of the positive's and the
    positive's own.
    """
    spark = rows.sparkSession
    n, top = rows.agg(F.count(F.lit(1)), F.max("norm")).first()
    unique = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.*")
    unique = stage(unique, "anchors")
    k = unique.count()
    primes = primes_for(top or 0.0)
    # Small tables are cut so that all cores have a block.
    spread = max(1024, ceil(n / (2 * spark.sparkContext.defaultParallelism)))
    blocks, groups = max(1, ceil(n / min(block_rows, spread))), max(1, ceil(k / block_anchors))
    low, high = window

    def positives(r: pa.Table, a: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if r.num_rows and a.num_rows:
            ids, labels = r["vec_id"].to_numpy(), r["label"].to_numpy()
            score = Scorer(matrix_of(r["v"]), matrix_of(a["v"]), primes)
            for anchor, label, s in zip(a["vec_id"].to_pylist(), a["label"].to_pylist(), score.scores()):
                at = best(s, np.flatnonzero((labels == label) & (ids != anchor)), n_positives)
                out[0] += [anchor] * len(at)
                out[1] += ids[at].tolist()
                out[2] += s[at].tolist()
        return _table(_POSITIVES, out)

    def negatives(r: pa.Table, a: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if r.num_rows and a.num_rows:
            ids, labels = r["vec_id"].to_numpy(), r["label"].to_numpy()
            score = Scorer(matrix_of(r["v"]), matrix_of(a["v"]), primes)
            known = zip(a["vec_id"].to_pylist(), a["label"].to_pylist(), a["scores"].to_pylist(), score.scores())
            for anchor, label, bounds, s in known:
                # low / high in least terms keeps the products inside 64 bits.
                may = np.flatnonzero((labels != label) & (s <= max(bounds)) & (s * up >= min(bounds) * down))
                part = s[may]
                for nth, bound in enumerate(bounds):
                    inside = may[(part <= bound) & (part * up >= bound * down)]
                    at = best(s, inside, n_negatives)
                    out[0] += [anchor] * len(at)
                    out[1] += [nth] * len(at)
                    out[2] += ids[at].tolist()
                    out[3] += s[at].tolist()
        return _table(_NEGATIVES, out)

    common = int(np.gcd(low, high))
    down, up = low // common, high // common
    found = _cells(rows, unique.select("vec_id", "label", "v"), blocks, groups, positives, _POSITIVES)
    first = W.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    nth = F.row_number().over(first) - 1
    chosen = stage(found.withColumn("nth", nth).filter(F.col("nth") < n_positives), "positives")
    bounds = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.array_sort(F.collect_list(F.struct("nth", "score")))["score"].alias("scores")  # n_positives at most
    )
    asked = unique.join(bounds, "vec_id")
    met = _cells(rows, asked, blocks, groups, negatives, _NEGATIVES)
    inside = W.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(inside)).filter(F.col("rank") <= n_negatives)
    return ranked.join(chosen, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )


def op13(vectors: DataFrame) -> DataFrame:
    """The contract's anchors, labels and integers."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = stage(integer_rows(vectors, "vec_id", "embedding", label, 256), "integers")
    return mine(rows, rows.filter(F.col("vec_id") % 100 == 0))


SQL = """
WITH kept AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM kept a, kept r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same AND other <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
