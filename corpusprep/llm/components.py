"""Connected components of a graph given by its edges, as joins and aggregations.

Large-star and small-star steps alternate: each node points its larger
neighbours, then its smaller ones, at the least node it knows. The edges end as
stars around the least node of each component, after a number of rounds that
grows with the logarithm of the longest path. Every round is staged in the
shared folder, so lineage stays short and lost executors cost one round. The
node that a round's edges meet in is found beforehand and its edges are spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusprep.operators.lookup import UNBOUNDED, lookup_join
from corpusprep.session import stage


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that is not the least of its component.

    ``edges`` holds pairs of nodes of one ordered type, in either direction;
    repeats and loops do no harm, pairs with a null are left out.
    """
    hi, lo = F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    now = stage(edges.filter(F.col(a) != F.col(b)).select(hi, lo).distinct(), "edges")
    seen = _checksum(now)
    while seen[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # The hub of a large component has as many rows as the component has nodes.
        known = lookup_join(both, least, "u", "inner", bound=UNBOUNDED)
        large = known.filter(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.filter(F.col("hi") != F.col("lo"))
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi").select(
            F.explode(
                F.array(F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))
            ).alias("e")
        )
        now = stage(small.select("e.*").filter(F.col("hi") != F.col("lo")).distinct(), "edges")
        before, seen = seen, _checksum(now)
        if seen == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
