"""Shards along the curve: their order on real rows, and what pruning by each dimension skips."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.llm import hilbert
from corpusprep.session import stage


def test_rows_follow_the_curve_and_its_ties(docs):
    rows = sorted(hilbert.op2(docs).collect(), key=lambda r: (r["shard"], r["slot"]))
    keys = [(r["curve"], r["doc_id"], r["text_crc32"], r["size"]) for r in rows]
    assert keys == sorted(keys)


def test_curve_of_rows_equals_cells_by_quantiles(spark):
    """Cells counted plainly: how many of the cuts are at or below a value."""
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.normal()), int(rng.integers(0, 9))) for i in range(700)]
    df = spark.createDataFrame(rows, "id bigint, x double, y int")
    got = {r["id"]: r["curve"] for r in hilbert.hilbert_cells(df, ["x", "y"], "curve", 3).collect()}
    cells = []
    for k in (1, 2):
        values = np.array([float(r[k]) for r in rows])
        ranked = np.sort(values)
        cuts = np.unique([ranked[int(np.ceil(s * len(ranked))) - 1] for s in np.arange(1, 8) / 8])
        cells.append(np.array([(cuts <= v).sum() for v in values]))
    expect = hilbert.hilbert_index(cells, 3)
    assert [got[i] for i, _, _ in rows] == expect.tolist()


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rows = spark.range(20_000).select(
        "id", F.rand(1).alias("x"), (F.rand(2) * 1000).cast("int").alias("y"), F.concat(F.lit("s"), (F.rand(3) * 50).cast("int")).alias("name")
    )
    dims = ["x", "y", "name"]
    sharded = stage(hilbert.hilbert_shards(stage(rows), dims, ["id"], 64), "sharded")
    path = str(tmp_path_factory.mktemp("shards") / "out")
    hilbert.write_shards(sharded, path)
    return path, stage(hilbert.shard_ranges(sharded, dims), "ranges"), sharded


@pytest.mark.parametrize("bounds", [{"x": (0.1, 0.15)}, {"y": (400, 450)}, {"name": ("s17", "s17")}, {"x": (0.5, 0.6), "y": (0, 99)}])
def test_each_dimension_prunes_at_least_half_of_the_shards(spark, written, bounds):
    path, ranges, sharded = written
    found = hilbert.read_shards(spark, path, ranges, bounds)
    plain = sharded
    for d, (low, high) in bounds.items():
        plain = plain.filter(F.col(d).between(low, high))
    assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in plain.collect())
    # Folders that the scan lists, by its own metric.
    node = found._jdf.queryExecution().executedPlan()
    stack = [node]
    while not (at := stack.pop()).nodeName().startswith("Scan"):
        children = at.children()
        stack += [children.apply(i) for i in range(children.size())]
    assert 0 < at.metrics().apply("numPartitions").value() <= 32


def test_written_shards_keep_their_order(spark, written):
    path, _, sharded = written
    rows = spark.read.parquet(path).filter("shard = 5").collect()
    assert [r["slot"] for r in rows] == list(range(len(rows))) and spark.read.parquet(path).count() == sharded.count()
