"""The shape of the plans."""

import re

import pytest
from pyspark.sql import functions as F

from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.metrics import retain_latest
from corpusprep.plans import all_queries


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_packing_moves_the_text_once(spark, sf):
    plan = final_plan(all_queries()["pack_sequences"](spark, sf))
    wide = [line for line in plan.splitlines() if re.search(r"[^d]Exchange hashpartitioning\(.*doc_id", line)]
    reused = [line for line in plan.splitlines() if "ReusedExchange [doc_id" in line]
    assert len([w for w in wide if "Reused" not in w]) == 1 and len(reused) >= 2
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("name", ["global_index", "batch_rows", "seeded_shuffle", "trailing_mean_loss", "causal_mean"])
def test_no_single_task_sort_of_rows(spark, sf, name):
    """One-partition exchanges carry bucket totals, never rows of a table."""
    plan = all_queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1]


def test_scans_read_the_needed_columns_only(spark, sf):
    """Rows are staged with their place only; nothing else of the table comes along."""
    plan = all_queries()["seeded_shuffle"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    read = set(re.findall(r"ReadSchema: struct<(\S+)>", plan))
    assert read <= {"o_orderkey:bigint,__id:bigint", "__id:bigint"}


def test_positions_need_no_window_over_rows(spark, sf):
    """The rows meet the partition starts in a broadcast; only those starts are shuffled."""
    plan = final_plan(all_queries()["global_index"](spark, sf))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "search" not in plan
    main = plan[plan.index("BroadcastHashJoin") : plan.index("BroadcastQueryStage")]
    assert "Window" not in main and " Exchange" not in main


def test_split_is_a_filter(spark, sf):
    df = all_queries()["split_by_rank"](spark, sf).filter("split = 'train'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_newest_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("run"), F.col("id").alias("step"))
    plan = retain_latest(df, 3, by=["run"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lookup_broadcasts_small_tables_only(spark):
    facts, dim = spark.range(1000).toDF("k"), spark.range(5).toDF("k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = lookup_join(facts, dim, "k")._jdf.queryExecution().executedPlan().toString()
        large = lookup_join(facts, dim, "k", row_bytes=1 << 40)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "Broadcast" not in large


def test_large_lookups_broadcast_hot_keys_only(spark):
    facts = spark.range(1000).select(F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id")).alias("k"))
    plan = lookup_join(facts, spark.range(500).toDF("k"), "k", row_bytes=1 << 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and "__spread" in plan
