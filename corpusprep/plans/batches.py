"""Indexing, shuffling, batching, sharding and planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.sampling import seeded_key
from corpusprep.operators.batch import assign_shards, batch, corpus_stats, estimate_steps, plan_steps
from corpusprep.operators.order import global_index
from corpusprep.operators.sample import TEMPERATURE, mixture_weights
from corpusprep.operators.shuffle import BUFFER, block_shuffle, file_shuffle, repeat_epochs, shuffle
from corpusprep.operators.tokens import text_tokens
from corpusprep.plans.common import SEED, SQL_TOKENS, docs, r6
from corpusprep.sources.documents import read_table

BATCH = 256
SHARDS = 8
EPOCHS = 3
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def _orders(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey")


def _lineitem(spark, sf):
    return read_table(spark, sf, "lineitem").select(*LINE_KEY)


def index_rows(spark, sf):
    return global_index(_lineitem(spark, sf), LINE_KEY).drop("l_shipdate")


def batch_rows(spark, sf):
    return batch(_lineitem(spark, sf), LINE_KEY, BATCH).drop("l_shipdate")


def shard_rows(spark, sf):
    return assign_shards(batch(_orders(spark, sf), ["o_orderkey"], BATCH), BATCH, SHARDS)


def seeded_shuffle(spark, sf):
    return shuffle(_orders(spark, sf), ["o_orderkey"], SEED)


def shuffled_batches(spark, sf):
    """Loader order: shuffle, then fixed-size batches."""
    digest = seeded_key(SEED, F.lit(0), F.col("o_orderkey"))
    keyed = _orders(spark, sf).withColumn("digest", digest)
    return batch(keyed, ["digest", "o_orderkey"], BATCH).drop("digest")


def shuffle_files(spark, sf):
    return file_shuffle(read_table(spark, sf, "documents").select("source", "doc_id"), "source", ["doc_id"], SEED)


def shuffle_blocks(spark, sf):
    return block_shuffle(global_index(_orders(spark, sf), ["o_orderkey"]), "pos", SEED)


def epochs(spark, sf):
    rows = read_table(spark, sf, "orders").select("o_orderkey")
    steps = 2 * (rows.count() // BATCH) + 1
    return repeat_epochs(rows, ["o_orderkey"], BATCH, EPOCHS, steps, SEED)


def step_estimate(spark, sf):
    return estimate_steps(read_table(spark, sf, "documents"), "text", 64, 4)


def step_plan(spark, sf):
    return plan_steps(_lineitem(spark, sf), 12, 8, epochs=2)


def summary(spark, sf):
    return corpus_stats(docs(spark, sf), "source", F.size(text_tokens(F.col("text"))), 12, 8)


def mixture(spark, sf):
    weights = mixture_weights(read_table(spark, sf, "documents"), "lang", TEMPERATURE)
    return weights.select("lang", "n", r6(F.col("weight")).alias("weight"))


QUERIES = {
    "global_index": index_rows,
    "batch_rows": batch_rows,
    "assign_shards": shard_rows,
    "seeded_shuffle": seeded_shuffle,
    "shuffled_batches": shuffled_batches,
    "file_shuffle": shuffle_files,
    "block_shuffle": shuffle_blocks,
    "repeat_epochs": epochs,
    "estimate_steps": step_estimate,
    "plan_steps": step_plan,
    "corpus_stats": summary,
    "mixture_weights": mixture,
}

_KEY = ", ".join(LINE_KEY)
_SHOWN = ", ".join(LINE_KEY[:-1])

SQL = {
    "global_index": f"SELECT {_SHOWN}, row_number() OVER (ORDER BY {_KEY}) - 1 AS pos FROM lineitem",
    "batch_rows": f"""
        SELECT {_SHOWN}, pos // {BATCH} AS batch_id, CAST(pos % {BATCH} AS INTEGER) AS row_in_batch
        FROM (SELECT *, row_number() OVER (ORDER BY {_KEY}) - 1 AS pos FROM lineitem)
        WHERE pos // {BATCH} < (SELECT count(*) // {BATCH} FROM lineitem)""",
    "assign_shards": f"""
        SELECT o_orderkey, pos // {BATCH} AS batch_id, CAST(pos % {BATCH} AS INTEGER) AS row_in_batch,
               CAST(pos % {BATCH} // {BATCH // SHARDS} AS INTEGER) AS shard_id
        FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
        WHERE pos // {BATCH} < (SELECT count(*) // {BATCH} FROM orders)""",
    "seeded_shuffle": f"""
        SELECT o_orderkey, row_number() OVER (ORDER BY md5('{SEED}:0:' || o_orderkey)) - 1 AS pos FROM orders""",
    "shuffled_batches": f"""
        SELECT o_orderkey, pos // {BATCH} AS batch_id, CAST(pos % {BATCH} AS INTEGER) AS row_in_batch
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('{SEED}:0:' || o_orderkey)) - 1 AS pos FROM orders)
        WHERE pos // {BATCH} < (SELECT count(*) // {BATCH} FROM orders)""",
    "file_shuffle": f"""
        SELECT source, doc_id, row_number() OVER (ORDER BY md5('{SEED}:0:' || source), source, doc_id) - 1 AS pos
        FROM documents""",
    "block_shuffle": f"""
        WITH indexed AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
        SELECT o_orderkey, pos,
               pos // {BUFFER} * {BUFFER}
               + row_number() OVER (PARTITION BY pos // {BUFFER} ORDER BY md5('{SEED}:' || pos)) - 1 AS shuffled_pos
        FROM indexed""",
    "repeat_epochs": f"""
        WITH size AS (SELECT count(*) // {BATCH} AS per_epoch FROM orders),
        mixed AS (
          SELECT o_orderkey, e,
                 row_number() OVER (PARTITION BY e ORDER BY md5('{SEED}:' || e || ':' || o_orderkey)) - 1 AS pos
          FROM orders, range({EPOCHS}) r(e))
        SELECT o_orderkey, CAST(e AS INTEGER) AS epoch, e * per_epoch + pos // {BATCH} AS step,
               pos % {BATCH} AS row_in_batch
        FROM mixed, size
        WHERE pos // {BATCH} < per_epoch AND e * per_epoch + pos // {BATCH} < 2 * per_epoch + 1""",
    "estimate_steps": """
        SELECT total_bytes, est_tokens, est_tokens // 64 // 4 AS steps_per_epoch,
               greatest(100, 2 * (est_tokens // 64 // 4)) AS total_steps
        FROM (SELECT total_bytes,
                     CAST(floor(total_bytes * CAST(0.9 AS DOUBLE) / CAST(3.5 AS DOUBLE)) AS BIGINT) AS est_tokens
              FROM (SELECT CAST(sum(strlen(text)) AS BIGINT) AS total_bytes FROM documents))""",
    "plan_steps": """
        SELECT count(*) AS samples, count(*) // 12 AS batches,
               2 * greatest(1, count(*) // 12 // 8) AS total_steps FROM lineitem""",
    "corpus_stats": f"""WITH {SQL_TOKENS}
        SELECT (SELECT count(DISTINCT source) FROM documents) AS files, (SELECT count(*) FROM documents) AS samples,
               (SELECT count(*) FROM tokens) AS tokens, CAST(96 AS BIGINT) AS effective_batch""",
    "mixture_weights": f"""
        WITH sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
        SELECT lang, n, round(pow(n, CAST(1 AS DOUBLE) / CAST({TEMPERATURE} AS DOUBLE))
               / sum(pow(n, CAST(1 AS DOUBLE) / CAST({TEMPERATURE} AS DOUBLE))) OVER (), 6) AS weight FROM sizes""",
}
