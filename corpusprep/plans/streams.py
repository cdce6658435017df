"""Streaming queries: a given table as a stream, run until it is used up, and what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.operators.order import micros
from corpusprep.plans.batches import BATCH, SHARDS
from corpusprep.plans.common import SEQ_LEN, SQL_LOG, joined, r6
from corpusprep.plans.files import SQL_CODES, word_codes
from corpusprep.session import stage_path
from corpusprep.sources.arrow_stream import stream_pretokenized, write_pretokenized
from corpusprep.sources.documents import read_table
from corpusprep.streaming.metrics import metrics_stream
from corpusprep.streaming.packer import pack_stream
from corpusprep.streaming.run import for_each_batch, start, stream_corpus

TRAILING, TOKENS = 5, 127


def _stream(spark, sf, name):
    schema = read_table(spark, sf, name).schema
    return stream_corpus(spark, f"{sf}/{name}.parquet", schema=schema)


def _finished(sdf, spark):
    """What a stream has written when its input is used up."""
    out, checkpoint = stage_path(spark, "stream"), stage_path(spark, "checkpoint")
    start(sdf, out, checkpoint).awaitTermination()
    return spark.read.schema(sdf.schema).parquet(out)


def packed_stream(spark, sf):
    """``documents`` packed source by source as they arrive."""
    ids = _stream(spark, sf, "documents").select("source", "doc_id", word_codes(F.col("text")).alias("ids"))
    packed = _finished(pack_stream(ids, "source", "doc_id", "ids", SEQ_LEN), spark)
    return packed.select("source", "lane", "seq_id", joined(F.col("ids"), ",").alias("ids"))


def live_metrics(spark, sf):
    """The run metrics of ``events`` as a live log."""
    log = _stream(spark, sf, "events").select(
        F.col("user_id").alias("run"), "event_id", micros(F.col("ts")).alias("ts"), F.col("value").alias("loss")
    )
    live = _finished(metrics_stream(log, "run", "ts", "event_id", "loss", F.lit(TOKENS), TRAILING), spark)
    return live.select("run", "step", r6(F.col("loss")).alias("loss"), r6(F.col("trailing_mean")).alias("trailing_mean"),
                       "tokens_seen", r6(F.col("rate")).alias("rate"))


def streamed_batches(spark, sf):
    """``orders`` handed to a consumer in full batches, which writes them."""
    out = stage_path(spark, "batches")

    def consume(df, micro_batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/micro={micro_batch}")

    rows = _stream(spark, sf, "orders").select("o_orderkey")
    for_each_batch(rows, consume, stage_path(spark, "checkpoint"), "o_orderkey", BATCH, SHARDS).awaitTermination()
    kind = "o_orderkey bigint, batch_id bigint, row_in_batch int, shard_id int"
    return spark.read.schema(kind).parquet(f"{out}/micro=0")


def arrow_resumed(spark, sf):
    """Arrow files that arrive in two parts, read by a stream that is stopped between them."""
    folder, out, checkpoint = (stage_path(spark, label) for label in ("arrow", "stream", "checkpoint"))
    ids = read_table(spark, sf, "documents").select("doc_id", word_codes(F.col("text")).alias("input_ids"))
    for part in range(2):
        # Names of the second part sort after those of the first.
        write_pretokenized(ids.filter(F.col("doc_id") % 2 == part), folder, prefix=f"{part}")
        start(stream_pretokenized(spark, folder), out, checkpoint).awaitTermination()
    rows = spark.read.schema("input_ids array<bigint>").parquet(out)
    return rows.groupBy(joined(F.col("input_ids"), ",").alias("ids")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "pack_stream": packed_stream,
    "metrics_stream": live_metrics,
    "stream_batches": streamed_batches,
    "arrow_stream_resumed": arrow_resumed,
}

_D = "CAST({} AS DOUBLE)".format

SQL = {
    "pack_stream": f"""WITH {SQL_CODES},
        long AS (SELECT source, doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS k FROM codes),
        placed AS (SELECT source, id, row_number() OVER (PARTITION BY source ORDER BY doc_id, k) - 1 AS place FROM long)
        SELECT source, 0 AS lane, place // {SEQ_LEN} AS seq_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY place) AS ids
        FROM placed GROUP BY source, place // {SEQ_LEN} HAVING count(*) = {SEQ_LEN}""",
    "metrics_stream": f"""WITH {SQL_LOG}
        SELECT CAST(run AS VARCHAR) AS run, pos + 1 AS step, round(loss, 6) AS loss,
               round(avg(loss) OVER (PARTITION BY run ORDER BY pos ROWS BETWEEN {TRAILING - 1} PRECEDING AND CURRENT ROW), 6)
                 AS trailing_mean,
               {TOKENS} * (pos + 1) AS tokens_seen,
               round({TOKENS} * (pos + 1) / greatest({_D('1e-9')}, (ts - t0) / {_D('1e6')}), 6) AS rate
        FROM steps""",
    "stream_batches": f"""
        SELECT o_orderkey, pos // {BATCH} AS batch_id, CAST(pos % {BATCH} AS INTEGER) AS row_in_batch,
               CAST(pos % {BATCH} // {BATCH // SHARDS} AS INTEGER) AS shard_id
        FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
        WHERE pos // {BATCH} < (SELECT count(*) // {BATCH} FROM orders)""",
    "arrow_stream_resumed": f"""WITH {SQL_CODES}
        SELECT ids, count(*) AS n FROM (SELECT array_to_string(ids, ',') AS ids FROM codes) GROUP BY ids""",
}
