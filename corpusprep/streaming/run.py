"""Starting, resuming and consuming streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusprep.operators.batch import assign_shards
from corpusprep.operators.order import global_index
from corpusprep.session import staged_until_done
from corpusprep.sources.files import exists, is_file, remove


def stream_corpus(
    spark: SparkSession, path: str, max_files: int = 1000, schema: StructType | str | None = None
) -> DataFrame:
    """A growing folder as a stream: ``*.txt`` lines, or Parquet rows where a ``schema`` is given.

    A single Parquet file is a folder with that file only.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if schema is not None and is_file(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.schema(schema).option("pathGlobFilter", name).parquet(folder)
    if schema is not None:
        return reader.schema(schema).parquet(path)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(path)


def start(sdf: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet at ``path`` until the input is used up.

    A restart on the same ``checkpoint`` goes on where the last run stopped,
    the position in the input included.
    """
    return (
        sdf.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def for_each_batch(
    sdf: DataFrame,
    consume: Callable[[DataFrame, int], None],
    checkpoint: str,
    order: str,
    batch_size: int,
    shards: int = 1,
) -> StreamingQuery:
    """Hand the stream to ``consume`` in full batches with ``batch_id`` and ``shard_id``.

    Rows are batched along ``order``. Fewer than ``batch_size`` rows that are
    left over wait beside the checkpoint for the next micro-batch; a repeated
    micro-batch finds the same rows again. Rows left over two micro-batches ago
    and what is staged on the way are deleted when ``consume`` is done, so
    ``consume`` must have written what it wants to keep.
    """
    spark = sdf.sparkSession
    rest = f"{checkpoint.rstrip('/')}-rest"

    def prepared(df: DataFrame, micro_batch: int) -> None:
        before = f"{rest}/{micro_batch - 1}"
        rows = df.unionByName(spark.read.schema(df.schema).parquet(before)) if exists(spark, before) else df
        with staged_until_done(spark):
            indexed = global_index(rows, [order], out="__at", total="__n")
            full = F.floor(F.col("__n") / batch_size) * batch_size
            indexed.filter(F.col("__at") >= full).drop("__at", "__n").write.mode("overwrite").parquet(
                f"{rest}/{micro_batch}"
            )
            batched = indexed.filter(F.col("__at") < full).withColumns(
                {
                    "batch_id": F.floor(F.col("__at") / batch_size),
                    "row_in_batch": (F.col("__at") % batch_size).cast("int"),
                }
            )
            consume(assign_shards(batched.drop("__at", "__n"), batch_size, shards), micro_batch)
        # Repeating this micro-batch needs the rows before it and no older ones.
        remove(spark, f"{rest}/{micro_batch - 2}")

    return (
        sdf.writeStream.foreachBatch(prepared)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
