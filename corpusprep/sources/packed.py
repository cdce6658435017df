"""Packed sequences on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from corpusprep.session import stage
from corpusprep.sources.arrow_stream import require_length


TARGET_BYTES = 256 << 20


def plan_files(df: DataFrame, sizes: Column, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``(split, shard_id, files, first_file)``: as many files for each shard as its bytes ask for."""
    shards = df.groupBy("split", "shard_id").agg(F.sum(sizes).alias("bytes"))
    files = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")
    counted = shards.withColumn("files", files)
    # One row for each shard: they are as many as there are devices.
    ahead = W.orderBy("split", "shard_id").rowsBetween(W.unboundedPreceding, -1)
    return counted.withColumn("first_file", F.coalesce(F.sum("files").over(ahead), F.lit(0)).cast("int"))


def write_packed(
    df: DataFrame,
    path: str,
    key: str = "seq_id",
    ids: str = "ids",
    target_bytes: int = TARGET_BYTES,
    unpack: Column | None = None,
) -> None:
    """Parquet by ``split`` and ``shard_id`` in files of about ``target_bytes``, each in order of ``key``.

    The bytes of each shard's ids are measured first. Rows go to the file
    that their key's hash names; every file is a partition of its own.
    ``unpack`` makes the array of ids where it is written, from the text of
    tokens parted by blanks that ``ids`` then is: as text it is smaller to move.
    """
    columns = [c if unpack is None or c != ids else unpack.alias(ids) for c in df.columns]
    if unpack is None:
        item = df.schema[ids].dataType.elementType
        width = {"bigint": 8, "int": 4}.get(item.simpleString())
        size = F.size(ids) * width if width else F.octet_length(F.array_join(F.col(ids), " "))
    else:
        size = F.octet_length(ids)
    plan = stage(plan_files(df, size, target_bytes), "plan")
    total = plan.agg(F.sum("files")).first()[0] or 0
    if not total:
        df.select(*columns).write.partitionBy("split", "shard_id").parquet(path)
        return
    part = F.pmod(F.xxhash64(key), F.col("files")).cast("int")
    placed = df.join(F.broadcast(plan), ["split", "shard_id"]).withColumn("__file", F.col("first_file") + part)
    ordered = placed.repartitionById(total, "__file").sortWithinPartitions("split", "shard_id", key)
    ordered.select(*columns).write.partitionBy("split", "shard_id").parquet(path)


def read_packed(spark: SparkSession, path: str, length: int | None = None, ids: str = "ids") -> DataFrame:
    """What :func:`write_packed` wrote; filters on split and shard skip folders."""
    df = spark.read.parquet(path)
    return df if length is None else df.withColumn(ids, require_length(F.col(ids).cast("array<bigint>"), length))
