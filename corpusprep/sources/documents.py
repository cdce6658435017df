"""Tables read as corpora: each row of ``documents`` plays the part of a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan of whole texts, spread over the cores when it is too small to fill them by itself.

    A scan with at least one input split per core is left as it is, so no more
    than one split per core is ever moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def read_documents(spark: SparkSession, directory: str) -> DataFrame:
    """``documents``, spread over the cores."""
    return spread(read_table(spark, directory, "documents"), "doc_id")
