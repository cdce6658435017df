"""Text files as a corpus of lines, with their order and byte offsets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusprep.functions.text import byte_len, is_blank, repair_utf8
from corpusprep.operators.lookup import BROADCAST_BYTES, lookup_join
from corpusprep.operators.order import MAX_BUCKETS, ranged_index
from corpusprep.operators.pack import pack
from corpusprep.operators.split import TRAIN_SHARE, split_by_bytes
from corpusprep.session import stage
from corpusprep.sources.files import any_file, is_file

_BLOCK_ROW_BYTES = 256


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, size, id, value)``: raw lines of a file, or of all ``*.txt`` below a directory.

    ``id`` follows the lines of a block, ``block`` the blocks of a file.
    """
    reader = spark.read
    if not is_file(spark, path):
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
        if not any_file(spark, path, ".txt"):
            raise FileNotFoundError(f"no text files in {path}")
    # File paths come percent-encoded; a plus sign stands for itself.
    file = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return reader.text(path).select(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )


@dataclass
class Corpus:
    """``lines`` of all files, and how many files there are.

    ``lines`` holds ``(file, file_no, bucket, block_no, block_start, size, id, bytes, line)``;
    ``file_no`` numbers the files in path order, ``bucket`` gathers blocks when there are very many;
    ``moved`` says whether the lines left their place in the scan, which only very many blocks ask for.
    """

    lines: DataFrame
    n_files: int
    moved: bool = False


def read_corpus(spark: SparkSession, path: str) -> Corpus:
    """Every line of a corpus, bad bytes repaired.

    ``(block_no, id)`` orders all lines. One pass over the text measures the
    blocks; what it finds is one small row per block. ``block_start`` is the
    byte offset of the block's first line in its file, counting one byte for
    each line end.
    """
    raw = scan_text(spark, path)
    measured = stage(
        raw.groupBy("file", "block").agg(F.sum(byte_len(F.col("value")) + 1).cast("bigint").alias("bytes")), "blocks"
    )
    files = ranged_index(measured.select("file").distinct(), ["file"], "file_no")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    n_blocks, n_files = measured.count(), files.count()
    numbered = lookup_join(
        ranged_index(measured, ["file", "block"], "block_no"),
        files,
        "file",
        "inner",
        bound=n_files,
        row_bytes=_BLOCK_ROW_BYTES,
    )
    blocks = numbered.select(
        "file", "file_no", "block", "block_no", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("block_start")
    )
    placed = lookup_join(raw, blocks, ["file", "block"], "inner", bound=n_blocks, row_bytes=_BLOCK_ROW_BYTES)
    lines = placed.select(
        "file",
        "file_no",
        F.floor(F.col("block_no") / math.ceil((n_blocks + 1) / MAX_BUCKETS)).alias("bucket"),
        "block_no",
        "block_start",
        "size",
        "id",
        byte_len(F.col("value")).alias("bytes"),
        repair_utf8(F.col("value")).alias("line"),
    )
    return Corpus(lines, n_files, n_blocks * _BLOCK_ROW_BYTES > BROADCAST_BYTES)


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``end`` and ``start`` of lines that come block by block, each block in order."""
    open_, at = None, 0  # the block being read, and the bytes of its lines so far
    for batch in batches:
        if not batch.num_rows:
            continue
        block, begin, size = (batch.column(c).to_numpy() for c in ("block_no", "block_start", "size"))
        taken = batch.column("bytes").to_numpy().astype(np.int64) + 1
        first = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        total = np.cumsum(taken)
        ahead = (total - taken)[first]
        ahead[0] -= at if block[0] == open_ else 0
        inside = total - np.repeat(ahead, np.diff(np.append(first, len(block))))
        open_, at = block[-1], int(inside[-1])
        end = begin + inside
        columns = [*batch.columns, pa.array(np.minimum(end, size)), pa.array(end - taken)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "end", "start"])


def with_byte_offsets(df: DataFrame, moved: bool = False) -> DataFrame:
    """Adds ``start`` and ``end`` of each line in its file, in bytes, the line end included.

    Lines that lie as they were scanned are counted along where they are; only
    lines that were ``moved`` between tasks since have to meet again.
    """
    if not moved:
        kinds = StructType([*df.schema.fields, StructField("end", LongType()), StructField("start", LongType())])
        return df.mapInArrow(_offsets, kinds)
    along = W.partitionBy("block_no").orderBy("id").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.col("block_start") + F.sum(F.col("bytes") + 1).over(along)
    return (
        df.withColumn("end", end)
        .withColumn("start", F.col("end") - F.col("bytes") - 1)
        .withColumn("end", F.least("end", "size"))
    )


def split_by_file(corpus: Corpus, share: float = TRAIN_SHARE) -> DataFrame:
    """The first ``floor(share * n)`` files in path order are ``train``, the others ``val``."""
    train = F.col("file_no") < int(corpus.n_files * share)
    return corpus.lines.withColumn("split", F.when(train, "train").otherwise("val"))


def split_corpus(corpus: Corpus, share: float = TRAIN_SHARE) -> DataFrame:
    """Lines with their ``split``: by files, or by bytes when the corpus is a single file."""
    if corpus.n_files > 1:
        return split_by_file(corpus, share)
    return split_by_bytes(with_byte_offsets(corpus.lines, corpus.moved), share)


def pack_corpus(df: DataFrame, ids: Column, length: int) -> DataFrame:
    """Pack the non-blank lines of a corpus, or of one of its splits, in corpus order.

    ``ids`` tokenizes the ``line`` column.
    """
    lines = df.filter(~is_blank(F.col("line"))).select("bucket", "block_no", "id", "line")
    return pack(lines, ["block_no", "id"], ids, length, bucket=F.col("bucket"))
