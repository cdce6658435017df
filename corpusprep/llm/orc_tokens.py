"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

``write_tokens`` puts documents in ascending id order into files. Each row has
the id, the ids of its tokens as an integer array (ORC's run-length encoding),
its file's number and how many ids the file holds before it. The stripes have
row indexes and a Bloom filter on ``doc_id``, so a lookup by id skips files,
stripes and row groups by metadata, and stripes are read in parallel.

``read_tokens`` gives the rows back with ``start``, the number of ids of all
documents before it: the file's start, from one total per file, and the place
inside the file.

Null texts are empty documents (the end id only). Null ids come first. Rows
that share an id stand next to each other, ordered by a hash of the text, then
by the text. An empty table writes no rows and reads as none. Texts are encoded
whole, a very long one by itself; one that may hold a special token of the
tokenizer goes to the library as it is. Further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from corpusprep.session import stage_path

SCHEMA = "doc_id bigint, file int, before bigint, n_tokens bigint, ids array<int>"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("file", pa.int32()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


_TOGETHER = 128
_MOST_CHARS = 1 << 23  # bytes of words whose ids a worker keeps
_SPECIAL = "<|"  # how the special tokens begin; the tokenizer finds them before it parts words
_END = "<|end|>"  # begins like them, so it is in no text that is parted into words
#: A letter and a mark after it, which the tokenizer parts anyway: fewer words are then distinct.
_EDGE = r"([a-z\x{df}-\x{f6}\x{f8}-\x{ff}])([.,;:!?&*$#%|)(\"-])"


class WordIds:
    """Ids of words, laid end to end, for a tokenizer that drops white space and never joins across it.

    A worker keeps the words it has met and their ids; beyond ``_MOST_CHARS`` it
    starts over, which changes the time it takes and never the ids.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task for each core already
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.start_over()

    def start_over(self) -> None:
        self._keep(pa.array([_END], pa.string()), np.array([1]), np.array([self.end], np.int32))

    def _keep(self, known: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        self.known, self.counts, self.ids = known, counts, ids
        ends = np.append(0, np.cumsum(counts)).astype(np.int32)
        self.lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _learn(self, new: pa.Array) -> None:
        """Encode words, many in one call, since a call has its price; the tokens' places tell them apart again."""
        words = new.to_pylist()
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        found = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        ids, counts = [self.ids], [self.counts]
        for group, encoding in zip(groups, found):
            n = len(encoding.ids)
            starts = np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * n)[::2]
            ends = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in group]))
            ids.append(np.array(encoding.ids, np.int32))
            counts.append(np.diff(ends, prepend=0))
        self._keep(pa.concat_arrays([self.known, new]), np.concatenate(counts), np.concatenate(ids))

    def codes(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words in ``counts`` and ``lists``."""
        if self.known.nbytes > _MOST_CHARS:
            self.start_over()
        at = pc.index_in(words, value_set=self.known)
        if at.null_count:
            new = words.filter(pc.is_null(at))
            fresh = np.arange(len(self.known), len(self.known) + len(new))
            places = at.fill_null(-1).to_numpy().astype(np.int64)
            places[places < 0] = fresh
            self._learn(new)
            return places
        return at.to_numpy().astype(np.int64)


@lru_cache(maxsize=2)
def word_ids(path: str, end: int) -> WordIds:
    """The words of a tokenizer file of the ``tokenizers`` library; one for each worker."""
    return WordIds(path, end)


def encode_texts(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts laid end to end, ``end`` after each, and how many each has.

    Texts are put in lower case as far as ASCII goes, parted at ASCII white space
    and before marks, and the distinct words are looked up once. A word that no
    such text holds closes each of them and stands for the end id. Texts that may
    hold a special token go to the library whole.
    """
    memory = word_ids(path, end)
    texts = pc.fill_null(texts, "")
    special = pc.match_substring(texts, _SPECIAL).to_numpy(zero_copy_only=False)
    common = pc.ascii_lower(pc.if_else(pa.array(special), "", texts) if special.any() else texts)
    closed = pc.binary_join_element_wise(pc.replace_substring_regex(common, _EDGE, r"\1 \2"), _END, " ")
    lists = pc.ascii_split_whitespace(closed)
    words = lists.flatten().dictionary_encode()
    code = memory.codes(words.dictionary)[words.indices.to_numpy()]
    ids = memory.lists.take(pa.array(code)).flatten().to_numpy()
    sums = np.cumsum(memory.counts[code])
    counts = np.diff(sums[np.cumsum(lists.value_lengths().to_numpy()) - 1], prepend=0) if len(texts) else np.zeros(0, np.int64)
    if not special.any():
        return ids, counts
    starts = np.cumsum(counts) - counts
    parts, at = [], 0
    for i in np.flatnonzero(special).tolist():
        found = memory.whole(texts[i].as_py())
        parts += [ids[at : starts[i]], found]
        at, counts[i] = starts[i], len(found) + 1
    return np.concatenate([*parts, ids[at:]]), counts


def slices(texts: pa.Array, most_bytes: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded size together; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and size + n > most_bytes:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield begin, len(sizes)


def tokenized(docs: DataFrame, path: str, end: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``SCHEMA``; ``file`` is the partition, in which rows keep their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts):
                flat, n = encode_texts(texts.slice(a, b - a), path, end)
                starts = before + np.cumsum(n) - n
                before += len(flat)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(flat))
                columns = [ids.slice(a, b - a), pa.array(np.full(b - a, file, np.int32)), pa.array(starts), pa.array(n), lists]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def write_tokens(
    docs: DataFrame, to: str, path: str, end: int, files: int | None = None, row_group: int = 1_000
) -> None:
    """Encode ``docs`` in id order and write them to ``to``.

    Texts, not ids, are shuffled: they are smaller. ``files`` defaults to the
    shuffle partitions, which a cluster sizes to its data.
    """
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that share an id are many files if need be: their texts' hashes part them.
    mark = F.xxhash64("text")
    narrow = docs.select("doc_id", "text")
    ordered = narrow.repartitionByRange(files, "doc_id", mark).sortWithinPartitions("doc_id", mark, "text")
    (
        tokenized(ordered, path, end)
        .write.option("orc.compress", "zstd")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", row_group)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(to)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``SCHEMA`` with ``start``. Filters on ``doc_id`` reach the stripes' indexes and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    # One row for each file, so the window and the broadcast are bounded by their number.
    ahead = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    firsts = totals.select(F.col("file").alias("__file"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__first"))
    joined = rows.join(F.broadcast(firsts), F.col("file") == F.col("__file"))
    return joined.withColumn("start", F.col("__first") + F.col("before")).drop("__file", "__first")


def look_up(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """Rows of ``SCHEMA`` of some documents: files, stripes and row groups without them are skipped by their metadata."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin([int(i) for i in ids]))


def ids_crc32(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the checksum is that of the ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<i4")
            ends = np.cumsum(np.append(0, lists.value_lengths().to_numpy(zero_copy_only=False))) * 4
            raw = memoryview(values).cast("B") if len(values) else b""
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kept = rows.select("doc_id", "start", "n_tokens", "ids")
    return kept.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op7(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """The contract's columns, from files written and read back."""
    to = stage_path(docs.sparkSession, "orc")
    write_tokens(docs, to, path, end)
    return ids_crc32(read_tokens(docs.sparkSession, to))
