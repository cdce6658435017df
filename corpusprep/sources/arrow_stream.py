"""Spark data source for folders of pre-tokenized Arrow files, as a table and as a stream.

Both Arrow formats lay their record batches out as messages with a header each.
Planning reads the headers only: they give every batch's place, size and rows,
so a file is read by many tasks, one range of batches each, and every row knows
its position. A stream's offset is ``(file, batch)``: after a restart it goes on
inside a file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

# Fixed values of the Arrow formats: how the random-access format begins, what comes before a
# message's size, and the kinds of messages.
_FILE_MAGIC = b"ARROW1"
_CONTINUATION = b"\xff\xff\xff\xff"
_SCHEMA, _DICTIONARY, _BATCH = 1, 2, 3

SPLIT_BYTES = 64 << 20
_PLANNERS = 16  # files whose headers are read at the same time


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _listed(path: str) -> list[str]:
    fs, folder = _open(path)
    infos = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(i.path for i in infos if i.type == pafs.FileType.File and i.path.endswith(".arrow"))


def arrow_files(path: str) -> list[str]:
    """The ``*.arrow`` files directly in a folder, sorted."""
    found = _listed(path)
    if not found:
        raise ValueError(f"no .arrow files in {path}")
    return found


# --- headers -----------------------------------------------------------------


def _field(table: bytes, at: int, number: int) -> int | None:
    """Place of a field of a flat table, if it is there."""
    vtable = at - struct.unpack_from("<i", table, at)[0]
    entry = 4 + 2 * number
    if entry >= struct.unpack_from("<H", table, vtable)[0]:
        return None
    offset = struct.unpack_from("<H", table, vtable + entry)[0]
    return at + offset if offset else None


def _message(header: bytes) -> tuple[int, int, int]:
    """Kind of a message, bytes of its body, and rows of a record batch."""
    at = struct.unpack_from("<I", header, 0)[0]
    kind, inner, body = _field(header, at, 1), _field(header, at, 2), _field(header, at, 3)
    of = header[kind] if kind else 0
    rows = 0
    if of == _BATCH and inner:
        place = _field(header, inner + struct.unpack_from("<I", header, inner)[0], 0)
        rows = struct.unpack_from("<q", header, place)[0] if place else 0
    return of, struct.unpack_from("<q", header, body)[0] if body else 0, rows


@dataclass(frozen=True)
class Batch:
    offset: int
    size: int
    rows: int


@dataclass(frozen=True)
class Layout:
    """What a file holds: its schema, its complete record batches, and whether it has dictionaries."""

    schema: pa.Schema | None
    batches: tuple[Batch, ...]
    dictionaries: bool


def layout(source: pa.NativeFile) -> Layout:
    """Read the headers of a file in either format; a batch that is still being written does not count."""
    end = source.size()
    at = 8 if source.read(len(_FILE_MAGIC)) == _FILE_MAGIC else 0
    schema, batches, dictionaries = None, [], False
    while at + 8 <= end:
        source.seek(at)
        prefix = source.read(8)
        marked = prefix[:4] == _CONTINUATION
        size = struct.unpack_from("<i", prefix, 4 if marked else 0)[0]
        begin = at + (8 if marked else 4)
        if size <= 0 or begin + size > end:
            break
        source.seek(begin)
        kind, body, rows = _message(source.read(size))
        after = begin + size + body
        if after > end:
            break
        if kind == _SCHEMA:
            source.seek(at)
            schema = pa.ipc.read_schema(pa.py_buffer(source.read(after - at)))
        elif kind == _BATCH:
            batches.append(Batch(at, after - at, rows))
        dictionaries |= kind == _DICTIONARY
        at = after
    return Layout(schema, tuple(batches), dictionaries)


def _checked(found: Layout, path: str, column: str) -> Layout:
    """The layout, or an error that names the file and the column."""
    if found.schema is None:
        if found.batches:
            raise ValueError(f"{path} has no Arrow schema")
        return found
    where = found.schema.get_all_field_indices(column)
    if len(where) != 1:
        what = "no column" if not where else f"{len(where)} columns"
        raise ValueError(f"{path} has {what} {column!r}; it has {found.schema.names}")
    kind = found.schema.field(where[0]).type
    lists = pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind)
    if not lists or not pa.types.is_integer(kind.value_type):
        raise ValueError(f"column {column!r} of {path} is {kind}, not lists of integers")
    return found


def _layouts(root: str, files: list[str], column: str) -> list[Layout]:
    fs, _ = _open(root)

    def one(path: str) -> Layout:
        with fs.open_input_file(path) as source:
            return _checked(layout(source), path, column)

    with ThreadPoolExecutor(_PLANNERS) as pool:
        return list(pool.map(one, files))


# --- reading -----------------------------------------------------------------


@dataclass
class _Range(InputPartition):
    """``count`` record batches of a file from its ``first`` one on; ``row`` is that one's first row."""

    file_no: int
    path: str
    schema: bytes
    first: int
    count: int
    offset: int
    row: int
    dictionaries: bool


def _ranges(file_no: int, path: str, found: Layout, begin: int, end: int, split_bytes: int) -> Iterator[_Range]:
    """Batches ``begin`` to ``end`` of a file in ranges of about ``split_bytes``."""
    schema = found.schema.serialize().to_pybytes() if found.schema else b""
    row = sum(b.rows for b in found.batches[:begin])
    first, size, rows = begin, 0, 0
    for i in range(begin, end):
        size, rows = size + found.batches[i].size, rows + found.batches[i].rows
        if size >= split_bytes or i + 1 == end:
            offset = found.batches[first].offset
            yield _Range(file_no, path, schema, first, i + 1 - first, offset, row, found.dictionaries)
            row, first, size, rows = row + rows, i + 1, 0, 0


def _batches(root: str, part: _Range) -> Iterator[pa.RecordBatch]:
    fs, _ = _open(root)
    with fs.open_input_file(part.path) as source:
        if part.dictionaries:
            # Batches refer to dictionaries that come before them, so the reader starts at the beginning.
            random = source.read(len(_FILE_MAGIC)) == _FILE_MAGIC
            source.seek(0)
            reader = pa.ipc.open_file(source) if random else pa.ipc.open_stream(source)
            for i in range(part.first + part.count):
                batch = reader.get_batch(i) if random else reader.read_next_batch()
                if i >= part.first:
                    yield batch
            return
        schema = pa.ipc.read_schema(pa.py_buffer(part.schema))
        source.seek(part.offset)
        for _ in range(part.count):
            yield pa.ipc.read_record_batch(pa.ipc.read_message(source), schema)


def _rows(root: str, part: _Range, column: str, position: bool) -> Iterator[pa.RecordBatch]:
    kind, row = pa.list_(pa.int64()), part.row
    for batch in _batches(root, part):
        ids = batch.column(batch.schema.get_field_index(column)).cast(kind)
        if not position:
            yield pa.RecordBatch.from_arrays([ids], names=[column])
            continue
        n = len(ids)
        place = [pa.array([part.file_no] * n, pa.int32()), pa.array(range(row, row + n), pa.int64())]
        yield pa.RecordBatch.from_arrays([*place, ids], names=["file_no", "row_no", column])
        row += n


class _Reader(DataSourceReader):
    def __init__(self, root: str, column: str, position: bool, split_bytes: int):
        self.root, self.column, self.position, self.split_bytes = root, column, position, split_bytes

    def partitions(self) -> list[InputPartition]:
        files = arrow_files(self.root)
        found = _layouts(self.root, files, self.column)
        return [
            r
            for i, (path, has) in enumerate(zip(files, found))
            for r in _ranges(i, path, has, 0, len(has.batches), self.split_bytes)
        ] or [_Range(0, "", b"", 0, 0, 0, 0, False)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return _rows(self.root, partition, self.column, self.position) if partition.count else iter(())


class _StreamReader(DataSourceStreamReader):
    """Files in order of their names, each from its first batch to its last complete one."""

    def __init__(self, root: str, column: str, position: bool, split_bytes: int):
        self.root, self.column, self.position, self.split_bytes = root, column, position, split_bytes

    def initialOffset(self) -> dict:
        return {"file": "", "batch": 0}

    def latestOffset(self) -> dict:
        files = _listed(self.root)
        if not files:
            return self.initialOffset()
        last = _layouts(self.root, files[-1:], self.column)[0]
        return {"file": files[-1].rsplit("/", 1)[-1], "batch": len(last.batches)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = _listed(self.root)
        names = [f.rsplit("/", 1)[-1] for f in files]
        due = [i for i, n in enumerate(names) if start["file"] <= n <= end["file"]]
        out: list[InputPartition] = []
        for i, has in zip(due, _layouts(self.root, [files[i] for i in due], self.column)):
            first = start["batch"] if names[i] == start["file"] else 0
            last = end["batch"] if names[i] == end["file"] else len(has.batches)
            out.extend(_ranges(i, files[i], has, first, last, self.split_bytes))
        return out

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        return _rows(self.root, partition, self.column, self.position)


# --- writing -----------------------------------------------------------------


@dataclass
class _Written(WriterCommitMessage):
    part: int
    temporary: str
    rows: int


class _Writer(DataSourceArrowWriter):
    """A file for each task, under a name of its own until all are there."""

    def __init__(self, root: str, prefix: str, overwrite: bool):
        self.root, self.prefix, self.overwrite = root, prefix, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, folder = _open(self.root)
        fs.create_dir(folder, recursive=True)
        temporary, rows, writer = f"{folder}/_{uuid.uuid4().hex}.tmp", 0, None
        with fs.open_output_stream(temporary) as sink:
            for batch in iterator:
                writer = writer or pa.ipc.new_stream(sink, batch.schema)
                writer.write_batch(batch)
                rows += batch.num_rows
            if writer:
                writer.close()
        return _Written(TaskContext.get().partitionId(), temporary, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, folder = _open(self.root)
        old = _listed(self.root) if self.overwrite else []
        label = uuid.uuid4().hex[:8]
        for m in sorted((m for m in messages if m), key=lambda m: m.part):
            if m.rows:
                fs.move(m.temporary, f"{folder}/{self.prefix}-{m.part:05d}-{label}.arrow")
            else:
                fs.delete_file(m.temporary)
        for path in old:
            fs.delete_file(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, _ = _open(self.root)
        for m in messages:
            if m:
                fs.delete_file(m.temporary)


class ArrowStreamSource(DataSource):
    """A range of record batches for each task, one batch in memory; only the id column is passed on."""

    @classmethod
    def name(cls) -> str:
        return "arrow_stream"

    def _settings(self) -> tuple[str, str, bool, int]:
        position = self.options.get("position", "false").lower() == "true"
        split_bytes = int(self.options.get("split_bytes", SPLIT_BYTES))
        return self.options["path"], self.options.get("column", "input_ids"), position, split_bytes

    def schema(self) -> str:
        _, column, position, _ = self._settings()
        return f"{'file_no int, row_no bigint, ' if position else ''}`{column}` array<bigint>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(*self._settings())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(*self._settings())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("prefix", "part"), overwrite)


def _options(reader, column: str, position: bool, split_bytes: int):
    set_ = reader.format("arrow_stream").option("column", column).option("position", str(position))
    return set_.option("split_bytes", split_bytes)


def read_pretokenized(
    spark: SparkSession,
    path: str,
    column: str = "input_ids",
    position: bool = False,
    split_bytes: int = SPLIT_BYTES,
    length: int | None = None,
) -> DataFrame:
    """``input_ids array<bigint>`` of all Arrow files of a folder.

    With ``position``, ``file_no`` and ``row_no`` say where each row stands,
    which identifies it for a shuffle. With ``length``, a sequence of another
    length is an error in the job that meets it. A file without the column, or
    with something else in it, is an error that names both before any task runs.
    """
    files = arrow_files(path)
    _layouts(path, files, column)
    spark.dataSource.register(ArrowStreamSource)
    df = _options(spark.read, column, position, split_bytes).load(path)
    return df if length is None else df.withColumn(column, require_length(F.col(column), length))


def stream_pretokenized(
    spark: SparkSession, path: str, column: str = "input_ids", position: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """A growing folder of Arrow files as a stream.

    Files are taken in order of their names, so new ones must sort after those
    already read; a file may also grow by further batches while it is the last.
    A restart on the same checkpoint goes on with the next batch, also inside a file.
    """
    spark.dataSource.register(ArrowStreamSource)
    return _options(spark.readStream, column, position, split_bytes).load(path)


def write_pretokenized(df: DataFrame, path: str, mode: str = "append", prefix: str = "part") -> None:
    """Write rows as Arrow files, one for each task; none has its final name before all are written."""
    df.sparkSession.dataSource.register(ArrowStreamSource)
    df.write.format("arrow_stream").mode(mode).option("prefix", prefix).save(path)


def require_length(ids: Column, length: int) -> Column:
    """The ids, or an error in the job that meets a sequence of another length."""
    message = F.concat(F.lit(f"expected {length} ids, got "), F.size(ids).cast("string"))
    return F.when(F.size(ids) == length, ids).otherwise(F.raise_error(message).cast("array<bigint>"))
