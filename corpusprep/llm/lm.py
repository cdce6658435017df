"""Language-model scores from an Elias-Fano n-gram trie.

The model is a bigram model with absolute discounting: with counts c, discount
D, and d(u) the number of different words after u,

    P(w | u) = max(c(u w) - D, 0) / c(u) + D d(u) / c(u) * P1(w)
    P1(w) = (c(w) + 1) / (N + V + 1)

for training counts of all words and the end of each text; a text's start is a
context too. After an unknown context P1 is taken. Every pair of the training
texts is in the trie.

The trie lies in files that tasks map into memory:

* **words**, cut by hash range: the words' 64-bit hashes in order and the running
  sums of their counts as Elias-Fano sequences. A word's id is its place.
* **pointers**, cut alike: running sums of the numbers of successors, monotone,
  so one entry gives where a word's successors begin and the next one where they end.
* **pairs**, cut by running count so that each file stands for the same number of
  training pairs; a context with more is spread by its successors' ids. Successor
  ids are stored relative to what the context before ended with, which makes one
  monotone sequence; discounted log probabilities are quantised to sixteen bits.

A pair is looked up by its context's pointers and a successor search between
them. Counting is partitioned by Spark: words by hash range, pairs by file, so
no task or driver holds the model; the driver sees sizes of files only. Files
lie in the shared folder and are mapped in place; from a store that cannot be
mapped a worker first copies the files it needs next to itself.

Null texts count as empty. Null ids belong to training. Repeated rows count as
often as they stand there. With no training text all scores come from P1 with
N = V = 0, which is 1. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusprep.llm.chunks import pieces
from corpusprep.llm.common import held_out, words_of
from corpusprep.llm.eliasfano import EliasFano
from corpusprep.session import stage, stage_path

FOLDS = 7
DISCOUNT = 0.75
LEVELS = 1 << 16
WORDS_PER_FILE = 1 << 18
PAIRS_PER_FILE = 1 << 21
_PIECE = 1 << 22
#: Neither can be a word, for words hold no white space.
_END, _START = xxhash.xxh64_intdigest(b"\n"), xxhash.xxh64_intdigest(b" ")


class _Hashes(dict):
    """Hashes of words seen before; started over when there are too many."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def token_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of some texts laid end to end, and the number of each text's; an end is a token."""
    rows = []
    for text in texts:
        words = words_of(text)
        row = np.empty(len(words) + 1, np.uint64)
        row[:-1] = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
        row[-1] = _END
        rows.append(row)
    return np.concatenate(rows) if rows else np.zeros(0, np.uint64), np.array([len(r) for r in rows], np.int64)


def _runs(column: pa.Array) -> Iterator[list[str | None]]:
    """Texts of a column in runs of bounded size, so that no more of a batch is in Python at once."""
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        ahead = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, ahead + _PIECE, side="right")))
        yield column.slice(at, end - at).to_pylist()
        at = end


# --- files -----------------------------------------------------------------


def _filesystem(uri: str):
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays as one file, whole or not at all: a repeated task puts the same file in its place."""
    heads, at = {}, 0
    for key, a in arrays.items():
        heads[key] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    head = json.dumps(heads).encode()
    head = len(head).to_bytes(8, "little") + head
    store, place = _filesystem(folder)
    store.create_dir(place, recursive=True)
    part = f"{place}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(head + b"\0" * (-len(head) % 64))
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 64))
    store.move(part, f"{place}/{name}")


@lru_cache(maxsize=1)
def _copies() -> str:
    import atexit

    place = tempfile.mkdtemp(prefix="trie-")
    atexit.register(shutil.rmtree, place, ignore_errors=True)
    return place


@lru_cache(maxsize=4096)
def load(folder: str, name: str) -> dict[str, np.ndarray]:
    """Arrays of a file, mapped into memory."""
    from pyarrow import fs

    store, place = _filesystem(folder)
    path = f"{place}/{name}"
    if not isinstance(store, fs.LocalFileSystem):
        copy = os.path.join(_copies(), f"{os.path.basename(place)}-{name}")
        with store.open_input_stream(path) as source, open(copy, "wb") as out:
            shutil.copyfileobj(source, out, 1 << 20)
        path = copy
    raw = np.memmap(path, np.uint8, "r")
    n = int(raw[:8].view("<u8")[0])
    heads = json.loads(bytes(raw[8 : 8 + n]))
    base = -(-(8 + n) // 64) * 64
    return {k: raw[base + at : base + at + size * np.dtype(kind).itemsize].view(kind) for k, (kind, size, at) in heads.items()}


def _named(prefix: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{prefix}.{k}": v for k, v in arrays.items()}


@lru_cache(maxsize=8192)
def _sequence(folder: str, name: str, prefix: str) -> EliasFano:
    arrays = load(folder, name)
    return EliasFano({k.partition(".")[2]: v for k, v in arrays.items() if k.startswith(prefix + ".")})


# --- model -----------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Where the files are, and for each file what lies before it: small arrays, one entry a file."""

    folder: str
    bits: int  # of the hash that name the file of a word
    ids: np.ndarray  # words before each file of words
    sums: np.ndarray  # training tokens before each file of words
    tokens: int  # N
    types: int  # V
    per_file: int = PAIRS_PER_FILE
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # pairs before each file of pairs
    distinct: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # pairs before each file of pointers
    discount: float = DISCOUNT
    step: float = 0.05

    def word_file(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)

    def find_words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(id, count, tokens before)`` of sorted distinct hashes; id -1 for unknown ones."""
        ids, counts, before = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        files = self.word_file(h)
        for f in np.unique(files).tolist():
            if self.ids[f] == self.ids[f + 1]:
                continue
            rows = slice(*np.searchsorted(files, [f, f + 1]))
            at = _sequence(self.folder, f"words-{f}", "hash").find(h[rows])
            known = np.flatnonzero(at >= 0) + rows.start
            at = at[at >= 0]
            sums = _sequence(self.folder, f"words-{f}", "sums")
            low = sums.get(at).astype(np.int64)
            ids[known] = self.ids[f] + at
            counts[known] = sums.get(at + 1).astype(np.int64) - low
            before[known] = self.sums[f] + low
        return ids, counts, before

    def pair_file(self, before: np.ndarray, count: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """File of each pair, from its context's tokens before and count, and its successor's id."""
        first = before // self.per_file
        span = (before + count - 1) // self.per_file - first + 1
        return first + np.where(span > 1, (successor.astype(np.float64) / (self.types + 1) * span).astype(np.int64), 0)

    def successors(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the successors of sorted context ids begin and end in the order of all pairs."""
        begin, end = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        files = np.searchsorted(self.ids, ids, side="right") - 1
        for f in np.unique(files).tolist():
            rows = slice(*np.searchsorted(files, [f, f + 1]))
            pointers = _sequence(self.folder, f"pointers-{f}", "to")
            at = ids[rows] - self.ids[f]
            begin[rows] = self.distinct[f] + pointers.get(at).astype(np.int64)
            end[rows] = self.distinct[f] + pointers.get(at + 1).astype(np.int64)
        return begin, end

    def p1(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.types + 1)

    def score(self, texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
        """``(n_tokens, n_known, base, score)`` arrays for consecutive runs of texts."""
        for a, b in pieces(texts, _PIECE):
            h, n = token_hashes(texts[a:b])
            kinds, at = np.unique(np.append(h, np.uint64(_START)), return_inverse=True)
            ids, counts, before = self.find_words(kinds)
            counts[kinds == _START] = 0 if self.tokens == 0 else counts[kinds == _START]
            starts = np.cumsum(n) - n
            left = np.append(at[-1], at[:-2])
            left[starts] = at[-1]
            at = at[:-1]
            lower = self.p1(counts)
            pair, place = np.unique(left.astype(np.int64) * len(kinds) + at, return_inverse=True)
            u, w = pair // len(kinds), pair % len(kinds)
            p = lower[w].copy()
            seen = np.flatnonzero((ids[u] >= 0) & (counts[u] > 0))
            if len(seen):
                p[seen] = self._pairs(ids, counts, before, lower, u[seen], w[seen])
            logs = np.log10(p)[place]
            known = (counts > 0)[at].astype(np.int64)
            sums = [np.add.reduceat(x, starts) for x in (known, np.log10(lower)[at], logs)]
            yield n, *sums

    def _pairs(self, ids, counts, before, lower, u, w) -> np.ndarray:
        contexts, back = np.unique(u, return_inverse=True)
        order = np.argsort(ids[contexts])
        begin, end = np.zeros(len(contexts), np.int64), np.zeros(len(contexts), np.int64)
        begin[order], end[order] = self.successors(ids[contexts][order])
        mass = self.discount * (end - begin) / counts[contexts]
        p = mass[back] * lower[w]
        trained = np.flatnonzero(ids[w] >= 0)
        files = self.pair_file(before[u[trained]], counts[u[trained]], ids[w[trained]])
        order = np.argsort(files, kind="stable")
        trained, files = trained[order], files[order]
        for f in np.unique(files).tolist():
            if self.pairs[f] == self.pairs[f + 1]:
                continue
            rows = trained[slice(*np.searchsorted(files, [f, f + 1]))]
            first, n = self.pairs[f], self.pairs[f + 1] - self.pairs[f]
            lo = np.clip(begin[back[rows]] - first, 0, n)
            hi = np.clip(end[back[rows]] - first, 0, n)
            values = _sequence(self.folder, f"pairs-{f}", "next")
            base = np.where(lo > 0, values.get(np.maximum(lo - 1, 0)).astype(np.int64), 0)
            found = values.find((base + ids[w[rows]] + 1).astype(np.uint64), lo, hi)
            hit = np.flatnonzero(found >= 0)
            level = load(self.folder, f"pairs-{f}")["level"][found[hit]]
            p[rows[hit]] += 10.0 ** (-self.step * level)
        return p


# --- training --------------------------------------------------------------


def _ordered(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as signed numbers of the same order."""
    return (h ^ np.uint64(1 << 63)).view("i8")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows of one value of the first column after another, from a partition sorted by it."""
    now, rows = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if keys[a] != now:
                if rows:
                    yield now, rows
                now, rows = int(keys[a]), []
            rows.append(batch.slice(a, b - a))
    if rows:
        yield now, rows


def _column(rows: list[pa.RecordBatch], i: int) -> np.ndarray:
    return np.concatenate([r.column(i).to_numpy() for r in rows])


def _cumulative(sizes: dict[int, int], n: int) -> np.ndarray:
    return np.cumsum([0, *[sizes.get(i, 0) for i in range(n)]], dtype=np.int64)


def train(texts: DataFrame, words_per_file: int = WORDS_PER_FILE, pairs_per_file: int = PAIRS_PER_FILE) -> Model:
    """The model of a one-column table of texts."""
    spark = texts.sparkSession
    folder = stage_path(spark, "trie")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in _runs(batch.column(0)):
                h, n = np.unique(token_hashes(run)[0], return_counts=True)
                h, n = np.append(h, np.uint64(_START)), np.append(n, len(run))
                yield pa.RecordBatch.from_arrays([pa.array(_ordered(h)), pa.array(n)], names=["h", "n"])

    counted = texts.mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    counted = stage(counted, "counts")
    start = int(_ordered(np.array([_START], np.uint64))[0])
    size, tokens, starts = counted.agg(
        F.count(F.lit(1)), F.sum("n"), F.sum(F.when(F.col("h") == start, F.col("n")))
    ).first()
    starts = starts or 0
    bits = max(0, (max(1, size) // words_per_file).bit_length())
    files = 1 << bits
    # The top bits of the hash, which are uniform, name the file.
    file = F.lit(0) if not bits else (F.shiftright("h", 64 - bits) + (files >> 1)).cast("int")
    filed = counted.withColumn("file", file)
    heads = filed.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("s")).collect()  # one row a file
    ids = _cumulative({r["file"]: r["n"] for r in heads}, files)
    sums = _cumulative({r["file"]: r["s"] for r in heads}, files)

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, rows in _grouped(batches):
            h = _column(rows, 1).view("u8") ^ np.uint64(1 << 63)
            total = np.append(0, np.cumsum(_column(rows, 2))).astype(np.uint64)
            save(folder, f"words-{f}", _named("hash", EliasFano.build(h).arrays) | _named("sums", EliasFano.build(total).arrays))
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32())], names=["file"])

    dealt = filed.select("file", "h", "n").repartition(max(1, min(parts, files)), "file").sortWithinPartitions("file", "h")
    dealt.mapInArrow(write_words, "file int").agg(F.count(F.lit(1))).collect()
    tokens = (tokens or 0) - starts
    step = (np.log10(max(tokens, 1)) + 1.0) / (LEVELS - 1)
    types = size - (1 if starts else 0)
    model = Model(folder, bits, ids, sums, tokens, types, pairs_per_file, step=float(step))
    return _with_pairs(texts, model, parts) if tokens else model


def _with_pairs(texts: DataFrame, model: Model, parts: int) -> Model:
    """The model with its files of pairs and pointers."""
    width = max(1, int(model.ids[-1]).bit_length())

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in _runs(batch.column(0)):
                h, n = token_hashes(run)
                kinds, at = np.unique(np.append(h, np.uint64(_START)), return_inverse=True)
                ids, counts, before = model.find_words(kinds)
                left = np.append(at[-1], at[:-2])
                left[np.cumsum(n) - n] = at[-1]
                keys, times = np.unique((ids[left] << width) | ids[at[:-1]], return_counts=True)
                u = np.searchsorted(ids[np.argsort(ids)], keys >> width)
                u = np.argsort(ids)[u]
                file = model.pair_file(before[u], counts[u], keys & ((1 << width) - 1))
                # One packed row for each file: keys in order, as differences, compress well.
                order = np.argsort(file, kind="stable")
                cuts = np.flatnonzero(np.append(True, np.diff(file[order]) != 0))
                names, blobs = file[order][cuts], []
                for rows in np.split(order, cuts[1:]):
                    blobs.append(_pack(keys[rows], times[rows]))
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(blobs, pa.binary())], names=["file", "blob"])

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, rows in _grouped(batches):
            keys, times = _merge([_unpack(x) for r in rows for x in r.column(1).to_pylist()])
            u, w = keys >> width, keys & ((1 << width) - 1)
            contexts, begin, distinct = np.unique(u, return_index=True, return_counts=True)
            last = w[np.append(begin[1:], len(w)) - 1] + 1
            base = np.cumsum(last) - last  # what all contexts before ended with
            values = (w + 1 + np.repeat(base, distinct)).astype(np.uint64)
            total = _context_counts(model, contexts)
            p = (times - model.discount) / np.repeat(total, distinct)
            level = np.clip(np.rint(-np.log10(p) / model.step), 0, LEVELS - 1).astype(np.uint16)
            save(model.folder, f"pairs-{f}", _named("next", EliasFano.build(values).arrays) | {"level": level})
            columns = [pa.array(np.full(len(contexts), f, np.int64)), pa.array(contexts), pa.array(distinct)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "u", "d"])

    rows = texts.mapInArrow(pair, "file bigint, blob binary")
    n_files = int(model.sums[-1]) // model.per_file + 1
    dealt = rows.repartition(max(1, min(n_files, 4 * parts)), "file").sortWithinPartitions("file")
    found = stage(dealt.mapInArrow(write_pairs, "file bigint, u bigint, d bigint"), "contexts")
    sizes = {r["file"]: r["n"] for r in found.groupBy("file").agg(F.sum("d").alias("n")).collect()}  # one row a file
    pairs = _cumulative(sizes, n_files)
    edges = model.ids

    def write_pointers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, group in _grouped(batches):
            d = np.zeros(edges[f + 1] - edges[f] + 1, np.int64)
            np.add.at(d, _column(group, 1) - edges[f] + 1, _column(group, 2))
            save(model.folder, f"pointers-{f}", _named("to", EliasFano.build(np.cumsum(d).astype(np.uint64)).arrays))
            yield pa.RecordBatch.from_arrays([pa.array([f], pa.int64()), pa.array([int(d.sum())])], names=["file", "n"])

    # Each file of words has a row at least, so that each gets its pointers: a context of its own with no pairs.
    firsts = [(int(edges[f]), 0) for f in range(len(edges) - 1) if edges[f] < edges[f + 1]]
    spark = texts.sparkSession
    each = spark.createDataFrame(firsts, "u bigint, d bigint").unionByName(found.select("u", "d"))
    bounds = pa.array(edges)

    def file_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = bounds.to_numpy()
        for batch in batches:
            u = batch.column(0)
            file = np.searchsorted(cuts, u.to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(file), u, batch.column(1)], names=["file", "u", "d"])

    filed = each.mapInArrow(file_of, "file bigint, u bigint, d bigint")
    placed = filed.repartition(max(1, min(parts, len(firsts))), "file").sortWithinPartitions("file")
    heads = {r["file"]: r["n"] for r in placed.mapInArrow(write_pointers, "file bigint, n bigint").collect()}  # one row a file
    return Model(
        model.folder, model.bits, model.ids, model.sums, model.tokens, model.types, model.per_file,
        pairs, _cumulative(heads, len(edges) - 1), model.discount, model.step,
    )


def _context_counts(model: Model, ids: np.ndarray) -> np.ndarray:
    """Training counts of sorted ids."""
    out = np.zeros(len(ids), np.int64)
    files = np.searchsorted(model.ids, ids, side="right") - 1
    for f in np.unique(files).tolist():
        rows = slice(*np.searchsorted(files, [f, f + 1]))
        sums = _sequence(model.folder, f"words-{f}", "sums")
        at = ids[rows] - model.ids[f]
        out[rows] = (sums.get(at + 1) - sums.get(at)).astype(np.int64)
    return out


def _pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted keys and their counts: differences byte by byte, so that equal high bytes compress away."""
    gaps = np.diff(keys, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)
    need = int(np.flatnonzero(gaps.any(0)).max(initial=0)) + 1
    some = np.flatnonzero(times > 1).astype("<u4")
    head = np.array([len(keys), need, len(some)], "<u4").tobytes()
    return head + gaps[:, :need].T.tobytes() + some.tobytes() + times[some].astype("<u8").tobytes()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, need, k = np.frombuffer(blob, "<u4", 3).tolist()
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :need] = np.frombuffer(blob, np.uint8, n * need, 12).reshape(need, n).T
    times = np.ones(n, np.int64)
    some = np.frombuffer(blob, "<u4", k, 12 + n * need)
    times[some] = np.frombuffer(blob, "<u8", k, 12 + n * need + 4 * k)
    return np.cumsum(gaps.view("<u8").ravel().astype(np.int64)), times


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    times = np.concatenate([t for _, t in parts])
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(times, first)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score)`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for n, known, base, found in chain.from_iterable(map(model.score, _runs(batch.column(1)))):
                columns = [batch.column(0).slice(at, len(n)), pa.array(n), pa.array(known), pa.array(base), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_tokens", "n_known", "base_score", "score"])
                at += len(n)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    return df.select(id_col, text).mapInArrow(run, schema)


def op4(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    out = held_out(F.col("doc_id"), FOLDS)
    model = train(docs.filter(~out).select("text"))
    found = score(docs, model)
    return found.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
