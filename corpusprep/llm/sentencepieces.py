"""SentencePiece encoding with the byte span of every piece, and decoding.

``Charsmap`` reads a model's compiled character map (a double-array trie and a
pool of replacements) and normalises by longest prefix, recording for every
normalised byte the source byte it came from. White space becomes the marker
character, and a marker is put in front where the model asks for it. A piece's
length in normalised bytes then projects it onto source bytes; a byte piece
covers one byte.

Ids are those of the sentencepiece library. Where the map is empty and no piece
holds the marker after another character, a text is encoded chunk by chunk
(cut before white space), which gives the same ids; other models encode whole
texts.

A null or empty text has no pieces and decodes to the empty text. Repeated
rows are encoded alike. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusprep.llm.chunks import ChunkMemory, flat, pieces

MARKER = "▁"
_CHUNKS = re.compile(" *[^ ]+| +$")


class Charsmap:
    """Longest-prefix normalisation through a compiled character map; an empty one changes nothing."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.pool = blob[4 + size :]

    def prefix(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix at ``at``, and what it becomes."""
        units = self.units
        if not units:
            return None
        found, node = None, self._offset(units[0])
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != source[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        end = self.pool.index(b"\0", found[1])
        return found[0], self.pool[found[1] : end]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def normalize(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source byte of each of them and of the end."""
        if not self.units:
            return source, np.arange(len(source) + 1)
        out, places, at = bytearray(), [], 0
        while at < len(source):
            mapped = self.prefix(source, at)
            if mapped is None:
                n = 1
                while at + n < len(source) and source[at + n] & 0xC0 == 0x80:
                    n += 1
                out += source[at : at + n]
                places += range(at, at + n)
            else:
                n, text = mapped
                out += text
                places += [at] * len(text)
            at += n
        return bytes(out), np.array([*places, len(source)])


class Pieces:
    """A model of the sentencepiece library with what the spans need."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        spec = model.normalizer_spec
        self.map = Charsmap(spec.precompiled_charsmap)
        self.dummy_prefix = spec.add_dummy_prefix
        self.squeeze = spec.remove_extra_whitespaces
        kinds = model.pieces[0].__class__.Type
        self.is_byte = np.array([p.type == kinds.BYTE for p in model.pieces])
        self.size = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.unknown = self.library.unk_id()
        whole = all(
            MARKER not in p.piece.lstrip(MARKER) for p in model.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)
        )
        suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.by_chunk = whole and self.dummy_prefix and not (self.map.units or self.squeeze or suffix)
        self.lone = (self.library.piece_to_id(MARKER),)
        self.memory = ChunkMemory(self._encode_chunks)

    def _encode_chunks(self, chunks: list[str]) -> list[tuple]:
        # The library puts a marker in front of each chunk, so a chunk comes without its first space.
        found = self.library.encode([c[1:] for c in chunks], num_threads=1)
        return [tuple(ids) if c != " " else self.lone for c, ids in zip(chunks, found)]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """A text with a space in front, cut before each run of spaces; whole if it holds the marker itself."""
        if not text:
            return []
        if MARKER in text:
            return [" " + text]
        return _CHUNKS.findall(" " + text)

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        for a, b in pieces(texts):
            if self.by_chunk:
                cut = [self.chunks(t or "") for t in texts[a:b]]
                look = self.memory.learn(cut)
                for chunks in cut:
                    yield flat(look, chunks)
            else:
                for ids in self.library.encode([t or "" for t in texts[a:b]], num_threads=1):
                    yield np.array(ids, np.int32)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First source byte of each piece, and the byte after its last."""
        source = text.encode("utf-8", "surrogatepass")
        normal, places = self.map.normalize(source)
        flags = np.frombuffer(normal, np.uint8)
        if self.squeeze:
            blank = flags == 0x20
            keep = ~(blank & np.append(True, blank[:-1]))  # of a run of spaces the first stays; none in front
            while len(keep) and keep.any() and blank[np.flatnonzero(keep)[-1]]:
                keep[np.flatnonzero(keep)[-1]] = False
            end = places[-1]
            flags, places = flags[keep], np.append(places[:-1][keep], end)
        # Every space is a marker of three bytes; the prefix is one that has no source.
        wide = np.where(flags == 0x20, 3, 1)
        front = 3 if self.dummy_prefix and len(flags) else 0
        edge = np.concatenate([np.full(front, places[0]), np.repeat(places[:-1], wide), places[-1:]])
        sizes = self.size[ids]
        if (ids == self.unknown).any():
            sizes = self._with_unknown(text, ids, sizes)
        ends = np.cumsum(sizes)
        return edge[ends - sizes].astype(np.int32), edge[ends].astype(np.int32)

    def _with_unknown(self, text: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """An unknown piece has the length of its surface, which the library knows."""
        names = self.library.encode(text, out_type=str)
        return np.where(ids == self.unknown, [len(n.encode()) for n in names], sizes)

    def decode(self, rows: Sequence[np.ndarray]) -> list[str]:
        return self.library.decode([r.tolist() for r in rows], num_threads=1) if len(rows) else []


@lru_cache(maxsize=2)
def model(path: str) -> Pieces:
    """One model for each worker."""
    return Pieces(path)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, list, list[np.ndarray]]]:
    """Ids, texts and token ids of bounded slices of ``(id, text)`` batches."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        ids = model(path).encode(texts)
        for a, b in pieces(texts):
            yield batch.column(0).slice(a, b - a), texts[a:b], [next(ids) for _ in range(a, b)]


def _lists(rows: Sequence[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows).astype(np.int32)))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, ids, starts, ends)``: token ids of each text and the source bytes of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, rows in _encoded(batches, path):
            spans = [model(path).spans(t or "", r) for t, r in zip(texts, rows)]
            columns = [keys, _lists(rows), _lists([s for s, _ in spans]), _lists([e for _, e in spans])]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "starts", "ends"])

    kind = df.schema[id_col].dataType.simpleString()
    kept = df.select(id_col, F.col(text).cast("string").alias("text"))
    return kept.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, starts array<int>, ends array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(id, text)``: the text of each row of token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(r or [], np.int32) for r in batch.column(1).to_pylist()]
            texts = pa.array(model(path).decode(rows), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=[id_col, "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids).mapInArrow(run, f"`{id_col}` {kind}, text string")


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


_DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string"


def op5(docs: DataFrame, path: str) -> DataFrame:
    """The contract's digests, and one of the spans (starts, then ends, as little-endian 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [str(i) for i in range(len(model(path).size))]
        for keys, texts, rows in _encoded(batches, path):
            digests = [_hex(",".join(map(names.__getitem__, r.tolist())).encode()) for r in rows]
            decoded = [_hex(t.encode()) for t in model(path).decode(rows)]
            spans = [_hex(b"".join(x.astype("<i4").tobytes() for x in model(path).spans(t or "", r))) for t, r in zip(texts, rows)]
            counts = pa.array([len(r) for r in rows], pa.int64())
            columns = [keys, counts, pa.array(digests), pa.array(decoded), pa.array(spans)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(run, _DIGESTS)


def encode_checked(df: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` with ``n_tokens`` and ``round_trip``: whether the ids decode to the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, rows in _encoded(batches, path):
            spans = [model(path).spans(t or "", r) for t, r in zip(texts, rows)]
            same = [a == (b or "") for a, b in zip(model(path).decode(rows), texts)]
            counts = pa.array([len(r) for r in rows], pa.int64())
            lists = [_lists(rows), _lists([s for s, _ in spans]), _lists([e for _, e in spans])]
            names = [id_col, "n_tokens", "ids", "starts", "ends", "round_trip"]
            yield pa.RecordBatch.from_arrays([keys, counts, *lists, pa.array(same)], names=names)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids array<int>, starts array<int>, ends array<int>, round_trip boolean"
    return df.select(id_col, F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
