"""Language identification with bit-sliced Bloom filters of character n-grams.

A filter has one word of bits for each slot, bit l for language l, so a lookup
of an n-gram (the AND of its slots) returns all languages that contain it at
once. A language contains an n-gram when its rate there is at least
``MIN_RATE``, and at least ``SHARE`` of the highest rate in any language:
stray words of other languages do not enter.

A text's n-grams are looked up and counted for each language. A share f of
n-grams outside a language seems to be in it, where f follows from how full
the language's bits are; the count h of n lookups becomes
(h - n f) / (1 - f). The language with the highest count is predicted (the first
in order among equals), with its share of all counts as the score.

N-grams are of lower-case letters, everything else parts words like a space.
A null text, or one without a letter, is ``und`` with score 0. A text whose
n-grams no language has gets the most frequent language with score 0; if no
language was learnt that is ``und``. Null languages are not learnt from. Repeated rows count as often as
they stand there. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusprep.llm.chunks import pieces
from corpusprep.llm.common import held_out
from corpusprep.session import stage

FOLDS = 4
GRAM = 4
SLOTS = 1 << 20  # a power of two; 8 bytes for each 64 languages
HASHES = 4
MIN_RATE = 2e-6
SHARE = 0.1
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def letters(text: str) -> str:
    """Lower-case letters with single spaces between words, and spaces around."""
    return "  " + _OTHER.sub(" ", text.lower()).strip() + "  "


def grams(texts: Sequence[str], n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of some normalised texts, and how many each text has."""
    lengths = np.array([max(0, len(t) - n + 1) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < n:
        return np.zeros(0, np.uint64), lengths
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ codes[k : len(codes) - n + 1 + k]) * _MIX
        h ^= h >> np.uint64(29)
    # N-grams across two texts are left out.
    ends = np.cumsum([len(t) for t in texts])
    keep = np.ones(len(codes), bool)
    for k in range(1, n):
        keep[ends - k] = False
    return h[keep[: len(h)]], lengths


def slots(h: np.ndarray, m: int = SLOTS, k: int = HASHES) -> list[np.ndarray]:
    """The ``k`` slots of each hash."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(m - 1)).astype(np.int64) for i in range(k)]


def gram_counts(rows: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all ``(lang, text)`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [letters(t) for l, t in zip(langs, texts) if l == lang and t]
                for a, b in pieces(own, 1 << 22):
                    found, n = np.unique(grams(own[a:b])[0], return_counts=True)
                    columns = [pa.array([lang] * len(found)), pa.array(found.view("i8")), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    found = rows.select("lang", "text").mapInArrow(run, "lang string, gram bigint, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Filters:
    """Languages in order, ``(SLOTS, words)`` bits, and the share of set slots of each language."""

    langs: tuple[str, ...]
    bits: np.ndarray
    full: np.ndarray
    usual: int

    def classify(self, texts: Sequence[str | None]) -> Iterator[tuple[str, float]]:
        n_langs = len(self.langs)
        rate = np.minimum(self.full**HASHES, 0.999)
        for a, b in pieces(texts, 1 << 20):
            normal = [letters(t or "") for t in texts[a:b]]
            h, n = grams(normal)
            at = slots(h)
            ends = np.cumsum(n)
            hits = np.zeros((len(normal), n_langs))
            some = np.flatnonzero(n)
            for word in range(self.bits.shape[1] if n_langs else 0):
                held = self.bits[at[0], word]
                for s in at[1:]:
                    held = held & self.bits[s, word]
                for bit in range(min(64, n_langs - 64 * word)):
                    inside = ((held >> np.uint64(bit)) & np.uint64(1)).astype(np.int32)
                    if len(some):
                        hits[some, 64 * word + bit] = np.add.reduceat(inside, (ends - n)[some])
            true = np.maximum(0, hits - n[:, None] * rate) / (1 - rate)
            for i, text in enumerate(texts[a:b]):
                if not n_langs or not any(map(str.isalpha, text or "")):
                    yield UNKNOWN, 0.0
                elif not true[i].any():
                    yield self.langs[self.usual], 0.0
                else:
                    best = int(true[i].argmax())
                    yield self.langs[best], float(true[i, best] / true[i].sum())


def learn(rows: DataFrame) -> Filters:
    """Filters from all ``(lang, text)`` rows.

    Counting, the choice of n-grams and the filling of slots are aggregations.
    What comes back to be broadcast are the slots, whose number is fixed.
    """
    spark = rows.sparkSession
    counts = stage(gram_counts(rows.filter(F.col("lang").isNotNull())), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    # One row for each language; languages are few by nature.
    known = sorted((r["lang"], r["total"]) for r in totals.collect())
    langs = tuple(lang for lang, _ in known)
    words = max(1, -(-len(langs) // 64))
    if not known:
        return Filters((), np.zeros((SLOTS, 1), np.uint64), np.zeros(0), 0)
    numbered = spark.createDataFrame([(l, i, t) for i, (l, t) in enumerate(known)], "lang string, no int, total bigint")
    rated = counts.join(F.broadcast(numbered), "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = F.max("rate").over(W.partitionBy("gram"))  # one row for each language at most
    kept = rated.withColumn("top", top).filter((F.col("rate") >= MIN_RATE) & (F.col("rate") >= SHARE * F.col("top")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no = batch.column(1).to_numpy()
            mask = (np.uint64(1) << (no % 64).astype(np.uint64)).view("i8")
            for s in slots(batch.column(0).to_numpy().view("u8")):
                columns = [pa.array(s * words + no // 64), pa.array(mask)]
                yield pa.RecordBatch.from_arrays(columns, names=["at", "mask"])

    placed = kept.select("gram", "no").mapInArrow(place, "at bigint, mask bigint")
    filled = placed.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(SLOTS * words, np.uint64)
    bits[filled.column("at").to_numpy()] = filled.column("mask").to_numpy().view("u8")
    bits = bits.reshape(SLOTS, words)
    full = np.array([np.count_nonzero(bits[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / SLOTS for i in range(len(langs))])
    return Filters(langs, bits, full, int(np.argmax([t for _, t in known])))


def identify(df: DataFrame, filters: Filters, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of each row. The filters are broadcast: a fixed number of slots."""
    shared = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.classify(batch.column(1).to_pylist()))
            columns = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def op8(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    out = held_out(F.col("doc_id"), FOLDS)
    filters = learn(docs.filter(~out).select("lang", "text"))
    found = identify(docs, filters)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
