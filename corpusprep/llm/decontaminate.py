"""Benchmark decontamination by template windows and slot consistency.

Words are turned into templates: a number becomes ``<num>``, a unit ``<unit>``,
a capitalised word inside a sentence ``<name>``; other words are in lower case.
Windows of ``WINDOW`` words of documents and benchmark items meet by an
equality join on hashes, in two families:

* **literal** windows of lower-case words: the passage itself;
* **template** windows with at least ``LITERALS`` plain words and a slot: a
  question with other numbers, names or units in it. Such a match counts when
  the slots of all windows of one alignment correspond: each value of the item
  stands for one value in the document, and back.

Items with fewer words are one window of all their words. Those below
``SHORTEST`` say too little to be a passage: they match documents that consist
of them. A first word may be a name or not, so a window that starts an item
comes in both forms.

A Bloom filter of the benchmark's windows, sized by their number up to 32 MB, is
broadcast; it lets through what may match, and the join decides. It drops no
match. Texts are read once: what the filter lets through is staged.

Null or blank texts match nothing. Rows with a null id are left out of the
matches, and stay in ``drop_contaminated``. Rows that share an id are matched
together. An empty table or benchmark gives no matches. Very long texts are cut
into windows whole, one at a time. Further columns are ignored, and stay in
``drop_contaminated``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusprep.llm.chunks import pieces
from corpusprep.llm.common import fresh
from corpusprep.session import stage

WINDOW, LITERALS, SHORTEST = 13, 7, 8
_PROBES, _BITS_PER_WINDOW = 5, 16
_LEAST_BITS, _MOST_BITS = 1 << 23, 1 << 28  # one megabyte to 32; beyond, more windows reach the join
_WORD = re.compile(r"[^\W_]+(?:[.,][0-9]+)*|[.!?\n]")
# Units of measure and money.
UNITS = frozenset(
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g gram grams kg kilogram kilograms lb lbs pound pounds "
    "oz ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years percent dollar dollars usd euro euros eur cent cents "
    "degree degrees mph kmh watt watts kw volt volts meter meters metre metres kilometer kilometers kilometre kilometres".split()
)
_KINDS = {"num": 1, "unit": 2, "name": 3}
_MUL = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_MUL), -1, 1 << 64))


@dataclass(frozen=True)
class Words:
    """Words of some texts, laid end to end: hashes ``literal`` and ``template``, ``kind`` of slot (0: none), ``text`` they are of."""

    literal: np.ndarray
    template: np.ndarray
    kind: np.ndarray
    text: np.ndarray


class _Lexicon(dict):
    """Numbers for raw words, which tables of what is known of them are indexed by."""

    MOST = 400_000

    def __init__(self) -> None:
        self.codes, self.kinds, self.capitals = [], [], []

    def __missing__(self, word: str) -> int:
        low = word.lower()
        self.codes.append(0 if word in ".!?\n" else xxhash.xxh64_intdigest(low) | 1)
        self.kinds.append(1 if word[0].isdigit() else 2 if low in UNITS else 0)
        self.capitals.append(word[0].isupper())
        self[word] = len(self.codes) - 1
        return self[word]

    def start_over(self) -> None:
        """Forget all words when there are too many; called between texts."""
        if len(self) > self.MOST:
            self.clear()
            self.__init__()


_LEXICON = _Lexicon()
_SLOTS = np.array([0] + [xxhash.xxh64_intdigest(f"<{k}>") | 1 for k in _KINDS], np.uint64)


def words_of_texts(texts: Sequence[str | None]) -> Words:
    """Words of whole texts; a word after a stop, a line end or nothing does not count as a name."""
    _LEXICON.start_over()
    raw = [_WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    at = np.fromiter(map(_LEXICON.__getitem__, chain.from_iterable(raw)), np.int64, int(sizes.sum()))
    # Only the entries in use are turned into arrays.
    used, at = np.unique(at, return_inverse=True)
    code = np.array([_LEXICON.codes[i] for i in used.tolist()], np.uint64)[at]
    kind = np.array([_LEXICON.kinds[i] for i in used.tolist()], np.int8)[at]
    capital = np.array([_LEXICON.capitals[i] for i in used.tolist()], bool)[at]
    mark = code == 0
    first = np.append(True, mark[:-1])[: len(mark)]
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    kind = np.where((kind == 0) & capital & ~first, 3, kind)[~mark]
    code = code[~mark]
    return Words(code, np.where(kind > 0, _SLOTS[kind], code), kind, np.repeat(np.arange(len(sizes)), sizes)[~mark])


def window_hashes(code: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words: differences of a running polynomial, shifted to the same power."""
    m = len(code) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    powers = np.full(len(code), _MUL)
    powers[0] = 1
    back = np.full(m, _INVERSE)
    back[0] = 1
    sums = np.append(np.uint64(0), np.cumsum(code * np.cumprod(powers)))
    h = (sums[n:] - sums[:-n]) * np.cumprod(back) + np.uint64(n)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def windows(words: Words, n: int, literals: int = LITERALS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(place, family, hash)`` of all windows of ``n`` words inside a text; family 0 is literal, 1 template."""
    a = window_hashes(words.literal, n)
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int8), a
    whole = words.text[n - 1 :] == words.text[: len(a)]
    slots = np.append(0, np.cumsum(words.kind > 0))
    inside = slots[n:] - slots[:-n]
    plain = np.flatnonzero(whole)
    ok = np.flatnonzero(whole & (inside > 0) & (n - inside >= min(literals, n)))
    b = window_hashes(words.template, n)[ok] ^ np.uint64(0x5851F42D4C957F2D)
    families = np.repeat(np.array([0, 1], np.int8), [len(plain), len(ok)])
    return np.concatenate([plain, ok]), families, np.concatenate([a[plain], b])


def _slot_lists(words: Words, places: np.ndarray, families: np.ndarray, n: int) -> pa.Array:
    """Values of the slots of template windows; literal windows have none."""
    values = [
        words.literal[at : at + n][words.kind[at : at + n] > 0].view("i8") if f else np.zeros(0, np.int64)
        for at, f in zip(places.tolist(), families.tolist())
    ]
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))


_ROWS = "id bigint, start int, family tinyint, width int, hash bigint, slots array<bigint>"
_NAMES = ["id", "start", "family", "width", "hash", "slots"]


def _bit(h: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The i-th bit that a hash sets in a filter of ``bits`` bits, a power of two."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)


def _batch(keys: np.ndarray, words: Words, found: Sequence[np.ndarray], n: int) -> pa.RecordBatch:
    places, families, h = found
    own = words.text[places]
    starts = places - np.searchsorted(words.text, own)
    columns = [
        pa.array(keys[own]), pa.array(starts.astype(np.int32)), pa.array(families),
        pa.array(np.full(len(h), n, np.int32)), pa.array(h.view("i8")), _slot_lists(words, places, families, n),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def item_windows(items: DataFrame, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """All windows of benchmark items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of_texts([text])
                n = min(WINDOW, len(words.literal))
                if key is None or not n:
                    continue
                keys = np.array([key], np.int64)
                yield _batch(keys, words, windows(words, n), n)
                if words.kind[0] in (0, 3):
                    kind = words.kind.copy()
                    kind[0] = 3 - kind[0]
                    turned = Words(words.literal, np.where(kind > 0, _SLOTS[kind], words.literal), kind, words.text)
                    places, families, h = windows(turned, n)
                    at = (places == 0) & (families == 1)
                    yield _batch(keys, turned, (places[at], families[at], h[at]), n)

    return items.select(F.col(id_col).cast("bigint"), text).mapInArrow(run, _ROWS)


def bloom(found: DataFrame) -> np.ndarray:
    """Filter of the windows' hashes as 64-bit words, sized by their number; what reaches the driver is bounded by its size."""
    n = found.count()
    bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << (_BITS_PER_WINDOW * n).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view("u8")
            at = np.unique(np.concatenate([_bit(h, i, bits) for i in range(_PROBES)]))
            words, first = np.unique(at >> 6, return_index=True)
            masks = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(masks.view("i8"))], names=["word", "mask"])

    set_ = found.select("hash").mapInArrow(place, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    words = set_.toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy().view("u8")
    return out


def _held(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (filter_[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


def document_windows(docs: DataFrame, widths: Sequence[int], filter_: np.ndarray, id_col: str, text: str) -> DataFrame:
    """Windows of documents that the filter lets through; those below ``SHORTEST`` words are whole documents."""
    shared, bits = docs.sparkSession.sparkContext.broadcast(filter_), len(filter_) << 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            ids = batch.column(0)
            keys, texts = ids.fill_null(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            for a, b in pieces(texts):
                words = words_of_texts([t if k else None for t, k in zip(texts[a:b], known[a:b])])
                for n in widths:
                    places, families, h = windows(words, n)
                    may = np.arange(len(h))
                    if n < SHORTEST:
                        sizes = np.bincount(words.text, minlength=b - a)
                        may = may[sizes[words.text[places]] == n]
                    for i in range(_PROBES):
                        may = may[_held(held, _bit(h[may], i, bits))]
                    if len(may):
                        yield _batch(keys[a:b], words, (places[may], families[may], h[may]), n)

    return docs.select(F.col(id_col).cast("bigint"), text).mapInArrow(run, _ROWS)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, item_id, n_literal, n_template)``: windows of each document that match each item."""
    known = stage(item_windows(items.select("item_id", "text")), "windows")
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())  # WINDOW at most
    # Staged, since both kinds of windows are looked at and texts should be read once.
    found = stage(document_windows(docs, widths, bloom(known), id_col, text), "met")
    right = known.select(
        F.col("id").alias("item_id"), F.col("start").alias("item_start"), "family", "width", "hash", F.col("slots").alias("item_slots")
    )
    met = found.join(right, ["family", "width", "hash"])
    literal = met.filter(F.col("family") == 0).groupBy("id", "item_id").agg(F.count(F.lit(1)).alias("n_literal"))
    # Windows of one alignment are judged together; they are no more than the item has words.
    aligned = (
        met.filter((F.col("family") == 1) & (F.size("slots") == F.size("item_slots")))
        .groupBy("id", "item_id", (F.col("start") - F.col("item_start")).alias("shift"))
        .agg(F.count(F.lit(1)).alias("n"), F.flatten(F.collect_set(F.arrays_zip("slots", "item_slots"))).alias("pairs"))
    )
    # As many pairs of values as values on either side: each value stands for one other.
    pairs = F.size(F.array_distinct("pairs"))
    same = (F.size(F.array_distinct("pairs.slots")) == pairs) & (F.size(F.array_distinct("pairs.item_slots")) == pairs)
    template = aligned.filter(same).groupBy("id", "item_id").agg(F.sum("n").alias("n_template"))
    return literal.join(template, ["id", "item_id"], "full").select(
        F.col("id").alias(id_col),
        "item_id",
        F.coalesce("n_literal", F.lit(0)).cast("bigint").alias("n_literal"),
        F.coalesce("n_template", F.lit(0)).cast("bigint").alias("n_template"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that match an item. Columns stay; rows without an id stay."""
    bad = fresh(docs, "__bad")
    found = matches(docs, items, id_col, text).select(F.col(id_col).alias(bad)).distinct()
    return docs.join(found, docs[id_col] == F.col(bad), "left_anti")


def op6(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that match."""
    return matches(docs, items)
