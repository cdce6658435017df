"""Tokens, vocabularies, encoding and decoding."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusprep.functions.schedule import pad_amount
from corpusprep.functions.text import is_blank, words
from corpusprep.operators.lookup import BROADCAST_BYTES, UNBOUNDED, lookup_join
from corpusprep.operators.order import ranged_index
from corpusprep.session import stage

# The special tokens come first in every vocabulary.
UNK, EOS = "<unk>", "<eos>"
UNK_ID, EOS_ID = 0, 1
FIRST_ID = 2
_ENTRY_BYTES = 64
_HEAD_ROWS = 1 << 18  # of a vocabulary, sent at most: each executor hashes them by their text, in several times its size


def append_eos(ids: Column, eos) -> Column:
    """The ids of a line, closed by the end-of-sequence id."""
    return F.concat(ids, F.array(F.lit(eos)))


def text_tokens(text: Column, eos: str = EOS) -> Column:
    """Word tokens of a whole text; every non-blank line ends in ``eos``."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: ~is_blank(line))
    return F.flatten(F.transform(lines, lambda line: append_eos(words(line), eos)))


def count_tokens(df: DataFrame, tokens: Column) -> DataFrame:
    """``(token, n)`` over all rows."""
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(counts: DataFrame, max_size: int | None = None) -> DataFrame:
    """``(token, id, n)`` ranked by count, then by token; ids start after the specials.

    With ``max_size`` the head is found by a distributed top-k. Without it the
    ranking is spread over range partitions.
    """
    order = [F.desc("n"), F.asc("token")]
    if max_size is None:
        ranked = ranged_index(counts, order, "rank")
    else:
        top = counts.orderBy(*order).limit(max_size)
        # At most ``max_size`` rows are left.
        ranked = top.withColumn("rank", F.row_number().over(W.orderBy(*order)) - 1)
    return ranked.select("token", (F.col("rank") + FIRST_ID).cast("int").alias("id"), "n")


def special_ids(vocab: DataFrame, eos: str = EOS, pad: str = "<pad>") -> DataFrame:
    """One row ``(eos_id, pad_id)``; a vocabulary without ``pad`` pads with ``eos``."""
    found = vocab.filter(F.col("token").isin(eos, pad)).agg(
        F.max(F.when(F.col("token") == eos, F.col("id"))).alias("eos_id"),
        F.max(F.when(F.col("token") == pad, F.col("id"))).alias("pad_id"),
    )
    return found.withColumn("pad_id", F.coalesce("pad_id", "eos_id"))


def pad_vocab(vocab: DataFrame, multiple: int) -> DataFrame:
    """``(token, id)`` with ``<pad_i>`` entries until all ids, the special ones included, are a multiple of ``multiple``."""
    top = F.coalesce(vocab.agg(F.max("id")).scalar(), F.lit(FIRST_ID - 1))
    pads = vocab.sparkSession.range(multiple).filter(F.col("id") < pad_amount(top + 1, multiple))
    return vocab.select("token", "id").unionByName(
        pads.select(
            F.format_string("<pad_%d>", F.col("id")).alias("token"),
            (top + 1 + F.col("id")).cast("int").alias("id"),
        )
    )


def to_ids(tokens: DataFrame, vocab: DataFrame, eos: str = EOS, bound: int | None = None, rare: bool = False) -> DataFrame:
    """Replace the ``token`` column by its ``id``; unknown tokens get the unknown id.

    A vocabulary too large to broadcast is parted by id, which follows the
    count: nearly all rows find their token in its head, where they lie; only
    the others are staged and shuffled to the rest. The head is of one size
    however large the vocabulary is. With ``rare`` the caller knows that all
    rows are such others.
    """
    table = vocab.select("token", F.col("id").alias("__id"))
    kept = [c for c in tokens.columns if c != "token"]
    is_eos = F.col("token") == eos
    known = F.when(is_eos, F.lit(EOS_ID)).otherwise(F.coalesce("__id", F.lit(UNK_ID))).alias("id")
    most = min(BROADCAST_BYTES // _ENTRY_BYTES, _HEAD_ROWS)
    if (table.limit(most + 1).count() if bound is None else bound) <= most:
        return tokens.join(F.broadcast(table), "token", "left").select(*kept, known)
    if rare:
        return lookup_join(tokens, table, "token", bound=bound).select(*kept, known)
    in_head = F.coalesce(F.col("__id").between(0, most - 1), F.lit(False))
    near = tokens.join(F.broadcast(table.filter(in_head)), "token", "left")
    found = F.col("__id").isNotNull() | F.coalesce(is_eos, F.lit(False))
    # Read for their hot keys and for the join.
    others = stage(near.filter(~found).drop("__id"), "rare_tokens")
    away = lookup_join(others, table.filter(~in_head), "token", bound=UNBOUNDED)
    return near.filter(found).select(*kept, known).unionByName(away.select(*kept, known))


def decode(
    ids: DataFrame, vocab: DataFrame, by: list[str], pos: str, bound: int | None = None, around: DataFrame | None = None
) -> DataFrame:
    """Text of each ``by`` group of ``(pos, id)`` rows, special ids skipped.

    A group is one line or one sequence, so it is small; groups that hold
    special ids only come out as empty texts. ``around`` has one row per group,
    with ``runs``: the texts before, between and after the group's words, null
    where there is none. Its other columns are kept.
    """
    named = lookup_join(ids, vocab.select("id", "token"), "id", bound=bound)
    pieces = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("at"), F.col("token").alias("word"))))
    # Null for a special id, which leaves its place and is not joined.
    words = F.transform(pieces, lambda p: p["word"])
    if around is None:
        return named.groupBy(*by).agg(F.array_join(words, " ").alias("text"))
    both = around.join(named.groupBy(*by).agg(words.alias("__words")), by)
    between = F.flatten(F.zip_with("runs", "__words", lambda run, word: F.array(run, word)))
    return both.select(*[c for c in around.columns if c != "runs"], F.array_join(between, " ").alias("text"))


def text_delta(df: DataFrame, by: list[str], step: str, text: str = "text") -> DataFrame:
    """``delta``: what each step's text adds to the step before.

    ``by`` names one generation, whose steps are few.
    """
    before = F.lag(text).over(W.partitionBy(*by).orderBy(step))
    return df.withColumn("delta", F.substr(F.col(text), F.coalesce(F.length(before), F.lit(0)) + 1))


class Tokenizer(Protocol):
    """What a user's tokenizer must offer. It is pickled to the workers."""

    eos_id: int

    def load(self) -> None:
        """Called once per task before the first batch."""

    def encode_batch(self, texts: list[str]) -> list[list[int]]: ...

    def decode_batch(self, ids: list[list[int]]) -> list[str]: ...


class JsonTokenizer:
    """A trained tokenizer in the ``tokenizers`` JSON format; a missing pad token falls back to ``eos``."""

    def __init__(self, text: str, eos: str = EOS, pad: str = "<pad>"):
        self.text, self._inner = text, None
        self.load()
        self.eos_id = self._inner.token_to_id(eos)
        pad_id = self._inner.token_to_id(pad)
        self.pad_id = self.eos_id if pad_id is None else pad_id
        self.vocab_size = self._inner.get_vocab_size()

    @classmethod
    def open(cls, path: str, fallback: str | None = None, **tokens: str) -> JsonTokenizer:
        """From a file, or from the ``fallback`` file when the first cannot be read."""
        try:
            with open(path, encoding="utf-8") as file:
                return cls(file.read(), **tokens)
        except OSError:
            if fallback is None:
                raise
            return cls.open(fallback, **tokens)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_inner": None}

    def load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        from tokenizers import Tokenizer as Inner

        self._inner = self._inner or Inner.from_str(self.text)

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._inner.encode_batch(texts, add_special_tokens=False)]

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        return self._inner.decode_batch(ids, skip_special_tokens=True)


def _where_present(rows: pd.Series, run: Callable[[list], list]) -> pd.Series:
    """``run`` over the rows that are not null; null rows stay null."""
    out = pd.Series([None] * len(rows), index=rows.index, dtype=object)
    present = rows.notna()
    kept = rows[present].tolist()
    if kept:
        out[present] = pd.Series(run(kept), index=rows.index[present], dtype=object)
    return out


def encode_with(tokenizer: Tokenizer, text: Column) -> Column:
    """Ids of a text column by a user's tokenizer, without special tokens."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer.load()
        for texts in batches:
            yield _where_present(texts, tokenizer.encode_batch)

    return run(text)


def decode_with(tokenizer: Tokenizer, ids: Column) -> Column:
    """Text of an id-array column by a user's tokenizer."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer.load()
        for rows in batches:
            yield _where_present(rows, lambda kept: tokenizer.decode_batch([[int(i) for i in row] for row in kept]))

    return run(ids)
