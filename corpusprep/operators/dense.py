"""Vocabularies as dense tables: whole arrays of tokens to ids and back, without a row per token."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.operators.lookup import BROADCAST_BYTES, UNBOUNDED
from corpusprep.operators.tokens import EOS, EOS_ID, UNK_ID, decode, to_ids
from corpusprep.session import stage

_HEAD_BYTES = BROADCAST_BYTES // 2  # of a vocabulary that is not sent as a whole: the ids that are
_GAPS = "struct<runs: array<string>, missing: array<string>>"


def _lists(like: pa.Array, values: pa.Array) -> pa.Array:
    """``values`` in lists as long as those of ``like``, null where ``like`` is."""
    sizes = pc.fill_null(pc.list_value_length(like), 0)
    ends = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes.cast(pa.int32()))])
    mask = pc.is_null(like) if like.null_count else None
    return pa.ListArray.from_arrays(ends, values, mask=mask)


def _places(flat: pa.Array, words: pa.Array) -> pa.Array:
    """``index_in`` for more words than tokens: the words are looked up among the tokens; 0 where there is none."""
    coded = flat.dictionary_encode()
    found = pc.index_in(words, value_set=coded.dictionary, skip_nulls=True)
    places = np.zeros(len(coded.dictionary) + 1, np.int32)
    places[np.asarray(found.drop_null())] = np.flatnonzero(np.asarray(pc.is_valid(found)))
    return pa.array(places[np.asarray(pc.fill_null(coded.indices, len(coded.dictionary)))], pa.int32())


def _ends(counts: np.ndarray) -> pa.Array:
    """Offsets of lists of these sizes."""
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


@dataclass(frozen=True)
class DenseVocabulary:
    """Tokens at the place of their id; sent once to each worker."""

    tokens: Broadcast

    def encode(self, tokens: Column, eos: str = EOS) -> Column:
        """Ids of an array of tokens; unknown ones get the unknown id."""
        shared = self.tokens

        @F.arrow_udf("array<int>")
        def run(lists: pa.Array) -> pa.Array:
            flat = lists.flatten()
            found = pc.fill_null(pc.index_in(flat, value_set=shared.value), UNK_ID)
            return _lists(lists, pc.if_else(pc.fill_null(pc.equal(flat, eos), False), pa.scalar(EOS_ID, pa.int32()), found))

        return run(tokens)

    def gaps(self, tokens: Column, eos: str = EOS) -> Column:
        """An array of tokens to ids and back, as far as the tokens are known here.

        ``missing`` has the tokens that are not, ``runs`` the text before, between
        and after them: one more, null where there is none. Without a missing
        token the one run is the whole text.
        """
        shared = self.tokens

        @F.arrow_udf(_GAPS)
        def run(lists: pa.Array) -> pa.Array:
            words, flat = shared.value, lists.flatten()
            is_eos = pc.fill_null(pc.equal(flat, eos), False)
            ids = pc.if_else(is_eos, pa.scalar(EOS_ID, pa.int32()), _places(flat, words))
            unknown = np.asarray(pc.and_(pc.equal(ids, UNK_ID), pc.is_valid(flat)))
            named = words.take(pc.if_else(pc.less(ids, len(words)), ids, pa.scalar(None, pa.int32())))
            kept = np.asarray(pc.is_valid(named)) & ~unknown
            rows = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            # Every row starts a run, and so does every missing token.
            place = rows + np.cumsum(unknown)
            sizes = np.bincount(place[kept], minlength=len(lists) + int(unknown.sum()))
            texts = pc.binary_join(pa.ListArray.from_arrays(_ends(sizes), named.filter(pa.array(kept))), " ")
            runs = pc.if_else(pa.array(sizes > 0), texts, pa.scalar(None, pa.string()))
            away = np.bincount(rows[unknown], minlength=len(lists))
            mask = pc.is_null(lists)
            parts = [
                pa.ListArray.from_arrays(_ends(away + 1), runs, mask=mask),
                pa.ListArray.from_arrays(_ends(away), flat.filter(pa.array(unknown)), mask=mask),
            ]
            return pa.StructArray.from_arrays(parts, names=["runs", "missing"])

        return run(tokens)

    def decode(self, ids: Column) -> Column:
        """Text of an array of ids, words parted by blanks; ids of special tokens and beyond the vocabulary are skipped."""
        shared = self.tokens

        @F.arrow_udf("string")
        def run(lists: pa.Array) -> pa.Array:
            words = shared.value
            flat = lists.flatten().cast(pa.int64())
            inside = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(words)))
            named = words.take(pc.if_else(pc.fill_null(inside, False), flat, UNK_ID))
            kept = pc.is_valid(named)
            # What is skipped leaves its list: count what stays in each.
            counted = _lists(lists, kept.cast(pa.int32()))
            ends = pc.cumulative_sum(counted.flatten())
            stop = pc.cumulative_sum(pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32()))
            total = pa.concat_arrays([pa.array([0], pa.int32()), ends])
            offsets = pa.concat_arrays([pa.array([0], pa.int32()), total.take(stop)])
            text = pc.binary_join(pa.ListArray.from_arrays(offsets, named.filter(kept)), " ")
            return pc.if_else(pc.is_valid(lists), text, pa.scalar(None, pa.string()))

        return run(ids)


def _collected(vocab: DataFrame, top: int | None) -> DenseVocabulary:
    if top is None:
        table = pa.array([], pa.string())
    else:
        found = vocab.select("token", F.col("id").cast("int").alias("id")).toArrow().combine_chunks()
        places = pc.index_in(pa.array(range(top + 1), pa.int32()), value_set=found["id"].combine_chunks())
        table = found["token"].combine_chunks().take(places).cast(pa.string())
    return DenseVocabulary(vocab.sparkSession.sparkContext.broadcast(table))


def dense_vocabulary(vocab: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DenseVocabulary | None:
    """The dense form of ``(token, id)``, or None when it is too large to send to every worker.

    Its size is measured before anything is collected. Ids that no token has
    stay empty, the special ones among them.
    """
    size = vocab.agg(F.sum(F.octet_length("token") + 8).alias("bytes"), F.max("id").alias("top")).first()
    if size["top"] is not None and size["bytes"] + 4 * size["top"] > most_bytes:
        return None
    return _collected(vocab, size["top"])


def dense_head(vocab: DataFrame, most_bytes: int = _HEAD_BYTES) -> tuple[DenseVocabulary, int]:
    """The dense form of the ids below a cut, and the cut: as many as ``most_bytes`` hold, by blocks of ids."""
    block = max(1, most_bytes >> 10)
    by_block = vocab.groupBy(F.floor(F.col("id") / block).alias("b"))
    cut = held = 0
    top = None
    # A row for each block; ids are of type int, so the blocks are few.
    for r in sorted(by_block.agg(F.sum(F.octet_length("token") + 8).alias("bytes"), F.max("id").alias("top")).collect()):
        held += r["bytes"]
        if held + 4 * r["top"] > most_bytes:
            break
        cut, top = r["top"] + 1, r["top"]
    return _collected(vocab.filter(F.col("id") < cut), top), cut


def recode(df: DataFrame, tokens: Column, vocab: DataFrame, most_bytes: int = _HEAD_BYTES) -> DataFrame:
    """Add ``text``: each array of tokens to ids and back by a vocabulary too large to send to every worker.

    The ids below a cut, nearly all tokens if ids follow the count, are worked
    out where the rows lie, in one pass that stages its result. Of the others
    the tokens alone are shuffled to the rest of the vocabulary, and the words
    they come back as meet the text around them. Equal rows stay apart.
    """
    head, cut = dense_head(vocab, most_bytes)
    parts = df.select(*df.columns, head.gaps(tokens).alias("__parts")).select(*df.columns, "__parts.*")
    staged = stage(parts.withColumn("__row", F.monotonically_increasing_id()), "gaps", "zstd")
    is_away = F.coalesce(F.size("missing") > 0, F.lit(False))
    near, away = staged.filter(~is_away), staged.filter(is_away)
    rest = vocab.filter(F.col("id") >= cut)
    rare = away.select("__row", F.posexplode("missing").alias("pos", "token"))
    ids = stage(to_ids(rare, rest, bound=UNBOUNDED, rare=True), "gap_ids")
    filled = decode(ids, rest, ["__row"], "pos", UNBOUNDED, away.select(*df.columns, "runs", "__row"))
    whole = near.select(*df.columns, F.array_join("runs", " ").alias("text"))
    return whole.unionByName(filled.drop("__row"))
