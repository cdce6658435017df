"""Packing token lists into sequences of one fixed length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.operators.dense import dense_vocabulary
from corpusprep.operators.lookup import BROADCAST_BYTES
from corpusprep.operators.order import _BUCKET, running
from corpusprep.operators.tokens import to_ids


_TOKEN_BYTES = 16
DOCS_PER_BUCKET = 20_000  # rows here are whole texts, so buckets hold fewer of them


def _place(
    df: DataFrame, order: Sequence[str | Column], ids: Column, bucket: Column | None, count: Column | None = None
) -> DataFrame:
    """``__ids`` of each row with ``__at``, their offset in the whole stream, and the span of the row's bucket.

    ``count`` may say more cheaply how many ids there are.
    """
    return running(
        df,
        order,
        {"__at": (F.size("__ids") if count is None else count).cast("bigint")},
        bucket=bucket,
        span="__at",
        derive={"__ids": ids},
        rows_per_bucket=DOCS_PER_BUCKET,
    ).select(_BUCKET, "__low", "__high", "__at", "__ids")


def _cut(placed: DataFrame, length: int) -> DataFrame:
    """One row ``(…, seq_id, at, ids)`` for each sequence that a row's tokens reach into."""
    at, n, tokens = F.col("__at"), F.size("__ids").cast("bigint"), F.col("__ids")
    first, last = F.floor(at / length), F.floor((at + n - 1) / length)

    def piece(seq: Column) -> Column:
        begin = F.greatest(seq * length - at, F.lit(0))
        end = F.least((seq + 1) * length - at, n)
        return F.struct(
            seq.alias("seq_id"),
            (at + begin).alias("at"),
            F.slice(tokens, (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids"),
        )

    cuts = F.when(n > 0, F.transform(F.sequence(first, last), piece))
    return placed.select(_BUCKET, "__low", "__high", F.explode(cuts).alias("p")).select("*", "p.*").drop("p")


def _join(pieces: DataFrame, keys: Sequence[str], length: int) -> DataFrame:
    """Pieces of a sequence laid end to end; a group holds at most one sequence of tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("at", "ids")))
    whole = pieces.groupBy(*keys).agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
    return whole.filter(F.size("ids") == length).select("seq_id", "ids")


def _assemble(placed: DataFrame, length: int, look_up=lambda pieces: pieces) -> DataFrame:
    """Sequences from placed rows.

    Sequences inside a bucket are joined where the bucket lies, which moves no
    rows. Only the pieces of sequences that cross a bucket edge, at most two
    sequences for each bucket, meet across the cluster.
    """
    begin, end = F.col("seq_id") * length, (F.col("seq_id") + 1) * length
    across = (begin < F.col("__low")) | (end > F.col("__high"))
    inner_low = F.ceil(F.col("__low") / length) * length
    inner_high = F.floor(F.col("__high") / length) * length
    near_edge = (F.col("__at") < inner_low) | (F.col("__at") + F.size("__ids") > inner_high)

    inside = look_up(_cut(placed, length).filter(~across))
    edges = look_up(_cut(placed.filter(near_edge), length).filter(across))
    return _join(inside, [_BUCKET, "seq_id"], length).unionByName(_join(edges, ["seq_id"], length))


def pack(
    df: DataFrame, order: Sequence[str | Column], ids: Column, length: int, bucket: Column | None = None
) -> DataFrame:
    """``(seq_id, ids)``: the token arrays of all rows in order, cut every ``length`` tokens.

    ``ids`` may be any array expression, such as the tokenization of a text.
    What does not fill a row's last sequence is carried to the next row; the
    final incomplete sequence is dropped.
    """
    return _assemble(_place(df, order, ids, bucket), length)


def pack_tokens(
    df: DataFrame,
    order: Sequence[str | Column],
    tokens: Column,
    vocab: DataFrame,
    length: int,
    bucket: Column | None = None,
    bound: int | None = None,
) -> DataFrame:
    """``pack`` of token strings, looked up in ``vocab`` on the way.

    A vocabulary that every worker can hold turns whole arrays into ids where
    they lie. A larger one is joined, with a row for each token of a piece.
    ``bound`` says how many tokens the vocabulary has at most, if that is known.
    """
    known = bound is not None and bound * _TOKEN_BYTES > BROADCAST_BYTES
    table = None if known else dense_vocabulary(vocab)
    if table is not None:
        return _assemble(_place(df, order, table.encode(tokens), bucket, F.size(tokens)), length)

    def look_up(pieces: DataFrame) -> DataFrame:
        long = pieces.select(_BUCKET, "seq_id", "at", F.posexplode("ids").alias("k", "token"))
        found = to_ids(long, vocab, bound=bound)
        return found.select(_BUCKET, "seq_id", (F.col("at") + F.col("k")).alias("at"), F.array("id").alias("ids"))

    return _assemble(_place(df, order, tokens, bucket), length, look_up)
