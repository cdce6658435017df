"""From raw or pre-tokenized files to sharded training batches on disk."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusprep.operators.batch import accum_groups, assign_shards, batch_at, estimate_steps, plan_steps
from corpusprep.operators.shuffle import BUFFER, block_shuffle, repeat_epochs, shuffle
from corpusprep.operators.split import TRAIN_SHARE
from corpusprep.session import stage
from corpusprep.sources.corpus import pack_corpus, read_corpus, split_corpus
from corpusprep.sources.packed import write_packed


@dataclass(frozen=True)
class PrepareConfig:
    """Sizes of the prepared data; the defaults suit a small model."""

    seq_len: int = 1024
    batch_size: int = 256
    shards: int = 8
    grad_accum: int = 8
    train_share: float = TRAIN_SHARE
    shuffle_buffer: int = BUFFER
    seed: int = 42


def prepare_text(spark: SparkSession, path: str, out: str, ids: Column, cfg: PrepareConfig = PrepareConfig()) -> None:
    """Split, pack, shuffle, batch and shard a text corpus, and write it to ``out``.

    ``ids`` tokenizes the ``line`` column, end-of-sequence id included. Training
    sequences are mixed within the shuffle buffer, validation ones keep their order.
    """
    lines = split_corpus(read_corpus(spark, path), cfg.train_share)
    parts = []
    for split in ("train", "val"):
        packed = stage(pack_corpus(lines.filter(F.col("split") == split), ids, cfg.seq_len), "packed")
        if split == "train":
            packed = block_shuffle(packed, "seq_id", cfg.seed, cfg.shuffle_buffer, out="pos")
        else:
            packed = packed.withColumn("pos", F.col("seq_id"))
        batched = assign_shards(batch_at(packed, "pos", cfg.batch_size), cfg.batch_size, cfg.shards)
        parts.append(batched.withColumn("split", F.lit(split)))
    write_packed(parts[0].unionByName(parts[1]), out)


def prepare_pretokenized(
    df: DataFrame, ids: Sequence[str], cfg: PrepareConfig = PrepareConfig(), epoch: int = 0
) -> DataFrame:
    """One epoch of loader order over pre-sliced sequences: shuffle, batch, group into steps.

    ``ids`` identify a sequence. Adds ``batch_id``, ``row_in_batch``,
    ``accum_step``, ``micro`` and ``complete``.
    """
    batched = batch_at(shuffle(df, ids, cfg.seed, epoch), "pos", cfg.batch_size).drop("pos")
    batches = F.floor(df.agg(F.count(F.lit(1))).scalar() / cfg.batch_size)
    return batched.withColumns(accum_groups(F.col("batch_id"), batches, cfg.grad_accum))


def plan_text(spark: SparkSession, path: str, cfg: PrepareConfig = PrepareConfig()) -> DataFrame:
    """Estimated tokens and steps of a text corpus, one row, from its bytes."""
    lines = read_corpus(spark, path).lines.select(F.concat("line", F.lit("\n")).alias("line"))
    return estimate_steps(lines, "line", cfg.seq_len, cfg.batch_size)


def plan_pretokenized(df: DataFrame, cfg: PrepareConfig = PrepareConfig(), epochs: int = 1, max_steps: int = 0) -> int:
    """Optimizer steps of a run over pre-sliced sequences; ``max_steps`` goes before ``epochs``."""
    return plan_steps(df, cfg.batch_size, cfg.grad_accum, epochs, max_steps).first()["total_steps"]


def prepare_run(
    df: DataFrame, ids: Sequence[str], cfg: PrepareConfig = PrepareConfig(), epochs: int = 1, max_steps: int = 0
) -> DataFrame:
    """All micro-batches of a run, epoch after epoch, until its planned optimizer steps are done.

    Adds ``epoch``, ``step`` (the micro-batch over all epochs), ``row_in_batch``,
    ``optimizer_step`` and ``micro``. With ``max_steps`` the data is repeated as often as that asks for.
    """
    batches = df.count() // cfg.batch_size
    if not batches:
        raise ValueError(f"fewer than {cfg.batch_size} sequences make no batch")
    due = plan_pretokenized(df, cfg, epochs, max_steps) * cfg.grad_accum
    needed = -(-due // batches) if max_steps > 0 else epochs
    rows = repeat_epochs(df, ids, cfg.batch_size, needed, due, cfg.seed)
    groups = accum_groups(F.col("step"), F.lit(due), cfg.grad_accum)
    return rows.withColumns({"optimizer_step": groups["accum_step"], "micro": groups["micro"]})
