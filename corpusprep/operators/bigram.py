"""A next-token model by smoothed pair counts: fitting, scoring, generating."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.functions.arrays import inputs_of, labels_of, search_sorted, stop_at_eos
from corpusprep.functions.sampling import uniform
from corpusprep.operators.lookup import BROADCAST_BYTES, UNBOUNDED, lookup_join
from corpusprep.operators.order import running
from corpusprep.session import stage

STEPS_PER_STAGE = 10
HOT_SHARE = 1_000  # a token is hot when it makes up more than 1 in so many
LEAST_CHUNKS = 16
CHUNK_SIZE = 256
FOLLOWER_BYTES = 40
_KEY_BYTES = 64


def pair_counts(df: DataFrame, ids: Column, ends: bool = False) -> DataFrame:
    """``(prev, next, n)`` over all neighbouring tokens of a row.

    With ``ends`` the last token of a row with pairs comes with a null after
    it too, which adds nothing to ``n``: every token is then a ``prev``, and
    what only ends rows has ``n`` 0.
    """
    rows = df.select(ids.alias("__ids"))
    labels = labels_of(F.col("__ids"))
    if not ends:
        pairs = rows.select(F.inline(F.arrays_zip(inputs_of(F.col("__ids")), labels)).alias("prev", "next"))
        return pairs.groupBy("prev", "next").agg(F.count(F.lit(1)).alias("n"))
    # The shorter arrays end in nulls. A filter would make the tokens twice.
    counted = F.array_repeat(F.lit(1), F.size("__ids") - 1)
    zipped = F.when(F.size("__ids") > 1, F.arrays_zip("__ids", labels, counted))
    pairs = rows.select(F.inline(zipped).alias("prev", "next", "counted"))
    return pairs.groupBy("prev", "next").agg(F.count("counted").alias("n"))


@dataclass
class Bigram:
    """Pair counts, context totals and the number of distinct tokens."""

    pairs: DataFrame
    contexts: DataFrame
    vocab_size: Column


def fit_bigram(df: DataFrame, ids: Column) -> Bigram:
    """Add-one smoothed next-token model of the token rows."""
    # Each token is a ``prev`` here: one pass over the pairs gives the totals and the tokens.
    pairs = stage(pair_counts(df, ids, ends=True), "pairs")
    tokens = stage(pairs.groupBy("prev").agg(F.sum("n").alias("total")), "contexts")
    size = tokens.agg(F.count(F.lit(1))).scalar()
    return Bigram(pairs.filter("n > 0"), tokens.filter("total > 0"), size)


def bigram_table(model: Bigram) -> DataFrame:
    """``(prev, next, n, total, logprob)`` of every pair seen in training."""
    joined = lookup_join(model.pairs, model.contexts, "prev", "inner")
    prob = (F.col("n") + 1) / (F.col("total") + model.vocab_size)
    return joined.withColumn("logprob", F.log(prob))


def score_bigram(df: DataFrame, ids: Column, model: Bigram) -> DataFrame:
    """Token count, mean loss and perplexity of held-out token rows, one row.

    Held-out pairs are counted first, so the first join sees each pair once.
    Pairs that share their first token and their count have one loss, so the
    second join sees each count once. The counts of a token are different
    numbers that add up to its total, so they are few and no token is hot.
    """
    held = pair_counts(df, ids).withColumnRenamed("n", "seen")
    met = held.join(model.pairs, ["prev", "next"], "left").groupBy("prev", "n").agg(F.sum("seen").alias("seen"))
    known = stage(met, "known")
    placed = lookup_join(known, model.contexts, "prev", bound=UNBOUNDED, skewed=False)
    prob = (F.coalesce("n", F.lit(0)) + 1) / (F.coalesce("total", F.lit(0)) + model.vocab_size)
    return (
        placed.withColumn("loss", -F.log(prob))
        .agg(
            F.sum("seen").alias("tokens"),
            (F.sum(F.col("seen") * F.col("loss")) / F.sum("seen")).alias("loss"),
        )
        .withColumn("perplexity", F.exp("loss"))
    )


def successors(pairs: DataFrame) -> DataFrame:
    """``(prev, next)``: the most frequent follower, the smallest one on ties."""
    return pairs.groupBy("prev").agg(F.min_by("next", F.struct(-F.col("n"), F.col("next"))).alias("next"))


def greedy_paths(pairs: DataFrame, n: int) -> DataFrame:
    """``(state, path)``: the ``n`` tokens that follow each token (fewer at a dead end).

    Paths are doubled: one self-join turns paths of k tokens into paths of 2k.
    The work depends on the vocabulary only, not on how many prompts there are.
    """
    paths = stage(successors(pairs).select(F.col("prev").alias("state"), F.array("next").alias("path")), "paths")
    states = paths.count()
    reach = 1
    while reach < n:
        more = paths.select(F.col("state").alias("__end"), F.col("path").alias("__more"))
        ends = paths.withColumn("__end", F.element_at("path", -1))
        grown = lookup_join(ends, more, "__end", bound=states, row_bytes=64 + 16 * reach).select(
            "state", F.when(F.col("__more").isNull(), F.col("path")).otherwise(F.concat("path", "__more")).alias("path")
        )
        reach *= 2
        paths = stage(grown, "paths")
    return paths.select("state", F.slice("path", 1, n).alias("path"))


def generate_greedy(prompts: DataFrame, ids: Column, pairs: DataFrame, n: int, eos) -> DataFrame:
    """Adds ``generated``: up to ``n`` tokens after the last one of ``ids``, through the first ``eos``."""
    paths = greedy_paths(pairs, n)
    asked = prompts.withColumn("state", F.try_element_at(ids, F.lit(-1)))
    path = stop_at_eos(F.col("path"), F.lit(eos), n)
    nothing = F.array().cast(paths.schema["path"].dataType)
    return (
        lookup_join(asked, paths, "state", row_bytes=64 + 16 * n)
        .withColumn("generated", F.coalesce(path, nothing))
        .drop("state", "path")
    )


def draw_tables(pairs: DataFrame, temperature: float) -> tuple[DataFrame, DataFrame]:
    """``(state, total, chunks)`` and ``(state, chunk, nexts, edges)``.

    The followers of a token lie end to end, each as long as its weight, and
    that line is cut into equally long chunks. A draw lands in every chunk
    equally often, so the chunks spread a token that many draws start from;
    tokens that are frequent get several even when few tokens follow them. The
    line of a token with very many followers is laid in several range partitions.
    """
    weighted = pairs.select(
        F.col("prev").alias("state"), "next", "n", F.pow("n", F.lit(1.0 / temperature)).alias("weight")
    )
    laid = stage(running(weighted, ["next"], {"low": F.col("weight")}, by=["state"]), "edges")
    edges = laid.select("state", "next", "n", (F.col("low") + F.col("weight")).alias("edge"), "low")
    hot = F.sum("n") * HOT_SHARE > pairs.agg(F.sum("n")).scalar()
    spread = F.when(hot, LEAST_CHUNKS).otherwise(1)
    states = edges.groupBy("state").agg(
        F.max("edge").alias("total"),
        F.greatest(spread, F.ceil(F.count(F.lit(1)) / CHUNK_SIZE).cast("int")).alias("chunks"),
    )
    placed = lookup_join(edges, states, "state", "inner")
    cover = F.sequence(chunk_of(F.col("low")), chunk_of(F.col("edge")))
    rows = F.array_sort(F.collect_list(F.struct("edge", "next")))
    chunks = (
        placed.select("state", "next", "edge", F.explode(cover).alias("chunk"))
        .groupBy("state", "chunk")
        .agg(rows.alias("rows"))
        .select("state", "chunk", F.col("rows.next").alias("nexts"), F.col("rows.edge").alias("edges"))
    )
    return states, chunks


def chunk_of(target: Column) -> Column:
    return F.least(F.floor(target / (F.col("total") / F.col("chunks"))), F.col("chunks") - 1).cast("int")


def _asked(chunks: DataFrame, aimed: DataFrame) -> DataFrame:
    """The chunks that ``aimed`` draws from; all of them when those are too many to name."""
    asked = aimed.filter(F.col("chunk").isNotNull()).select("state", "chunk").distinct()
    most = BROADCAST_BYTES // _KEY_BYTES
    if asked.limit(most + 1).count() > most:
        return chunks
    return chunks.join(F.broadcast(asked), ["state", "chunk"], "left_semi")


def generate_sampled(
    prompts: DataFrame, key: str, ids: Column, pairs: DataFrame, n: int, eos, temperature: float, seed: int
) -> DataFrame:
    """Like :func:`generate_greedy` with a fresh categorical draw per token.

    Prompts advance together, one join per token; lineage is cut by a staged
    table every few tokens. Where the tables are too large to broadcast, a
    join looks at its rows more than once, so each token's rows are staged, and
    only the chunks that some prompt draws from are moved.
    """
    states, chunks = (stage(table, "draws") for table in draw_tables(pairs, temperature))
    n_states = states.count()
    n_followers = chunks.agg(F.coalesce(F.sum(F.size("nexts")), F.lit(0))).first()[0]
    fits = n_followers * FOLLOWER_BYTES <= BROADCAST_BYTES
    small = fits and n_states <= BROADCAST_BYTES // _KEY_BYTES
    kind = chunks.schema["nexts"].dataType
    state = prompts.select(
        key, F.try_element_at(ids, F.lit(-1)).alias("state"), F.array().cast(kind).alias("generated")
    )
    for step in range(n):
        aimed = lookup_join(state, states, "state", bound=n_states)
        aimed = aimed.withColumn("target", uniform(seed, F.lit(step), F.col(key)) * F.col("total"))
        aimed = aimed.withColumn("chunk", chunk_of(F.col("target")))
        if not fits:
            aimed = stage(aimed, "aimed")
        joined = aimed.join(F.broadcast(chunks) if fits else _asked(chunks, aimed), ["state", "chunk"], "left")
        drawn = F.get("nexts", F.least(search_sorted(F.col("edges"), F.col("target")), F.size("nexts") - 1))
        taken = joined.withColumn("__next", drawn)
        state = taken.select(
            key,
            F.when(F.col("__next") != F.lit(eos), F.col("__next")).alias("state"),
            F.when(F.col("__next").isNull(), F.col("generated"))
            .otherwise(F.concat("generated", F.array("__next")))
            .alias("generated"),
        )
        if not small or (step + 1) % STEPS_PER_STAGE == 0:
            state = stage(state, "generated")
    return state.select(key, "generated")
