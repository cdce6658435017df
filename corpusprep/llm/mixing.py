"""Mixing sources to target weights, as Column expressions and joins only.

1. **Targets.** Sources share a part of all words by weight; none takes more
   than ``repeats`` times what it has, and the excess goes to the others. The
   water level that this ends at is found from running sums over the sources.
2. **Blocks.** The documents of a source, in a seeded order, are cut into blocks
   of about ``block_words`` words. A source's supply is its blocks, permuted
   anew for each pass over them; it gives the block copies that begin below its
   target. In the last one, documents are taken while their middle lies below it.
3. **Quotas.** A tree over the shards splits the number of block copies of each
   source: a node of shards a to b gives its left half a multivariate
   hypergeometric draw of its own quotas, the right half keeps the rest. So each
   shard has an exact quota of each source, all shards are of equal size to one
   block, and the shards are what dealing out all copies at random would give.
4. **Draws.** A shard takes the next copies of each source's permutation, as
   many as its quota. Draws of shards are disjoint since the quotas add up.
5. **Local shuffle.** Rows are ordered inside their shard by a seeded digest.

All randomness is a digest of the seed and of what is drawn, so reruns agree.
Only the tree's nodes hold all sources in a row, 16 bytes each; no row, group or
task holds a source's documents. A hot source is many range partitions and
blocks.

Null and blank texts have size 0 and cost one unit of a block, so that a block
holds a bounded number of documents; they are in the mix when their block is.
Rows without an id are documents like others. Rows that share an id are ordered
by size; equal ones are exchangeable. A null source is a source of its own and
the last one. Sources without words have target 0. An empty table gives an
empty mix. Texts of any length are counted whole. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpusprep.functions.sampling import seeded_key, uniform
from corpusprep.llm.common import WORD, let
from corpusprep.operators.lookup import lookup_join
from corpusprep.operators.order import global_index, running
from corpusprep.session import stage

# Weights of sources in turn, words of the mix over all words, most copies of a document.
WEIGHTS = (3, 1, 2)
SHARE, REPEATS = 1.5, 2
SHARDS, BLOCK_WORDS, SEED = 24, 4096, 42
_TAIL = 12  # standard deviations; what lies beyond has a share below 1e-30


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """``(source, source_size, no, target)`` from ``(source, source_size)``; ``no`` counts sources in code point order."""
    numbered = stage(global_index(sizes, [F.col("source").asc_nulls_last()], out="no"), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    rows = numbered.withColumns({"weight": weight, "cap": (F.col("source_size") * repeats).cast("double")})
    # Sources reach their caps in this order as the level rises.
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    below = stage(running(rows, ["ratio", "no"], {"caps": F.col("cap"), "weights": F.col("weight")}), "levels")
    whole = below.agg(
        (F.sum("source_size") * F.lit(share)).alias("all"), F.sum("weight").alias("w")
    ).first()
    level = (F.lit(float(whole["all"] or 0)) - F.col("caps")) / (F.lit(float(whole["w"] or 1)) - F.col("weights"))
    found = below.agg(F.max(F.when(level <= F.col("ratio"), level)).alias("level")).first()["level"]
    target = F.col("cap") if found is None else F.least("cap", F.lit(found) * F.col("weight"))
    return below.select("source", "source_size", "no", target.alias("target"))


def hypergeometric(hits: Column, size: Column, draws: Column, u: Column) -> Column:
    """How many of ``hits`` special items are among ``draws`` of ``size`` drawn without putting back.

    Inverts the distribution function at ``u``: weights follow from the ratio
    of neighbouring probabilities, over all values within twelve standard
    deviations of the mean.
    """

    def drawn(a: Column) -> Column:
        k, n, m = (a[c].cast("double") for c in ("k", "n", "m"))
        share = k / F.greatest(n, F.lit(1.0))
        mean = m * share
        variance = mean * (F.lit(1.0) - share) * (n - m) / F.greatest(n - 1, F.lit(1.0))
        spread = F.sqrt(F.greatest(variance, F.lit(0.0))) * _TAIL + _TAIL
        low = F.greatest(F.lit(0.0), m - (n - k), F.floor(mean - spread).cast("double"))
        high = F.least(k, m, F.ceil(mean + spread).cast("double"))

        def ratio(x: Column) -> Column:
            """Probability of x + 1 over that of x."""
            return (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))

        def walk(r: Column) -> Column:
            steps = F.sequence(r["low"], r["high"])
            zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
            total = F.aggregate(
                steps,
                zero,
                lambda s, x: F.struct((s["w"] * ratio(x.cast("double"))).alias("w"), (s["sum"] + s["w"]).alias("sum")),
                lambda s: s["sum"],
            )

            def pick(aim: Column) -> Column:
                begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), r["low"].alias("at"))
                return F.aggregate(
                    steps,
                    begin,
                    lambda s, x: F.struct(
                        (s["w"] * ratio(x.cast("double"))).alias("w"),
                        (s["sum"] + s["w"]).alias("sum"),
                        F.when(s["sum"] <= aim, x).otherwise(s["at"]).alias("at"),
                    ),
                    lambda s: s["at"],
                )

            return let(total * u, pick)

        return let(F.struct(low.cast("bigint").alias("low"), high.cast("bigint").alias("high")), walk)

    return let(F.struct(hits.alias("k"), size.alias("n"), draws.alias("m")), drawn)


def _left_quotas(quotas: Column, draws: Column, seed: int, first: Column, last: Column) -> Column:
    """Multivariate hypergeometric draw: one source after the other, each from what is left of the draws."""
    size = F.aggregate(quotas, F.lit(0).cast("bigint"), lambda s, q: s + q["k"])

    def draw(n: Column) -> Column:
        def step(s: Column, q: Column) -> Column:
            x = hypergeometric(q["k"], s["n"], s["m"], uniform(seed, F.lit("split"), first, last, q["no"]))
            return let(
                x,
                lambda got: F.struct(
                    (s["n"] - q["k"]).alias("n"),
                    (s["m"] - got).alias("m"),
                    F.concat(s["out"], F.array(F.struct(q["no"].alias("no"), got.alias("k")))).alias("out"),
                ),
            )

        begin = F.struct(
            n.alias("n"), draws.cast("bigint").alias("m"), F.array().cast("array<struct<no:bigint,k:bigint>>").alias("out")
        )
        return F.aggregate(quotas, begin, step, lambda s: s["out"])

    return let(size, draw)


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``(shard, no, k)`` from the block copies ``(no, k)`` of each source: the leaves of the splitting tree."""
    all_ = F.array_sort(F.collect_list(F.struct(F.col("no").cast("bigint").alias("no"), F.col("k").cast("bigint").alias("k"))))
    total = F.sum("k")
    nodes = quotas.agg(all_.alias("quotas"), F.coalesce(total, F.lit(0)).alias("all")).select(
        F.lit(0).alias("first"), F.lit(shards).alias("last"), "quotas", "all"
    )

    def before(shard: Column) -> Column:
        return F.floor(shard.cast("bigint") * F.col("all") / shards)

    for _ in range((shards - 1).bit_length()):
        a, b = F.col("first"), F.col("last")
        middle = F.floor((a + b) / 2).cast("int")

        def halves(left: Column) -> Column:
            rest = F.zip_with(
                F.col("quotas"), left, lambda q, x: F.struct(q["no"].alias("no"), (q["k"] - x["k"]).alias("k"))
            )
            return F.array(
                F.struct(a.alias("first"), middle.alias("last"), left.alias("quotas")),
                F.struct(middle.alias("first"), b.alias("last"), rest.alias("quotas")),
            )

        whole = F.array(F.struct(a.alias("first"), b.alias("last"), F.col("quotas")))
        split = let(_left_quotas(F.col("quotas"), before(middle) - before(a), seed, a, b), halves)
        nodes = nodes.select("all", F.explode(F.when(b - a > 1, split).otherwise(whole)).alias("n")).select("n.*", "all")
    return nodes.select(F.col("first").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.no", "q.k")


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size)`` staged: texts are read once."""
    return stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "sized")


def place_documents(sized: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Staged documents with their source's ``no``, their ``place`` and ``words`` before them in its order, and their ``block``."""
    digest = seeded_key(seed, F.lit("doc"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    ahead = {"words": F.col("size"), "place": F.lit(1).cast("bigint")}
    along = running(sized, [digest, "doc_id", "size"], ahead, by=["source"])
    # Null sources meet their row too, since structs compare null-safely.
    numbers = targets.select(F.struct("source").alias("__key"), "no", "source_size", "target")
    known = lookup_join(along.withColumn("__key", F.struct("source")), numbers, "__key", "inner").drop("__key")
    return stage(known.withColumn("block", F.floor((F.col("words") + F.col("place")) / block_words)), "placed")


def block_copies(placed: DataFrame, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """Staged copies ``(no, block, pass, index, start, first)`` that the mix takes, each source's in permuted order.

    ``index`` counts a source's copies, ``start`` is the words before a copy,
    ``first`` the words before its block in the source's order.
    """
    blocks = placed.groupBy("no", "block").agg(
        F.sum("size").alias("size"), F.min("words").alias("first"), F.first("target").alias("target")
    )
    copies = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    digest = seeded_key(seed, F.lit("block"), F.col("pass"), F.col("no"), F.col("block"))
    ahead = {"start": F.col("size"), "index": F.lit(1).cast("bigint")}
    along = running(copies, ["pass", digest, "block"], ahead, by=["no"])
    return stage(along.filter(F.col("start") < F.col("target")).drop("size"), "copies")


def mix_placed(
    placed: DataFrame, copies: DataFrame, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """``(no, place, doc_id, size, pass, shard, slot)``: one row for each copy of a document in the mix."""
    quotas = split_quotas(copies.groupBy("no").agg(F.count(F.lit(1)).alias("k")), shards, seed)
    # At most ``shards`` rows for each source.
    ends = running(quotas, ["shard"], {"begin": F.col("k")}, by=["no"])
    draws = ends.filter(F.col("k") > 0).select(
        "no", "shard", F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("k") - 1)).alias("index")
    )
    drawn = copies.join(draws, ["no", "index"]).select("no", "block", "pass", "start", "first", "target", "shard")
    middle = F.col("start") + (F.col("words") - F.col("first")) + F.col("size") / 2
    rows = placed.select("no", "block", "place", "doc_id", "size", "words").join(drawn, ["no", "block"])
    taken = rows.filter(middle <= F.col("target")).select("no", "place", "doc_id", "size", "pass", "shard")
    digest = seeded_key(seed, F.lit("slot"), F.col("shard"), F.col("no"), F.col("place"), F.col("pass"))
    return global_index(taken, [digest, "no", "place", "pass"], by=["shard"], out="slot")


def op12(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the rows of the mix."""
    sized = sized_documents(docs)
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    placed = place_documents(sized, targets)
    mix = mix_placed(placed, block_copies(placed))
    taken = mix.groupBy("no", "place").agg(F.sum("size").alias("taken"))
    return placed.join(taken, ["no", "place"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


#: The same rows in DuckDB's SQL: targets, blocks and permutations; shards don't change what is taken.
SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
numbered AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST({list(map(float, WEIGHTS))}[no % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight,
         CAST(source_size * {REPEATS} AS DOUBLE) AS cap
  FROM numbered),
levels AS (
  SELECT *, cap / weight AS ratio,
         (CAST((SELECT sum(source_size) FROM weighed) AS DOUBLE) * {SHARE}
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((SELECT sum(weight) FROM weighed)
          - coalesce(sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
targets AS (
  SELECT *, least(cap, coalesce((SELECT max(level) FROM levels WHERE level <= ratio) * weight, cap)) AS target FROM levels),
along AS (
  SELECT doc_id, sized.source, size, no, source_size, target,
         row_number() OVER p - 1 AS place, CAST(sum(size) OVER p AS BIGINT) - size AS words
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
  WINDOW p AS (PARTITION BY no ORDER BY md5('{SEED}:doc:' || coalesce(CAST(doc_id AS VARCHAR), '-')), doc_id NULLS FIRST, size
               ROWS UNBOUNDED PRECEDING)),
placed AS (SELECT *, (words + place) // {BLOCK_WORDS} AS block FROM along),
blocks AS (SELECT no, block, CAST(sum(size) AS BIGINT) AS size, min(words) AS first FROM placed GROUP BY no, block),
copies AS (
  SELECT no, block, first, pass, CAST(sum(size) OVER (PARTITION BY no ORDER BY pass,
         md5('{SEED}:block:' || pass || ':' || no || ':' || block), block ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
  FROM blocks, range({REPEATS}) t(pass)),
taken AS (
  SELECT placed.no, place, CAST(sum(size) AS BIGINT) AS taken
  FROM placed JOIN copies ON placed.no = copies.no AND placed.block = copies.block
  WHERE start < target AND start + (words - first) + size / 2 <= target GROUP BY placed.no, place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed LEFT JOIN taken USING (no, place)
"""
