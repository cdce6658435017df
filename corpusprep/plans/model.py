"""The pair-count model: fitted on the first nine tenths of the documents, scored on the rest."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.operators.bigram import (
    bigram_table,
    fit_bigram,
    generate_greedy,
    generate_sampled,
    pair_counts,
    score_bigram,
)
from corpusprep.operators.sample import TEMPERATURE
from corpusprep.operators.split import split_by_rank
from corpusprep.operators.tokens import EOS, text_delta, text_tokens
from corpusprep.plans.common import SEED, SQL_TOKENS, docs, joined, r6
from corpusprep.session import stage
from corpusprep.sources.documents import read_table, spread

NEW_TOKENS = 8


def _split(spark, sf, part):
    rows = split_by_rank(read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return spread(rows.filter(F.col("split") == part), "doc_id")


def bigram_fit(spark, sf):
    table = bigram_table(fit_bigram(_split(spark, sf, "train"), text_tokens(F.col("text"))))
    return table.select("prev", "next", "n", "total", r6(F.col("logprob")).alias("logprob"))


def bigram_perplexity(spark, sf):
    tokens = text_tokens(F.col("text"))
    scored = score_bigram(_split(spark, sf, "val"), tokens, fit_bigram(_split(spark, sf, "train"), tokens))
    return scored.select(
        "tokens", r6(F.col("loss")).alias("loss"), F.round(F.col("perplexity"), 3).alias("perplexity")
    )


def _generated(spark, sf):
    """Continuations of every document that ends inside a line: its final ``<eos>`` is taken off."""
    tokens = text_tokens(F.col("text"))
    prompts = docs(spark, sf).select("doc_id", tokens.alias("tokens"))
    prompts = prompts.select("doc_id", F.slice("tokens", 1, F.greatest(F.size("tokens") - 1, F.lit(0))).alias("tokens"))
    pairs = stage(pair_counts(docs(spark, sf), tokens), "pairs")
    return prompts, pairs


def greedy(spark, sf):
    prompts, pairs = _generated(spark, sf)
    out = generate_greedy(prompts, F.col("tokens"), pairs, NEW_TOKENS, EOS)
    return out.select("doc_id", joined(F.col("generated")).alias("generated"))


def sampled(spark, sf):
    prompts, pairs = _generated(spark, sf)
    out = generate_sampled(prompts, "doc_id", F.col("tokens"), pairs, NEW_TOKENS, EOS, TEMPERATURE, SEED)
    return out.select("doc_id", joined(F.col("generated")).alias("generated"))


def deltas(spark, sf):
    prompts, pairs = _generated(spark, sf)
    out = generate_greedy(prompts, F.col("tokens"), pairs, NEW_TOKENS, EOS)
    sizes = F.when(F.size("generated") > 0, F.sequence(F.lit(1), F.size("generated")))
    steps = out.select("doc_id", "generated", F.explode(sizes).alias("step"))
    texts = steps.select("doc_id", "step", joined(F.slice("generated", F.lit(1), F.col("step"))).alias("text"))
    return text_delta(texts, ["doc_id"], "step")


QUERIES = {
    "bigram_fit": bigram_fit,
    "bigram_perplexity": bigram_perplexity,
    "generate_greedy": greedy,
    "generate_sampled": sampled,
    "text_delta": deltas,
}

_PAIRS = f"""{SQL_TOKENS},
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 < floor(0.9 * count(*) OVER ()) AS train FROM documents
),
neighbours AS (
  SELECT doc_id, tok AS prev, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM tokens
),
train_pairs AS (
  SELECT prev, next, count(*) AS n FROM neighbours JOIN ranks USING (doc_id)
  WHERE train AND next IS NOT NULL GROUP BY prev, next
),
contexts AS (SELECT prev, CAST(sum(n) AS BIGINT) AS total FROM train_pairs GROUP BY prev),
size AS (SELECT count(*) AS v FROM (SELECT prev FROM train_pairs UNION SELECT next FROM train_pairs))"""

_GREEDY = f"""{SQL_TOKENS},
neighbours AS (
  SELECT tok AS prev, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM tokens
),
follow AS (
  SELECT prev, next FROM (
    SELECT prev, next, row_number() OVER (PARTITION BY prev ORDER BY count(*) DESC, next) AS r
    FROM neighbours WHERE next IS NOT NULL GROUP BY prev, next)
  WHERE r = 1
),
lasts AS (
  SELECT doc_id, max(CASE WHEN pos = n - 2 THEN tok END) AS last
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM tokens) GROUP BY doc_id
),
walk AS (
  SELECT d.doc_id, l.last AS tail, 0 AS step, '' AS out FROM documents d LEFT JOIN lasts l USING (doc_id)
  UNION ALL
  SELECT w.doc_id, f.next, w.step + 1, CASE WHEN w.step = 0 THEN f.next ELSE w.out || ' ' || f.next END
  FROM walk w JOIN follow f ON f.prev = w.tail
  WHERE w.step < {NEW_TOKENS} AND (w.step = 0 OR w.tail <> '<eos>')
)"""

_DRAWS = f"""{SQL_TOKENS},
neighbours AS (
  SELECT tok AS prev, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM tokens
),
pairs AS (
  SELECT prev, next, count(*) AS n FROM neighbours WHERE next IS NOT NULL GROUP BY prev, next
),
edges AS (
  SELECT prev, next,
         sum(pow(n, CAST(1 AS DOUBLE) / CAST({TEMPERATURE} AS DOUBLE))) OVER (PARTITION BY prev ORDER BY next) AS hi
  FROM pairs
),
bounds AS (
  SELECT prev, next, hi, coalesce(lag(hi) OVER (PARTITION BY prev ORDER BY next), CAST(0 AS DOUBLE)) AS lo,
         max(hi) OVER (PARTITION BY prev) AS total FROM edges
),
lasts AS (
  SELECT doc_id, max(CASE WHEN pos = n - 2 THEN tok END) AS last
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM tokens) GROUP BY doc_id
),
walk AS (
  SELECT d.doc_id, l.last AS tail, 0 AS step, '' AS out FROM documents d LEFT JOIN lasts l USING (doc_id)
  UNION ALL
  SELECT w.doc_id, b.next, w.step + 1, CASE WHEN w.step = 0 THEN b.next ELSE w.out || ' ' || b.next END
  FROM (
    SELECT *, (CAST(CAST('0x' || substr(md5('{SEED}:' || step || ':' || doc_id), 1, 12) AS BIGINT) AS DOUBLE)
               + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE) AS u FROM walk) w
  JOIN bounds b ON b.prev = w.tail AND b.lo <= w.u * b.total AND w.u * b.total < b.hi
  WHERE w.step < {NEW_TOKENS} AND (w.step = 0 OR w.tail <> '<eos>')
)"""

SQL = {
    "bigram_fit": f"""WITH {_PAIRS}
        SELECT prev, next, n, total, round(ln(CAST(n + 1 AS DOUBLE) / CAST(total + v AS DOUBLE)), 6) AS logprob
        FROM train_pairs JOIN contexts USING (prev), size""",
    "bigram_perplexity": f"""WITH {_PAIRS},
        held AS (
          SELECT prev, next, count(*) AS seen FROM neighbours JOIN ranks USING (doc_id)
          WHERE NOT train AND next IS NOT NULL GROUP BY prev, next),
        scored AS (
          SELECT seen, -ln(CAST(coalesce(n, 0) + 1 AS DOUBLE) / CAST(coalesce(total, 0) + v AS DOUBLE)) AS loss
          FROM held LEFT JOIN train_pairs USING (prev, next) LEFT JOIN contexts USING (prev), size)
        SELECT CAST(sum(seen) AS BIGINT) AS tokens, round(sum(seen * loss) / sum(seen), 6) AS loss,
               round(exp(sum(seen * loss) / sum(seen)), 3) AS perplexity FROM scored""",
    "generate_greedy": f"""WITH RECURSIVE {_GREEDY}
        SELECT doc_id, arg_max(out, step) AS generated FROM walk GROUP BY doc_id""",
    "generate_sampled": f"""WITH RECURSIVE {_DRAWS}
        SELECT doc_id, arg_max(out, step) AS generated FROM walk GROUP BY doc_id""",
    "text_delta": f"""WITH RECURSIVE {_GREEDY}
        SELECT doc_id, CAST(step AS INTEGER) AS step, out AS text,
               CASE WHEN step = 1 THEN tail ELSE ' ' || tail END AS delta FROM walk WHERE step > 0""",
}
