"""Losses over ``embeddings`` read as logits: the vector is the logits, the label the class."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.arrays import cross_entropy, softmax
from corpusprep.functions.sql import register_sql
from corpusprep.operators.batch import batch, leading_batches
from corpusprep.operators.loss import (
    eval_loss,
    masked_mean,
    mean_loss,
    moving_eval_loss,
    pad_mask,
    perplexity,
    score_with,
    val_delta,
)
from corpusprep.operators.metrics import number_steps
from corpusprep.operators.order import micros
from corpusprep.operators.sample import TEMPERATURE, sample_categorical, sample_logits
from corpusprep.plans.common import DIMS, SEED, embeddings, millionths, r6
from corpusprep.sources.documents import read_table

PAD = 0
EVAL_BATCH = 16
EVALUATIONS = 9


def _losses(spark, sf):
    loss = cross_entropy(F.col("embedding"), F.col("label"))
    return embeddings(spark, sf).select("vec_id", "label", loss.alias("loss"), pad_mask(F.col("label"), PAD).alias("mask"))


def token_loss(spark, sf):
    return _losses(spark, sf).select("vec_id", "label", r6(F.col("loss")).alias("loss"))


def masked_mean_loss(spark, sf):
    return _losses(spark, sf).agg(r6(masked_mean(F.col("loss"), F.col("mask"))).alias("loss"))


def plain_mean_loss(spark, sf):
    return _losses(spark, sf).groupBy("label").agg(r6(mean_loss(F.col("loss"))).alias("loss"))


def validation_loss(spark, sf):
    batched = leading_batches(_losses(spark, sf), ["vec_id"], EVAL_BATCH)
    return eval_loss(batched, "loss", "mask").select(r6(F.col("val_loss")).alias("val_loss"), "batches")


def moving_validation_loss(spark, sf):
    """Evaluations that go on through all batches and start over."""
    batched = batch(_losses(spark, sf), ["vec_id"], EVAL_BATCH)
    found = moving_eval_loss(batched, "loss", "mask", EVALUATIONS)
    return found.select("evaluation", r6(F.col("val_loss")).alias("val_loss"), "batches")


def mean_perplexity(spark, sf):
    return _losses(spark, sf).agg(r6(perplexity(F.col("loss"))).alias("perplexity"))


def probabilities(spark, sf):
    return embeddings(spark, sf).select("vec_id", millionths(softmax(F.col("embedding"), TEMPERATURE)).alias("probs"))


def linear_model():
    """A user's model: loaded once in each task, it gets batches and gives batches."""
    import numpy as np

    weights = np.arange(1, DIMS + 1, dtype=np.float64)

    def score(batches):
        for rows in batches:
            logits = np.stack(rows["embedding"].to_numpy()).astype(np.float64) if len(rows) else np.zeros((0, DIMS))
            rows = rows[["vec_id"]].assign(score=logits @ weights, best=logits.argmax(1) if len(rows) else [])
            yield rows

    return score


def model_scores(spark, sf):
    rows = embeddings(spark, sf).select("vec_id", "embedding")
    scored = score_with(rows, linear_model, "vec_id bigint, score double, best int")
    return scored.withColumn("score", r6(F.col("score")))


def sql_functions(spark, sf):
    """The same functions called from SQL."""
    register_sql(spark)
    z = "CAST(embedding AS ARRAY<DOUBLE>)"
    return embeddings(spark, sf).selectExpr(
        "vec_id",
        f"round(cross_entropy({z}, label), 6) AS loss",
        f"round(softmax({z}, 1D)[label], 6) AS prob",
        f"round(rms_normalize({z})[0], 6) AS first",
        "round_up(vec_id, 128) AS rounded",
    )


def draws_long(spark, sf):
    long = embeddings(spark, sf).select("vec_id", F.posexplode("embedding").alias("item", "logit"))
    return sample_categorical(long, ["vec_id"], "item", F.col("logit").cast("double"), SEED)


def draws_array(spark, sf):
    drawn = sample_logits(F.col("embedding"), F.col("vec_id"), SEED)
    return embeddings(spark, sf).select("vec_id", drawn.alias("item"))


def delta(spark, sf):
    log = read_table(spark, sf, "events").select(
        F.col("user_id").alias("run"),
        "event_type",
        "event_id",
        micros(F.col("ts")).alias("ts"),
        F.col("value").alias("loss"),
    )
    val, train = (
        number_steps(log.filter(F.col("event_type") == kind)).withColumnRenamed("pos", "step")
        for kind in ("purchase", "view")
    )
    return val_delta(val, train, ["run", "step"]).withColumn("delta", r6(F.col("delta")))


QUERIES = {
    "cross_entropy": token_loss,
    "masked_mean_loss": masked_mean_loss,
    "mean_loss": plain_mean_loss,
    "eval_loss": validation_loss,
    "moving_eval_loss": moving_validation_loss,
    "perplexity": mean_perplexity,
    "score_with": model_scores,
    "sql_functions": sql_functions,
    "softmax_probs": probabilities,
    "sample_categorical": draws_long,
    "sample_logits": draws_array,
    "val_delta": delta,
}

_LOSSES = """
logits AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS z FROM embeddings),
tops AS (SELECT *, list_max(z) AS top FROM logits),
losses AS (
  SELECT vec_id, label, top + ln(list_sum(list_transform(z, lambda x: exp(x - top)))) - z[label + 1] AS loss,
         CASE WHEN label <> 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS mask
  FROM tops
)"""

_T = f"CAST({TEMPERATURE} AS DOUBLE)"
_DRAW = f"""
        WITH long AS (
          SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS logit, generate_subscripts(embedding, 1) - 1 AS item
          FROM embeddings),
        scored AS (
          SELECT vec_id, item, logit / {_T} - ln(-ln(
            (CAST(CAST('0x' || substr(md5('{SEED}:0:' || vec_id || ':' || item), 1, 12) AS BIGINT) AS DOUBLE)
             + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE))) AS score
          FROM long)
        SELECT vec_id, CAST(arg_max(item, score) AS INTEGER) AS item FROM scored GROUP BY vec_id"""

SQL = {
    "cross_entropy": f"WITH {_LOSSES} SELECT vec_id, label, round(loss, 6) AS loss FROM losses",
    "masked_mean_loss": f"""WITH {_LOSSES}
        SELECT round(sum(loss * mask) / (sum(mask) + CAST(1e-6 AS DOUBLE)), 6) AS loss FROM losses""",
    "mean_loss": f"WITH {_LOSSES} SELECT label, round(avg(loss), 6) AS loss FROM losses GROUP BY label",
    "eval_loss": f"""WITH {_LOSSES},
        placed AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM losses),
        means AS (
          SELECT pos // {EVAL_BATCH} AS b, sum(loss * mask) / (sum(mask) + CAST(1e-6 AS DOUBLE)) AS m
          FROM placed WHERE pos // {EVAL_BATCH} < n // {EVAL_BATCH} AND pos // {EVAL_BATCH} < 20 GROUP BY b)
        SELECT round(avg(m), 6) AS val_loss, count(*) AS batches FROM means HAVING count(*) > 0""",
    "moving_eval_loss": f"""WITH {_LOSSES},
        placed AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n FROM losses),
        means AS (
          SELECT pos // {EVAL_BATCH} AS b, any_value(n) // {EVAL_BATCH} AS total,
                 sum(loss * mask) / (sum(mask) + CAST(1e-6 AS DOUBLE)) AS m
          FROM placed WHERE pos // {EVAL_BATCH} < n // {EVAL_BATCH} GROUP BY pos // {EVAL_BATCH})
        SELECT evaluation, round(avg(m), 6) AS val_loss, count(*) AS batches
        FROM means JOIN range({EVALUATIONS}) r(evaluation) ON evaluation % (total // 20 + 1) = b // 20
        GROUP BY evaluation""",
    "perplexity": f"WITH {_LOSSES} SELECT round(exp(avg(loss)), 6) AS perplexity FROM losses",
    "score_with": f"""
        SELECT vec_id, round(list_inner_product(z, [CAST(i AS DOUBLE) FOR i IN range(1, {DIMS + 1})]), 6) AS score,
               CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS best
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS z FROM embeddings)""",
    "sql_functions": f"""WITH {_LOSSES},
        norms AS (SELECT vec_id, sqrt(list_sum([x * x FOR x IN z]) / len(z) + CAST(1e-6 AS DOUBLE)) AS rms, z FROM logits)
        SELECT vec_id, round(loss, 6) AS loss, round(exp(-loss), 6) AS prob, round(z[1] / rms, 6) AS first,
               (vec_id + 127) // 128 * 128 AS rounded
        FROM losses JOIN norms USING (vec_id)""",
    "softmax_probs": f"""
        WITH scaled AS (
          SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / {_T}) AS z FROM embeddings),
        tops AS (SELECT vec_id, z, list_max(z) AS top FROM scaled),
        exps AS (SELECT vec_id, list_transform(z, lambda x: exp(x - top)) AS e FROM tops),
        sums AS (SELECT vec_id, e, list_sum(e) AS s FROM exps)
        SELECT vec_id, array_to_string(list_transform(e, lambda x: CAST(round(x / s * 1e6) AS BIGINT)), ',') AS probs FROM sums""",
    "sample_categorical": _DRAW,
    "sample_logits": _DRAW,
    "val_delta": """
        WITH steps AS (
          SELECT user_id AS run, event_type, value AS loss,
                 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS step
          FROM events)
        SELECT v.run, v.step, v.loss AS val_loss, t.loss AS train_loss, round(v.loss - t.loss, 6) AS delta
        FROM steps v JOIN steps t USING (run, step)
        WHERE v.event_type = 'purchase' AND t.event_type = 'view'""",
}
