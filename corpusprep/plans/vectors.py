"""Vector lookups, normalisation and clipping."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.arrays import rms_normalize
from corpusprep.operators.metrics import number_steps
from corpusprep.operators.vectors import clip_by_global_norm, global_norm, lookup_vectors
from corpusprep.plans.common import DIMS, SQL_LOG, embeddings, millionths, r6, run_log

MAX_NORM = 1.0


def looked_up(spark, sf):
    """Every event as a token (its run's id) at its position in the run."""
    steps = number_steps(run_log(spark, sf)).select("event_id", F.col("run").alias("token"), "pos")
    table = embeddings(spark, sf).select("vec_id", "embedding")
    found = lookup_vectors(steps, "token", "pos", table, table, DIMS)
    return found.select("event_id", "token", "pos", millionths(F.col("vector")).alias("vector"))


def normalized(spark, sf):
    return embeddings(spark, sf).select("vec_id", millionths(rms_normalize(F.col("embedding"))).alias("vector"))


def table_norm(spark, sf):
    return global_norm(embeddings(spark, sf), "embedding").select(r6(F.col("norm")).alias("norm"))


def clipped(spark, sf):
    scaled = clip_by_global_norm(embeddings(spark, sf), "embedding", MAX_NORM)
    return scaled.select("vec_id", "label", millionths(F.col("embedding")).alias("vector"))


QUERIES = {
    "lookup_vectors": looked_up,
    "rms_normalize": normalized,
    "global_norm": table_norm,
    "clip_vectors": clipped,
}

_VECTORS = "vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_TEXT = "array_to_string(list_transform({}, lambda x: CAST(round(({}) * 1e6) AS BIGINT)), ',')".format
_NORM = "norms AS (SELECT sqrt(sum(list_sum(list_transform(v, lambda x: x * x)))) AS norm FROM vectors)"

SQL = {
    "lookup_vectors": f"""WITH {SQL_LOG}, {_VECTORS}
        SELECT event_id, run AS token, pos,
               array_to_string(list_transform(list_zip(t.v, p.v), lambda z: CAST(round((z[1] + z[2]) * 1e6) AS BIGINT)), ',')
               AS vector
        FROM steps LEFT JOIN vectors t ON t.vec_id = run LEFT JOIN vectors p ON p.vec_id = pos""",
    "rms_normalize": f"""WITH {_VECTORS},
        scaled AS (
          SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v) + CAST(1e-6 AS DOUBLE)) AS rms
          FROM vectors)
        SELECT vec_id, {_TEXT('v', 'x / rms')} AS vector FROM scaled""",
    "global_norm": f"WITH {_VECTORS}, {_NORM} SELECT round(norm, 6) AS norm FROM norms",
    "clip_vectors": f"""WITH {_VECTORS}, {_NORM},
        scales AS (SELECT least(CAST(1 AS DOUBLE), CAST({MAX_NORM} AS DOUBLE) / (norm + CAST(1e-6 AS DOUBLE))) AS s FROM norms)
        SELECT vec_id, label, {_TEXT('v', 'x * s')} AS vector FROM vectors, scales""",
}
