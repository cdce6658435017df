"""The column functions as SQL functions, inlined by the optimizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

from corpusprep.functions.arrays import EPS
from corpusprep.functions.schedule import FLOOR
from corpusprep.functions.text import NON_BLANK

_COSINE = "{floor} + 0.5D * (1 - {floor}) * (1 + cos(pi() * {progress}))"

FUNCTIONS = {
    "byte_len(txt STRING)": ("INT", "octet_length(txt)"),
    "repair_utf8(txt STRING)": ("STRING", "make_valid_utf8(txt)"),
    "is_blank(txt STRING)": ("BOOLEAN", "NOT txt RLIKE '" + NON_BLANK.replace("\\", "\\\\") + "'"),
    "pad_amount(x BIGINT, multiple BIGINT)": ("BIGINT", "pmod(-x, multiple)"),
    "round_up(x BIGINT, multiple BIGINT)": ("BIGINT", "x + pmod(-x, multiple)"),
    "lr_cosine(step DOUBLE, base DOUBLE, warmup DOUBLE, total DOUBLE)": (
        "DOUBLE",
        "base * CASE WHEN step < warmup THEN (step + 1) / greatest(1D, warmup) ELSE "
        + _COSINE.format(floor=f"{FLOOR}D", progress="(step - warmup) / greatest(1D, total - warmup)")
        + " END",
    ),
    "lr_cosine_clamped(step DOUBLE, peak DOUBLE, warmup DOUBLE, decay_steps DOUBLE)": (
        "DOUBLE",
        "peak * CASE WHEN step < warmup THEN step / greatest(1D, warmup) ELSE "
        + _COSINE.format(
            floor=f"{FLOOR}D", progress="least(1D, (step - warmup) / greatest(1D, decay_steps - warmup))"
        )
        + " END",
    ),
    "cross_entropy(logits ARRAY<DOUBLE>, label INT)": (
        "DOUBLE",
        "transform(array(array_max(logits)), m -> m + ln(aggregate(logits, 0D, (a, x) -> a + exp(x - m))))[0]"
        " - get(logits, label)",
    ),
    "masked_mean(losses ARRAY<DOUBLE>, mask ARRAY<DOUBLE>)": (
        "DOUBLE",
        "aggregate(zip_with(losses, mask, (l, m) -> l * m), 0D, (a, x) -> a + x)"
        f" / (aggregate(mask, 0D, (a, x) -> a + x) + {EPS}D)",
    ),
    "softmax(logits ARRAY<DOUBLE>, temperature DOUBLE)": (
        "ARRAY<DOUBLE>",
        "transform(array(transform(array(array_max(logits)),"
        " m -> transform(logits, x -> exp((x - m) / temperature)))[0]),"
        " e -> transform(array(aggregate(e, 0D, (a, x) -> a + x)), s -> transform(e, x -> x / s))[0])[0]",
    ),
    "rms_normalize(vec ARRAY<DOUBLE>)": (
        "ARRAY<DOUBLE>",
        f"transform(array(sqrt(aggregate(vec, 0D, (a, x) -> a + x * x) / size(vec) + {EPS}D)),"
        " r -> transform(vec, x -> x / r))[0]",
    ),
}


def register_sql(spark: SparkSession) -> None:
    """Create the functions in the session."""
    for signature, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
