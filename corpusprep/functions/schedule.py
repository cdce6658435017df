"""Step-dependent weights and rounding."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

FLOOR = 0.1  # fixed value: the share of the base rate that the decay ends on


def lr_cosine(step: Column, base: float, warmup: int, total: int, floor: float = FLOOR) -> Column:
    """Linear warm-up from ``1/warmup``, then a cosine that is not held at its end."""
    progress = (step - warmup) / F.lit(float(max(1, total - warmup)))
    decayed = F.lit(floor) + F.lit(0.5 * (1 - floor)) * (1 + F.cos(F.lit(math.pi) * progress))
    rising = (step + 1) / F.lit(float(max(1, warmup)))
    return F.lit(float(base)) * F.when(step < warmup, rising).otherwise(decayed)


def lr_cosine_clamped(step: Column, peak: float, warmup: int, decay_steps: int, floor: float = FLOOR) -> Column:
    """Linear warm-up from zero, a cosine until ``decay_steps``, constant after that."""
    span = F.lit(float(max(1, decay_steps - warmup)))
    progress = F.least(F.lit(1.0), (step - warmup) / span)
    decayed = F.lit(floor) + F.lit(0.5 * (1 - floor)) * (1 + F.cos(F.lit(math.pi) * progress))
    rising = step / F.lit(float(max(1, warmup)))
    return F.lit(float(peak)) * F.when(step < warmup, rising).otherwise(decayed)


def pad_amount(x: Column, multiple: int) -> Column:
    """What must be added to reach a multiple."""
    return F.pmod(-x, F.lit(multiple))


def round_up(x: Column, multiple: int) -> Column:
    return x + pad_amount(x, multiple)
