"""Reproducible randomness: every draw is a digest of a seed and of what is drawn."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DIGITS = 12


def seeded_key(seed: int, *parts: Column) -> Column:
    """A hex digest to order by; the same on every machine and retry."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(seed: int, *parts: Column) -> Column:
    """A number strictly between 0 and 1."""
    head = F.conv(F.substring(seeded_key(seed, *parts), 1, DIGITS), 16, 10).cast("double")
    return (head + F.lit(0.5)) / F.lit(float(16**DIGITS))


def gumbel(seed: int, *parts: Column) -> Column:
    """Standard Gumbel noise: the arg-max of ``logit + gumbel`` is a categorical draw."""
    return -F.log(-F.log(uniform(seed, *parts)))
