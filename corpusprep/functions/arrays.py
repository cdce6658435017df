"""Array columns: id sequences, logits and vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

EPS = 1e-6  # fixed value: guards the divisions below


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def inputs_of(ids: Column) -> Column:
    """All but the last id."""
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def labels_of(ids: Column) -> Column:
    """All but the first id."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))


def truncate_context(ids: Column, length: int) -> Column:
    """The last ``length`` ids."""
    return F.slice(ids, F.greatest(F.size(ids) - length + 1, F.lit(1)), F.lit(length))


def stop_at_eos(ids: Column, eos, max_new_tokens: int) -> Column:
    """Ids up to and including the first ``eos``, and at most ``max_new_tokens``."""
    at = F.array_position(ids, eos)
    end = F.when(at > 0, at).otherwise(F.size(ids))
    return F.slice(ids, F.lit(1), F.least(end, F.lit(max_new_tokens)).cast("int"))


def drop_special(ids: Column, specials: Sequence) -> Column:
    """Ids without the special ones; repeats of the others stay."""
    return F.filter(ids, lambda x: ~x.isin(list(specials)))


def _doubles(values: Column) -> Column:
    return values.cast("array<double>")


def log_sum_exp(logits: Column) -> Column:
    return bind(
        F.array_max(_doubles(logits)),
        lambda top: top + F.log(F.aggregate(_doubles(logits), F.lit(0.0), lambda acc, x: acc + F.exp(x - top))),
    )


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Probabilities proportional to ``exp(logit / temperature)``."""
    scaled = F.transform(_doubles(logits), lambda x: x / F.lit(float(temperature)))
    shifted = bind(F.array_max(scaled), lambda top: F.transform(scaled, lambda x: F.exp(x - top)))
    return bind(
        shifted,
        lambda e: bind(
            F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x),
            lambda total: F.transform(e, lambda x: x / total),
        ),
    )


def cross_entropy(logits: Column, label: Column) -> Column:
    """Softmax cross-entropy of an integer label."""
    return log_sum_exp(logits) - F.get(_doubles(logits), label)


def sum_of_squares(vector: Column) -> Column:
    return F.aggregate(_doubles(vector), F.lit(0.0), lambda acc, x: acc + x * x)


def rms_normalize(vector: Column, weight: Column | None = None, eps: float = EPS) -> Column:
    """The vector over its root mean square, scaled per element by ``weight``."""
    scaled = bind(
        F.sqrt(sum_of_squares(vector) / F.size(vector) + F.lit(eps)),
        lambda rms: F.transform(_doubles(vector), lambda x: x / rms),
    )
    if weight is None:
        return scaled
    return F.zip_with(scaled, _doubles(weight), lambda x, w: x * w)


def add_vectors(left: Column, right: Column) -> Column:
    return F.zip_with(_doubles(left), _doubles(right), lambda x, y: x + y)


def search_sorted(values: Column, key: Column, max_size: int = 1 << 30) -> Column:
    """How many of the ascending ``values`` are at most ``key``; a binary search."""
    jumps = F.array(*[F.lit(1 << i) for i in range(max_size.bit_length() - 1, -1, -1)])
    return bind(
        key,
        lambda sought: F.aggregate(
            jumps,
            F.lit(0),
            lambda at, jump: F.when(F.get(values, at + jump - 1) <= sought, at + jump).otherwise(at),
        ),
    )
