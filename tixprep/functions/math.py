"""Numeric scalars used by weighting, reporting and evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi]; a null stays null (``greatest``/``least`` would skip it)."""
    c = col_(c)
    out = c
    if hi is not None:
        out = F.least(out, F.lit(hi))
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def percent_round(n, total, digits: int = 2) -> Column:
    """Percentage rounded half-to-even, like ``Series.round``."""
    return F.bround(col_(n) / col_(total) * 100.0, digits)


def level_weight(n, min_n=None) -> Column:
    """sqrt(1/n) normalised by its minimum over classes == sqrt(max_n / n)."""
    w = F.sqrt(F.lit(1.0) / col_(n))
    return w if min_n is None else w / col_(min_n)


def geometric_clip(w1, w2, w3, lo: float = 1.0, hi: float = 10.0) -> Column:
    """(w1*w2*w3)^(1/3) clipped to [lo, hi]."""
    g = F.pow(col_(w1) * col_(w2) * col_(w3), F.lit(1.0 / 3.0))
    return F.least(F.lit(hi), F.greatest(F.lit(lo), g))


def arg_max(a) -> Column:
    """0-based position of the largest element; first position on ties."""
    a = col_(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def log_sum_exp(a) -> Column:
    """Stable log(sum(exp(x))) of a numeric array."""
    a = col_(a)
    m = F.array_max(a)
    return m + F.log(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x - m)))


def cross_entropy(logits, label) -> Column:
    """-log softmax(logits)[label] for a 0-based integer label."""
    return log_sum_exp(logits) - F.element_at(col_(logits), col_(label).cast("int") + 1)
