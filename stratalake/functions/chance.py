"""Probability arithmetic used when scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clip(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def jitter(x: Column, width: float = 0.02, seed: int | None = None) -> Column:
    """Add uniform noise in ±width. Opt-in: nothing in this package calls it."""
    return x + (F.rand(seed) * (2 * width) - width)


def percent_text(x: Column) -> Column:
    return F.format_string("%.1f%%", x * 100)
