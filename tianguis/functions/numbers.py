"""Exact money arithmetic, percentages and binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
TOTAL = "decimal(24,2)"
COUNT = "decimal(15,0)"


def exact_mean(total: Column, count: Column) -> Column:
    """Sum / count with 16 decimals; ``avg(decimal)`` would keep only 6. NULL for no rows."""
    return total.cast(TOTAL) / F.nullif(count.cast(COUNT), F.lit(0).cast(COUNT))


def percent(part: Column, whole: Column) -> Column:
    """Unrounded part / whole * 100 in decimals, NULL when the whole is zero."""
    return part.cast(TOTAL) * 100 / F.nullif(whole.cast(TOTAL), F.lit(0).cast(TOTAL))


def growth(current: Column, previous: Column) -> Column:
    """I8: percentage change to two places, NULL without a previous value or when it is zero."""
    return F.round(percent(current - previous, previous), 2)


def share(part: Column, whole: Column) -> Column:
    """part / whole * 100 as a double, as the exploration layer reports it."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100


def true_share(predicate: Column) -> Column:
    """Percentage of *all* rows for which the predicate holds; unknown counts as false."""
    return F.sum(F.when(predicate, 1).otherwise(0)).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100


def clip(value: Column, low=None, high=None) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    clipped = value
    if low is not None:
        clipped = F.greatest(clipped, F.lit(low).cast(_same(low)))
    if high is not None:
        clipped = F.least(clipped, F.lit(high).cast(_same(high)))
    return F.when(value.isNotNull(), clipped)


def _same(bound) -> str:
    return "int" if isinstance(bound, int) else "decimal(24,2)"


def right_closed_bin(value: Column, edges: Sequence[int], labels: Sequence[str]) -> Column:
    """Label of the (lo, hi] bin; values outside every bin get NULL."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], labels))):
        label = F.when((value > low) & (value <= high), name).otherwise(label)
    return label


def traffic_light(value: Column, high: float, medium: float) -> Column:
    """Three-level severity."""
    return F.when(value > high, "alto").when(value > medium, "medio").otherwise("bajo")
