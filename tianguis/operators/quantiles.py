"""Exact quantiles by linear interpolation, and box-plot statistics.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer. Here values
are counted first, ordered with the distributed running sum, and only the two order statistics
next to each quantile are picked. Fractions are given as integers, so positions are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.operators.ordering import running


def counted_values(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """(by..., value, n) for the values that are present; copies collapse before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(*(by or []), value).agg(F.count(F.lit(1)).alias("n"))


def _pick(value: str, fraction: tuple[int, int]) -> Column:
    """Interpolated quantile as an aggregate over (value, n, upto, total) rows."""
    numerator, denominator = fraction
    scaled = (F.col("total") - 1) * numerator
    index = F.floor(scaled / denominator)
    rest = scaled % denominator
    start = F.col("upto") - F.col("n")

    def at(position: Column) -> Column:
        return F.max(F.when((start <= position) & (position < F.col("upto")), F.col(value)))

    low = at(index)
    high = F.coalesce(at(index + 1), low)
    weight = F.max(rest).cast("decimal(6,0)") / F.lit(denominator).cast("decimal(6,0)")
    return (low + (high - low) * weight.cast("decimal(8,6)")).cast("decimal(24,6)")


def exact_quantiles(counted: DataFrame, value: str, fractions: dict[str, tuple[int, int]]) -> DataFrame:
    """One row with the named quantiles plus the count, sum, minimum and maximum."""
    ordered = running(counted, [(value, False)], sums={"n": ("upto", "total")})
    return ordered.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum(F.col(value) * F.col("n")).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        *[_pick(value, fraction).alias(name) for name, fraction in fractions.items()],
    )


def quantiles_of(df: DataFrame, value: str, fractions: dict[str, tuple[int, int]]) -> DataFrame:
    """``exact_quantiles`` for a column whose number of distinct values is not known."""
    return exact_quantiles(counted_values(df, value), value, fractions)


def box_statistics(df: DataFrame, by: str, value: str) -> DataFrame:
    """Count, quartiles and 1.5 IQR whiskers per group.

    Values are ordered within their group by ranges, so a group that holds most of the rows is spread over
    tasks. The groups are the labels of an axis: their quartiles, one entry each, come back to the counted values
    as a map instead of shuffling the values on a handful of keys.
    """
    counted = counted_values(df.where(F.col(by).isNotNull()), value, [by])
    ordered = running(counted, [(value, False)], within=by, sums={"n": ("upto", "total")})
    quartiles = ordered.groupBy(by).agg(
        F.sum("n").alias("n"),
        _pick(value, (1, 4)).alias("q1"),
        _pick(value, (1, 2)).alias("mediana"),
        _pick(value, (3, 4)).alias("q3"),
    )
    spread = (F.col("q3") - F.col("q1")) * F.lit(1.5).cast("decimal(2,1)")
    fences = quartiles.agg(
        F.map_from_entries(
            F.collect_list(F.struct(by, F.struct((F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))))
        )
    ).scalar()
    fence = F.element_at(fences, F.col(by))
    inside = counted.groupBy(by).agg(
        F.min(F.when(F.col(value) >= fence["low"], F.col(value))).alias("_low"),
        F.max(F.when(F.col(value) <= fence["high"], F.col(value))).alias("_high"),
    )
    # A fence can leave no value beyond the box; the whisker then ends at the box.
    return quartiles.join(inside, by).select(
        by,
        "n",
        F.least("_low", "q1").alias("bigote_inferior"),
        "q1",
        "mediana",
        "q3",
        F.greatest("_high", "q3").alias("bigote_superior"),
    )
