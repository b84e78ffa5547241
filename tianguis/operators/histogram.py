"""Equal-width histograms with an inclusive last edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tianguis.operators.quantiles import counted_values


def equal_width(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, desde, hasta, n) for ``bins`` bins between the minimum and the maximum of ``value``.

    Values are counted first: an integer or clipped-money column shrinks to its domain before
    the shuffle, and both the range and the bins read the same exchange. Empty bins are kept.
    A column with a single value gets a range of width one around it.
    """
    counted = counted_values(df, value)
    kind = dict(df.dtypes)[value]
    # One scalar subquery over the same exchange, named once per frame that uses it.
    extent = counted.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar().alias("_extent")
    low, high = F.col("_extent.low"), F.col("_extent.high")

    scaled = (F.col(value) - low) * bins
    if kind == "double":
        index = F.floor(scaled / F.nullif(high - low, F.lit(0.0)))
    else:
        index = F.call_function("div", scaled, F.nullif(high - low, F.lit(0).cast(kind)))
    index = F.when(low == high, bins // 2).otherwise(F.least(index, F.lit(bins - 1))).cast("int")
    filled = counted.select(value, "n", extent).groupBy(index.alias("bin")).agg(F.sum("n").alias("n"))

    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), extent)
    start = F.when(low == high, low.cast("double") - 0.5).otherwise(low.cast("double"))
    width = F.when(low == high, F.lit(1.0)).otherwise(high.cast("double") - low.cast("double"))
    return (
        spine.join(filled, "bin", "left")
        .select(
            "bin",
            (start + width * F.col("bin") / bins).alias("desde"),
            (start + width * (F.col("bin") + 1) / bins).alias("hasta"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
        .where(F.col("desde").isNotNull())
    )
