"""Row, null and duplicate profiles of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.functions.numbers import traffic_light


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def table_profile(name: str, df: DataFrame) -> DataFrame:
    """Rows, columns, percentage of empty cells and surplus copies of whole rows.

    Equal rows are counted together under a 256-bit digest of their typed values, so long texts stay where they
    are, one pass answers all four, and copies collapse before the shuffle.
    """
    nulls = _total([F.col(c).isNull().cast("int") for c in df.columns]).alias("_row_nulls")
    digest = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256).alias("_digest")
    distinct = df.select(digest, nulls).groupBy("_digest", "_row_nulls").agg(F.count(F.lit(1)).alias("_n"))
    sums = distinct.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("filas"),
        F.sum(F.col("_n") * F.col("_row_nulls")).alias("_nulls"),
        F.count(F.lit(1)).alias("_distinct"),
    )
    width = len(df.columns)
    return sums.select(
        F.lit(name).alias("dataset"),
        "filas",
        F.lit(width).alias("columnas"),
        (F.col("_nulls").cast("double") / F.nullif(F.col("filas") * width, F.lit(0)) * 100).alias("nulos_pct"),
        (F.col("filas") - F.col("_distinct")).alias("duplicados"),
    )


def null_profile(name: str, df: DataFrame) -> DataFrame:
    """Percentage of missing values per column that has any, with a severity."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("_nulls")) for c in df.columns])
    share = F.col("_nulls").cast("double") / F.nullif(F.col("_rows"), F.lit(0)) * 100
    return (
        counted.select("_rows", F.inline(pairs))
        .select(F.lit(name).alias("dataset"), "columna", share.alias("nulos_pct"))
        .where(F.col("nulos_pct") > 0)
        .withColumn("severidad", traffic_light(F.col("nulos_pct"), 10, 3))
    )
