"""Seller segmentation by revenue quartile."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.functions.display import money_text
from tianguis.functions.numbers import exact_mean, percent
from tianguis.operators.ordering import running, tile_of
from tianguis.plans.reporting import seller_totals
from tianguis.sources.warehouse import read_segments, rewrite_segments

# Segment letters and their descriptions.
SEGMENTS = {
    "A": "Alto rendimiento",
    "B": "Medio-alto",
    "C": "Medio-bajo",
    "D": "Bajo rendimiento",
}


class NoActiveSellers(LookupError):
    """K4: there is no sale to segment by."""


def segment_sellers(star) -> DataFrame:
    """Sellers with their metrics and quartile letter.

    ``segment_sk`` is the position by revenue, the order in which rows used to be inserted.
    Sales are summed per seller before the seller's attributes and dates are looked up.
    """
    totals = seller_totals(star)
    metrics = totals.join(star.dim_sellers, "seller_sk").select(
        "seller_sk",
        "seller_id",
        F.col("seller_city").alias("ciudad"),
        F.col("seller_state").alias("estado"),
        F.col("revenue_total").alias("ingresos_total"),
        F.col("total_ordenes").cast("int").alias("total_ordenes"),
        F.col("productos_distintos").cast("int").alias("productos_distintos"),
        F.round(exact_mean(F.col("revenue_total"), F.col("_n")), 2).alias("ticket_promedio"),
        F.to_date(F.col("_first").cast("string"), "yyyyMMdd").alias("primera_venta"),
        F.to_date(F.col("_last").cast("string"), "yyyyMMdd").alias("ultima_venta"),
    )
    placed = running(metrics, [("ingresos_total", True), ("seller_id", False)], position="segment_sk", count="_sellers")
    tile = tile_of(F.col("segment_sk"), F.col("_sellers"), len(SEGMENTS))
    letter = F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), tile)
    return placed.withColumn("segmento", letter).select("segment_sk", *metrics.columns, "segmento")


def refresh_segments(star, folder: str) -> DataFrame:
    """K2: rewrite the segment table and return its summary."""
    if star.fact_order_items.isEmpty():
        raise NoActiveSellers("the item fact has no sales")
    rewrite_segments(segment_sellers(star), folder)
    return segment_summary(read_segments(star.fact_order_items.sparkSession, folder))


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size and revenue of each segment and its share of all revenue."""
    stats = segments.groupBy("segmento").agg(
        F.count(F.lit(1)).alias("total_vendedores"),
        F.min("ingresos_total").cast("decimal(15,2)").alias("ingresos_min"),
        F.max("ingresos_total").cast("decimal(15,2)").alias("ingresos_max"),
        F.round(exact_mean(F.sum("ingresos_total"), F.count("ingresos_total")), 2)
        .cast("decimal(15,2)")
        .alias("ingresos_avg"),
        F.sum("ingresos_total").cast("decimal(15,2)").alias("ingresos_total"),
    )
    description = F.lit(None).cast("string")
    for letter, text in SEGMENTS.items():
        description = F.when(F.col("segmento") == letter, text).otherwise(description)
    # Four rows.
    everything = F.sum("ingresos_total").over(Window.partitionBy())
    return stats.select(
        "segmento",
        description.alias("descripcion"),
        "total_vendedores",
        "ingresos_min",
        "ingresos_max",
        "ingresos_avg",
        "ingresos_total",
        F.round(percent(F.col("ingresos_total"), everything), 2).cast("decimal(6,2)").alias("pct_del_total"),
    )


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Sellers, revenue spread and mean orders per segment."""
    return segments.groupBy("segmento").agg(
        F.count(F.lit(1)).alias("vendedores"),
        F.round(exact_mean(F.sum("ingresos_total"), F.count("ingresos_total")), 2).alias("revenue_promedio"),
        F.min("ingresos_total").alias("revenue_min"),
        F.max("ingresos_total").alias("revenue_max"),
        F.round(exact_mean(F.sum("total_ordenes"), F.count("total_ordenes")), 1).alias("ordenes_promedio"),
    )


def segment_distribution_text(segments: DataFrame) -> DataFrame:
    """The distribution as it is printed."""
    amounts = ("revenue_promedio", "revenue_min", "revenue_max")
    return segment_distribution(segments).withColumns(
        {
            **{c: money_text(F.col(c)) for c in amounts},
            "ordenes_promedio": F.format_number("ordenes_promedio", 1),
        }
    )


def segment_top(segments: DataFrame, segment: str = "A", n: int = 10) -> DataFrame:
    """The ``n`` sellers with the most revenue in a segment."""
    return (
        segments.where(F.col("segmento") == segment)
        .orderBy(F.col("ingresos_total").desc(), "seller_id")
        .limit(n)
        .select(
            "seller_id",
            "ciudad",
            "estado",
            F.col("ingresos_total").alias("ingresos"),
            F.col("total_ordenes").alias("ordenes"),
            F.col("productos_distintos").alias("skus"),
            "primera_venta",
            "ultima_venta",
        )
    )


def segment_mean_revenue(segments: DataFrame) -> DataFrame:
    """Mean revenue per segment."""
    return segments.groupBy("segmento").agg(
        F.round(exact_mean(F.sum("ingresos_total"), F.count("ingresos_total")), 2).alias("ingresos_promedio")
    )
