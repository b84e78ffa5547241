"""Exploration of delivery times and review scores, and the summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tianguis.functions.dates import elapsed_days_floored
from tianguis.functions.numbers import clip, exact_mean, right_closed_bin, share, traffic_light, true_share
from tianguis.operators.histogram import equal_width
from tianguis.operators.quantiles import counted_values, exact_quantiles
from tianguis.plans.explore_catalog import category_totals
from tianguis.plans.explore_orders import order_revenue, orders_by_state, orders_enriched

# The two sets of delivery bins.
DASHBOARD_BINS = ([0, 7, 14, 21, 30, 200], ["0-7 dias", "8-14 dias", "15-21 dias", "22-30 dias", "30+ dias"])
NOTEBOOK_BINS = ([0, 7, 14, 21, 30, 60], ["0-7d", "8-14d", "15-21d", "22-30d", "30d+"])


def mean(column) -> Column:
    """Mean of an integer column as one division, so that it does not depend on the order of rows."""
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def delivery_days(frames) -> DataFrame:
    """Delivered orders with both timestamps: whole days to deliver and days ahead of the estimate."""
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return frames.orders.where(
        (F.col("order_status") == "delivered") & received.isNotNull() & bought.isNotNull()
    ).select(
        "order_id",
        "customer_id",
        elapsed_days_floored(bought, received).alias("dias_entrega"),
        elapsed_days_floored(received, F.col("order_estimated_delivery_date")).alias("dias_vs_estimado"),
    )


def delivered_orders(frames) -> DataFrame:
    """L32/D12."""
    states = frames.customers.select("customer_id", "customer_state")
    return delivery_days(frames).join(states, "customer_id", "left")


def delivery_histogram_clipped(frames) -> DataFrame:
    """Days to deliver, outliers counted at 0 and 60."""
    days = delivery_days(frames).select(clip(F.col("dias_entrega"), 0, 60).alias("dias"))
    return equal_width(days, "dias", 40)


def delivery_histogram_filtered(frames) -> DataFrame:
    """Days to deliver, outliers left out."""
    days = delivery_days(frames).where(F.col("dias_entrega").between(0, 60)).select(F.col("dias_entrega").alias("dias"))
    return equal_width(days, "dias", 40)


def estimate_histogram(frames) -> DataFrame:
    """Days ahead of the estimate, outliers counted at -30 and 30."""
    days = delivery_days(frames).select(clip(F.col("dias_vs_estimado"), -30, 30).alias("dias"))
    return equal_width(days, "dias", 40)


def delivery_by_state(frames, min_orders: int = 100) -> DataFrame:
    """Mean days per state with enough orders, and how slow that is."""
    return (
        delivered_orders(frames)
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(mean("dias_entrega").alias("dias_prom"), F.count("order_id").alias("n"))
        .where(F.col("n") >= min_orders)
        .withColumn("severidad", traffic_light(F.col("dias_prom"), 20, 15))
    )


def slowest_states(by_state: DataFrame, n: int) -> DataFrame:
    """The slowest ``n`` states."""
    return by_state.orderBy(F.col("dias_prom").desc(), "customer_state").limit(n)


def delivery_overall(frames) -> DataFrame:
    """Mean and median days to deliver over all delivered orders."""
    counted = counted_values(delivery_days(frames), "dias_entrega")
    return exact_quantiles(counted, "dias_entrega", {"mediana": (1, 2)}).select(
        (F.col("sum").cast("double") / F.nullif("n", F.lit(0))).alias("promedio"),
        F.col("mediana").cast("double").alias("mediana"),
        F.col("n").alias("ordenes"),
    )


def on_time_share(frames) -> DataFrame:
    """Share of delivered orders not later than estimated; without an estimate, late."""
    return delivery_days(frames).agg(true_share(F.col("dias_vs_estimado") >= 0).alias("pct_a_tiempo"))


def scores_per_order(frames) -> DataFrame:
    """Scored reviews per order, summed before any join."""
    return frames.reviews.where(F.col("review_score").isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("review_score").cast("int")).alias("_score")
    )


def score_by_delivery_bucket(frames, bins=DASHBOARD_BINS, keep_unreviewed: bool = True) -> DataFrame:
    """Mean score per delivery bucket.

    Starting from deliveries, a bucket without reviews stays with no score; starting from
    reviews (``keep_unreviewed=False``) it is not observed.
    """
    edges, labels = bins
    bucket = right_closed_bin(F.col("dias_entrega"), edges, labels)
    how = "left" if keep_unreviewed else "inner"
    return (
        delivery_days(frames)
        .select("order_id", bucket.alias("rango_entrega"))
        .where(F.col("rango_entrega").isNotNull())
        .join(scores_per_order(frames), "order_id", how)
        .groupBy("rango_entrega")
        .agg((F.sum("_score").cast("double") / F.sum("_n")).alias("review_score"))
    )


def score_distribution(frames) -> DataFrame:
    """Reviews per score and their share of all reviews, scored or not."""
    counted = frames.reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("cantidad"))
    everything = counted.agg(F.sum("cantidad")).scalar()
    return counted.where(F.col("review_score").isNotNull()).select(
        F.col("review_score").cast("int").alias("score"), "cantidad", share(F.col("cantidad"), everything).alias("pct")
    )


def score_summary(frames) -> DataFrame:
    """Mean score and the shares of good, bad, best and worst reviews."""
    score = F.col("review_score")
    return frames.reviews.agg(
        mean(score.cast("int")).alias("score_promedio"),
        true_share(score >= 4).alias("pct_positivas"),
        true_share(score <= 2).alias("pct_negativas"),
        true_share(score == 5).alias("pct_5_estrellas"),
        true_share(score == 1).alias("pct_1_estrella"),
    )


def dashboard_kpis(frames, filtered: DataFrame) -> DataFrame:
    """Three cards over the filtered enriched orders, three over everything."""
    cards = filtered.agg(
        F.count(F.lit(1)).alias("ordenes"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue_total"),
        F.round(exact_mean(F.sum("revenue"), F.count("revenue")), 4).alias("ticket_promedio"),
    )
    days = delivery_days(frames).agg(
        F.struct(mean("dias_entrega").alias("mean"), true_share(F.col("dias_vs_estimado") >= 0).alias("on_time"))
    ).scalar()
    score = frames.reviews.agg(mean(F.col("review_score").cast("int"))).scalar()
    return cards.select(
        "*",
        score.alias("score_promedio"),
        days["mean"].alias("entrega_promedio"),
        days["on_time"].alias("pct_a_tiempo"),
    )


def executive_summary(frames) -> DataFrame:
    """One row with the headline findings."""
    per_order = order_revenue(frames).agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue_total"),
        F.round(exact_mean(F.sum("revenue"), F.count("revenue")), 4).alias("ticket_promedio"),
    )
    scores = score_summary(frames).select(F.struct("score_promedio", "pct_5_estrellas", "pct_1_estrella")).scalar()
    days = delivery_days(frames).agg(
        F.struct(mean("dias_entrega").alias("mean"), true_share(F.col("dias_vs_estimado") >= 0).alias("on_time"))
    ).scalar()
    category = category_totals(frames).orderBy(F.desc("revenue"), "category").limit(1).select("category").scalar()
    state = orders_by_state(orders_enriched(frames)).where(F.col("posicion") == 1).select("customer_state").scalar()
    return per_order.select(
        "*",
        scores["score_promedio"].alias("score_promedio"),
        scores["pct_5_estrellas"].alias("pct_5_estrellas"),
        scores["pct_1_estrella"].alias("pct_1_estrella"),
        days["mean"].alias("entrega_promedio"),
        days["on_time"].alias("pct_a_tiempo"),
        category.alias("categoria_top"),
        state.alias("estado_top"),
        frames.order_items.agg(F.count_distinct("seller_id")).scalar().alias("vendedores_activos"),
    )
