"""Exploration of orders, months, order values, states and payments.

Money here is price only, without freight (T17). Groups with a missing key are left out (T12)
and the sum of no values is zero (T9).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.functions.dates import month_start
from tianguis.functions.display import money_text
from tianguis.functions.numbers import clip, exact_mean, share
from tianguis.operators.checks import stacked
from tianguis.operators.histogram import equal_width
from tianguis.operators.profile import null_profile, table_profile
from tianguis.operators.quantiles import box_statistics, quantiles_of


def dataset_profile(frames) -> DataFrame:
    """L19."""
    names = ("orders", "customers", "order_items", "payments", "reviews", "products", "sellers", "translation")
    return stacked([table_profile(name, getattr(frames, name)) for name in names])


def missing_values(frames) -> DataFrame:
    """Columns of orders and products with missing values."""
    return stacked([null_profile(name, getattr(frames, name)) for name in ("orders", "products")])


def order_revenue(frames) -> DataFrame:
    """Per order, price, freight and number of items."""
    return frames.order_items.groupBy("order_id").agg(
        F.sum("price").alias("revenue"), F.sum("freight_value").alias("freight"), F.count("order_item_id").alias("n_items")
    )


def orders_enriched(frames) -> DataFrame:
    """Every order with its revenue, if any, and its customer's place, if known."""
    places = frames.customers.select("customer_id", "customer_state", "customer_city")
    return frames.orders.join(order_revenue(frames), "order_id", "left").join(places, "customer_id", "left")


def items_enriched(frames) -> DataFrame:
    """Every item with category, order dates and customer state."""
    categories = frames.products.join(frames.translation, "product_category_name", "left").select(
        "product_id", "product_category_name_english"
    )
    orders = frames.orders.select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        "order_status",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ).join(frames.customers.select("customer_id", "customer_state"), "customer_id", "left")
    return frames.order_items.join(categories, "product_id", "left").join(orders, "order_id", "left")


def filter_orders(
    orders: DataFrame,
    dates: tuple[dt.date, dt.date] | None = None,
    states: Sequence[str] = (),
    status: Sequence[str] = ("delivered",),
) -> DataFrame:
    """Inclusive calendar days, states and statuses; an empty list does not filter."""
    kept = orders
    if dates:
        bought = F.col("order_purchase_timestamp")
        first, after = dates[0], dates[1] + dt.timedelta(days=1)
        # Half-open on the timestamp itself, so the scan can skip row groups.
        kept = kept.where(
            (bought >= F.lit(first).cast("timestamp_ntz")) & (bought < F.lit(after).cast("timestamp_ntz"))
        )
    if states:
        kept = kept.where(F.col("customer_state").isin(list(states)))
    if status:
        kept = kept.where(F.col("order_status").isin(list(status)))
    return kept


def headline_counts(frames) -> DataFrame:
    """L22."""
    orders = frames.orders.agg(
        F.count(F.lit(1)).alias("ordenes"),
        F.min("order_purchase_timestamp").cast("date").alias("primera_fecha"),
        F.max("order_purchase_timestamp").cast("date").alias("ultima_fecha"),
    )
    items = frames.order_items.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("price"), F.lit(0)).alias("revenue"))
    ).scalar()
    return orders.select(
        "ordenes",
        items["n"].alias("items"),
        frames.customers.agg(F.count_distinct("customer_unique_id")).scalar().alias("clientes_unicos"),
        frames.sellers.agg(F.count(F.lit(1))).scalar().alias("vendedores"),
        frames.products.agg(F.count(F.lit(1))).scalar().alias("productos"),
        items["revenue"].alias("revenue_total"),
        "primera_fecha",
        "ultima_fecha",
    )


def order_status_counts(frames) -> DataFrame:
    """L23."""
    return frames.orders.where(F.col("order_status").isNotNull()).groupBy("order_status").agg(
        F.count(F.lit(1)).alias("cantidad")
    )


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders and revenue per calendar month of (optionally filtered) enriched orders."""
    return (
        orders.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month_start(F.col("order_purchase_timestamp")).alias("mes"))
        .agg(F.count("order_id").alias("n_ordenes"), F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"))
    )


def monthly_table_text(monthly: DataFrame) -> DataFrame:
    """The monthly table as it is shown."""
    return monthly.select(
        F.date_format("mes", "yyyy-MM").alias("mes"),
        F.col("n_ordenes").alias("ordenes"),
        money_text(F.col("revenue"), "R$ ", 0).alias("revenue"),
    )


def monthly_highlights(monthly: DataFrame) -> DataFrame:
    """The month with most orders, and growth from the fifth month to the third last."""
    # One row per calendar month.
    placed = monthly.select(
        "*",
        F.row_number().over(Window.orderBy("mes")).alias("_from_start"),
        F.row_number().over(Window.orderBy(F.col("mes").desc())).alias("_from_end"),
    )
    fifth = F.max(F.when(F.col("_from_start") == 5, F.col("n_ordenes")))
    third_last = F.max(F.when(F.col("_from_end") == 3, F.col("n_ordenes")))
    return placed.agg(
        # The earliest of several equal months.
        F.max_by("mes", F.struct("n_ordenes", "_from_end")).alias("mes_pico"),
        F.max("n_ordenes").alias("ordenes_pico"),
        (third_last.cast("double") / F.nullif(fifth, F.lit(0)) * 100 - 100).alias("crecimiento_pct"),
    )


def delivered_values(frames) -> DataFrame:
    """Delivered orders that have items."""
    delivered = frames.orders.where(F.col("order_status") == "delivered").select("order_id")
    return delivered.join(order_revenue(frames), "order_id").where(F.col("revenue").isNotNull())


def order_value_stats(frames) -> DataFrame:
    """Exact median and 90th percentile next to sum, mean and maximum."""
    stats = quantiles_of(delivered_values(frames), "revenue", {"mediana": (1, 2), "p90": (9, 10)})
    return stats.select(
        F.col("sum").alias("revenue_total"),
        F.round(exact_mean(F.col("sum"), F.col("n")), 4).alias("revenue_promedio"),
        "mediana",
        F.col("max").alias("maximo"),
        "p90",
        F.col("n").alias("ordenes"),
    )


def order_value_histogram(frames, upper: int = 1000, bins: int = 50) -> DataFrame:
    """Order values, larger ones counted at ``upper``."""
    clipped = delivered_values(frames).select(clip(F.col("revenue"), high=upper).cast("decimal(12,2)").alias("revenue"))
    return equal_width(clipped, "revenue", bins)


def order_value_by_items(frames, upper: int = 2000) -> DataFrame:
    """Box statistics of the order value for 1, 2, 3, 4 and 5 or more items."""
    n_items = F.col("n_items")
    label = F.when(n_items >= 5, "5+").otherwise(n_items.cast("string"))
    clipped = delivered_values(frames).select(
        label.alias("n_items"), clip(F.col("revenue"), high=upper).cast("decimal(12,2)").alias("revenue")
    )
    return box_statistics(clipped, "n_items", "revenue")


def orders_by_state(orders: DataFrame) -> DataFrame:
    """Orders and revenue per state, with share, running share and position."""
    per_state = (
        orders.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count("order_id").alias("n_ordenes"), F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"))
    )
    # One row per state.
    by_orders = Window.orderBy(F.col("n_ordenes").desc(), "customer_state")
    everything = F.sum("n_ordenes").over(Window.partitionBy())
    upto = F.sum("n_ordenes").over(by_orders.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_state.select(
        "customer_state",
        "n_ordenes",
        "revenue",
        share(F.col("n_ordenes"), everything).alias("pct_ordenes"),
        share(upto, everything).alias("pct_acum"),
        F.row_number().over(by_orders).alias("posicion"),
    )


def top_state_share(by_state: DataFrame, n: int = 3) -> DataFrame:
    """Share of all orders held by the first ``n`` states."""
    first = F.sum(F.when(F.col("posicion") <= n, F.col("n_ordenes")))
    return by_state.agg(share(first, F.sum("n_ordenes")).alias("pct_top"))


def top_states_by_revenue(by_state: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` states with most *orders*, placed by their revenue."""
    ascending = Window.orderBy("revenue", "customer_state")
    return by_state.where(F.col("posicion") <= n).select(
        "customer_state", "n_ordenes", "revenue", F.row_number().over(ascending).alias("lugar")
    )


def payment_type_stats(frames) -> DataFrame:
    """L30."""
    return frames.payments.where(F.col("payment_type").isNotNull()).groupBy("payment_type").agg(
        F.count("order_id").alias("n_transacciones"),
        F.coalesce(F.sum("payment_value"), F.lit(0)).alias("revenue"),
        (F.sum("payment_installments").cast("double") / F.nullif(F.count("payment_installments"), F.lit(0))).alias(
            "cuotas_prom"
        ),
    )


def card_share(by_type: DataFrame, payment_type: str = "credit_card") -> DataFrame:
    """Share of the value paid by card, and its mean number of instalments."""
    card = F.col("payment_type") == payment_type
    return by_type.agg(
        share(F.sum(F.when(card, F.col("revenue"))), F.sum("revenue")).alias("pct_revenue"),
        F.max(F.when(card, F.col("cuotas_prom"))).alias("cuotas_prom"),
    )


def card_installments(frames, n: int = 12) -> DataFrame:
    """How often card payments use each of the ``n`` lowest instalment counts."""
    return (
        frames.payments.where((F.col("payment_type") == "credit_card") & F.col("payment_installments").isNotNull())
        .groupBy(F.col("payment_installments").alias("cuotas"))
        .agg(F.count(F.lit(1)).alias("transacciones"))
        .orderBy("cuotas")
        .limit(n)
    )


def filter_domain(frames) -> DataFrame:
    """First and last day, and the sorted states and statuses to choose from."""
    orders = frames.orders.select("customer_id", "order_status", "order_purchase_timestamp")
    when = F.col("order_purchase_timestamp")
    ends = {"fecha_min": F.min(when), "fecha_max": F.max(when)}
    days = orders.agg(*[edge.cast("date").cast("string").alias(name) for name, edge in ends.items()]).select(
        F.inline(F.array(*[F.struct(F.lit(name).alias("campo"), F.col(name).alias("valor")) for name in ends]))
    )
    # States of customers who ordered, without a row per order: customers are matched once.
    states = frames.customers.join(orders.select("customer_id").distinct(), "customer_id", "left_semi").select(
        F.lit("customer_state").alias("campo"), F.col("customer_state").alias("valor")
    )
    statuses = orders.select(F.lit("order_status").alias("campo"), F.col("order_status").alias("valor"))
    choices = stacked([states.distinct(), statuses.distinct()]).where(F.col("valor").isNotNull())
    return stacked([days, choices]).select(
        "campo", "valor", F.row_number().over(Window.partitionBy("campo").orderBy("valor")).alias("orden")
    )
