"""Exploration of categories and sellers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.functions.numbers import exact_mean, share
from tianguis.operators.checks import stacked
from tianguis.operators.histogram import equal_width
from tianguis.operators.ordering import running

UNKNOWN = "unknown"


def category_totals(frames) -> DataFrame:
    """Revenue, items and orders per category (English, else the raw name, else unknown).

    Items are reduced to (product, order) before products are joined, and to (category, order) before orders are
    counted, so neither a hot product nor a hot category meets the join or the count row by row.
    """
    label = F.coalesce("product_category_name_english", "product_category_name", F.lit(UNKNOWN))
    products = frames.products.select("product_id", "product_category_name")
    per_pair = frames.order_items.groupBy("product_id", "order_id").agg(
        F.sum("price").alias("revenue"), F.count("order_item_id").alias("n_items")
    )
    return (
        per_pair.join(products.join(frames.translation, "product_category_name", "left"), "product_id", "left")
        .groupBy(label.alias("category"), "order_id")
        .agg(F.sum("revenue").alias("revenue"), F.sum("n_items").alias("n_items"))
        .groupBy("category")
        .agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).cast("decimal(20,2)").alias("revenue"),
            F.sum("n_items").alias("n_items"),
            F.count("order_id").alias("n_orders"),
        )
    )


def category_stats(frames) -> DataFrame:
    """Categories by revenue with share, running share and position."""
    # One row per category: a bounded set of labels.
    by_revenue = Window.orderBy(F.col("revenue").desc(), "category")
    ordered = category_totals(frames).withColumns(
        {
            "rank": F.row_number().over(by_revenue).cast("long"),
            "_upto": F.sum("revenue").over(by_revenue.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_total": F.sum("revenue").over(Window.partitionBy()),
        }
    )
    return ordered.select(
        "category",
        "revenue",
        "n_items",
        "n_orders",
        share(F.col("revenue"), F.col("_total")).alias("revenue_pct"),
        share(F.col("_upto"), F.col("_total")).alias("revenue_acum"),
        "rank",
    )


def categories_for_share(stats: DataFrame, limit: int = 80) -> DataFrame:
    """How many leading categories stay within ``limit`` percent of the revenue."""
    return stats.agg(F.count_if(F.col("revenue_acum") <= limit).alias("n_categorias"))


def top_categories(stats: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` categories with most revenue."""
    return stats.where(F.col("rank") <= n).select("category", "revenue", "revenue_pct", "rank")


def category_scores(frames, min_reviews: int = 100) -> DataFrame:
    """Mean score per category over (review, item) pairs, reviews without items included.

    Reviews are summed per order and items counted per order and product before they meet, so
    no pair is produced. (Adaptive execution cannot split the right side of a left join, hence
    the second count: an order then has at most one row per product.)
    """
    per_order = frames.reviews.where(F.col("review_score").isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("review_score").cast("int")).alias("_score")
    )
    bought = frames.order_items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("_items"))
    items = F.coalesce("_items", F.lit(1))
    per_product = (
        per_order.join(bought, "order_id", "left")
        .groupBy("product_id")
        .agg(F.sum(F.col("_n") * items).alias("_n"), F.sum(F.col("_score") * items).alias("_score"))
    )
    categories = frames.products.join(frames.translation, "product_category_name", "left").select(
        "product_id", "product_category_name_english"
    )
    return (
        per_product.join(categories, "product_id", "left")
        .groupBy(F.coalesce("product_category_name_english", F.lit(UNKNOWN)).alias("category"))
        .agg(F.sum("_n").alias("n_reviews"), F.sum("_score").alias("_score"))
        .where(F.col("n_reviews") >= min_reviews)
        .select("category", (F.col("_score").cast("double") / F.col("n_reviews")).alias("avg_score"), "n_reviews")
    )


def best_and_worst(scores: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best categories and the ``n`` worst, worst first, as one list."""
    best = scores.orderBy(F.col("avg_score").desc(), "category").limit(n).withColumn("grupo", F.lit("mejores"))
    worst = scores.orderBy(F.col("avg_score").asc(), F.col("category").desc()).limit(n).withColumn("grupo", F.lit("peores"))
    return stacked([best, worst])


def seller_totals(frames) -> DataFrame:
    """Per seller: revenue, orders, items and mean price."""
    return frames.order_items.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.coalesce(F.sum("price"), F.lit(0)).alias("revenue"),
        F.count_distinct("order_id").alias("n_ordenes"),
        F.count("order_item_id").alias("n_items"),
        F.round(exact_mean(F.sum("price"), F.count("price")), 4).alias("ticket_prom"),
    )


def seller_stats(frames) -> DataFrame:
    """Sellers by revenue with share, running share and position."""
    ordered = running(
        seller_totals(frames),
        [("revenue", True), ("seller_id", False)],
        position="rank",
        sums={"revenue": ("_upto", "_total")},
    )
    return ordered.join(frames.sellers.select("seller_id", "seller_state"), "seller_id", "left").select(
        "seller_id",
        "revenue",
        "n_ordenes",
        "n_items",
        "ticket_prom",
        "seller_state",
        share(F.col("revenue"), F.col("_total")).alias("revenue_pct"),
        share(F.col("_upto"), F.col("_total")).alias("revenue_acum"),
        "rank",
    )


def seller_revenue(frames) -> DataFrame:
    return frames.order_items.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.coalesce(F.sum("price"), F.lit(0)).alias("revenue")
    )


def revenue_log_histogram(frames, bins: int = 40) -> DataFrame:
    """Sellers by log10(revenue + 1)."""
    logs = seller_revenue(frames).select(F.log10(F.col("revenue").cast("double") + 1).alias("log_revenue"))
    return equal_width(logs, "log_revenue", bins)


def lorenz_curve(frames) -> DataFrame:
    """Running share of revenue against the share of sellers, poorest first."""
    ordered = running(
        seller_revenue(frames),
        [("revenue", False), ("seller_id", False)],
        position="posicion",
        count="_sellers",
        sums={"revenue": ("_upto", "_total")},
    )
    steps = F.nullif((F.col("_sellers") - 1).cast("double"), F.lit(0.0))
    return ordered.select(
        "seller_id",
        "posicion",
        F.coalesce((F.col("posicion") - 1) / steps * 100, F.lit(0.0)).alias("pct_vendedores"),
        share(F.col("_upto"), F.col("_total")).alias("pct_revenue"),
    )


def seller_concentration(frames) -> DataFrame:
    """How few sellers make half of the revenue, how many have under ten orders, and the
    mean and median revenue. The median is read off the positions already computed."""
    totals = frames.order_items.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.coalesce(F.sum("price"), F.lit(0)).alias("revenue"), F.count_distinct("order_id").alias("n_ordenes")
    )
    ordered = running(
        totals,
        [("revenue", True), ("seller_id", False)],
        position="_rank",
        count="_sellers",
        sums={"revenue": ("_upto", "_total")},
    )
    sellers = F.max("_sellers")
    middle = F.col("_rank").isin(F.floor((F.col("_sellers") + 1) / 2), F.floor((F.col("_sellers") + 2) / 2))
    middle_value = F.when(middle, F.col("revenue"))
    # The running share against 50 %, without dividing.
    leading = F.count_if(F.col("_upto") * 2 <= F.col("_total"))
    return ordered.agg(
        F.coalesce(sellers, F.lit(0)).alias("vendedores"),
        share(leading, sellers).alias("pct_vendedores_50"),
        share(F.count_if(F.col("n_ordenes") < 10), sellers).alias("pct_menos_10_ordenes"),
        F.round(exact_mean(F.max("_total"), sellers), 4).alias("revenue_promedio"),
        F.round(exact_mean(F.min(middle_value) + F.max(middle_value), F.lit(2)), 4).alias("revenue_mediana"),
    )


def seller_states(frames, n: int = 10) -> DataFrame:
    """The ``n`` seller states with most revenue."""
    return (
        seller_revenue(frames)
        .join(frames.sellers.select("seller_id", "seller_state"), "seller_id")
        .where(F.col("seller_state").isNotNull())
        .groupBy("seller_state")
        .agg(F.sum("revenue").alias("revenue"), F.count("seller_id").alias("n_sellers"))
        .orderBy(F.col("revenue").desc(), "seller_state")
        .limit(n)
    )
