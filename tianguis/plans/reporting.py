"""The five reporting views and the questions asked of them.

Facts are reduced to one row per dimension key before a dimension is joined: the partial
aggregation removes hot products, sellers and customers from the shuffle, and the join then
reuses the partitioning of the aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.functions.dates import elapsed_days_truncated
from tianguis.functions.numbers import exact_mean, growth, percent
from tianguis.operators.ordering import with_ranks

NO_CATEGORY = "Sin categoría"


def monthly_revenue(star) -> DataFrame:
    """L1: revenue per month with growth over the previous month that has sales.

    Sales are reduced to one row per order and then per day before the calendar is joined. An
    order has one date, so the distinct orders of the days of a month add up.
    """
    by_day = (
        star.fact_order_items.groupBy("date_sk", "order_id")
        .agg(F.sum("total_value").alias("revenue"), F.count("total_value").alias("_n"))
        .groupBy("date_sk")
        .agg(F.sum("revenue").alias("revenue"), F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("total_ordenes"))
    )
    by_month = (
        by_day.join(star.dim_date.select("date_sk", "year", "month", "month_name"), "date_sk")
        .groupBy("year", "month", "month_name")
        .agg(*[F.sum(c).alias(c) for c in ("revenue", "total_ordenes", "_n")])
    )
    # One row per calendar month.
    previous = F.lag("revenue").over(Window.orderBy("year", "month"))
    return by_month.withColumn("revenue_mes_anterior", previous).select(
        "year",
        "month",
        "month_name",
        F.round("revenue", 2).alias("revenue"),
        "total_ordenes",
        F.round(exact_mean(F.col("revenue"), F.col("_n")), 2).alias("ticket_promedio"),
        F.round("revenue_mes_anterior", 2).alias("revenue_mes_anterior"),
        growth(F.col("revenue"), F.col("revenue_mes_anterior")).alias("crecimiento_pct"),
    )


def category_pareto(star) -> DataFrame:
    """L2: categories by revenue with their running share (ties share one value)."""
    per_product = star.fact_order_items.groupBy("product_sk").agg(
        F.sum("total_value").alias("revenue"), F.count(F.lit(1)).alias("total_items")
    )
    per_category = (
        per_product.join(star.dim_products.select("product_sk", "product_category_name_english"), "product_sk")
        .groupBy("product_category_name_english")
        .agg(F.sum("revenue").cast("decimal(24,2)").alias("revenue"), F.sum("total_items").alias("total_items"))
        .select(
            F.coalesce("product_category_name_english", F.lit(NO_CATEGORY)).alias("categoria"), "revenue", "total_items"
        )
    )
    # One row per category: a bounded set of labels. The default frame gives equal values one running sum.
    by_revenue = Window.orderBy(F.col("revenue").desc())
    ranked = per_category.withColumns(
        {
            "ranking": F.rank().over(by_revenue).cast("long"),
            "_upto": F.sum("revenue").over(by_revenue).cast("decimal(24,2)"),
            "_total": F.sum("revenue").over(Window.partitionBy()).cast("decimal(24,2)"),
        }
    )
    return ranked.select(
        "categoria",
        F.round("revenue", 2).alias("revenue"),
        "total_items",
        F.round(percent(F.col("revenue"), F.col("_total")), 2).alias("pct_del_total"),
        F.round(percent(F.col("_upto"), F.col("_total")), 2).alias("pct_acumulado"),
        "ranking",
        # The unrounded share against 0.8, without dividing.
        F.when(F.col("_upto") * 10 <= F.col("_total") * 8, "Top 80%").otherwise("Restante 20%").alias("segmento_pareto"),
    )


def seller_totals(star) -> DataFrame:
    """Per seller key: revenue, items, distinct orders, distinct products and first and last sale.

    E3: both distinct counts come from one reading of the fact. Rows meet by order and seller, so that neither a hot order
    nor a hot seller is one task's work, and one row of each order is marked there. Then a row goes out once with its amounts
    and its mark, which collapse into one row for each seller and task, and once with its product; the pairs of seller and
    product collapse inside the task, then in one exchange, and are counted. No task holds orders but those it sorts.
    """
    fact = star.fact_order_items.select("seller_sk", "order_id", "product_sk", "total_value", "date_sk")
    # Any row of an order at a seller will do: all marks of a seller are added.
    place = F.row_number().over(Window.partitionBy("order_id", "seller_sk").orderBy("order_id"))
    first = F.when((place == 1) & F.col("order_id").isNotNull(), 1)
    marked = fact.repartition("order_id", "seller_sk").withColumn("_order", first)
    blank = {f.name: F.lit(None).cast(f.dataType) for f in marked.schema if f.name not in ("seller_sk", "order_id")}

    def out(*names: str):
        return F.struct(*[(F.col(n) if n in names else blank[n]).alias(n) for n in blank])

    both = marked.select("seller_sk", F.inline(F.array(out("_order", "total_value", "date_sk"), out("product_sk"))))
    pairs = both.groupBy("seller_sk", "product_sk").agg(
        F.sum("total_value").alias("revenue"),
        F.count("total_value").alias("_n"),
        F.count("_order").alias("_orders"),
        F.min("date_sk").alias("_first"),
        F.max("date_sk").alias("_last"),
    )
    return pairs.groupBy("seller_sk").agg(
        F.sum("revenue").cast("decimal(20,2)").alias("revenue_total"),
        F.sum("_n").alias("_n"),
        F.sum("_orders").alias("total_ordenes"),
        F.count("product_sk").alias("productos_distintos"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )


def seller_ranking(star) -> DataFrame:
    """L3: sellers with independent ranks by revenue, orders and rounded ticket."""
    metrics = (
        seller_totals(star)
        .join(star.dim_sellers.select("seller_sk", "seller_id", "seller_city", "seller_state"), "seller_sk")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            "revenue_total",
            "total_ordenes",
            F.round(exact_mean(F.col("revenue_total"), F.col("_n")), 2).alias("ticket_promedio"),
            "productos_distintos",
        )
    )
    ranked = with_ranks(
        metrics,
        "seller_id",
        {"revenue_total": "ranking_revenue", "total_ordenes": "ranking_ordenes", "ticket_promedio": "ranking_ticket"},
    )
    return ranked.withColumn("revenue_total", F.round("revenue_total", 2))


def delivery_by_state(star) -> DataFrame:
    """L4: whole elapsed days per customer state, weighted by items."""
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    delivered = star.dim_orders.where(bought.isNotNull() & received.isNotNull() & (received > bought)).select(
        "order_sk", elapsed_days_truncated(bought, received).alias("dias")
    )
    per_customer = (
        star.fact_order_items.select("order_sk", "customer_sk")
        .join(delivered, "order_sk")
        .groupBy("customer_sk")
        .agg(
            F.sum("dias").alias("_sum"),
            F.min("dias").alias("_min"),
            F.max("dias").alias("_max"),
            F.count("dias").alias("_n"),
        )
    )
    per_state = (
        per_customer.join(star.dim_customers.select("customer_sk", "customer_state"), "customer_sk")
        .groupBy(F.col("customer_state").alias("estado"))
        .agg(
            F.sum("_sum").alias("_sum"),
            F.min("_min").alias("entrega_minima"),
            F.max("_max").alias("entrega_maxima"),
            F.sum("_n").alias("total_entregas"),
        )
        .withColumn("_mean", exact_mean(F.col("_sum"), F.col("total_entregas")))
    )
    return per_state.select(
        "estado",
        F.round("_mean", 1).alias("dias_promedio"),
        "entrega_minima",
        "entrega_maxima",
        "total_entregas",
        F.rank().over(Window.orderBy(F.col("_mean").asc())).alias("ranking_mejor_entrega"),
        F.rank().over(Window.orderBy(F.col("_mean").desc())).alias("ranking_peor_entrega"),
    )


def review_summary(reviews: DataFrame) -> DataFrame:
    """Per order: how many scored reviews and what they add up to."""
    score = F.col("review_score")
    return reviews.where(score.isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(score.cast("int")).alias("score_sum"),
        F.sum(F.when(score >= 4, 1).otherwise(0)).alias("positive"),
        F.sum(F.when(score <= 2, 1).otherwise(0)).alias("negative"),
    )


def category_satisfaction(star, min_rows: int = 50) -> DataFrame:
    """Every (item, review) pair of an order counts once, per category.

    The pairs are never produced: reviews are summed per order first, and an item adds its
    order's sums. Totals over pairs come out the same, however many reviews one order has.
    """
    per_product = (
        star.fact_order_items.select("order_id", "product_sk", "total_value")
        .join(review_summary(star.fact_reviews), "order_id")
        .groupBy("product_sk")
        .agg(
            F.sum("reviews").alias("_pairs"),
            F.sum("score_sum").alias("_score"),
            F.sum("positive").alias("_positive"),
            F.sum("negative").alias("_negative"),
            F.sum(F.col("total_value") * F.col("reviews").cast("decimal(15,0)")).alias("_value"),
        )
    )
    label = F.coalesce("product_category_name_english", F.lit(NO_CATEGORY))
    per_category = (
        per_product.join(star.dim_products.select("product_sk", "product_category_name_english"), "product_sk")
        .groupBy(label.alias("categoria"))
        .agg(*[F.sum(c).alias(c) for c in ("_pairs", "_score", "_positive", "_negative", "_value")])
        .where(F.col("_pairs") >= min_rows)
        .withColumn("_mean", exact_mean(F.col("_score"), F.col("_pairs")))
    )
    by_mean = Window.orderBy(F.col("_mean").desc())  # one row per category
    return per_category.withColumn("ranking_satisfaccion", F.rank().over(by_mean).cast("long")).select(
        "categoria",
        F.round("_mean", 2).alias("score_promedio"),
        F.col("_pairs").alias("total_reviews"),
        F.col("_positive").alias("reviews_positivas"),
        F.col("_negative").alias("reviews_negativas"),
        F.round(percent(F.col("_positive"), F.col("_pairs")), 1).alias("pct_satisfaccion"),
        F.round(exact_mean(F.col("_value"), F.col("_pairs")), 2).alias("ticket_promedio"),
        "ranking_satisfaccion",
    )


# View names are fixed values: they are what existing queries select from.
VIEWS = {
    "vw_revenue_mensual": monthly_revenue,
    "vw_top_categorias_pareto": category_pareto,
    "vw_ranking_vendedores": seller_ranking,
    "vw_tiempo_entrega_estado": delivery_by_state,
    "vw_satisfaccion_cliente": category_satisfaction,
}

# G1: how each view is ordered when it is shown (column, descending).
PRESENTATION_ORDER = {
    "vw_revenue_mensual": [("year", False), ("month", False)],
    "vw_top_categorias_pareto": [("revenue", True)],
    "vw_ranking_vendedores": [("revenue_total", True)],
    "vw_tiempo_entrega_estado": [("dias_promedio", False)],
    "vw_satisfaccion_cliente": [("score_promedio", True)],
}


def reporting_views(star) -> dict[str, DataFrame]:
    return {name: build(star) for name, build in VIEWS.items()}


def ordered_view(name: str, df: DataFrame) -> DataFrame:
    """G1: sort at the edge only; other code reads the unsorted view."""
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in PRESENTATION_ORDER[name]])


def peak_month(monthly: DataFrame) -> DataFrame:
    """The month with the highest revenue, the earliest on a tie."""
    return (
        monthly.orderBy(F.col("revenue").desc(), "year", "month").limit(1).select("year", "month", "month_name", "revenue")
    )


def revenue_by_year(monthly: DataFrame) -> DataFrame:
    """Mean monthly revenue per year."""
    return monthly.groupBy("year").agg(
        F.round(exact_mean(F.sum("revenue"), F.count("revenue")), 2).alias("revenue_promedio")
    )


def revenue_by_seller_place(ranking: DataFrame) -> DataFrame:
    """Treemap of seller revenue by state and city."""
    return ranking.groupBy("seller_state", "seller_city").agg(
        F.sum("revenue_total").alias("revenue_total"), F.count(F.lit(1)).alias("vendedores")
    )


def slowest_states(delivery: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` states with the worst mean delivery, by name on a tie."""
    return (
        delivery.orderBy("ranking_peor_entrega", "estado").limit(n).select("estado", "dias_promedio", "ranking_peor_entrega")
    )


def headline_kpis(
    views: dict[str, DataFrame],
    years: list[int] | None = None,
    months: list[int] | None = None,
    states: list[str] | None = None,
    categories: list[str] | None = None,
) -> DataFrame:
    """Three cards over filtered view rows; an empty or missing list does not filter.

    Revenue is the sum of the monthly rows; mean delivery days weighs a state's rounded mean by
    its deliveries; the mean score weighs a category's rounded score by its rows.
    """

    def kept(df: DataFrame, column: str, values) -> DataFrame:
        return df.where(F.col(column).isin(list(values))) if values else df

    monthly = kept(kept(views["vw_revenue_mensual"], "year", years), "month", months)
    delivery = kept(views["vw_tiempo_entrega_estado"], "estado", states)
    scores = kept(views["vw_satisfaccion_cliente"], "categoria", categories)
    revenue = monthly.agg(F.sum("revenue").alias("revenue_total"))
    days = delivery.agg(
        F.round(
            exact_mean(F.sum(F.col("dias_promedio") * F.col("total_entregas")), F.sum("total_entregas")), 2
        ).alias("dias_promedio")
    )
    score = scores.agg(
        F.round(exact_mean(F.sum(F.col("score_promedio") * F.col("total_reviews")), F.sum("total_reviews")), 2).alias(
            "score_promedio"
        )
    )
    return revenue.select("revenue_total", days.scalar().alias("dias_promedio"), score.scalar().alias("score_promedio"))


def inactive_days(star) -> DataFrame:
    """Calendar days without a sale."""
    sold = star.fact_order_items.select("date_sk").distinct()
    return star.dim_date.join(sold, "date_sk", "left_anti").select("date_sk", "full_date", "day_name")
