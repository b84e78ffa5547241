
from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from checks.oracle import statements  # noqa: E402
from tianguis.operators.checks import stacked  # noqa: E402
from tianguis.plans import explore_catalog as catalog  # noqa: E402
from tianguis.plans import explore_orders as orders  # noqa: E402
from tianguis.plans import explore_service as service  # noqa: E402
from tianguis.plans import functions, monthly, quality, reporting, segments  # noqa: E402
from tianguis.plans import star as star_plans  # noqa: E402
from tianguis.sources.raw import manifest  # noqa: E402
from tianguis.sources.standin import StandIn  # noqa: E402

try:
    from tianguis.llm.entry import QUERIES as CORPUS_QUERIES  # noqa: E402
    from tianguis.llm.entry import SQL as CORPUS_SQL  # noqa: E402
except ImportError as error:  # the subpackage or something it needs is not installed: the other queries still work
    print(f"queries of tianguis.llm are left out: {error}", file=sys.stderr)
    CORPUS_QUERIES, CORPUS_SQL = {}, {}

def plain(df: DataFrame) -> DataFrame:
    """Integers as bigint and decimals as double, the types the comparison SQL returns."""
    integers = (T.ByteType, T.ShortType, T.IntegerType)
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, integers):
            column = column.cast("bigint").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _built_star(s: StandIn):
    return star_plans.plan_star(s.staging)


def _soiled_star(s: StandIn):
    return star_plans.plan_star(s.soiled)


def _fact_by_natural_keys(s: StandIn) -> DataFrame:
    """The item fact with its surrogate keys translated back, which also proves the keys.

    The fact lies by its orders when it is built. There the order key is held against the order, and customers come back
    once for each pair of order and customer. Items then travel for products and sellers alone, without their total: what it
    differs from price and freight is next to nothing.
    """
    star = _built_star(s)
    parts = F.col("price") + F.col("freight_value")
    fact = star.fact_order_items.drop("order_item_sk")
    # The pairs read every column of the fact, so that both readings share its exchanges.
    pairs = fact.groupBy("order_id", "customer_sk").agg(F.max(F.xxhash64(*fact.columns)).alias("_whole")).where(F.col("_whole").isNotNull())
    bought = (
        pairs.drop("_whole")
        .join(star.dim_customers.select("customer_sk", "customer_id"), "customer_sk")
        .join(star.dim_orders.select("order_sk", "order_id"), "order_id")
        .withColumnsRenamed({"order_id": "_order_id", "order_sk": "_order_sk", "customer_sk": "_customer_sk"})
    )
    # Keys are compared by their difference: as keys of the join they would make Spark deal the items out anew.
    same = [F.col(key) - F.col(f"_{key}") == 0 for key in ("order_sk", "customer_sk")]
    return (
        fact.join(bought, [F.col("order_id") == F.col("_order_id"), *same])
        .withColumn("_rest", F.col("total_value") - parts)
        .drop("total_value")
        .join(star.dim_products.select("product_sk", "product_id"), "product_sk")
        .join(star.dim_sellers.select("seller_sk", "seller_id"), "seller_sk")
        .select(
            "order_id",
            "order_item_id",
            "customer_id",
            "product_id",
            "seller_id",
            "date_sk",
            "price",
            "freight_value",
            (parts + F.col("_rest")).cast("decimal(10,2)").alias("total_value"),
        )
    )


def _with_matched_order(star, fact: str, key: str) -> DataFrame:
    """A fact with its order key translated back to the order it resolved to."""
    matched = star.dim_orders.select("order_sk", F.col("order_id").alias("matched_order_id"))
    return getattr(star, fact).join(matched, "order_sk", "left").drop(key, "order_sk")


def _surrogate_keys(s: StandIn) -> DataFrame:
    star = _built_star(s)
    keys = {
        "dim_customers": "customer_sk",
        "dim_sellers": "seller_sk",
        "dim_products": "product_sk",
        "dim_orders": "order_sk",
        "fact_order_items": "order_item_sk",
        "fact_payments": "payment_sk",
        "fact_reviews": "review_sk",
    }
    return stacked(
        [
            getattr(star, table)
            .agg(
                F.count(F.lit(1)).alias("filas"),
                F.count_distinct(key).alias("claves"),
                F.count_if(F.col(key).isNull()).alias("nulas"),
                F.min(key).alias("menor"),
                F.max(key).alias("mayor"),
            )
            .select(F.lit(table).alias("tabla"), "filas", "claves", "nulas", "menor", "mayor")
            for table, key in keys.items()
        ]
    )


def _sliced(s: StandIn) -> DataFrame:
    return reporting.headline_kpis(
        reporting.reporting_views(s.star),
        years=[1997, 1998],
        months=[1, 2, 3],
        states=["NATION_1", "NATION_2"],
        categories=["cat_3", "cat_4"],
    )


def _filtered(s: StandIn) -> DataFrame:
    return orders.filter_orders(
        orders.orders_enriched(s),
        dates=(dt.date(1996, 3, 15), dt.date(2000, 6, 30)),
        states=["NATION_1", "NATION_5", "NATION_9"],
    )


def _report_by_function(s: StandIn) -> DataFrame:
    functions.register_functions(s.spark, s.star)
    return s.spark.sql(f"SELECT * FROM {functions.REPORT}(2001, 4)")


def _summary_by_function(s: StandIn) -> DataFrame:
    functions.register_functions(s.spark, s.star)
    return s.spark.sql(f"SELECT * FROM {functions.SEGMENTS}()")


def _snapshots(s: StandIn) -> DataFrame:
    return monthly.monthly_snapshots(s.star)


PLANS: dict[str, Callable[[StandIn], DataFrame]] = {
    # Reporting views and what is asked of them.
    "monthly_revenue": lambda s: reporting.monthly_revenue(s.star),
    "category_pareto": lambda s: reporting.category_pareto(s.star),
    "seller_ranking": lambda s: reporting.seller_ranking(s.star),
    "delivery_by_state": lambda s: reporting.delivery_by_state(s.star),
    "category_satisfaction": lambda s: reporting.category_satisfaction(s.star),
    "category_satisfaction_binding": lambda s: reporting.category_satisfaction(s.star, min_rows=2200),
    "view_counts": lambda s: quality.view_counts(reporting.reporting_views(s.star)),
    "peak_month": lambda s: reporting.peak_month(reporting.monthly_revenue(s.star)),
    "revenue_by_year": lambda s: reporting.revenue_by_year(reporting.monthly_revenue(s.star)),
    "seller_revenue_by_state_city": lambda s: reporting.revenue_by_seller_place(reporting.seller_ranking(s.star)),
    "slowest_states_top10": lambda s: reporting.slowest_states(reporting.delivery_by_state(s.star)),
    "bi_headline_kpis": lambda s: reporting.headline_kpis(reporting.reporting_views(s.star)),
    "bi_headline_kpis_sliced": _sliced,
    "inactive_days": lambda s: reporting.inactive_days(s.star),
    # Monthly report and snapshots.
    "monthly_report_one": lambda s: monthly.monthly_report(s.star, 2001, 4),
    "monthly_report_function": _report_by_function,
    "monthly_report_range": lambda s: monthly.report_rows(s.star),
    "monthly_report_batch": _snapshots,
    "months_with_revenue": lambda s: monthly.months_with_revenue(_snapshots(s)),
    "snapshot_listing": lambda s: monthly.snapshot_listing(_snapshots(s)),
    "snapshot_listing_text": lambda s: monthly.snapshot_listing_text(_snapshots(s)),
    "snapshot_peak": lambda s: monthly.snapshot_peak(_snapshots(s)),
    # Segments.
    "seller_segments": lambda s: segments.segment_sellers(s.star),
    "segment_summary": lambda s: segments.segment_summary(segments.segment_sellers(s.star)),
    "segment_summary_function": _summary_by_function,
    "segment_distribution": lambda s: segments.segment_distribution(segments.segment_sellers(s.star)),
    "segment_distribution_text": lambda s: segments.segment_distribution_text(segments.segment_sellers(s.star)),
    "segment_a_top10": lambda s: segments.segment_top(segments.segment_sellers(s.star)),
    "segment_avg_revenue": lambda s: segments.segment_mean_revenue(segments.segment_sellers(s.star)),
    # The star schema from text staging.
    "dim_date": lambda s: star_plans.dim_date(s.staging),
    "dim_customers": lambda s: star_plans.dim_customers(s.staging).drop("customer_sk"),
    "dim_sellers": lambda s: star_plans.dim_sellers(s.staging).drop("seller_sk"),
    "dim_products": lambda s: star_plans.dim_products(s.staging).drop("product_sk"),
    "dim_orders": lambda s: star_plans.dim_orders(s.staging).drop("order_sk"),
    "fact_order_items": _fact_by_natural_keys,
    "fact_payments": lambda s: _with_matched_order(_built_star(s), "fact_payments", "payment_sk"),
    "fact_reviews": lambda s: _with_matched_order(_built_star(s), "fact_reviews", "review_sk"),
    "surrogate_keys": _surrogate_keys,
    # Reports over the star that is built from text staging, clean and soiled.
    "built_monthly_revenue": lambda s: reporting.monthly_revenue(_built_star(s)),
    "built_category_pareto": lambda s: reporting.category_pareto(_built_star(s)),
    "built_seller_ranking": lambda s: reporting.seller_ranking(_built_star(s)),
    "built_delivery_by_state": lambda s: reporting.delivery_by_state(_built_star(s)),
    "built_category_satisfaction": lambda s: reporting.category_satisfaction(_built_star(s)),
    "built_segment_summary": lambda s: segments.segment_summary(segments.segment_sellers(_built_star(s))),
    "soiled_monthly_revenue": lambda s: reporting.monthly_revenue(_soiled_star(s)),
    "soiled_dq_info": lambda s: quality.star_info(_soiled_star(s)),
    "soiled_dq_checks": lambda s: quality.star_checks(_soiled_star(s)),
    "soiled_fk_coverage": lambda s: quality.fk_coverage(_soiled_star(s)),
    "soiled_fact_amounts": lambda s: quality.fact_amounts(_soiled_star(s)),
    # Quality.
    "staging_counts": lambda s: quality.staging_counts(s.staging),
    "file_manifest": lambda s: manifest(quality.staging_counts(s.staging)),
    "dq_info": lambda s: quality.star_info(_built_star(s)),
    "dq_checks": lambda s: quality.star_checks(_built_star(s)),
    "dq_constraints": lambda s: quality.star_constraints(_built_star(s)),
    "dq_text_lengths": lambda s: quality.text_lengths(_built_star(s)),
    "dq_fact_amounts": lambda s: quality.fact_amounts(_built_star(s)),
    "fk_coverage": lambda s: quality.fk_coverage(_built_star(s)),
    "sk_integrity": lambda s: quality.sk_integrity(_built_star(s)),
    "calendar_gaps": lambda s: quality.calendar_gaps(s.star.dim_date),
    "dq_views": lambda s: quality.view_checks(reporting.reporting_views(s.star)),
    "dq_snapshots": lambda s: quality.snapshot_checks(_snapshots(s)),
    "dq_segment_constraints": lambda s: quality.segment_constraints(segments.segment_sellers(s.star)),
    "dq_snapshot_constraints": lambda s: quality.snapshot_constraints(_snapshots(s)),
    "dq_segments": lambda s: quality.segment_checks(segments.segment_sellers(s.star)),
    # Exploration: orders, months, values, states, payments.
    "dataset_profile": orders.dataset_profile,
    "null_profile": orders.missing_values,
    "order_revenue": orders.order_revenue,
    "orders_enriched": orders.orders_enriched,
    "items_enriched": orders.items_enriched,
    "headline_counts": orders.headline_counts,
    "order_status_counts": orders.order_status_counts,
    "eda_monthly": lambda s: orders.orders_by_month(orders.orders_enriched(s)),
    "eda_monthly_delivered": lambda s: orders.orders_by_month(orders.filter_orders(orders.orders_enriched(s))),
    "eda_monthly_filtered": lambda s: orders.orders_by_month(_filtered(s)),
    "eda_monthly_text": lambda s: orders.monthly_table_text(orders.orders_by_month(orders.orders_enriched(s))),
    "eda_monthly_highlights": lambda s: orders.monthly_highlights(orders.orders_by_month(orders.orders_enriched(s))),
    "order_value_stats": orders.order_value_stats,
    "order_value_histogram": orders.order_value_histogram,
    "order_value_histogram_wide": lambda s: orders.order_value_histogram(s, upper=300_000),
    "order_value_by_items": orders.order_value_by_items,
    "order_value_by_items_wide": lambda s: orders.order_value_by_items(s, upper=400_000),
    "orders_by_state": lambda s: orders.orders_by_state(orders.orders_enriched(s)),
    "top_state_share": lambda s: orders.top_state_share(orders.orders_by_state(orders.orders_enriched(s))),
    "top_states_by_revenue": lambda s: orders.top_states_by_revenue(orders.orders_by_state(orders.orders_enriched(s))),
    "payment_type_stats": orders.payment_type_stats,
    "card_share": lambda s: orders.card_share(orders.payment_type_stats(s)),
    "card_installments": orders.card_installments,
    "filter_domain": orders.filter_domain,
    # Exploration: categories and sellers.
    "eda_category_stats": catalog.category_stats,
    "categories_for_80": lambda s: catalog.categories_for_share(catalog.category_stats(s)),
    "top_categories": lambda s: catalog.top_categories(catalog.category_stats(s)),
    "category_satisfaction_eda": catalog.category_scores,
    "category_best_worst": lambda s: catalog.best_and_worst(catalog.category_scores(s)),
    "eda_seller_stats": catalog.seller_stats,
    "seller_revenue_log_histogram": lambda s: catalog.revenue_log_histogram(s).withColumns(
        {"desde": F.round("desde", 6), "hasta": F.round("hasta", 6)}
    ),
    "lorenz_curve": catalog.lorenz_curve,
    "seller_concentration": catalog.seller_concentration,
    "seller_state_top10": catalog.seller_states,
    # Exploration: delivery, scores, summaries.
    "delivered_orders": service.delivered_orders,
    "delivery_histogram_clipped": service.delivery_histogram_clipped,
    "delivery_histogram_filtered": service.delivery_histogram_filtered,
    "estimate_histogram": service.estimate_histogram,
    "delivery_state_eda": service.delivery_by_state,
    "delivery_state_slowest": lambda s: service.slowest_states(service.delivery_by_state(s), 10),
    "delivery_overall": service.delivery_overall,
    "on_time_pct": service.on_time_share,
    "score_by_delivery_bucket": service.score_by_delivery_bucket,
    "score_by_delivery_bucket_notebook": lambda s: service.score_by_delivery_bucket(
        s, service.NOTEBOOK_BINS, keep_unreviewed=False
    ),
    "score_distribution": service.score_distribution,
    "score_summary": service.score_summary,
    "dashboard_kpis": lambda s: service.dashboard_kpis(s, orders.filter_orders(orders.orders_enriched(s))),
    "executive_summary": service.executive_summary,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: monthly revenue with growth."""
    star = StandIn(spark, "/root/testdata/sf0.001").star
    return plain(reporting.ordered_view("vw_revenue_mensual", reporting.monthly_revenue(star)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(plan: Callable[[StandIn], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(plan(StandIn(spark, sf_dir)))

    return {name: run(plan) for name, plan in PLANS.items()} | CORPUS_QUERIES


def oracle_sql() -> dict[str, str]:
    return statements() | CORPUS_SQL
