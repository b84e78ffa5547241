"""From text staging to the star schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tianguis.functions.dates import date_key, sunday_zero
from tianguis.functions.numbers import MONEY
from tianguis.functions.text import blank_to_null, clean_city, clean_state
from tianguis.operators.keys import first_by_key, keyed_first, lookup, with_row_key, with_surrogate_key
from tianguis.schemas import FACT_KEYS, FACT_NEAR, MAX_LENGTHS, STAR_COLUMNS, conform
from tianguis.sources.builds import new_build, publish
from tianguis.sources.warehouse import Lengths, Star, read_star, write_dimension, write_fact

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


def calendar(orders: DataFrame, when: str) -> DataFrame:
    """Every day between the first and the last timestamp."""
    ends = orders.agg(F.min(when).cast("date").alias("first"), F.max(when).cast("date").alias("last"))
    day = F.col("full_date")
    return ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date")).select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        sunday_zero(day).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_date(staging: Mapping[str, DataFrame]) -> DataFrame:
    name = "order_purchase_timestamp"
    return calendar(staging["orders"].select(blank_to_null(name).cast("timestamp_ntz").alias(name)), name)


def dim_customers(staging: Mapping[str, DataFrame]) -> DataFrame:
    """L12."""
    kept = keyed_first(staging["customers"], "customer_id", "customer_sk").withColumns(
        {"customer_city": clean_city("customer_city"), "customer_state": clean_state("customer_state")}
    )
    return conform(kept, STAR_COLUMNS["dim_customers"])


def dim_sellers(staging: Mapping[str, DataFrame]) -> DataFrame:
    """L12."""
    kept = keyed_first(staging["sellers"], "seller_id", "seller_sk").withColumns(
        {"seller_city": clean_city("seller_city"), "seller_state": clean_state("seller_state")}
    )
    return conform(kept, STAR_COLUMNS["dim_sellers"])


def dim_products(staging: Mapping[str, DataFrame]) -> DataFrame:
    """L13. Both sides are reduced to one row per key before the join, which leaves the row the
    join would have kept first anyway."""
    products = first_by_key(staging["products"], "product_id")
    translation = first_by_key(staging["product_category_translation"], "product_category_name")
    typed = products.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        *[
            blank_to_null(c).cast("int").alias(c)
            for c in ("product_name_lenght", "product_description_lenght", "product_photos_qty")
        ],
        *[
            blank_to_null(c).cast(MONEY).alias(c)
            for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
        ],
    )
    return conform(with_surrogate_key(typed, "product_id", "product_sk"), STAR_COLUMNS["dim_products"])


def dim_orders(staging: Mapping[str, DataFrame]) -> DataFrame:
    """L14."""
    kept = keyed_first(staging["orders"].drop("customer_id"), "order_id", "order_sk").withColumns(
        {c: blank_to_null(c).cast("timestamp_ntz") for c in ORDER_TIMESTAMPS}
    )
    return conform(kept, STAR_COLUMNS["dim_orders"])


def dated_orders(staging: Mapping[str, DataFrame]) -> DataFrame:
    """``dim_orders`` as far as the facts look into it: keys and purchase timestamps.

    The row kept of an order is the smallest by its columns in order, so the columns up to the timestamp decide what
    the timestamp is; those after it can't and stay at home.
    """
    kept = keyed_first(staging["orders"].select("order_id", "order_status", ORDER_TIMESTAMPS[0]), "order_id", "order_sk")
    return kept.select(
        F.col("order_sk").cast("long").alias("order_sk"),
        "order_id",
        blank_to_null(ORDER_TIMESTAMPS[0]).cast("timestamp_ntz").alias(ORDER_TIMESTAMPS[0]),
    )


def fact_order_items(staging: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Items whose order, customer, product and seller are all known, without a row key.

    The order side (order, its date, its customer) is joined up first, so items cross the
    network once for it. The day of a timestamp that is there is known not to be NULL, as the other keys are: a check of
    all keys and amounts then asks nothing of the order side, and its filter reaches the items before they are moved.
    """
    day = F.coalesce(date_key(F.col("order_purchase_timestamp")), F.lit(0))
    dated = dims["dim_orders"].where(F.col("order_purchase_timestamp").isNotNull()).select(
        "order_id", "order_sk", day.alias("date_sk")
    )
    buyers = lookup(
        staging["orders"].select("order_id", "customer_id"), dims["dim_customers"], "customer_id", "customer_sk"
    )
    orders = buyers.join(dated, "order_id").select("order_id", "order_sk", "date_sk", "customer_sk")

    items = staging["order_items"].select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("price").cast(MONEY).alias("price"),
        F.col("freight_value").cast(MONEY).alias("freight_value"),
        (F.col("price").cast("decimal(38,18)") + F.col("freight_value").cast("decimal(38,18)"))
        .cast(MONEY)
        .alias("total_value"),
    )
    items = lookup(items, dims["dim_products"], "product_id", "product_sk")
    items = lookup(items, dims["dim_sellers"], "seller_id", "seller_sk")
    return items.join(orders, "order_id")


def fact_payments(staging: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Payments of unknown orders stay, without an order key."""
    typed = staging["order_payments"].select(
        "order_id",
        blank_to_null("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        blank_to_null("payment_installments").cast("int").alias("payment_installments"),
        blank_to_null("payment_value").cast(MONEY).alias("payment_value"),
    )
    return lookup(typed, dims["dim_orders"], "order_id", "order_sk", "left")


def fact_reviews(staging: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
    """Reviews of unknown orders stay, without an order key."""
    typed = staging["order_reviews"].select(
        "review_id",
        "order_id",
        blank_to_null("review_score").cast("smallint").alias("review_score"),
        blank_to_null("review_comment_title").alias("review_comment_title"),
        blank_to_null("review_comment_message").alias("review_comment_message"),
        blank_to_null("review_creation_date").cast("timestamp_ntz").alias("review_creation_date"),
        blank_to_null("review_answer_timestamp").cast("timestamp_ntz").alias("review_answer_timestamp"),
    )
    return lookup(typed, dims["dim_orders"], "order_id", "order_sk", "left")


DIMENSIONS = {
    "dim_date": dim_date,
    "dim_customers": dim_customers,
    "dim_sellers": dim_sellers,
    "dim_products": dim_products,
    "dim_orders": dim_orders,
}
FACTS = {"fact_order_items": fact_order_items, "fact_payments": fact_payments, "fact_reviews": fact_reviews}


def plan_star(staging: Mapping[str, DataFrame]) -> Star:
    """All eight tables as lazy plans.

    A query may read a fact more than once, in a subquery too. A lookup that turned into a broadcast in one reading only, by
    what had been measured until then, would make the readings differ and the fact be computed for each of them. So lookups
    are merge joins here; where a stored star is built, Spark decides.
    """
    dims = {name: build(staging) for name, build in DIMENSIONS.items()}
    seen = {name: dim.hint("merge") for name, dim in (dims | {"dim_orders": dated_orders(staging)}).items()}
    facts = {
        name: conform(with_row_key(build(staging, seen), FACT_KEYS[name], near=FACT_NEAR.get(name)), STAR_COLUMNS[name])
        for name, build in FACTS.items()
    }
    return Star(**dims, **facts)


def _at_once(tasks: dict[str, Callable[[], dict[str, int]]]) -> dict[str, dict[str, int]]:
    """Submit independent writes together; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = {name: pool.submit(inheritable_thread_target(task)) for name, task in tasks.items()}
    return {name: done.result() for name, done in running.items()}


def write_star(
    spark: SparkSession, staging: Mapping[str, DataFrame], folder: str, lengths: Lengths = MAX_LENGTHS
) -> tuple[Star, dict[str, dict[str, int]]]:
    """A4: build the star, and return it with the counts of its tables (A5, M1-M4), taken while they were written.

    The dimensions are written, then the facts against the stored dimensions, into a build of its own. Readers of
    ``folder`` see the new tables all at once when the last one is complete; a failure leaves the old ones as they were.
    ``lengths`` are the longest texts that the write accepts; a source whose states are not two letters brings its own.
    """
    build = new_build(folder)
    counts = _at_once({name: partial(write_dimension, name, plan(staging), build, lengths) for name, plan in DIMENSIONS.items()})
    dims = {name: spark.read.parquet(f"{build}/{name}") for name in DIMENSIONS}
    counts |= _at_once({name: partial(write_fact, name, plan(staging, dims), build, lengths) for name, plan in FACTS.items()})
    publish(spark, folder, build)
    return read_star(spark, folder), counts


def build_star(spark: SparkSession, staging: Mapping[str, DataFrame], folder: str, lengths: Lengths = MAX_LENGTHS) -> Star:
    """A4: ``write_star`` without the counts."""
    return write_star(spark, staging, folder, lengths)[0]
