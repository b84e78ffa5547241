"""The supplied order/line-item tables read as marketplace data.

The supplied tables have no deliveries, reviews, payments or categories; those are derived from
keys by fixed arithmetic, so any engine gets the same values. Identifiers keep their integer
type and double as surrogate keys in ``StandInStar``; ``staging`` hands out the same rows as
text, for the jobs that start from raw files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tianguis.functions.dates import date_key
from tianguis.functions.text import clean_city, clean_state
from tianguis.plans.star import calendar
from tianguis.schemas import MAX_LENGTHS, RAW_COLUMNS

#: Longest texts of a star built from these tables: names of nations stand for states.
STATE_LETTERS = 25
LENGTHS = MAX_LENGTHS | {
    table: MAX_LENGTHS[table] | {column: STATE_LETTERS}
    for table, column in (("dim_customers", "customer_state"), ("dim_sellers", "seller_state"))
}

# Every derived column, in terms of the supplied ones.
STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' "
    "ELSE CASE WHEN o_orderkey % 10 = 0 THEN 'canceled' ELSE 'delivered' END END"
)
PURCHASE_TS = "timestampadd(SECOND, o_orderkey * 31 % 86400, o_orderdate)"
APPROVED_TS = (
    f"CASE WHEN {STATUS} <> 'canceled' THEN "
    "timestampadd(SECOND, o_orderkey * 31 % 86400 + 600 + o_orderkey % 7200, o_orderdate) END"
)
CARRIER_TS = (
    f"CASE WHEN {STATUS} = 'delivered' THEN timestampadd(SECOND, 86400 + o_orderkey % 3600, o_orderdate) END"
)
DELIVERED_TS = (
    f"CASE WHEN {STATUS} = 'delivered' THEN timestampadd(SECOND, "
    "86400 * (1 + o_orderkey * 7919 % 45) + o_orderkey * 104729 % 86400, o_orderdate) END"
)
ESTIMATED_TS = "timestampadd(SECOND, 86400 * (10 + o_orderkey % 5 * 7), o_orderdate)"
PRICE = "CAST(l_extendedprice AS DECIMAL(10,2))"
FREIGHT = f"CAST({PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2))"
CATEGORY = "CASE WHEN p_size <> 50 THEN p_brand END"
BRAND_NUMBER = "CAST(substr(p_brand, 7) AS INT)"
CATEGORY_ENGLISH = f"CASE WHEN p_size <> 50 AND {BRAND_NUMBER} <= 20 THEN concat('cat_', {BRAND_NUMBER}) END"
PAYMENT_TYPE = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN 'boleto' WHEN '5' THEN 'voucher' ELSE 'credit_card' END"
)
SCORE = (
    "CASE WHEN o_orderkey * 13 % 10 <= 5 THEN 5 WHEN o_orderkey * 13 % 10 = 6 THEN 4 "
    "WHEN o_orderkey * 13 % 10 = 7 THEN 3 WHEN o_orderkey * 13 % 10 = 8 THEN 2 ELSE 1 END"
)
# One review unless the key ends the twenty, and a second one-star review for one key in 97.
REVIEWS = (
    "inline(array_compact(array("
    f"CASE WHEN o_orderkey % 20 <> 0 THEN named_struct('seq', 1, 'score', {SCORE}) END, "
    "CASE WHEN o_orderkey % 97 = 1 THEN named_struct('seq', 2, 'score', 1) END)))"
)


class StandIn:
    """Typed frames with the raw files' columns."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            f"{STATUS} AS order_status",
            f"{PURCHASE_TS} AS order_purchase_timestamp",
            f"{APPROVED_TS} AS order_approved_at",
            f"{CARRIER_TS} AS order_delivered_carrier_date",
            f"{DELIVERED_TS} AS order_delivered_customer_date",
            f"{ESTIMATED_TS} AS order_estimated_delivery_date",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._read("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS order_item_id",
            "l_partkey AS product_id",
            "l_suppkey AS seller_id",
            "l_shipdate AS shipping_limit_date",
            f"{PRICE} AS price",
            f"{FREIGHT} AS freight_value",
        )

    @cached_property
    def customers(self) -> DataFrame:
        return (
            self._read("customer")
            .join(self._read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey AS customer_id",
                "c_custkey - c_custkey % 2 AS customer_unique_id",
                "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS customer_zip_code_prefix",
                "c_mktsegment AS customer_city",
                "n_name AS customer_state",
            )
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return (
            self._read("supplier")
            .join(self._read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "s_suppkey AS seller_id",
                "lpad(CAST(s_suppkey % 100000 AS STRING), 5, '0') AS seller_zip_code_prefix",
                "r_name AS seller_city",
                "n_name AS seller_state",
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        known = "p_size <> 50"
        return self._read("part").selectExpr(
            "p_partkey AS product_id",
            f"{CATEGORY} AS product_category_name",
            f"CASE WHEN {known} THEN length(p_name) END AS product_name_lenght",
            f"CASE WHEN {known} THEN p_size * 10 END AS product_description_lenght",
            f"CASE WHEN {known} THEN p_size % 6 + 1 END AS product_photos_qty",
            "CASE WHEN p_size <> 49 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS product_weight_g",
            "CAST(p_size + 10 AS DECIMAL(10,2)) AS product_length_cm",
            "CAST(p_size % 30 + 2 AS DECIMAL(10,2)) AS product_height_cm",
            "CAST(p_size % 20 + 5 AS DECIMAL(10,2)) AS product_width_cm",
        )

    @cached_property
    def translation(self) -> DataFrame:
        return (
            self._read("part")
            .where(f"{BRAND_NUMBER} <= 20")
            .selectExpr(
                "p_brand AS product_category_name",
                f"concat('cat_', {BRAND_NUMBER}) AS product_category_name_english",
            )
            .distinct()
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey AS order_id",
            "1 AS payment_sequential",
            f"{PAYMENT_TYPE} AS payment_type",
            "CAST(1 + o_orderkey % 14 AS INT) AS payment_installments",
            "CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value",
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return (
            self._read("orders")
            .selectExpr("o_orderkey", "o_orderdate", REVIEWS)
            .selectExpr(
                "concat(CAST(o_orderkey AS STRING), '-', CAST(seq AS STRING)) AS review_id",
                "o_orderkey AS order_id",
                "CAST(score AS SMALLINT) AS review_score",
                "CASE WHEN o_orderkey % 4 = 0 THEN concat('title ', CAST(score AS STRING)) END AS review_comment_title",
                "CASE WHEN o_orderkey % 3 = 0 THEN 'said, \"fine\"' END AS review_comment_message",
                "timestampadd(SECOND, 86400 * 20, o_orderdate) AS review_creation_date",
                "timestampadd(SECOND, 86400 * 22 + o_orderkey % 86400, o_orderdate) AS review_answer_timestamp",
            )
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        return (
            self._read("nation")
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "CAST(n_nationkey AS STRING) AS geolocation_zip_code_prefix",
                "CAST(n_nationkey - 12 AS DOUBLE) AS geolocation_lat",
                "CAST(n_nationkey * 2 AS DOUBLE) AS geolocation_lng",
                "r_name AS geolocation_city",
                "n_name AS geolocation_state",
            )
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """Typed frames under the raw file names."""
        return {
            "customers": self.customers,
            "geolocation": self.geolocation,
            "orders": self.orders,
            "order_items": self.order_items,
            "order_payments": self.payments,
            "order_reviews": self.reviews,
            "products": self.products,
            "sellers": self.sellers,
            "product_category_translation": self.translation,
        }

    @cached_property
    def staging(self) -> dict[str, DataFrame]:
        """The rows as raw text: missing values are empty, place names are untidy."""
        text = {
            table: df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in RAW_COLUMNS[table]])
            for table, df in self.tables.items()
        }
        for table, prefix in (("customers", "customer"), ("sellers", "seller")):
            text[table] = text[table].withColumns(
                {
                    f"{prefix}_city": F.concat(F.lit(" "), F.lower(f"{prefix}_city")),
                    f"{prefix}_state": F.concat(F.lower(f"{prefix}_state"), F.lit("  ")),
                }
            )
        # A missing category is a missing field in the raw file, not an empty one.
        text["products"] = text["products"].withColumn(
            "product_category_name", F.nullif("product_category_name", F.lit(""))
        )
        return text

    @cached_property
    def soiled(self) -> dict[str, DataFrame]:
        """``staging`` with the faults raw files have, by fixed rules on keys, so that checks have something to find:
        repeated customers and orders, payments and reviews of unknown orders, scores out of range, unknown products,
        missing purchase timestamps and negative prices."""
        out = dict(self.staging)
        key = F.col("order_id").cast("bigint")
        customers, orders = out["customers"], out["orders"]
        again = customers.where(F.col("customer_id").cast("bigint") % 50 == 0)
        out["customers"] = customers.unionByName(again.withColumn("customer_unique_id", F.lit("zzz")))
        bought = F.when(key % 150 == 2, F.lit("")).otherwise(F.col("order_purchase_timestamp"))
        orders = orders.withColumn("order_purchase_timestamp", bought)
        out["orders"] = orders.unionByName(orders.where(key % 100 == 1).withColumn("order_status", F.lit("unavailable")))
        payments, reviews, items = out["order_payments"], out["order_reviews"], out["order_items"]
        unknown = F.concat(F.lit("-"), F.col("order_id"))
        out["order_payments"] = payments.unionByName(payments.where(key % 40 == 3).withColumn("order_id", unknown))
        lost = reviews.where((key % 60 == 5) & F.col("review_id").endswith("-1"))
        out["order_reviews"] = reviews.unionByName(lost.withColumns({"order_id": unknown, "review_score": F.lit("7")}))
        out["order_items"] = items.withColumns(
            {
                "product_id": F.when(key % 200 == 7, F.lit("unknown")).otherwise(F.col("product_id")),
                "price": F.when(key % 80 == 9, F.concat(F.lit("-"), F.col("price"))).otherwise(F.col("price")),
            }
        )
        return out

    @cached_property
    def star(self) -> StandInStar:
        return StandInStar(self)


class StandInStar:
    """The star schema with source identifiers as keys; same attributes as ``warehouse.Star``."""

    def __init__(self, source: StandIn):
        self._source = source

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar(self._source.orders, "order_purchase_timestamp")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._source.customers.select(
            F.col("customer_id").alias("customer_sk"),
            "customer_id",
            "customer_unique_id",
            "customer_zip_code_prefix",
            clean_city("customer_city").alias("customer_city"),
            clean_state("customer_state").alias("customer_state"),
        )

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return self._source.sellers.select(
            F.col("seller_id").alias("seller_sk"),
            "seller_id",
            "seller_zip_code_prefix",
            clean_city("seller_city").alias("seller_city"),
            clean_state("seller_state").alias("seller_state"),
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._source._read("part").selectExpr(
            "p_partkey AS product_sk",
            "p_partkey AS product_id",
            f"{CATEGORY} AS product_category_name",
            f"{CATEGORY_ENGLISH} AS product_category_name_english",
        )

    @cached_property
    def dim_orders(self) -> DataFrame:
        return self._source.orders.withColumn("order_sk", F.col("order_id"))

    @cached_property
    def fact_order_items(self) -> DataFrame:
        orders = self._source.orders.where(F.col("order_purchase_timestamp").isNotNull()).select(
            "order_id",
            F.col("customer_id").alias("customer_sk"),
            date_key(F.col("order_purchase_timestamp")).alias("date_sk"),
        )
        return self._source.order_items.join(orders, "order_id").select(
            "order_id",
            "order_item_id",
            "customer_sk",
            F.col("product_id").alias("product_sk"),
            F.col("seller_id").alias("seller_sk"),
            F.col("order_id").alias("order_sk"),
            "date_sk",
            "price",
            "freight_value",
            (F.col("price") + F.col("freight_value")).cast("decimal(10,2)").alias("total_value"),
        )

    @cached_property
    def fact_payments(self) -> DataFrame:
        return self._source.payments.withColumn("order_sk", F.col("order_id"))

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return self._source.reviews.withColumn("order_sk", F.col("order_id"))
