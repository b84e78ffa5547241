"""Table layouts. Names and types are fixed values: results are only comparable with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw files, in column order. Every column is text until the star schema types it.
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "order_reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "product_category_translation": ["product_category_name", "product_category_name_english"],
}

# Columns that are not text once typed.
TYPED_COLUMNS: dict[str, str] = {
    "order_purchase_timestamp": "timestamp_ntz",
    "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
    "shipping_limit_date": "timestamp_ntz",
    "review_creation_date": "timestamp_ntz",
    "review_answer_timestamp": "timestamp_ntz",
    "order_item_id": "int",
    "price": "decimal(10,2)",
    "freight_value": "decimal(10,2)",
    "payment_sequential": "int",
    "payment_installments": "int",
    "payment_value": "decimal(10,2)",
    "review_score": "smallint",
    "product_name_lenght": "int",
    "product_description_lenght": "int",
    "product_photos_qty": "int",
    "product_weight_g": "decimal(10,2)",
    "product_length_cm": "decimal(10,2)",
    "product_height_cm": "decimal(10,2)",
    "product_width_cm": "decimal(10,2)",
    "geolocation_lat": "double",
    "geolocation_lng": "double",
}

# Text that must be present: an empty value is an error, not a NULL.
REQUIRED_COLUMNS = {"order_item_id", "price", "freight_value"}

STAR_COLUMNS: dict[str, str] = {
    "dim_date": (
        "date_sk int, full_date date, year smallint, quarter smallint, month smallint, month_name string, "
        "day smallint, day_of_week smallint, day_name string, is_weekend boolean"
    ),
    "dim_customers": (
        "customer_sk bigint, customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "dim_sellers": (
        "seller_sk bigint, seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "dim_products": (
        "product_sk bigint, product_id string, product_category_name string, product_category_name_english string, "
        "product_name_lenght int, product_description_lenght int, product_photos_qty int, "
        "product_weight_g decimal(10,2), product_length_cm decimal(10,2), product_height_cm decimal(10,2), "
        "product_width_cm decimal(10,2)"
    ),
    "dim_orders": (
        "order_sk bigint, order_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    ),
    "fact_order_items": (
        "order_item_sk bigint, order_id string, order_item_id int, customer_sk bigint, product_sk bigint, "
        "seller_sk bigint, order_sk bigint, date_sk int, price decimal(10,2), freight_value decimal(10,2), "
        "total_value decimal(10,2)"
    ),
    "fact_payments": (
        "payment_sk bigint, order_id string, order_sk bigint, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(10,2)"
    ),
    "fact_reviews": (
        "review_sk bigint, review_id string, order_id string, order_sk bigint, review_score smallint, "
        "review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz, "
        "review_answer_timestamp timestamp_ntz"
    ),
}

FACT_KEYS = {"fact_order_items": "order_item_sk", "fact_payments": "payment_sk", "fact_reviews": "review_sk"}

# The column by which the rows of a fact lie together after its last join, where it has no NULLs.
FACT_NEAR = {"fact_order_items": "order_id"}

# Longest text each star column accepts.
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "dim_date": {"month_name": 20, "day_name": 20},
    "dim_customers": {
        "customer_id": 32,
        "customer_unique_id": 32,
        "customer_zip_code_prefix": 8,
        "customer_city": 100,
        "customer_state": 2,
    },
    "dim_sellers": {"seller_id": 32, "seller_zip_code_prefix": 8, "seller_city": 100, "seller_state": 2},
    "dim_products": {
        "product_id": 32,
        "product_category_name": 100,
        "product_category_name_english": 100,
    },
    "dim_orders": {"order_id": 32, "order_status": 20},
    "fact_order_items": {"order_id": 32},
    "fact_payments": {"order_id": 32, "payment_type": 30},
    "fact_reviews": {"review_id": 32, "order_id": 32},
}

# Star columns that must have a value.
REQUIRED_STAR_COLUMNS: dict[str, list[str]] = {
    "dim_date": [
        "date_sk",
        "full_date",
        "year",
        "quarter",
        "month",
        "month_name",
        "day",
        "day_of_week",
        "day_name",
        "is_weekend",
    ],
    "dim_customers": ["customer_sk", "customer_id"],
    "dim_sellers": ["seller_sk", "seller_id"],
    "dim_products": ["product_sk", "product_id"],
    "dim_orders": ["order_sk", "order_id"],
    "fact_order_items": ["order_item_sk", "order_id", "order_item_id"],
    "fact_payments": ["payment_sk", "order_id"],
    "fact_reviews": ["review_sk", "order_id"],
}

SNAPSHOT_COLUMNS = (
    "periodo string, fecha_generacion timestamp, ingresos_totales decimal(15,2), total_ordenes bigint, "
    "ticket_promedio decimal(10,2), top_categoria_1 string, top_categoria_2 string, top_categoria_3 string, "
    "top_vendedor_1 string, top_vendedor_2 string, top_vendedor_3 string, score_satisfaccion decimal(4,2)"
)

SEGMENT_COLUMNS = (
    "segment_sk bigint, seller_sk bigint, seller_id string, ciudad string, estado string, "
    "ingresos_total decimal(15,2), total_ordenes int, productos_distintos int, ticket_promedio decimal(10,2), "
    "primera_venta date, ultima_venta date, segmento string, fecha_segmentacion timestamp"
)

# M2-M4: what is counted while a table is written. The labels.
ROW_RULES: dict[str, dict[str, str]] = {
    "fact_order_items": {
        "07 | fact_order_items — customer_sk NULL": "customer_sk IS NULL",
        "08 | fact_order_items — product_sk NULL": "product_sk IS NULL",
        "09 | fact_order_items — seller_sk NULL": "seller_sk IS NULL",
        "10 | fact_order_items — date_sk NULL": "date_sk IS NULL",
        "11 | fact_order_items — price negativo": "price < 0",
    },
    "fact_reviews": {"12 | fact_reviews — score fuera de 1-5": "NOT review_score BETWEEN 1 AND 5"},
}

# Rules of the snapshot and segment tables: NOT NULL columns, text lengths, checks.
SNAPSHOT_CHECKS = {
    "required": ["periodo", "fecha_generacion", "ingresos_totales", "total_ordenes", "ticket_promedio"],
    "longest": {"periodo": 7},
    "checks": {"periodo": r"periodo RLIKE '^[0-9]{4}-[0-9]{2}$'"},
}
SEGMENT_CHECKS = {
    "required": [
        "seller_sk",
        "seller_id",
        "ingresos_total",
        "total_ordenes",
        "productos_distintos",
        "segmento",
        "fecha_segmentacion",
    ],
    "longest": {"seller_id": 50, "segmento": 1},
    "checks": {"segmento": "segmento IN ('A', 'B', 'C', 'D')"},
}

# Number of rows each raw file of the published data set has.
PUBLISHED_ROWS: dict[str, int] = {
    "customers": 99_441,
    "geolocation": 1_000_163,
    "orders": 99_441,
    "order_items": 112_650,
    "order_payments": 103_886,
    "order_reviews": 99_224,
    "products": 32_951,
    "sellers": 3_095,
    "product_category_translation": 71,
}


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the declared columns in order, cast to the declared types."""
    fields = T.StructType.fromDDL(ddl).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
