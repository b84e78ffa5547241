"""Data-quality checks over staging, star, views, snapshots and segments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.operators.checks import (
    duplicate_keys,
    labelled_counts,
    stacked,
    table_constraints,
    violations,
    with_verdict,
)
from tianguis.schemas import MAX_LENGTHS, REQUIRED_STAR_COLUMNS, ROW_RULES


PRIMARY_KEYS = {
    "dim_date": ["date_sk"],
    "dim_customers": ["customer_sk"],
    "dim_sellers": ["seller_sk"],
    "dim_products": ["product_sk"],
    "dim_orders": ["order_sk", "order_id"],
    "fact_order_items": ["order_item_sk"],
    "fact_payments": ["payment_sk"],
    "fact_reviews": ["review_sk"],
}
FOREIGN_KEYS = {
    "fact_order_items": {
        "customer_sk": "dim_customers",
        "product_sk": "dim_products",
        "seller_sk": "dim_sellers",
        "order_sk": "dim_orders",
        "date_sk": "dim_date",
    },
    "fact_payments": {"order_sk": "dim_orders"},
    "fact_reviews": {"order_sk": "dim_orders"},
}


class QualityFailure(RuntimeError):
    """Raised by ``require`` when a check counted violations."""


def staging_counts(staging: Mapping[str, DataFrame]) -> DataFrame:
    """A5/L17."""
    return labelled_counts({f"staging.{name}": df for name, df in staging.items()})


def view_counts(views: Mapping[str, DataFrame]) -> DataFrame:
    """A6/L17."""
    return labelled_counts(views, "vista")


def star_info(star) -> DataFrame:
    """Informative counts."""
    # The labels.
    tables = {
        "01 | fact_order_items": star.fact_order_items,
        "02 | dim_customers": star.dim_customers,
        "03 | dim_products": star.dim_products,
        "04 | dim_sellers": star.dim_sellers,
        "05 | dim_orders": star.dim_orders,
        "06 | dim_date": star.dim_date,
    }
    return labelled_counts(tables).select(F.lit("INFO").alias("tipo"), "tabla", "filas")


def star_checks(star) -> DataFrame:
    """Nine checks; the item fact is read once for its five."""
    # The labels.
    return with_verdict(
        stacked(
            [
                *[
                    violations(getattr(star, table), {label: F.expr(rule) for label, rule in rules.items()})
                    for table, rules in ROW_RULES.items()
                ],
                duplicate_keys(star.dim_customers, ["customer_id"], "13 | dim_customers — IDs duplicados"),
                duplicate_keys(star.dim_products, ["product_id"], "14 | dim_products  — IDs duplicados"),
                duplicate_keys(star.dim_sellers, ["seller_id"], "15 | dim_sellers   — IDs duplicados"),
            ]
        )
    )


def star_constraints(star) -> DataFrame:
    """The declared primary keys, foreign keys and NOT NULL columns, as checks; each table is read once."""
    return with_verdict(
        stacked(
            [
                table_constraints(
                    table,
                    getattr(star, table),
                    PRIMARY_KEYS[table],
                    {key: (getattr(star, dim), key) for key, dim in FOREIGN_KEYS.get(table, {}).items()},
                    columns,
                )
                for table, columns in REQUIRED_STAR_COLUMNS.items()
            ]
        )
    )


def text_lengths(star) -> DataFrame:
    """Declared text lengths, as checks: a longer value used to be refused on insert."""
    return with_verdict(
        stacked(
            [
                violations(
                    getattr(star, table), {f"largo {table}.{c}": F.length(c) > longest for c, longest in lengths.items()}
                )
                for table, lengths in MAX_LENGTHS.items()
            ]
        )
    )


def fact_amounts(star) -> DataFrame:
    """M2, M3: unresolved keys and negative amounts of the item fact, in one pass."""
    keys = ("customer_sk", "product_sk", "seller_sk", "order_sk", "date_sk")
    amounts = ("price", "freight_value", "total_value")
    return with_verdict(
        violations(
            star.fact_order_items,
            {
                **{f"{key} NULL": F.col(key).isNull() for key in keys},
                **{f"{amount} < 0": F.col(amount) < 0 for amount in amounts},
            },
        )
    )


def fk_coverage(star) -> DataFrame:
    """How many payments and reviews found their order; at least 99 % should."""

    def coverage(name: str, fact: DataFrame) -> DataFrame:
        counted = fact.agg(
            F.count(F.lit(1)).alias("filas"), F.count_if(F.col("order_sk").isNull()).alias("sin_order_sk")
        )
        resolved = (F.col("filas") - F.col("sin_order_sk")).cast("double") / F.nullif("filas", F.lit(0)) * 100
        return counted.select(F.lit(name).alias("tabla"), "filas", "sin_order_sk", resolved.alias("pct_resuelto"))

    both = stacked([coverage("fact_payments", star.fact_payments), coverage("fact_reviews", star.fact_reviews)])
    return both.withColumn("estado", F.when(F.col("pct_resuelto") >= 99, "PASS").otherwise("FAIL"))


def sk_integrity(star) -> DataFrame:
    """Payments whose order key belongs to another order id."""
    orders = star.dim_orders.select("order_sk", F.col("order_id").alias("_order_id"))
    joined = star.fact_payments.select("order_sk", "order_id").join(orders, "order_sk")
    return with_verdict(violations(joined, {"order_sk / order_id": F.col("order_id") != F.col("_order_id")}))


def calendar_gaps(dim_date: DataFrame) -> DataFrame:
    """Days followed by a gap. One row per calendar day, so one task may order them."""
    following = F.lead("full_date").over(Window.orderBy("full_date"))
    gaps = dim_date.select("full_date", following.alias("next_date"))
    return with_verdict(violations(gaps, {"dim_date gaps": F.datediff("next_date", "full_date") > 1}))


def view_checks(views: Mapping[str, DataFrame], min_rows: int = 50) -> DataFrame:
    """The running share never falls; groups are large enough; mean scores are 1-5."""
    pareto, scores = views["vw_top_categorias_pareto"], views["vw_satisfaccion_cliente"]
    # The rank before r is the one whose rows end at r, so neighbours meet by equality and not in one ordered task.
    by_rank = pareto.groupBy("ranking").agg(
        F.count(F.lit(1)).alias("_n"), F.min("pct_acumulado").alias("_low"), F.max("pct_acumulado").alias("_high")
    )
    before = by_rank.select((F.col("ranking") + F.col("_n")).alias("ranking"), F.col("_high").alias("_before"))
    return with_verdict(
        stacked(
            [
                violations(
                    by_rank.join(before, "ranking", "left"),
                    {"pct_acumulado decreciente": (F.col("_low") < F.col("_before")) | (F.col("_low") < F.col("_high"))},
                ),
                violations(
                    scores,
                    {
                        "total_reviews bajo el mínimo": F.col("total_reviews") < min_rows,
                        "score_promedio fuera de 1-5": ~F.col("score_promedio").between(1, 5),
                    },
                ),
            ]
        )
    )


def snapshot_checks(snapshots: DataFrame) -> DataFrame:
    """Period format, revenue sign, a top category wherever there are sales, one
    row per period."""
    rules = violations(
        snapshots,
        {
            "periodo con formato incorrecto": ~F.col("periodo").rlike(r"^\d{4}-\d{2}$"),
            "ingresos negativos": F.col("ingresos_totales") < 0,
            "sin top_categoria_1": (F.col("ingresos_totales") > 0) & F.col("top_categoria_1").isNull(),
        },
    )
    return with_verdict(stacked([rules, duplicate_keys(snapshots, ["periodo"], "periodo duplicado")]))


def segment_checks(segments: DataFrame) -> DataFrame:
    """Four segments of 20-30 % each, A above D, no other letter, one row per seller."""
    sizes = segments.groupBy("segmento").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("ingresos_total").alias("_mean")
    )
    # Four rows.
    shares = sizes.withColumn("_pct", F.col("_n") * 100 / F.sum("_n").over(Window.partitionBy()))

    def mean_of(letter: str):
        return F.max(F.when(F.col("segmento") == letter, F.col("_mean")))

    overall = sizes.agg(
        F.count_if(F.col("segmento").isin("A", "B", "C", "D")).alias("_kinds"),
        mean_of("A").alias("_a"),
        mean_of("D").alias("_d"),
    )
    return with_verdict(
        stacked(
            [
                violations(segments, {"segmento no válido": ~F.col("segmento").isin("A", "B", "C", "D")}),
                duplicate_keys(segments, ["seller_id"], "seller_id duplicado"),
                violations(shares, {"segmento fuera de 20-30 %": ~F.col("_pct").between(20, 30)}),
                violations(
                    overall,
                    {"segmentos ausentes": F.col("_kinds") != 4, "promedio de A no supera a D": F.col("_a") <= F.col("_d")},
                ),
            ]
        )
    )


def segment_constraints(segments: DataFrame) -> DataFrame:
    """Keys, NOT NULL columns and declared text lengths of the segment table."""
    required = ["segment_sk", "seller_sk", "seller_id", "ingresos_total", "total_ordenes", "productos_distintos", "segmento"]
    lengths = {"seller_id": 50, "ciudad": 100, "estado": 2, "segmento": 1}
    return with_verdict(
        stacked(
            [
                table_constraints("seller_segments", segments, ["segment_sk", "seller_id"], {}, required),
                violations(segments, {f"largo seller_segments.{c}": F.length(c) > n for c, n in lengths.items()}),
            ]
        )
    )


def snapshot_constraints(snapshots: DataFrame) -> DataFrame:
    """Key, NOT NULL columns and declared text length of the snapshot table."""
    table = "reporte_mensual_snapshot"
    required = ["periodo", "ingresos_totales", "total_ordenes", "ticket_promedio"]
    return with_verdict(
        stacked(
            [
                table_constraints(table, snapshots, ["periodo"], {}, required),
                violations(snapshots, {f"largo {table}.periodo": F.length("periodo") > 7}),
            ]
        )
    )


def require(checks: DataFrame) -> None:
    """Stop when a check failed. Checks are a handful of rows."""
    failed = [row["test"] for row in checks.where(F.col("estado") != "PASS").select("test").collect()]
    if failed:
        raise QualityFailure("; ".join(failed))
