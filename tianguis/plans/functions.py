"""The two procedures as SQL table functions (K1-K4).

``register_functions`` makes ``SELECT * FROM sp_generar_reporte_mensual(2018, 8)`` and
``SELECT * FROM sp_segmentar_vendedores()`` work over a star. A function only reads; the snapshot and segment tables
are written by ``monthly.refresh_months`` and ``segments.refresh_segments``. The report's arguments are literals by the
time the query is planned, so a stored fact is opened at the partitions of three months. An argument out of range, or
a star without a sale, is an error of the query.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tianguis.plans.monthly import NO_CATEGORY
from tianguis.plans.segments import segment_sellers, segment_summary
from tianguis.sources.warehouse import register_views, star_tables

# The names that queries call.
REPORT, SEGMENTS = "sp_generar_reporte_mensual", "sp_segmentar_vendedores"

#: The first day of the month asked for; NULL, so that nothing is read, for a wrong argument.
_FIRST = "IF(mes BETWEEN 1 AND 12 AND anio BETWEEN 2000 AND 2100, make_date(anio, mes, 1), CAST(NULL AS DATE))"
#: The month asked for, or the error of a wrong argument: it is raised in this one place.
_PERIOD = (
    "IF(mes BETWEEN 1 AND 12, IF(anio BETWEEN 2000 AND 2100, date_format(make_date(anio, mes, 1), 'yyyy-MM'), "
    "CAST(raise_error(concat('year ', anio, ' is not between 2000 and 2100')) AS STRING)), "
    "CAST(raise_error(concat('month ', mes, ' is not between 1 and 12')) AS STRING))"
)


def _sales(fact: str, months_back: int, by_partition: bool) -> str:
    """The item fact of the month asked for or of a comparison window; both ends move back and clamp."""
    low, high = (f"CAST({d} - INTERVAL {months_back} MONTH AS DATE)" for d in (_FIRST, f"last_day({_FIRST})"))
    key = "CAST(date_format({}, 'yyyyMMdd') AS INT)"
    rows = f"SELECT * FROM {fact} WHERE date_sk BETWEEN {key.format(low)} AND {key.format(high)}"
    return rows + (f" AND purchase_month = CAST(date_format({low}, 'yyyyMM') AS INT)" if by_partition else "")


def _three(rows: str, value: str, tie: str) -> str:
    """The three rows with the most revenue, as one value."""
    named = ", ".join(f"'n{k}', max(CASE WHEN rn = {k} THEN CAST({value} AS STRING) END)" for k in (1, 2, 3))
    ranked = f"SELECT *, row_number() OVER (ORDER BY revenue DESC, {tie}) AS rn FROM ({rows})"
    return f"SELECT named_struct({named}) FROM ({ranked}) WHERE rn <= 3"


def _growth(previous: str) -> str:
    return (
        f"CAST(round(CAST(sales.revenue - {previous} AS DECIMAL(24,2)) * 100 / "
        f"nullif(CAST({previous} AS DECIMAL(24,2)), 0), 2) AS DECIMAL(8,2))"
    )


def report_function(names: dict[str, str], by_partition: bool) -> str:
    """The statement that creates the report function; ``names`` are the views of the star's tables."""
    fact, reviews = names["fact_order_items"], names["fact_reviews"]
    tops = ", ".join(f"{kind}_{k} STRING" for kind in ("top_categoria", "top_vendedor") for k in (1, 2, 3))
    windows = {name: _sales(fact, back, by_partition) for name, back in (("now", 0), ("month_before", 1), ("year_before", 12))}
    money = "coalesce(sum(total_value), 0)"
    categories = f"""
        SELECT categoria, sum(revenue) AS revenue
        FROM (SELECT product_sk, sum(total_value) AS revenue FROM now GROUP BY product_sk)
        JOIN (SELECT product_sk, coalesce(product_category_name_english, product_category_name, '{NO_CATEGORY}') AS categoria
            FROM {names["dim_products"]}) USING (product_sk)
        GROUP BY categoria"""
    sellers = f"""
        SELECT seller_sk, seller_id, revenue FROM (SELECT seller_sk, sum(total_value) AS revenue FROM now GROUP BY seller_sk)
        JOIN {names["dim_sellers"]} USING (seller_sk)"""
    scores = f"""
        SELECT order_id, count(*) AS n, sum(CAST(review_score AS INT)) AS score FROM {reviews}
        WHERE review_score IS NOT NULL AND order_id IN (SELECT order_id FROM now) GROUP BY order_id"""
    return f"""
    CREATE OR REPLACE TEMPORARY FUNCTION {REPORT}(anio INT, mes INT)
    RETURNS TABLE (periodo STRING, ingresos_totales DECIMAL(15,2), ingresos_mes_anterior DECIMAL(15,2),
        crecimiento_mom_pct DECIMAL(8,2), ingresos_anio_anterior DECIMAL(15,2), crecimiento_yoy_pct DECIMAL(8,2),
        total_ordenes BIGINT, ticket_promedio DECIMAL(10,2), {tops}, score_satisfaccion_avg DECIMAL(4,2))
    RETURN WITH {", ".join(f"{name} AS ({rows})" for name, rows in windows.items())}, figures AS (
        SELECT {_PERIOD} AS periodo,
            (SELECT named_struct('revenue', {money}, 'items', count(*), 'orders', count(DISTINCT order_id)) FROM now) AS sales,
            (SELECT {money} FROM month_before) AS last_month,
            (SELECT {money} FROM year_before) AS last_year,
            ({_three(categories, "categoria", "categoria")}) AS best_categories,
            ({_three(sellers, "seller_id", "seller_sk")}) AS best_sellers,
            (SELECT named_struct('n', sum(n), 'score', sum(score)) FROM now JOIN ({scores}) USING (order_id)) AS reviewed
    )
    SELECT periodo, CAST(sales.revenue AS DECIMAL(15,2)), CAST(last_month AS DECIMAL(15,2)), {_growth("last_month")},
        CAST(last_year AS DECIMAL(15,2)), {_growth("last_year")}, sales.orders,
        CAST(coalesce(CAST(sales.revenue AS DECIMAL(24,2)) / nullif(CAST(sales.items AS DECIMAL(15,0)), 0), 0) AS DECIMAL(10,2)),
        best_categories.n1, best_categories.n2, best_categories.n3, best_sellers.n1, best_sellers.n2, best_sellers.n3,
        CAST(coalesce(CAST(reviewed.score AS DECIMAL(24,2)) / nullif(CAST(reviewed.n AS DECIMAL(15,0)), 0), 0) AS DECIMAL(4,2))
    FROM figures WHERE periodo IS NOT NULL"""


def segments_function(summary: str, columns: list[tuple[str, str]]) -> str:
    """The statement that creates the segment function over a view of the summary."""
    declared = ", ".join(f"{name} {kind}" for name, kind in columns)
    missing = ", ".join(
        f"CAST({"raise_error('the item fact has no sales')" if n == 0 else 'NULL'} AS {kind})" for n, (_, kind) in enumerate(columns)
    )
    return f"""
    CREATE OR REPLACE TEMPORARY FUNCTION {SEGMENTS}() RETURNS TABLE ({declared})
    RETURN SELECT * FROM {summary}
        UNION ALL SELECT {missing} FROM (SELECT count(*) AS n FROM {summary}) WHERE n = 0"""


def register_functions(spark: SparkSession, star, prefix: str = "dwh_") -> None:
    """K1, K2: register the star's tables as views ``prefix`` + name, and the two functions over them."""
    tables = star_tables(star) if hasattr(star, "__dataclass_fields__") else {n: getattr(star, n) for n in _NEEDED}
    names = {name: prefix + name for name in tables}
    summary = segment_summary(segment_sellers(star))
    register_views({names[n]: df for n, df in tables.items()} | {f"{prefix}segment_summary": summary})
    spark.sql(report_function(names, "purchase_month" in star.fact_order_items.columns))
    spark.sql(segments_function(f"{prefix}segment_summary", [(f.name, f.dataType.simpleString()) for f in summary.schema]))


_NEEDED = ("dim_products", "dim_sellers", "fact_order_items", "fact_reviews")
