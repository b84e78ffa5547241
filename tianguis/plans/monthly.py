"""Monthly executive report and its snapshots.

All months are computed in one job. The item fact is reduced to orders (one shuffle on the
order, which also serves the distinct order count and the review join) and then to days;
everything after that works on at most one row per calendar day.
"""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tianguis.functions.dates import month_key, period_label
from tianguis.functions.display import money_text
from tianguis.functions.numbers import exact_mean, growth
from tianguis.plans.reporting import review_summary
from tianguis.sources.warehouse import upsert_snapshots

NO_CATEGORY = "Sin Categoría"
CURRENT, LAST_MONTH, LAST_YEAR = "actual", "mes_anterior", "anio_anterior"


class InvalidParameter(ValueError):
    """K3: a month or year outside the accepted range."""


def validate_period(year: int, month: int) -> None:
    if not 1 <= month <= 12:
        raise InvalidParameter(f"month {month} is not between 1 and 12")
    if not 2000 <= year <= 2100:
        raise InvalidParameter(f"year {year} is not between 2000 and 2100")


Month = tuple[int, int]


def month_spine(dim_date: DataFrame, first: Month | None, last: Month | None) -> DataFrame:
    """One row per month: (periodo, inicio, fin). Without a range, the months of the calendar."""
    if first and last:
        ends = dim_date.sparkSession.range(1).select(
            F.lit(dt.date(*first, 1)).alias("low"), F.lit(dt.date(*last, 1)).alias("high")
        )
    else:
        ends = dim_date.agg(
            F.trunc(F.min("full_date"), "month").alias("low"), F.trunc(F.max("full_date"), "month").alias("high")
        )
    months = F.explode(F.sequence("low", "high", F.expr("interval 1 month")))
    return (
        ends.select(months.alias("inicio"))
        .select(F.date_format("inicio", "yyyy-MM").alias("periodo"), "inicio", F.last_day("inicio").alias("fin"))
    )


def comparison_days(spine: DataFrame) -> DataFrame:
    """The days of each month and of its two comparison windows.

    Both ends of a window move back by a month or a year and clamp to the end of the shorter
    month, so April is compared with 1-30 March.
    """
    windows = spine.selectExpr(
        "periodo",
        "inline(array("
        f"named_struct('tramo', '{CURRENT}', 'desde', inicio, 'hasta', fin), "
        f"named_struct('tramo', '{LAST_MONTH}', 'desde', CAST(inicio - INTERVAL 1 MONTH AS DATE), "
        "'hasta', CAST(fin - INTERVAL 1 MONTH AS DATE)), "
        f"named_struct('tramo', '{LAST_YEAR}', 'desde', CAST(inicio - INTERVAL 1 YEAR AS DATE), "
        "'hasta', CAST(fin - INTERVAL 1 YEAR AS DATE))))",
    )
    return windows.select(
        "periodo", "tramo", F.explode(F.sequence("desde", "hasta", F.expr("interval 1 day"))).alias("full_date")
    )


def months_of(first: tuple[int, int], last: tuple[int, int]) -> list[int]:
    """Month keys (yyyymm) of a range."""
    low, high = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    return [n // 12 * 100 + n % 12 + 1 for n in range(low, high + 1)]


def with_comparisons(months: list[int]) -> list[int]:
    """The months themselves, the one before each, and the same one a year earlier."""
    before = [m - 1 if m % 100 > 1 else m - 89 for m in months]
    return sorted({*months, *before, *[m - 100 for m in months]})


def items_of(star, months: list[int] | None) -> DataFrame:
    """The item fact of some months, or all: by its partition column where it is stored with one, so that other
    months are not opened, and by the first and last day."""
    fact = star.fact_order_items
    if months is None:
        return fact
    rows = fact.where(F.col("date_sk").between(months[0] * 100 + 1, months[-1] * 100 + 31))
    month = F.col("purchase_month") if "purchase_month" in fact.columns else month_key(F.col("date_sk"))
    return rows.where(month.isin(months))


def daily_totals(star, months: list[int] | None) -> DataFrame:
    """Per calendar day of ``months`` and of the months they are compared with: revenue, items and orders; of
    ``months`` alone also review scores weighted by items (T18), from the reviews of their orders."""
    # An order has one purchase date.
    orders = (
        items_of(star, with_comparisons(months) if months else None)
        .groupBy("order_id")
        .agg(F.min("date_sk").alias("date_sk"), F.sum("total_value").alias("revenue"), F.count(F.lit(1)).alias("items"))
    )
    reviews = star.fact_reviews
    if months:
        current = orders.where(month_key(F.col("date_sk")).isin(months)).select("order_id")
        reviews = reviews.join(current, "order_id", "left_semi")
    summary = review_summary(reviews).select("order_id", "reviews", "score_sum")
    items = F.col("items")
    per_day = (
        orders.join(summary, "order_id", "left")
        .groupBy("date_sk")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("items").alias("items"),
            F.count(F.lit(1)).alias("orders"),
            F.sum(items * F.col("score_sum")).alias("score_sum"),
            F.sum(items * F.col("reviews")).alias("score_n"),
        )
    )
    return per_day.join(star.dim_date.select("date_sk", "full_date"), "date_sk").drop("date_sk")


def _best_three(per_month: DataFrame, tie_break: str) -> DataFrame:
    """the three rows with the most revenue per month, numbered. Spark keeps only three per
    month and task before the shuffle."""
    best_first = Window.partitionBy("periodo").orderBy(F.col("revenue").desc(), F.col(tie_break).asc())
    return per_month.withColumn("rn", F.row_number().over(best_first)).where(F.col("rn") <= 3)


def _as_columns(best: DataFrame, name: str, prefix: str) -> DataFrame:
    """Rows 1 to 3 of a month as three columns."""
    return best.groupBy("periodo").agg(
        *[F.max(F.when(F.col("rn") == k, F.col(name).cast("string"))).alias(f"{prefix}_{k}") for k in (1, 2, 3)]
    )


def _per_month(star, key: str, months: list[int] | None) -> DataFrame:
    return (
        items_of(star, months)
        .groupBy(month_key(F.col("date_sk")).alias("_month"), key)
        .agg(F.sum("total_value").alias("revenue"))
        .select(period_label(F.col("_month")).alias("periodo"), key, "revenue")
    )


def top_categories(star, months: list[int] | None) -> DataFrame:
    label = F.coalesce("product_category_name_english", "product_category_name", F.lit(NO_CATEGORY))
    products = star.dim_products.select("product_sk", label.alias("categoria"))
    per_month = (
        _per_month(star, "product_sk", months)
        .join(products, "product_sk")
        .groupBy("periodo", "categoria")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return _as_columns(_best_three(per_month, "categoria"), "categoria", "top_categoria")


def top_sellers(star, months: list[int] | None) -> DataFrame:
    """Sellers are looked up for the three winners of a month only; equal revenue is decided by
    the surrogate key."""
    best = _best_three(_per_month(star, "seller_sk", months), "seller_sk")
    named = best.join(star.dim_sellers.select("seller_sk", "seller_id"), "seller_sk")
    return _as_columns(named, "seller_id", "top_vendedor")


def month_figures(star, first: Month | None, last: Month | None) -> DataFrame:
    """Every month from ``first`` to ``last``, or of the calendar, also those without a sale."""
    spine = month_spine(star.dim_date, first, last)
    months = months_of(first, last) if first and last else None
    daily = daily_totals(star, months)

    def over(window: str, column: str):
        return F.sum(F.when(F.col("tramo") == window, F.col(column)))

    # Days on both sides: the spine holds at most 93 days per month.
    figures = (
        comparison_days(spine)
        .join(daily, "full_date", "left")
        .groupBy("periodo")
        .agg(
            F.coalesce(over(CURRENT, "revenue"), F.lit(0)).alias("ingresos"),
            F.coalesce(over(LAST_MONTH, "revenue"), F.lit(0)).alias("ingresos_mes"),
            F.coalesce(over(LAST_YEAR, "revenue"), F.lit(0)).alias("ingresos_anio"),
            F.coalesce(over(CURRENT, "orders"), F.lit(0)).alias("ordenes"),
            over(CURRENT, "items").alias("_items"),
            over(CURRENT, "score_sum").alias("_score_sum"),
            over(CURRENT, "score_n").alias("_score_n"),
        )
    )
    return (
        figures.join(top_categories(star, months), "periodo", "left")
        .join(top_sellers(star, months), "periodo", "left")
        .withColumns(
            {
                "ticket": F.coalesce(exact_mean(F.col("ingresos"), F.col("_items")), F.lit(0)),
                "score": exact_mean(F.col("_score_sum"), F.col("_score_n")),
            }
        )
    )


def _report_columns(figures: DataFrame) -> DataFrame:
    """The 15 report columns; a month without reviews scores 0."""
    ingresos = F.col("ingresos")
    return figures.select(
        "periodo",
        ingresos.cast("decimal(15,2)").alias("ingresos_totales"),
        F.col("ingresos_mes").cast("decimal(15,2)").alias("ingresos_mes_anterior"),
        growth(ingresos, F.col("ingresos_mes")).cast("decimal(8,2)").alias("crecimiento_mom_pct"),
        F.col("ingresos_anio").cast("decimal(15,2)").alias("ingresos_anio_anterior"),
        growth(ingresos, F.col("ingresos_anio")).cast("decimal(8,2)").alias("crecimiento_yoy_pct"),
        F.col("ordenes").cast("bigint").alias("total_ordenes"),
        F.col("ticket").cast("decimal(10,2)").alias("ticket_promedio"),
        *[f"top_categoria_{k}" for k in (1, 2, 3)],
        *[f"top_vendedor_{k}" for k in (1, 2, 3)],
        F.coalesce("score", F.lit(0)).cast("decimal(4,2)").alias("score_satisfaccion_avg"),
    )


def _snapshot_columns(figures: DataFrame) -> DataFrame:
    """The stored columns; a month without reviews has no score."""
    return figures.select(
        "periodo",
        F.col("ingresos").cast("decimal(15,2)").alias("ingresos_totales"),
        F.col("ordenes").cast("bigint").alias("total_ordenes"),
        F.col("ticket").cast("decimal(10,2)").alias("ticket_promedio"),
        *[f"top_categoria_{k}" for k in (1, 2, 3)],
        *[f"top_vendedor_{k}" for k in (1, 2, 3)],
        F.col("score").cast("decimal(4,2)").alias("score_satisfaccion"),
    )


def report_rows(star, first: Month | None = None, last: Month | None = None) -> DataFrame:
    """The report columns for every month of a range, by default the calendar's."""
    return _report_columns(month_figures(star, first, last))


def monthly_report(star, year: int, month: int) -> DataFrame:
    """The report for one month. Of a stored fact it opens the partitions of three months."""
    validate_period(year, month)
    return report_rows(star, (year, month), (year, month))


def monthly_snapshots(star, first: Month | None = None, last: Month | None = None) -> DataFrame:
    """Snapshot rows for every month of a range, by default the calendar's."""
    return _snapshot_columns(month_figures(star, first, last))


def generate_monthly_report(star, folder: str, year: int, month: int) -> DataFrame:
    """K1: store the month's snapshot and return its report, from one computation: a single row."""
    validate_period(year, month)
    figures = month_figures(star, (year, month), (year, month))
    figures = figures.sparkSession.createDataFrame(figures.collect(), figures.schema)
    upsert_snapshots(_snapshot_columns(figures), folder)
    return _report_columns(figures)


def snapshot_status(figures: DataFrame) -> DataFrame:
    """K6: snapshot columns, and ``error``: what keeps a month from being stored, NULL if nothing does.

    A figure that its column cannot hold is an error of its month alone, not of the job.
    """
    limits = {
        "ingresos_totales": ("ingresos", "decimal(15,2)"),
        "ticket_promedio": ("ticket", "decimal(10,2)"),
        "score_satisfaccion": ("score", "decimal(4,2)"),
    }
    fitted = {name: F.col(source).try_cast(kind) for name, (source, kind) in limits.items()}
    faults = [
        F.when(F.col(source).isNotNull() & fitted[name].isNull(), F.lit(f"{name} does not fit {kind}"))
        for name, (source, kind) in limits.items()
    ]
    return figures.select(
        "periodo",
        fitted["ingresos_totales"].alias("ingresos_totales"),
        F.col("ordenes").cast("bigint").alias("total_ordenes"),
        fitted["ticket_promedio"].alias("ticket_promedio"),
        *[f"top_categoria_{k}" for k in (1, 2, 3)],
        *[f"top_vendedor_{k}" for k in (1, 2, 3)],
        fitted["score_satisfaccion"].alias("score_satisfaccion"),
        F.nullif(F.concat_ws("; ", *faults), F.lit("")).alias("error"),
    )


def refresh_months(star, folder: str, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Recompute the months of a range in one job, replace the stored rows of those without an error, and
    return (periodo, ingresos_totales, error) for every month. The stored row of a month with an error stays as it was.

    The figures are one row for each month, at most 1,212 by the range of the parameters.
    """
    validate_period(*first)
    validate_period(*last)
    status = snapshot_status(month_figures(star, first, last))
    status = status.sparkSession.createDataFrame(status.collect(), status.schema)
    upsert_snapshots(status.where(F.col("error").isNull()).drop("error"), folder)
    return status.select("periodo", "ingresos_totales", "error")


def refresh_snapshots(star, folder: str, first: tuple[int, int], last: tuple[int, int]) -> int:
    """``refresh_months``, with a warning for each month that had an error; returns how many of the months
    had revenue. The range can be run again, whole or in parts, since each run replaces just the periods it computed.
    """
    months = refresh_months(star, folder, first, last).cache()
    for row in months.where(F.col("error").isNotNull()).collect():
        warnings.warn(f"{row['periodo']}: {row['error']}", stacklevel=2)
    found = months_with_revenue(months.where(F.col("error").isNull())).first()[0]
    months.unpersist()
    return found


def months_with_revenue(snapshots: DataFrame) -> DataFrame:
    """K6: how many periods of a batch had sales."""
    return snapshots.agg(F.count_if(F.col("ingresos_totales") > 0).alias("periodos_con_datos"))


def snapshot_listing(snapshots: DataFrame) -> DataFrame:
    """The stored rows as the verification query shows them, without text formatting."""
    return snapshots.select(
        "periodo",
        F.col("ingresos_totales").alias("ingresos"),
        F.col("total_ordenes").alias("ordenes"),
        F.col("ticket_promedio").alias("ticket"),
        F.col("top_categoria_1").alias("cat_top1"),
        F.col("score_satisfaccion").alias("satisfaccion"),
    )


def snapshot_listing_text(snapshots: DataFrame) -> DataFrame:
    """The listing as it is printed."""
    return snapshot_listing(snapshots).withColumns(
        {"ingresos": money_text(F.col("ingresos")), "ticket": money_text(F.col("ticket"))}
    )


def snapshot_peak(snapshots: DataFrame) -> DataFrame:
    """The period with the highest revenue."""
    return snapshots.orderBy(F.col("ingresos_totales").desc(), "periodo").limit(1).select("periodo", "ingresos_totales")
