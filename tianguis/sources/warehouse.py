"""Parquet tables of the star schema, snapshots and segments, and view registration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tianguis.functions.dates import month_key
from tianguis.operators.keys import with_row_key
from tianguis.operators.rules import counted, enforced
from tianguis.schemas import (
    FACT_KEYS,
    FACT_NEAR,
    MAX_LENGTHS,
    REQUIRED_STAR_COLUMNS,
    ROW_RULES,
    SEGMENT_CHECKS,
    SEGMENT_COLUMNS,
    SNAPSHOT_CHECKS,
    SNAPSHOT_COLUMNS,
    STAR_COLUMNS,
    conform,
)
from tianguis.sources.builds import current, new_build, publish


@dataclass(frozen=True)
class Star:
    """Five dimensions and three facts."""

    dim_date: DataFrame
    dim_customers: DataFrame
    dim_sellers: DataFrame
    dim_products: DataFrame
    dim_orders: DataFrame
    fact_order_items: DataFrame
    fact_payments: DataFrame
    fact_reviews: DataFrame


def star_tables(star) -> dict[str, DataFrame]:
    return {f.name: getattr(star, f.name) for f in fields(Star)}


#: Longest texts by table and column.
Lengths = Mapping[str, Mapping[str, int]]


def _guarded(name: str, df: DataFrame, lengths: Lengths) -> DataFrame:
    """NOT NULL columns and declared text lengths, enforced by the write itself."""
    return enforced(df, name, REQUIRED_STAR_COLUMNS[name], lengths.get(name, {}))


def write_dimension(name: str, df: DataFrame, folder: str, lengths: Lengths = MAX_LENGTHS) -> dict[str, int]:
    """A4: write one dimension, and return its counts (``ROW_RULES``)."""
    out, seen = counted(_guarded(name, conform(df, STAR_COLUMNS[name]), lengths), name, ROW_RULES.get(name, {}))
    out.write.mode("overwrite").parquet(f"{folder}/{name}")
    return seen.get


def write_fact(name: str, df: DataFrame, folder: str, lengths: Lengths = MAX_LENGTHS) -> dict[str, int]:
    """A4: write one fact from rows without a key, and return its counts (``ROW_RULES``).

    The item fact is laid out by purchase month and sorted by day, so a one-month report opens the partitions of
    the month and of the two it is compared with. The rebalance hint lets adaptive execution split a month that holds most of
    the rows and merge the small ones.
    """
    by_month = name == "fact_order_items"
    keyed = with_row_key(df, FACT_KEYS[name], near=FACT_NEAR.get(name))
    if by_month:
        month = month_key(F.col("date_sk"))
        keyed = keyed.withColumn("purchase_month", month).hint("rebalance", "purchase_month")
        keyed = keyed.sortWithinPartitions("purchase_month", "date_sk")
    columns = STAR_COLUMNS[name] + (", purchase_month int" if by_month else "")
    out, seen = counted(_guarded(name, conform(keyed, columns), lengths), name, ROW_RULES.get(name, {}))
    writer = out.write.mode("overwrite")
    if by_month:
        writer = writer.partitionBy("purchase_month")
    writer.parquet(f"{folder}/{name}")
    return seen.get


def read_star(spark: SparkSession, folder: str) -> Star:
    """The current build of a star."""
    build = current(spark, folder)
    return Star(**{name: spark.read.parquet(f"{build}/{name}") for name in STAR_COLUMNS})


def upsert_snapshots(snapshots: DataFrame, folder: str) -> None:
    """Replace the periods present in ``snapshots``, leave every other period alone."""
    with_defaults = snapshots.withColumns(
        {
            "fecha_generacion": F.current_timestamp(),
            **{c: F.coalesce(c, F.lit(0)) for c in ("ingresos_totales", "total_ordenes", "ticket_promedio")},
        }
    )
    (
        enforced(conform(with_defaults, SNAPSHOT_COLUMNS), "reporte_mensual_snapshot", **SNAPSHOT_CHECKS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("periodo")
        .parquet(folder)
    )


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Partition values are read with the declared types, so '2018-01' stays text."""
    stored = spark.read.schema(SNAPSHOT_COLUMNS).parquet(folder)
    return conform(stored, SNAPSHOT_COLUMNS)


def rewrite_segments(segments: DataFrame, folder: str) -> None:
    """Replace the whole table with one set-based job; readers see the old rows until all new ones are there."""
    stamped = segments.withColumns(
        {
            "fecha_segmentacion": F.current_timestamp(),
            **{c: F.coalesce(c, F.lit(0)) for c in ("ingresos_total", "total_ordenes", "productos_distintos")},
        }
    )
    spark, build = segments.sparkSession, new_build(folder)
    rows = enforced(conform(stamped, SEGMENT_COLUMNS), "seller_segments", **SEGMENT_CHECKS)
    rows.write.parquet(build)
    publish(spark, folder, build)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENT_COLUMNS).parquet(current(spark, folder))


def publish_tables(spark: SparkSession, database: str, folder: str, names: list[str]) -> None:
    """Make the tables of the current build selectable as ``database.table`` from SQL.

    A table is dropped and created anew; where readers must never meet that gap, use ``publish_views``.
    """
    folder = current(spark, folder)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=f"{folder}/{name}", source="parquet")
        if any(column.isPartition for column in spark.catalog.listColumns(f"{database}.{name}")):
            spark.catalog.recoverPartitions(f"{database}.{name}")


def publish_views(spark: SparkSession, database: str, folder: str, names: list[str]) -> None:
    """Make ``database.table`` a view over the current build, each replaced in one step."""
    folder = current(spark, folder)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{folder}/{name}`")


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make frames queryable by name from SQL.

    A view keeps the files its frame was planned over. After a table has been rebuilt in place its views must be
    registered again: ``plans.publish.rebuild`` does both.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
