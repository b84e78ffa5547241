"""Raw CSV files, text staging and the typed view of it."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tianguis.functions.text import blank_to_null
from tianguis.schemas import PUBLISHED_ROWS, RAW_COLUMNS, REQUIRED_COLUMNS, TYPED_COLUMNS, text_schema


def read_raw(
    spark: SparkSession,
    folder: str,
    tables: list[str] | None = None,
    files: Mapping[str, str] | None = None,
    multi_line: Collection[str] = ("order_reviews",),
) -> dict[str, DataFrame]:
    """A1: one all-text frame per CSV file under ``folder`` (local, ``s3a://``, ``hdfs://`` ...).

    ``files`` maps a table to its file or folder name; the default is ``<table>.csv``. Fields may hold doubled
    quotes, and those of the tables in ``multi_line`` line breaks too (T8): such a file is read by one task, so a
    large one should arrive as many files in one folder. All other files are split.

    Reading is strict: a row with a field too many or too few, and a file whose header is not the table's
    columns in their order, raise. That also holds when one column or none is asked for, since rows are parsed
    whole.
    """
    files = files or {}
    return {
        table: spark.read.option("columnPruning", False).csv(
            f"{folder}/{files.get(table, table + '.csv')}",
            schema=text_schema(table),
            header=True,
            encoding="UTF-8",
            multiLine=table in multi_line,
            quote='"',
            escape='"',
            mode="FAILFAST",
            enforceSchema=False,
        )
        for table in (tables or RAW_COLUMNS)
    }


def typed(df: DataFrame) -> DataFrame:
    """A2: the same rows with numbers, money and timestamps; bad text raises (ANSI casts)."""
    columns = []
    for name in df.columns:
        kind = TYPED_COLUMNS.get(name)
        if kind is None:
            columns.append(F.col(name))
        elif name in REQUIRED_COLUMNS:
            columns.append(F.col(name).cast(kind).alias(name))
        else:
            columns.append(blank_to_null(name).cast(kind).alias(name))
    return df.select(*columns)


def write_staging(tables: Mapping[str, DataFrame], folder: str) -> None:
    """A3: replace every staging table."""
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{table}")


def read_staging(spark: SparkSession, folder: str, tables: list[str] | None = None) -> dict[str, DataFrame]:
    return {
        table: spark.read.schema(text_schema(table)).parquet(f"{folder}/{table}")
        for table in (tables or RAW_COLUMNS)
    }


def manifest(counts: DataFrame, expected: Mapping[str, int] = PUBLISHED_ROWS) -> DataFrame:
    """Compare measured counts (tabla, filas) with the expected files."""
    spark = counts.sparkSession
    wanted = spark.createDataFrame(
        [(f"staging.{table}", rows) for table, rows in expected.items()], "tabla string, esperadas bigint"
    )
    return wanted.join(counts, "tabla", "left").select(
        "tabla",
        "esperadas",
        F.coalesce("filas", F.lit(0)).cast("bigint").alias("filas"),
        F.when(F.col("filas") == F.col("esperadas"), "PASS").otherwise("FAIL").alias("estado"),
    )
