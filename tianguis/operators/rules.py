"""Rules that a write enforces, and counts taken while writing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def enforced(
    df: DataFrame,
    table: str,
    required: list[str] | None = None,
    longest: Mapping[str, int] | None = None,
    checks: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same rows; a row that breaks a rule fails the job that computes it, with the name of the column.

    ``required`` columns must not be NULL, texts must not be longer than ``longest`` allows, and ``checks`` (SQL) of a
    column must not be false (NULL passes, as in SQL). The rules ride on the columns they guard, so a write, which
    needs every column, meets all of them without another reading of the rows.
    """
    broken: dict[str, list[tuple[Column, str]]] = {}
    for c in required or []:
        broken.setdefault(c, []).append((F.col(c).isNull(), "is NULL"))
    for c, length in (longest or {}).items():
        broken.setdefault(c, []).append((F.char_length(c) > length, f"is longer than {length}"))
    for c, holds in (checks or {}).items():
        broken.setdefault(c, []).append((~F.expr(holds), "breaks its check"))

    def guarded(name: str) -> Column:
        column, kind = F.col(name), df.schema[name].dataType
        for fault, says in broken.get(name, []):
            column = F.when(fault, F.raise_error(F.lit(f"{table}.{name} {says}")).cast(kind)).otherwise(column)
        return column.alias(name)

    return df.select(*[guarded(c) for c in df.columns]) if broken else df


def counted(df: DataFrame, name: str, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds their number (``filas``) and how many satisfy each rule (SQL) once the
    rows have been written; no second reading is needed."""
    seen = Observation(name)
    counts = [F.count_if(F.expr(rule)).alias(label) for label, rule in rules.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("filas"), *counts), seen
