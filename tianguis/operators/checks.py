"""Counting rule violations.

All row rules of a table are counted in one pass; the counts become rows afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stacked(parts: list[DataFrame]) -> DataFrame:
    """H1: UNION ALL by column name."""
    return reduce(DataFrame.unionByName, parts)


def labelled_counts(tables: Mapping[str, DataFrame], label: str = "tabla") -> DataFrame:
    """One (label, filas) row per frame, listed by label."""
    counts = [df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias(label), "filas") for name, df in tables.items()]
    return stacked(counts).orderBy(label)


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(test, resultado): how many rows satisfy each rule; NULL counts as no violation.

    Rows that satisfy no rule count nowhere and are filtered out. Spark moves the filter below the joins that ``df`` is made
    of, as far as the rules allow, so good rows are read but not shuffled.
    """
    columns = {f"_{i}": rule for i, rule in enumerate(rules.values())}
    broken = df.where(reduce(Column.__or__, columns.values()))
    counted = broken.agg(*[F.count_if(rule).alias(name) for name, rule in columns.items()])
    pairs = F.array(
        *[F.struct(F.lit(label).alias("test"), F.col(f"_{i}").alias("resultado")) for i, label in enumerate(rules)]
    )
    return counted.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, key: list[str], label: str) -> DataFrame:
    """How many keys occur more than once."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return violations(repeated, {label: F.col("_n") > 1})


def table_constraints(
    table: str,
    df: DataFrame,
    primary: list[str],
    foreign: Mapping[str, tuple[DataFrame, str]],
    required: list[str],
) -> DataFrame:
    """(test, resultado) for the keys, references and NOT NULL columns of one table, from one reading of it.

    Every row names its values under the number of the rule they belong to; equal values of a rule are counted together
    before the shuffle, so a hot reference is one row where it meets the referenced keys, and long rows are never moved.
    Whole numbers travel as numbers, other values as text. A primary key counts the keys that occur more than once, a
    reference the rows whose key does not exist (NULL is allowed), a required column its NULLs.
    """
    labels = [f"pk {table}.{k}" for k in primary] + [f"fk {table}.{k}" for k in foreign] + [f"not null {table}.{c}" for c in required]
    keys = [*primary, *foreign]
    whole = [
        all(isinstance(frame.schema[name].dataType, T.IntegralType) for frame, name in [(df, k), *([foreign[k]] if n >= len(primary) else [])])
        for n, k in enumerate(keys)
    ]

    def under(rule: int, number: Column | None, text: Column | None = None) -> Column:
        parts = {"_number": (number, "bigint"), "_text": (text, "string")}
        return F.struct(
            F.lit(rule).alias("_rule"),
            *[(F.lit(None) if part is None else part).cast(kind).alias(name) for name, (part, kind) in parts.items()],
        )

    def value(rule: int, name: str) -> Column:
        return under(rule, F.col(name)) if whole[rule] else under(rule, None, F.col(name))

    def present(named: DataFrame) -> DataFrame:
        """Values that are there, in columns that are never NULL and so can be joined by."""
        there = named.where(F.col("_number").isNotNull() | F.col("_text").isNotNull())
        return there.select("_rule", F.coalesce("_number", F.lit(0)).alias("_number"), F.coalesce("_text", F.lit("")).alias("_text"))

    by = ["_rule", "_number", "_text"]
    named = [value(n, k) for n, k in enumerate(keys)]
    named += [under(n, F.when(F.col(c).isNull(), 1)) for n, c in enumerate(required, len(keys))]
    counted = present(df.select(F.inline(F.array(*named)))).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    if foreign:
        known = stacked([other.select(F.inline(F.array(value(n, name)))) for n, (other, name) in enumerate(foreign.values(), len(primary))])
        known = present(known).groupBy(*by).agg(F.lit(True).alias("_known"))
        counted = counted.join(known, by, "left")
    else:
        counted = counted.withColumn("_known", F.lit(None).cast("boolean"))

    def result(rule: int) -> Column:
        mine = F.col("_rule") == rule
        if rule < len(primary):
            return F.count_if(mine & (F.col("_n") > 1))
        return F.coalesce(F.sum(F.when(mine & F.col("_known").isNull(), F.col("_n"))), F.lit(0))

    totals = counted.agg(*[result(n).alias(f"_{n}") for n in range(len(labels))])
    pairs = [F.struct(F.lit(label).alias("test"), F.col(f"_{n}").alias("resultado")) for n, label in enumerate(labels)]
    return totals.select(F.inline(F.array(*pairs)))


def with_verdict(checks: DataFrame) -> DataFrame:
    """A check passes when it counts nothing."""
    return checks.select(
        "test",
        F.col("resultado").cast("bigint").alias("resultado"),
        F.when(F.col("resultado") == 0, "PASS").otherwise("FAIL").alias("estado"),
    )
