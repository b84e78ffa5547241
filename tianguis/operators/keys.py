"""Natural-key de-duplication and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets whose sizes are counted to place the keys of each.
KEY_BUCKETS = 16_384


def _bucket(key: str, buckets: int) -> Column:
    """The hash bucket of a key, known not to be NULL: no reading tests it once more."""
    return F.coalesce(F.pmod(F.xxhash64(key), F.lit(buckets)), F.lit(0))


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("_bucket", _bucket(key, buckets))


def _dealt(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows dealt out by bucket. The bucket is told from the key again where they arrive and doesn't travel."""
    return _bucketed(df.repartition(_bucket(key, buckets)), key, buckets)


def _whole(columns: list[str]) -> Column:
    """Makes a reading need every column, so that counting and numbering share one exchange."""
    return F.max(F.xxhash64(*columns)).alias("_whole")


def _smallest(df: DataFrame, groups: list[str], key: str, columns: list[str]) -> DataFrame:
    """One row for each of ``groups``, the smallest over the columns other than the key, NULLs first.

    An aggregate, so Spark knows its groups to be unique, and what is not asked for is neither compared nor moved.
    """
    others = [c for c in columns if c != key]
    if not others:
        return df.select(*groups).distinct()
    rows = df.groupBy(*groups).agg(F.min(F.struct(*others)).alias("_row"))
    return rows.select(*groups, *[F.col(f"_row.{c}").alias(c) for c in others])


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest over the remaining columns.

    Spark keeps one row per key and task before the shuffle, so copies of a hot key do not travel.
    """
    return _smallest(df, [key], key, df.columns).select(*df.columns)


def _offsets(counts: DataFrame) -> DataFrame:
    """(_bucket, _before): the rows in the buckets before. A bounded frame, so its window and its broadcast are too."""
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return F.broadcast(placed.groupBy("_bucket").agg(F.max("_before").alias("_before")))


def _key(name: str) -> Column:
    """The place after the rows before. Known not to be NULL: else a join by the key would test it on one reading of a frame."""
    return (F.coalesce("_before", F.lit(0)) + F.col("_place")).cast("long").alias(name)


def with_surrogate_key(df: DataFrame, key: str, name: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """B1: dense keys 1..n over the (unique) natural key, the same on every run over the same rows.

    Rows are dealt into hash buckets and counted there; a key is the number of rows in the buckets before plus the
    place in its own. There is no global sort and no window over more than a bucket.
    """
    return keyed_first(df, key, name, buckets)


def keyed_first(df: DataFrame, key: str, name: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """B1 and B3 in one shuffle: the smallest row of each key, numbered densely from 1.

    Rows are dealt out by bucket once, and each key is reduced to its row there. Counting the keys moves nothing but the
    keys, and neither does a reading that asks for the numbers alone: both share one exchange. Offsets are joined from the
    left, on a key known to be unique, so a reading that doesn't ask for the numbers has neither the join nor the count.
    """
    dealt = _dealt(df, key, buckets)
    kept = _smallest(dealt, ["_bucket", key], key, df.columns)
    counts = kept.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    placed = kept.withColumn("_place", place).join(_offsets(counts), "_bucket", "left")
    return placed.select(_key(name), *df.columns)


def with_row_key(df: DataFrame, name: str, buckets: int = KEY_BUCKETS, near: str | None = None) -> DataFrame:
    """B1 for facts: dense keys 1..n over whole rows, the same on every run over the same rows.

    Rows are put into groups, each group is counted, and a key is the number of rows in the groups before plus the place
    in its own, by the columns of the row; copies of a row are neighbours and get neighbouring keys. Without ``near`` the
    groups are the hash buckets of whole rows. A row that a third of the table repeats is one bucket, which is sorted with
    spilling and numbered as a stream.

    ``near`` names a column without NULLs by which the rows lie together already, such as that of the last join. Its values
    are the groups: rows stay where they are, and only (value, count) pairs are dealt out by bucket and back.

    What is joined is unique for each group and joined from the left, so a reading that doesn't ask for the key computes
    and moves nothing for it.
    """
    columns = df.columns
    if near is None:
        df = df.withColumn("_bucket", F.coalesce(F.pmod(F.xxhash64(*columns), F.lit(buckets)), F.lit(0)))
        starts, group = _offsets(df.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))), ["_bucket"]
    else:
        # Counting reads every column too, so that it shares the exchanges below with the rows.
        sizes = df.groupBy(near).agg(F.count(F.lit(1)).alias("_n"), _whole(columns)).where(F.col("_whole").isNotNull())
        dealt = _dealt(sizes.select(near, "_n"), near, buckets)
        counts = dealt.groupBy("_bucket").agg(F.sum("_n").alias("_n"), _whole([near])).where(F.col("_whole").isNotNull())
        inside = Window.partitionBy("_bucket").orderBy(near).rowsBetween(Window.unboundedPreceding, -1)
        placed = dealt.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(_offsets(counts), "_bucket")
        starts = placed.groupBy(near).agg(F.max(F.col("_before") + F.col("_inside")).alias("_before"))
        df, group = _bucketed(df, near, buckets), ["_bucket", near]
    order = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    numbered = df.withColumn("_place", F.row_number().over(order)).join(starts, near or "_bucket", "left")
    return numbered.select(_key(name), *columns)


def lookup(df: DataFrame, dimension: DataFrame, natural: str, surrogate: str, how: str = "inner") -> DataFrame:
    """Swap in a surrogate key. Broadcast or skew splitting is left to adaptive execution,
    which decides on measured sizes."""
    return df.join(dimension.select(natural, surrogate), natural, how)
