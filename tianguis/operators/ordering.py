"""Global order without a single-task window (G0; F3, F6, F9, F11, and F2, F8 over large tables).

An un-partitioned window sends every row to one task. That is right for months, states or categories, but not
for a table whose size follows the number of sellers or orders. Here one lazy plan serves every size: borders of the
whole order tuple are taken from a sample of the rows by a scalar subquery, rows are dealt out by the range they fall
in, numbered and summed inside it, and the totals of the ranges before are added. Nothing runs while a plan is built.

The sample is drawn by content: of the rows whose hash falls into one of so many slots, the one with the least hash.
Two evaluations of the subquery therefore give the same borders, whatever the partitions, and a value that many rows
share is cut by the columns that follow it in the order. There are as many ranges as the session's shuffle partitions
ask for.

The borders, the ranges' totals and the rows are three readings of one frame. Each of them reads every column of
it (``_read_whole``), so their plans agree below that point and Spark computes the frame's exchange once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Order = list[tuple[str, bool]]

#: Ranges for each shuffle partition, so many that hashing them deals them out evenly, and sampled rows for each range.
RANGES_EACH, SAMPLES_EACH = 16, 8


def _read_whole(df: DataFrame) -> Column:
    return F.max(F.xxhash64(*df.columns)).alias("_whole")


def _place(df: DataFrame, order: Order) -> Column:
    """The order of a row as one ascending value. NULLs come first in an ascending column, last in a descending one."""
    fields = []
    for n, (name, descending) in enumerate(order):
        value, kind = F.col(name), df.schema[name].dataType
        if descending and isinstance(kind, T.IntegralType):
            fields += [value.isNull(), F.bitwise_not(value)]  # like a minus, without overflow
        elif descending and isinstance(kind, T.NumericType):
            fields += [value.isNull(), -value]
        elif descending:
            raise TypeError(f"{name}: only numbers can be ordered from the largest")
        else:
            fields += [value.isNotNull(), value]
    return F.struct(*[field.alias(f"_{n}") for n, field in enumerate(fields)])


def _at_or_below(borders: Column, most: int, value: Column) -> Column:
    """How many of at most ``most`` sorted borders are at or below a value, by halving."""
    strides = F.array(*[F.lit(1 << b) for b in reversed(range(most.bit_length()))])
    return F.aggregate(
        strides, F.lit(0), lambda low, stride: F.when(F.get(borders, low + stride - 1) <= value, low + stride).otherwise(low)
    )


def _with_range(df: DataFrame, order: Order) -> DataFrame:
    """Add ``_range``: rows of a lower range come before those of a higher one in the order."""
    ranges = RANGES_EACH * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place, hashed = _place(df, order), F.xxhash64(*[name for name, _ in order])
    sample = (
        df.groupBy(F.pmod(hashed, F.lit(ranges * SAMPLES_EACH)))
        .agg(F.min(F.struct(hashed.alias("hash"), place.alias("at"))).alias("_first"), _read_whole(df))
        .where(F.col("_whole").isNotNull())
        .agg(F.sort_array(F.collect_list("_first.at")).alias("_all"))
    )
    picked = F.transform(
        F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("_all", F.floor(i * F.size("_all") / ranges).cast("int"))
    )
    borders = sample.select(F.array_compact(picked)).scalar()
    placed = df.withColumns({"_borders": borders, "_place": place})
    found = _at_or_below(F.col("_borders"), ranges - 1, F.col("_place"))
    # Never NULL, and known not to be: else the joins by range would test it once more on the rows below this frame, in one
    # reading and not in the others.
    return placed.withColumn("_range", F.coalesce(found, F.lit(0))).drop("_borders", "_place")


def _sort(order: Order) -> list[Column]:
    return [F.col(name).desc() if descending else F.col(name).asc() for name, descending in order]


def running(
    df: DataFrame,
    order: Order,
    *,
    within: str | None = None,
    position: str | None = None,
    count: str | None = None,
    sums: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Add positions and running sums over a total order.

    ``order`` is a list of (column, descending) whose columns together are unique; descending ones are numbers.
    ``position`` names the 1-based row number, ``count`` the number of rows, and ``sums`` maps a column to
    the names of its (running sum up to and including the row, grand total). ``within`` names a column whose
    values are ordered, counted and summed each by itself; none of its values needs to fit one task.
    """
    sums = sums or {}
    groups = [within] if within else []
    ranged = _with_range(df, [(g, False) for g in groups] + order).repartition("_range")

    # One row per range: a bounded frame, so its window and its broadcast are too (by group: not broadcast by hint).
    parts = (
        ranged.groupBy(*groups, "_range")
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums], _read_whole(ranged))
        .where(F.col("_whole").isNotNull())
    )
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*groups)
    offsets = parts.select(
        *groups,
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(everything).alias("_n_all"),
        *[F.sum(f"_sum_{c}").over(before).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(everything).alias(f"_all_{c}") for c in sums],
    )

    # The order is unique already; the hash makes this reading need every column too, whatever is asked of the result.
    inside = Window.partitionBy(*groups, "_range").orderBy(*_sort(order), F.xxhash64(*df.columns))
    upto_row = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*",
        F.row_number().over(inside).cast("long").alias("_rn"),
        *[F.sum(c).over(upto_row).alias(f"_local_{c}") for c in sums],
    )
    added = []
    if position:
        added.append((F.col("_rn") + F.col("_n_before")).alias(position))
    if count:
        added.append(F.col("_n_all").alias(count))
    for column, (upto, total) in sums.items():
        # Either part may be NULL (no earlier range, or only NULLs so far).
        local_sum, earlier = F.col(f"_local_{column}"), F.col(f"_before_{column}")
        added.append(F.coalesce(local_sum + earlier, local_sum, earlier).alias(upto))
        added.append(F.col(f"_all_{column}").alias(total))
    placed = local.join(offsets if within else F.broadcast(offsets), [*groups, "_range"])
    return placed.select(*df.columns, *added)


def _common(df: DataFrame, measures: list[str]) -> list[Column]:
    """The measures in one type that holds each of them exactly."""
    kinds = [df.schema[m].dataType for m in measures]
    if all(kind == kinds[0] for kind in kinds):
        return [F.col(m) for m in measures]
    scales = [k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds]
    digits = [k.precision - k.scale if isinstance(k, T.DecimalType) else 19 for k in kinds]
    if any(isinstance(k, (T.DoubleType, T.FloatType)) for k in kinds) or max(scales) + max(digits) > 38:
        raise TypeError("these measures have no common exact type")
    return [F.col(m).cast(T.DecimalType(max(scales) + max(digits), max(scales))) for m in measures]


def with_ranks(df: DataFrame, key: str, names: dict[str, str], descending: bool = True) -> DataFrame:
    """``RANK()`` over each measure of ``names`` (measure to rank column), with any number of ties.

    ``key`` is unique and not NULL. Every row goes out once for each measure, under its number, and all measures are
    ordered together: one set of borders, one exchange, one row of totals for each range. Ties are cut by the key; a
    range that begins with the value the range before ended with takes back the rows of that value counted so far.
    The ranks of a row meet again by its key, where the row itself comes along with the first measure.
    """
    whole = F.struct(*df.columns)
    none = F.lit(None).cast(df.select(whole.alias("_row")).schema["_row"].dataType)
    each = [
        F.struct(F.lit(n).alias("_measure"), value.alias("_value"), (none if n else whole).alias("_row"))
        for n, value in enumerate(_common(df, list(names)))
    ]
    rows = df.select(F.col(key).alias("_key"), F.inline(F.array(*each)))
    ranged = _with_range(rows, [("_measure", False), ("_value", descending), ("_key", False)])
    ranged = ranged.withColumn("_at", _place(rows, [("_value", descending)])).repartition("_range")

    by_value = ranged.groupBy("_measure", "_range", "_at").agg(F.count(F.lit(1)).alias("_n"), _read_whole(ranged))
    parts = (
        by_value.groupBy("_measure", "_range")
        .agg(
            F.sum("_n").alias("_n"),
            F.min("_at").alias("_first"),
            F.max("_at").alias("_last"),
            F.max_by("_n", "_at").alias("_n_last"),
            F.max("_whole").alias("_whole"),
        )
        .where(F.col("_whole").isNotNull())
    )
    by_range = Window.partitionBy("_measure").orderBy("_range")
    same_last = Window.partitionBy("_measure", "_last").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    totals = parts.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_of_last": F.sum("_n_last").over(same_last),
        }
    )
    carried = F.when(F.lag("_last").over(by_range) == F.col("_first"), F.lag("_of_last").over(by_range)).otherwise(0)
    offsets = totals.select("_measure", "_range", "_before", "_first", carried.alias("_carried"))

    inside = F.rank().over(Window.partitionBy("_measure", "_range").orderBy("_at"))
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(offsets), ["_measure", "_range"])
    rank = F.col("_before") + F.col("_inside") - F.when(F.col("_at") == F.col("_first"), F.col("_carried")).otherwise(0)
    gathered = placed.groupBy("_key").agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        *[F.max(F.when(F.col("_measure") == n, rank)).cast("long").alias(name) for n, name in enumerate(names.values())],
    )
    return gathered.select("_row.*", *names.values())


def tile_of(position: Column, count: Column, tiles: int) -> Column:
    """``NTILE(tiles)`` from a row number and the row count; larger tiles come first."""
    small = F.floor(count / tiles)
    large_tiles = count % tiles
    in_large = large_tiles * (small + 1)
    tile = F.when(position <= in_large, F.ceil(position / (small + 1))).otherwise(
        large_tiles + F.ceil((position - in_large) / F.nullif(small, F.lit(0)))
    )
    return tile.cast("int")
