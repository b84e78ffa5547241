"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def date_key(when: Column) -> Column:
    """B2: the YYYYMMDD integer of a date or timestamp, without formatting text."""
    return (F.year(when) * 10_000 + F.month(when) * 100 + F.dayofmonth(when)).cast("int")


def month_key(date_sk: Column) -> Column:
    """YYYYMM integer of a YYYYMMDD key."""
    return F.call_function("div", date_sk, F.lit(100)).cast("int")


def period_label(month: Column) -> Column:
    """I13: 'YYYY-MM' of a YYYYMM integer."""
    digits = month.cast("string")
    return F.concat_ws("-", F.substr(digits, F.lit(1), F.lit(4)), F.substr(digits, F.lit(5), F.lit(2)))


def elapsed_days_truncated(start: Column, end: Column) -> Column:
    """Day part of an interval; one hour early or late is 0 days."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def elapsed_days_floored(start: Column, end: Column) -> Column:
    """Whole days, rounded down; one hour late is -1 day."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / MICROS_PER_DAY).cast("int")


def month_start(when: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(when, "MM")


def sunday_zero(when: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(when) - 1
