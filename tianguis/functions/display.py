"""Numbers and timestamps as text, for the last step before a reader. Never compute on these."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_text(value: Column, symbol: str = "$", digits: int = 2) -> Column:
    """'$1,234.50'."""
    return F.concat(F.lit(symbol), F.format_number(value, digits))


def minute_text(when: Column) -> Column:
    """'2018-08-31 23:59'."""
    return F.date_format(when, "yyyy-MM-dd HH:mm")
