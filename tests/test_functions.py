"""Scalar expressions and the traps around them."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tianguis.functions.dates import (
    date_key,
    elapsed_days_floored,
    elapsed_days_truncated,
    month_key,
    period_label,
    sunday_zero,
)
from tianguis.functions.numbers import clip, exact_mean, growth, right_closed_bin, traffic_light, true_share
from tianguis.functions.text import blank_to_null, clean_state, title_words


def one(spark, schema, values, *columns):
    return spark.createDataFrame([values], schema).select(*columns).first()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mogi-guacu", "Mogi-Guacu"),
        ("sant'ana do sul", "Sant'Ana Do Sul"),
        ("SÃO  PAULO", "São  Paulo"),
        ("5th avenue", "5th Avenue"),
        ("", ""),
        (None, None),
    ],
)
def test_title_words_starts_a_word_after_any_symbol(spark, text, expected):
    assert one(spark, "t string", (text,), title_words(F.col("t")))[0] == expected


def test_blank_and_state(spark):
    assert tuple(one(spark, "a string, b string", ("", " sp "), blank_to_null("a"), clean_state("b"))) == (None, "SP")


@pytest.mark.parametrize(
    "start, end, truncated, floored",
    [
        ("2018-01-01 23:00:00", "2018-01-03 01:00:00", 1, 1),
        ("2018-01-01 01:00:00", "2018-01-01 00:00:00", 0, -1),
        ("2018-01-01 00:00:00", "2018-01-01 00:00:00", 0, 0),
        ("2018-01-03 01:00:00", "2018-01-01 00:00:00", -2, -3),
        ("2018-01-01 00:00:00.000001", "2018-01-01 00:00:00", 0, -1),
    ],
)
def test_elapsed_days_truncate_or_floor(spark, start, end, truncated, floored):
    a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    row = one(spark, "a string, b string", (start, end), elapsed_days_truncated(a, b), elapsed_days_floored(a, b))
    assert tuple(row) == (truncated, floored)


def test_date_keys(spark):
    day = F.col("d")
    row = one(spark, "d date", (dt.date(2018, 4, 1),), date_key(day), sunday_zero(day), period_label(month_key(date_key(day))))
    assert tuple(row) == (20180401, 0, "2018-04")


@pytest.mark.parametrize("value, label", [(0, None), (1, "a"), (7, "a"), (8, "b"), (200, "b"), (201, None), (None, None)])
def test_bins_are_closed_on_the_right(spark, value, label):
    assert one(spark, "v int", (value,), right_closed_bin(F.col("v"), [0, 7, 200], ["a", "b"]))[0] == label


def test_mean_keeps_more_places_than_avg(spark):
    df = spark.createDataFrame([(Decimal("0.01"),)] + [(Decimal("0.00"),)] * 2, "v decimal(10,2)")
    mean = df.agg(exact_mean(F.sum("v"), F.count("v"))).first()[0]
    assert str(mean).startswith("0.00333333333333")


def test_growth_without_a_base_is_unknown(spark):
    row = one(spark, "a decimal(10,2), z decimal(10,2), n decimal(10,2)", (Decimal(3), Decimal(0), None),
              growth(F.col("a"), F.col("z")), growth(F.col("a"), F.col("n")), growth(F.col("z"), F.col("a")))
    assert tuple(row) == (None, None, Decimal("-100.00"))


def test_clip_and_severity(spark):
    row = one(spark, "v int, w int", (99, None), clip(F.col("v"), 0, 60), clip(F.col("w"), 0, 60),
              traffic_light(F.col("v"), 20, 15), traffic_light(F.lit(16), 20, 15), traffic_light(F.lit(15), 20, 15))
    assert tuple(row) == (60, None, "alto", "medio", "bajo")


def test_unknown_counts_as_false_in_shares(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,), (0,)], "v int")
    assert df.agg(true_share(F.col("v") >= 0)).first()[0] == 50.0
