"""Quantiles, box plots and histograms against numpy."""

from decimal import Decimal

import numpy as np
import pytest

from tianguis.operators.histogram import equal_width
from tianguis.operators.quantiles import box_statistics, counted_values, exact_quantiles


@pytest.mark.parametrize("cents", [[100], [100, 250], list(range(0, 5000, 7)), [5, 5, 5, 5, 900], [1, 2, 3, 4]])
def test_quantiles_interpolate(many_partitions, cents):
    df = many_partitions.createDataFrame([(Decimal(c) / 100,) for c in cents] + [(None,)], "v decimal(10,2)")
    row = exact_quantiles(counted_values(df, "v"), "v", {"q1": (1, 4), "median": (1, 2), "p90": (9, 10)}).first()
    expected = np.quantile(np.array(cents) / 100, [0.25, 0.5, 0.9])
    assert [float(row[k]) for k in ("q1", "median", "p90")] == pytest.approx(expected, abs=1e-5)
    assert (row["n"], float(row["sum"])) == (len(cents), pytest.approx(sum(cents) / 100))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v decimal(10,2)")
    row = exact_quantiles(counted_values(df, "v"), "v", {"median": (1, 2)}).first()
    assert row["n"] == 0 and row["median"] is None


def test_box_statistics_per_group(many_partitions):
    rng = np.random.default_rng(3)
    groups = {"1": rng.integers(1, 5000, 300), "2": np.array([10]), "5+": np.array([1, 2, 3, 4, 1000])}
    data = [(g, Decimal(int(v)) / 100) for g, values in groups.items() for v in values]
    df = many_partitions.createDataFrame(data, "g string, v decimal(12,2)")
    got = {r["g"]: r for r in box_statistics(df, "g", "v").collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        values = values / 100
        q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        low = min(values[values >= q1 - 1.5 * (q3 - q1)].min(), q1)
        high = max(values[values <= q3 + 1.5 * (q3 - q1)].max(), q3)
        names = ("bigote_inferior", "q1", "mediana", "q3", "bigote_superior")
        assert [float(got[g][k]) for k in names] == pytest.approx([low, q1, q2, q3, high], abs=1e-5)
        assert got[g]["n"] == len(values)


@pytest.mark.parametrize("values", [[0, 60, 3, 3, 59], list(range(61)), [4, 4, 4], [-30, 30, 0]])
def test_integer_histogram_matches_numpy(spark, values):
    got = equal_width(spark.createDataFrame([(v,) for v in values], "v int"), "v", 40).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=40)
    assert [r["n"] for r in got] == list(counts)
    assert [r["desde"] for r in got] + [got[-1]["hasta"]] == pytest.approx(list(edges))


def test_double_histogram_matches_numpy(spark):
    values = list(np.random.default_rng(1).normal(5, 2, 400))
    got = equal_width(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", 40).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(np.histogram(values, bins=40)[0])


def test_histogram_of_nothing_is_empty(spark):
    assert equal_width(spark.createDataFrame([(None,)], "v int"), "v", 40).count() == 0
