"""The distributed order against brute force, with ties, few rows and NULLs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tianguis.operators.ordering import _with_range, running, tile_of, with_ranks


def pairs(n, values, seed=7):
    source = random.Random(seed)
    return [(i, source.randint(0, values)) for i in range(n)]


@pytest.mark.parametrize("n, values", [(1, 1), (3, 1), (500, 5), (500, 10**6)])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("key", ["long", "string", "date"])
def test_positions_and_sums(many_partitions, n, values, descending, key):
    data = pairs(n, values)
    name = {"long": "id", "string": "lpad(id, 5, '0')", "date": "date_add(DATE '2020-01-01', CAST(id AS INT))"}[key]
    df = many_partitions.createDataFrame(data, "id long, v long").repartition(3).selectExpr("id", "v", f"{name} AS k")
    expected, upto = {}, 0
    for i, (row, value) in enumerate(sorted(data, key=lambda r: (-r[1] if descending else r[1], r[0])), 1):
        upto += value
        expected[row] = (i, n, upto, sum(v for _, v in data))
    got = running(df, [("v", descending), ("k", False)], position="p", count="n", sums={"v": ("u", "t")})
    assert {r["id"]: (r["p"], r["n"], r["u"], r["t"]) for r in got.collect()} == expected


def test_positions_by_group(many_partitions):
    data = [(i, i % 3, v) for i, v in pairs(300, 20)]
    df = many_partitions.createDataFrame(data, "id long, g long, v long")
    got = running(df, [("v", False), ("id", True)], within="g", position="p", count="n", sums={"v": ("u", "t")})
    found = {r["id"]: (r["p"], r["n"], r["u"], r["t"]) for r in got.collect()}
    for group in range(3):
        upto = 0
        rows = sorted((r for r in data if r[1] == group), key=lambda r: (r[2], -r[0]))
        for i, (row, _, value) in enumerate(rows, 1):
            upto += value
            assert found[row] == (i, 100, upto, sum(r[2] for r in rows))


@pytest.mark.parametrize("n, values", [(1, 1), (400, 3), (400, 10**6)])
def test_rank_with_heavy_ties(many_partitions, n, values):
    data = pairs(n, values)
    df = many_partitions.createDataFrame(data, "id long, v long").selectExpr("*", "-v AS w")
    ranked = with_ranks(df, "id", {"v": "r", "w": "q"}).collect()
    assert {r["id"]: r["r"] for r in ranked} == {key: 1 + sum(other > value for _, other in data) for key, value in data}
    assert {r["id"]: r["q"] for r in ranked} == {key: 1 + sum(other < value for _, other in data) for key, value in data}


def test_rank_keeps_rows_without_a_value(many_partitions):
    df = many_partitions.createDataFrame([(1, 5), (2, None), (3, 7)], "id long, v long")
    assert {r["id"]: r["r"] for r in with_ranks(df, "id", {"v": "r"}).collect()} == {3: 1, 1: 2, 2: 3}


def test_running_sum_over_missing_values(many_partitions):
    data = [(1, None), (2, 4), (3, None), (4, 1)]
    df = many_partitions.createDataFrame(data, "id long, v long")
    result = {r["id"]: r["u"] for r in running(df, [("id", False)], sums={"v": ("u", "t")}).collect()}
    assert result == {1: None, 2: 4, 3: 4, 4: 5}


def test_nothing_to_order(spark):
    empty = spark.createDataFrame([], "id long, v long")
    assert running(empty, [("v", True), ("id", False)], position="p", sums={"v": ("u", "t")}).count() == 0
    assert with_ranks(empty, "id", {"v": "r"}).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), tiles=st.integers(1, 9))
def test_tiles_match_the_window_function(spark, n, tiles):
    positions = spark.range(1, n + 1).select(F.col("id").alias("p"), F.lit(n).cast("long").alias("n"))
    got = [r[0] for r in positions.select(tile_of(F.col("p"), F.col("n"), tiles), "p").orderBy("p").collect()]
    sizes = [n // tiles + (k < n % tiles) for k in range(tiles)]
    assert got == [k + 1 for k in range(tiles) for _ in range(sizes[k])]


def test_measures_of_several_types_rank_from_one_exchange(many_partitions):
    data = [(i, i % 4, None if i % 7 == 0 else i % 5) for i in range(200)]
    df = many_partitions.createDataFrame(data, "id long, v int, w long").selectExpr(
        "id", "v", "CAST(w AS DECIMAL(20,2)) AS w", "CAST(id % 3 AS DECIMAL(12,4)) / 3 AS x"
    )
    found = with_ranks(df, "id", {"v": "a", "w": "b", "x": "c"}, descending=False)
    kept = {r["id"]: r for r in found.collect()}
    for i, v, w in data:
        assert kept[i]["a"] == 1 + sum(other < v for _, other, _ in data)
        assert kept[i]["b"] == 1 + sum(other is None if w is not None else False for _, _, other in data) + sum(
            other < w for _, _, other in data if w is not None and other is not None
        )
        assert kept[i]["c"] == 1 + sum(other % 3 < i % 3 for other, _, _ in data)
        assert (kept[i]["v"], kept[i]["w"]) == (v, w)
    plan = found._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("ShuffleQueryStage") < 15


@pytest.mark.parametrize("descending", [False, True])
def test_rows_fall_into_many_ranges_in_order(many_partitions, descending):
    """Rows of a lower range come before those of a higher one, and a value that most rows share is split."""
    data = [(i, 7 if i % 3 else i) for i in range(3000)]
    df = many_partitions.createDataFrame(data, "id long, v long")
    found = _with_range(df, [("v", descending), ("id", False)]).collect()
    ordered = sorted(found, key=lambda r: (-r["v"] if descending else r["v"], r["id"]))
    assert [r["_range"] for r in ordered] == sorted(r["_range"] for r in found)
    shared = Counter(r["_range"] for r in found if r["v"] == 7)
    assert len(shared) > 50 and max(shared.values()) < 100
    assert len({r["_range"] for r in found}) > 80


@pytest.mark.parametrize("partitions", [3, 40])
def test_one_value_and_long_common_prefixes_are_dealt_out_evenly(many_partitions, partitions):
    """A million rows of one value, whose ids begin alike: no task gets over twice its share, whatever the input's partitions."""
    n = 1_000_000
    df = many_partitions.range(0, n, 1, partitions).selectExpr("5 AS v", "concat('seller_00000', lpad(id, 9, '0')) AS k")
    ranged = _with_range(df, [("v", True), ("k", False)])
    dealt = ranged.repartition("_range").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(dealt) == 7 and max(r["count"] for r in dealt) < 2 * n / 7
    borders = ranged.groupBy("_range").agg(F.min("k"), F.max("k")).orderBy("_range").collect()
    assert len(borders) == 112 and all(a[2] < b[1] for a, b in zip(borders, borders[1:], strict=False))
    if partitions == 40:
        again = _with_range(df.repartition(5), [("v", True), ("k", False)]).groupBy("_range").agg(F.min("k"), F.max("k"))
        assert again.orderBy("_range").collect() == borders


def test_texts_are_ordered_from_the_smallest_only(spark):
    with pytest.raises(TypeError):
        running(spark.createDataFrame([("a", 1)], "k string, v int"), [("k", True)], position="p")


def test_planning_runs_no_job_and_the_frame_is_computed_once(many_partitions):
    tracker = many_partitions.sparkContext.statusTracker()
    many_partitions.sparkContext.setJobGroup("planning", "plans only")
    facts = many_partitions.range(1000).selectExpr("id % 50 AS k", "id AS v")
    frame = facts.groupBy("k").agg(F.sum("v").alias("v"), F.count("v").alias("n"))
    plan = running(frame, [("v", True), ("k", False)], position="p", sums={"v": ("u", "t")})
    assert tracker.getJobIdsForGroup("planning") == []
    assert plan.count() == 50
    many_partitions.sparkContext.setJobGroup("other", "")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReusedExchange") >= 2  # the borders and the ranges' totals read what the rows read
