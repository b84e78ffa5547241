"""Replacement in one step, rules enforced on write, counts taken while writing, and the SQL table functions."""

import warnings
from dataclasses import replace
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tianguis.operators.rules import enforced
from tianguis.plans import functions, monthly, quality, star as plans
from tianguis.schemas import SEGMENT_CHECKS, SNAPSHOT_CHECKS
from tianguis.sources import builds
from tianguis.sources.warehouse import publish_views, read_segments, read_snapshots, read_star, rewrite_segments, star_tables


def keys(star):
    return {name: sorted(map(str, df.collect())) for name, df in star_tables(star).items()}


def test_a_failing_build_leaves_everything_as_it_was(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path)
    star, counts = plans.write_star(spark, raw, folder)
    publish_views(spark, "shop", folder, ["fact_order_items", "dim_date"])
    before, asked = keys(star), spark.table("shop.fact_order_items").count()

    # M1-M4 and A5: the counts taken while writing are those of the checks that read the tables again.
    assert {name: c["filas"] for name, c in counts.items()} == {name: len(found) for name, found in before.items()}
    seen = {label: n for c in counts.values() for label, n in c.items() if label != "filas"}
    assert seen == {r["test"]: r["resultado"] for r in quality.star_checks(star).collect() if r["test"] in seen} and len(seen) == 6

    monkeypatch.setitem(plans.FACTS, "fact_payments", lambda *_: spark.sql("SELECT raise_error('no payments') AS order_id"))
    with pytest.raises(Exception):
        plans.build_star(spark, {**raw, "sellers": raw["sellers"].limit(1)}, folder)
    assert keys(read_star(spark, folder)) == before == keys(star)
    assert spark.table("shop.fact_order_items").count() == asked

    monkeypatch.undo()
    plans.build_star(spark, {**raw, "sellers": raw["sellers"].limit(1)}, folder)
    assert read_star(spark, folder).dim_sellers.count() == 1
    assert keys(star) == before  # who planned over the old build can still read it
    assert builds.discard_old(spark, folder) == 2 and read_star(spark, folder).dim_sellers.count() == 1
    spark.sql("DROP DATABASE shop CASCADE")


@pytest.mark.parametrize(
    "table, change, says",
    [
        ("customers", {"customer_city": "rpad('x', 101, 'x')"}, "dim_customers.customer_city is longer than 100"),
        ("order_payments", {"order_id": "CAST(NULL AS STRING)"}, "fact_payments.order_id is NULL"),
    ],
)
def test_rules_are_enforced_by_the_write(spark, raw, tmp_path, table, change, says):
    broken = raw[table].withColumns({c: F.expr(e) for c, e in change.items()})
    with pytest.raises(PySparkException, match=says):
        plans.build_star(spark, {**raw, table: broken}, str(tmp_path))
    assert not (tmp_path / "CURRENT").exists()


def test_the_supplied_tables_bring_lengths_of_their_own(spark, tmp_path):
    """Their states are names of nations: the declared lengths refuse them, those of the adapter do not."""
    from tianguis.sources.standin import LENGTHS, StandIn

    staging = StandIn(spark, "/root/testdata/sf0.001").staging
    with pytest.raises(PySparkException, match="state is longer than 2"):
        plans.build_star(spark, staging, str(tmp_path))
    built = plans.build_star(spark, staging, str(tmp_path), LENGTHS)
    assert built.dim_customers.count() == staging["customers"].count() and built.fact_order_items.count() == staging["order_items"].count()


def test_checks_of_snapshots_and_segments(spark):
    period = spark.createDataFrame([("2018-1",)], "periodo string")
    with pytest.raises(PySparkException, match="snapshot.periodo breaks its check"):
        enforced(period, "snapshot", checks=SNAPSHOT_CHECKS["checks"]).collect()
    with pytest.raises(PySparkException, match="segments.segmento breaks its check"):
        enforced(spark.createDataFrame([("E",)], "segmento string"), "segments", checks=SEGMENT_CHECKS["checks"]).collect()
    assert enforced(spark.createDataFrame([(None,)], "segmento string"), "s", checks=SEGMENT_CHECKS["checks"]).count() == 1


def test_segments_stay_when_a_rewrite_fails(spark, star, tmp_path):
    from tianguis.plans.segments import segment_sellers

    folder, good = str(tmp_path / "segments"), segment_sellers(star)
    rewrite_segments(good, folder)
    with pytest.raises(PySparkException, match="segmento"):
        rewrite_segments(good.withColumn("segmento", F.lit("E")), folder)
    assert read_segments(spark, folder).count() == 2


def test_a_bad_month_is_held_apart(spark, star, tmp_path):
    """An amount that the snapshot cannot hold is an error of its month; the others are stored."""
    folder = str(tmp_path / "snapshots")
    monthly.refresh_snapshots(star, folder, (2018, 1), (2018, 4))
    before = rows(read_snapshots(spark, folder).drop("fecha_generacion"), "periodo")
    items = star.fact_order_items
    huge = items.where("date_sk = 20180331").withColumn("total_value", F.lit("99999999999999.99").cast("decimal(20,2)"))
    other = items.where("date_sk <> 20180331").withColumn("total_value", F.col("total_value").cast("decimal(20,2)"))
    burst = replace(star, fact_order_items=other.unionByName(huge))
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert monthly.refresh_snapshots(burst, folder, (2018, 1), (2018, 4)) == 2
    assert [str(w.message) for w in caught if "2018-03" in str(w.message)] == [
        "2018-03: ingresos_totales does not fit decimal(15,2); ticket_promedio does not fit decimal(10,2)"
    ]
    assert rows(read_snapshots(spark, folder).drop("fecha_generacion"), "periodo") == before
    found = rows(monthly.refresh_months(burst, folder, (2018, 3), (2018, 4)), "periodo")
    assert [(r["periodo"], r["error"] is None) for r in found] == [("2018-03", False), ("2018-04", True)]


@pytest.mark.parametrize("month", [(2018, 4), (2018, 1), (2017, 12), (2018, 2)])
def test_report_function(spark, star, month):
    functions.register_functions(spark, star)
    found = spark.sql("SELECT * FROM {}({}, {})".format(functions.REPORT, *month))
    want = monthly.monthly_report(star, *month)
    assert found.columns == want.columns and found.collect() == want.collect()
    assert [f.dataType for f in found.schema] == [f.dataType for f in want.schema]


@pytest.mark.parametrize("year, month, says", [(2018, 13, "month 13"), (2018, 0, "month 0"), (1999, 5, "year 1999")])
def test_report_function_refuses_wrong_arguments(spark, star, year, month, says):
    functions.register_functions(spark, star)
    with pytest.raises(Exception, match=says):
        spark.sql(f"SELECT * FROM {functions.REPORT}({year}, {month})").collect()


def test_report_function_opens_three_partitions(spark, raw, tmp_path):
    functions.register_functions(spark, plans.build_star(spark, raw, str(tmp_path)))
    found = spark.sql(f"SELECT * FROM {functions.REPORT}(2018, 4)")
    plan = found._jdf.queryExecution().executedPlan().toString()
    months = {m for m in ("201804", "201803", "201704") if f"(purchase_month" in plan and f" = {m})" in plan}
    assert months == {"201804", "201803", "201704"}
    assert found.first()["periodo"] == "2018-04"


def test_segment_function(spark, star):
    functions.register_functions(spark, star)
    assert spark.sql(f"SELECT * FROM {functions.SEGMENTS}()").count() == 2
    empty = SimpleNamespace(**{**star_tables(star), "fact_order_items": star.fact_order_items.limit(0)})
    functions.register_functions(spark, empty)
    with pytest.raises(Exception, match="no sales"):
        spark.sql(f"SELECT * FROM {functions.SEGMENTS}()").collect()
