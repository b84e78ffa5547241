"""Monthly report and snapshots."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from tianguis.plans import monthly
from tianguis.plans.quality import snapshot_checks

D = Decimal


def spans(spark, year, month):
    days = monthly.comparison_days(monthly.month_spine(spark.range(1), (year, month), (year, month)))
    ends = {}
    for row in days.collect():
        ends.setdefault(row["tramo"], []).append(row["full_date"])
    return {k: (min(v), max(v)) for k, v in ends.items()}


@pytest.mark.parametrize(
    "year, month, previous, last_year",
    [
        (2018, 4, ("2018-03-01", "2018-03-30"), ("2017-04-01", "2017-04-30")),
        (2018, 3, ("2018-02-01", "2018-02-28"), ("2017-03-01", "2017-03-31")),
        (2018, 2, ("2018-01-01", "2018-01-28"), ("2017-02-01", "2017-02-28")),
        (2016, 2, ("2016-01-01", "2016-01-29"), ("2015-02-01", "2015-02-28")),
        (2017, 2, ("2017-01-01", "2017-01-28"), ("2016-02-01", "2016-02-28")),
    ],
)
def test_comparison_windows_clamp_both_ends(spark, year, month, previous, last_year):
    found = spans(spark, year, month)
    day = dt.date.fromisoformat
    assert found[monthly.LAST_MONTH] == tuple(map(day, previous))
    assert found[monthly.LAST_YEAR] == tuple(map(day, last_year))


def test_april_is_compared_with_thirty_days_of_march(star):
    """The only sale of March is on the 31st, so April has nothing to compare with."""
    row = monthly.monthly_report(star, 2018, 4).first().asDict()
    assert row == {
        "periodo": "2018-04",
        "ingresos_totales": D("60.00"),
        "ingresos_mes_anterior": D("0.00"),
        "crecimiento_mom_pct": None,
        "ingresos_anio_anterior": D("0.00"),
        "crecimiento_yoy_pct": None,
        "total_ordenes": 2,
        "ticket_promedio": D("30.00"),
        "top_categoria_1": "health_beauty",
        "top_categoria_2": "sem_traducao",
        "top_categoria_3": None,
        "top_vendedor_1": row["top_vendedor_1"],
        "top_vendedor_2": row["top_vendedor_2"],
        "top_vendedor_3": None,
        "score_satisfaccion_avg": D("2.00"),
    }
    assert {row["top_vendedor_1"], row["top_vendedor_2"]} == {"s1", "s2"}


def test_scores_are_weighted_by_items_and_categories_fall_back(star):
    row = monthly.monthly_report(star, 2018, 1).first()
    # o1 has two items and scores 5 and 1; o2 has no score.
    assert row["score_satisfaccion_avg"] == D("3.00")
    assert (row["top_categoria_1"], row["top_categoria_2"]) == ("health_beauty", "sem_traducao")
    march = monthly.monthly_report(star, 2018, 3).first()
    assert march["top_categoria_1"] == "Sin Categoría" and march["ingresos_mes_anterior"] == 0


def test_a_month_without_sales_has_a_row(star):
    found = rows(monthly.monthly_snapshots(star, (2018, 1), (2018, 5)), "periodo")
    assert [r["periodo"] for r in found] == ["2018-01", "2018-02", "2018-03", "2018-04", "2018-05"]
    empty = found[1]
    assert (empty["ingresos_totales"], empty["total_ordenes"], empty["ticket_promedio"]) == (0, 0, 0)
    assert empty["top_categoria_1"] is None and empty["score_satisfaccion"] is None
    assert monthly.monthly_report(star, 2018, 2).first()["score_satisfaccion_avg"] == 0


def test_batch_equals_single_months(star):
    batch = {r["periodo"]: r for r in monthly.report_rows(star, (2018, 1), (2018, 4)).collect()}
    for month in (1, 2, 3, 4):
        assert monthly.monthly_report(star, 2018, month).first() == batch[f"2018-{month:02d}"]


def test_batch_questions(star):
    snapshots = monthly.monthly_snapshots(star, (2017, 12), (2018, 5))
    assert monthly.months_with_revenue(snapshots).first()[0] == 3
    assert tuple(monthly.snapshot_peak(snapshots).first()) == ("2018-01", D("241.00"))
    assert monthly.snapshot_listing(snapshots).columns == ["periodo", "ingresos", "ordenes", "ticket", "cat_top1", "satisfaccion"]
    assert {r["estado"] for r in snapshot_checks(snapshots).collect()} == {"PASS"}


@pytest.mark.parametrize("year, month", [(2018, 0), (2018, 13), (1999, 12), (2101, 1)])
def test_parameters_are_checked_before_planning(year, month):
    with pytest.raises(monthly.InvalidParameter):
        monthly.monthly_report(None, year, month)


def test_one_month_filters_the_scan(spark, raw, tmp_path):
    from tianguis.plans.star import build_star

    stored = build_star(spark, raw, str(tmp_path))
    plan = monthly.monthly_report(stored, 2018, 4)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_sk,20170401)" in plan and "LessThanOrEqual(date_sk,20180431)" in plan
