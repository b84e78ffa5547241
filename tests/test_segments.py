"""Seller segments."""

from decimal import Decimal

from conftest import rows

from tianguis.plans import segments
from tianguis.plans.quality import segment_checks
from tianguis.plans.reporting import seller_totals
from tianguis.plans.star import plan_star


def seller_star(spark, n):
    items = spark.range(n).selectExpr(
        "id AS seller_sk", "id AS order_id", "id % 5 AS product_sk", "20180101 + id % 28 AS date_sk",
        "CAST(10 + id % 50 AS DECIMAL(10,2)) AS total_value",
    )
    sellers = spark.range(n).selectExpr(
        "id AS seller_sk", "lpad(id, 5, '0') AS seller_id", "'City' AS seller_city", "'SP' AS seller_state"
    )
    return type("S", (), {"fact_order_items": items, "dim_sellers": sellers})


def test_two_sellers_fill_the_first_two_tiles(star):
    found = rows(segments.segment_sellers(star), "segment_sk")
    assert [(r["segment_sk"], r["seller_id"], r["segmento"], r["ingresos_total"]) for r in found] == [
        (1, "s1", "A", Decimal("161.00")),
        (2, "s2", "B", Decimal("161.00")),
    ]
    assert str(found[0]["primera_venta"]) == "2018-01-30" and str(found[0]["ultima_venta"]) == "2018-04-15"


def test_quartiles_with_ties(many_partitions):
    fake = seller_star(many_partitions, 203)
    found = rows(segments.segment_sellers(fake), "segment_sk")
    ordered = sorted(found, key=lambda r: (-r["ingresos_total"], r["seller_id"]))
    assert [r["segmento"] for r in ordered] == ["A"] * 51 + ["B"] * 51 + ["C"] * 51 + ["D"] * 50


def test_summary_adds_up(spark):
    found = segments.segment_sellers(seller_star(spark, 200))
    summary = rows(segments.segment_summary(found), "segmento")
    assert [r["descripcion"] for r in summary] == ["Alto rendimiento", "Medio-alto", "Medio-bajo", "Bajo rendimiento"]
    assert abs(sum(r["pct_del_total"] for r in summary) - 100) < Decimal("0.03")
    assert {r["estado"] for r in segment_checks(found).collect()} == {"PASS"}
    top = segments.segment_top(found).collect()
    assert len(top) == 10 and top[0]["ingresos"] == 59
    means = {r["segmento"]: r["ingresos_promedio"] for r in segments.segment_mean_revenue(found).collect()}
    assert means["A"] > means["B"] > means["C"] > means["D"]


def test_bad_segments_are_noticed(spark):
    bad = spark.createDataFrame(
        [("s1", "A", Decimal(1)), ("s1", "Z", Decimal(2)), ("s2", "D", Decimal(5))],
        "seller_id string, segmento string, ingresos_total decimal(15,2)",
    )
    failed = {r["test"] for r in segment_checks(bad).collect() if r["estado"] == "FAIL"}
    assert failed == {
        "segmento no válido",
        "seller_id duplicado",
        "segmento fuera de 20-30 %",
        "segmentos ausentes",
        "promedio de A no supera a D",
    }


def test_the_built_fact_is_computed_once_for_all_readings(spark, standin):
    """built_segment_summary: the sample of the order read a fact that was joined otherwise, and so all of it was computed twice."""
    summary = segments.segment_summary(segments.segment_sellers(plan_star(standin.staging)))
    summary.collect()
    plan = summary._jdf.queryExecution().executedPlan().toString()
    for key in ("product_id", "seller_id", "order_id"):
        assert f"SortMergeJoin [{key}#" in plan and f"BroadcastHashJoin [{key}#" not in plan.split("Initial Plan")[0]


def test_seller_totals_hold_no_orders(many_partitions):
    """segment_distribution: every task held a row for each order and product of its sellers in a hash table, which spilled."""
    data = [(n % 3 if n % 11 else None, n % 40 if n % 7 else None, n % 5 if n % 6 else None, None if n % 4 == 0 else n, n) for n in range(300)]
    data += [(1, 1, 1, 5, 9)] * 50 + [(7, None, None, None, None), (8, 500, 2, 1, 3), (8, 500, 4, 1, 2)]
    kinds = "seller_sk int, order_id int, product_sk int, total_value decimal(10,2), date_sk int"
    items = many_partitions.createDataFrame([(s, o, p, None if v is None else Decimal(v), d) for s, o, p, v, d in data], kinds)
    totals = seller_totals(type("S", (), {"fact_order_items": items}))
    expected = {}
    for seller in {row[0] for row in data}:
        mine = [row[1:] for row in data if row[0] == seller]
        orders, products, values, days = ([x for x in column if x is not None] for column in zip(*mine))
        revenue = sum(values) if values else None
        expected[seller] = (revenue, len(values), len(set(orders)), len(set(products)), min(days, default=None), max(days, default=None))
    assert {r[0]: tuple(r)[1:] for r in totals.collect()} == expected
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate(keys=[" in line and "order_id#" in line.split("functions=")[0]]
