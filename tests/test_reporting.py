"""The five views on hand-written files (L1-L5, L49-L54) and their invariants."""

from decimal import Decimal

from conftest import rows

from tianguis.plans import quality, reporting, segments
from tianguis.plans.star import plan_star

D = Decimal


def test_monthly_revenue_compares_with_the_last_month_that_sold(star):
    found = rows(reporting.monthly_revenue(star), "year", "month")
    assert [
        (r["month"], r["month_name"], r["revenue"], r["total_ordenes"], r["ticket_promedio"], r["revenue_mes_anterior"],
         r["crecimiento_pct"])
        for r in found
    ] == [
        (1, "January", D("241.00"), 2, D("80.33"), None, None),
        (3, "March", D("21.00"), 1, D("21.00"), D("241.00"), D("-91.29")),
        (4, "April", D("60.00"), 2, D("30.00"), D("21.00"), D("185.71")),
    ]


def test_pareto(star):
    found = rows(reporting.category_pareto(star), "ranking")
    assert [(r["categoria"], r["revenue"], r["total_items"], r["pct_del_total"], r["pct_acumulado"], r["segmento_pareto"])
            for r in found] == [
        ("health_beauty", D("215.50"), 3, D("66.93"), D("66.93"), "Top 80%"),
        ("Sin categoría", D("106.50"), 3, D("33.07"), D("100.00"), "Restante 20%"),
    ]


def test_sellers_are_counted_without_expanding_the_fact(star):
    for plan in (reporting.seller_totals(star), segments.segment_sellers(star)):
        assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()


def test_equal_sellers_share_a_rank(star):
    found = rows(reporting.seller_ranking(star), "seller_id")
    assert [(r["seller_id"], r["seller_state"], r["revenue_total"], r["total_ordenes"], r["productos_distintos"],
             r["ranking_revenue"], r["ranking_ordenes"], r["ranking_ticket"]) for r in found] == [
        ("s1", "SP", D("161.00"), 3, 2, 1, 1, 1),
        ("s2", "RJ", D("161.00"), 3, 2, 1, 1, 1),
    ]


def test_delivery_days_are_truncated_and_weighted_by_items(star):
    found = rows(reporting.delivery_by_state(star), "estado")
    assert [(r["estado"], r["dias_promedio"], r["entrega_minima"], r["entrega_maxima"], r["total_entregas"],
             r["ranking_mejor_entrega"], r["ranking_peor_entrega"]) for r in found] == [
        ("RJ", D("9.5"), 0, 19, 2, 2, 1),
        ("SP", D("1.0"), 1, 1, 2, 1, 2),
    ]


def test_satisfaction_counts_item_review_pairs(star):
    found = rows(reporting.category_satisfaction(star, min_rows=1), "categoria")
    # health_beauty: item 1 of o1 with scores 5 and 1; the rest: item 2 of o1 (5, 1), o3 (4), o7 (2).
    assert [(r["categoria"], r["score_promedio"], r["total_reviews"], r["reviews_positivas"], r["reviews_negativas"],
             r["pct_satisfaccion"], r["ticket_promedio"], r["ranking_satisfaccion"]) for r in found] == [
        ("Sin categoría", D("3.00"), 4, 2, 2, D("50.0"), D("40.50"), 1),
        ("health_beauty", D("3.00"), 2, 1, 1, D("50.0"), D("110.00"), 1),
    ]
    assert reporting.category_satisfaction(star, min_rows=3).count() == 1


def test_one_order_with_very_many_reviews_and_items(spark):
    """A third of everything in one order: the pairs are counted, not produced."""
    items = spark.range(3000).selectExpr(
        "CASE WHEN id < 1000 THEN 0 ELSE id END AS order_id", "id % 3 AS product_sk", "CAST(1.5 AS DECIMAL(10,2)) AS total_value"
    )
    reviews = spark.range(3000).selectExpr(
        "CASE WHEN id < 1000 THEN 0 ELSE id END AS order_id", "CAST(1 + id % 5 AS SMALLINT) AS review_score"
    )
    products = spark.range(3).selectExpr("id AS product_sk", "concat('c', id) AS product_category_name_english")
    fake = type("S", (), {"fact_order_items": items, "fact_reviews": reviews, "dim_products": products})
    got = reporting.category_satisfaction(fake, min_rows=1)
    pairs = items.join(reviews, "order_id").groupBy("product_sk").count()
    assert sorted(r["total_reviews"] for r in got.collect()) == sorted(r["count"] for r in pairs.collect())


def test_questions_asked_of_the_views(star):
    views = reporting.reporting_views(star)
    monthly = views["vw_revenue_mensual"]
    assert tuple(reporting.peak_month(monthly).first())[:2] == (2018, 1)
    assert [tuple(r) for r in reporting.revenue_by_year(monthly).collect()] == [(2018, D("107.33"))]
    assert [r["estado"] for r in reporting.slowest_states(views["vw_tiempo_entrega_estado"], 1).collect()] == ["RJ"]
    places = rows(reporting.revenue_by_seller_place(views["vw_ranking_vendedores"]), "seller_state")
    assert [(r["seller_city"], r["revenue_total"], r["vendedores"]) for r in places] == [
        ("Rio De Janeiro", D("161.00"), 1),
        ("Campinas", D("161.00"), 1),
    ]
    assert reporting.inactive_days(star).count() == 91 - 5


def test_headline_cards_follow_their_slicers(star):
    views = reporting.reporting_views(star)
    everything = reporting.headline_kpis(views).first()
    assert (everything["revenue_total"], everything["dias_promedio"]) == (D("322.00"), D("5.25"))
    sliced = reporting.headline_kpis(views, months=[4], states=["SP"]).first()
    assert (sliced["revenue_total"], sliced["dias_promedio"]) == (D("60.00"), D("1.00"))


def test_views_keep_their_presentation_order(star):
    shown = reporting.ordered_view("vw_tiempo_entrega_estado", reporting.delivery_by_state(star))
    assert [r["estado"] for r in shown.collect()] == ["SP", "RJ"]


def test_view_counts_and_invariants(standin):
    views = reporting.reporting_views(standin.star)
    counts = {r["vista"]: r["filas"] for r in quality.view_counts(views).collect()}
    assert set(counts) == set(reporting.VIEWS) and counts["vw_revenue_mensual"] > 70
    assert {r["estado"] for r in quality.view_checks(views).collect()} == {"PASS"}


def test_facts_are_reduced_before_dimensions_join(standin):
    """The products of the Pareto view are joined to one row per product, not to every item."""
    plan = reporting.category_pareto(standin.star)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("product_category_name_english")
    assert "Aggregate [product_sk" in plan[join:]


def test_satisfaction_meets_the_fact_where_it_lies(star):
    """built_category_satisfaction: rows of items and reviews used to be dealt out and ordered for keys that the view doesn't read."""
    plan = reporting.category_satisfaction(star)._jdf.queryExecution().executedPlan().toString()
    hashed = [line for line in plan.splitlines() if "xxhash64(" in line]
    assert not [line for line in hashed if "order_item_id" in line or "review_id" in line]


def test_ranking_reads_the_built_fact_once(spark, standin):
    """built_seller_ranking: all readings of the frame that is ranked join the fact alike, so they share its exchanges."""
    ranking = reporting.seller_ranking(plan_star(standin.staging))
    assert ranking.count() == standin.sellers.count()
    ranking.collect()
    plan = ranking._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and "SortMergeJoin [seller_id#" in plan and "BroadcastHashJoin [seller_id#" not in plan
    assert not [line for line in plan.splitlines() if "Window [row_number()" in line and "order_item_id" in line]
