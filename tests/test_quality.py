"""Checks pass on good data and count violations on bad."""

import dataclasses
import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tianguis.operators.checks import table_constraints, violations
from tianguis.plans import quality
from tianguis.plans.star import plan_star


def verdicts(checks):
    return {r["test"]: (r["resultado"], r["estado"]) for r in checks.collect()}


def test_counts(raw, star):
    staging = rows(quality.staging_counts(raw), "tabla")
    assert [(r["tabla"], r["filas"]) for r in staging][:2] == [("staging.customers", 5), ("staging.geolocation", 1)]
    info = rows(quality.star_info(star), "tabla")
    assert [r["filas"] for r in info] == [6, 4, 4, 3, 8, 91] and {r["tipo"] for r in info} == {"INFO"}


def test_good_star_passes(star):
    for checks in (quality.star_checks(star), quality.star_constraints(star), quality.fact_amounts(star),
                   quality.sk_integrity(star), quality.calendar_gaps(star.dim_date)):
        assert {v for v in verdicts(checks).values()} == {(0, "PASS")}
        quality.require(checks)


def test_violations_are_counted(star):
    item = star.fact_order_items.withColumns(
        {
            "price": F.when(F.col("order_id") == "o1", -1).otherwise(F.col("price")).cast("decimal(10,2)"),
            "seller_sk": F.when(F.col("order_id") == "o2", None).otherwise(F.col("seller_sk")),
            "product_sk": F.when(F.col("order_id") == "o3", -7).otherwise(F.col("product_sk")),
        }
    )
    bad = dataclasses.replace(
        star,
        fact_order_items=item,
        dim_sellers=star.dim_sellers.unionByName(star.dim_sellers),
        fact_reviews=star.fact_reviews.withColumn("review_score", F.col("review_score") + 3),
    )
    found = verdicts(quality.star_checks(bad))
    assert found["11 | fact_order_items — price negativo"] == (2, "FAIL")
    assert found["09 | fact_order_items — seller_sk NULL"] == (1, "FAIL")
    assert found["12 | fact_reviews — score fuera de 1-5"] == (4, "FAIL")
    assert found["15 | dim_sellers   — IDs duplicados"] == (3, "FAIL")
    assert found["13 | dim_customers — IDs duplicados"] == (0, "PASS")
    constraints = verdicts(quality.star_constraints(bad))
    assert constraints["fk fact_order_items.product_sk"] == (1, "FAIL")
    assert constraints["fk fact_order_items.seller_sk"] == (0, "PASS")
    assert constraints["pk dim_sellers.seller_sk"] == (3, "FAIL")
    with pytest.raises(quality.QualityFailure, match="price negativo"):
        quality.require(quality.star_checks(bad))


def test_coverage_below_99_percent_fails(star):
    found = rows(quality.fk_coverage(star), "tabla")
    assert [(r["filas"], r["sin_order_sk"], r["estado"]) for r in found] == [(17, 9, "FAIL"), (7, 1, "FAIL")]


def test_wrong_order_keys_and_calendar_gaps(spark, star):
    swapped = dataclasses.replace(star, fact_payments=star.fact_payments.withColumn("order_id", F.lit("other")))
    assert verdicts(quality.sk_integrity(swapped))["order_sk / order_id"] == (8, "FAIL")
    days = spark.createDataFrame([(dt.date(2018, 1, d),) for d in (1, 2, 5, 6, 9)], "full_date date")
    assert verdicts(quality.calendar_gaps(days)) == {"dim_date gaps": (2, "FAIL")}


def test_snapshot_rules(spark):
    bad = spark.createDataFrame(
        [("2018-1", 5.0, "x"), ("2018-02", -1.0, None), ("2018-03", 2.0, None)],
        "periodo string, ingresos_totales double, top_categoria_1 string",
    )
    assert [v[0] for v in verdicts(quality.snapshot_checks(bad.unionByName(bad.limit(1)))).values()] == [2, 1, 1, 1]


def test_text_lengths(star):
    assert {v for v in verdicts(quality.text_lengths(star)).values()} == {(0, "PASS")}
    long_state = dataclasses.replace(star, dim_sellers=star.dim_sellers.withColumn("seller_state", F.lit("SPX")))
    assert verdicts(quality.text_lengths(long_state))["largo dim_sellers.seller_state"] == (3, "FAIL")


def test_keys_of_several_types_are_counted_together(spark):
    """dq_constraints: whole numbers travel as numbers, other keys as text, and an empty text or a zero is a value."""
    df = spark.createDataFrame(
        [(0, "", 1, "x"), (0, "a", 2, None), (7, "a", None, "1"), (None, None, 3, "")], "n long, t string, f int, g string"
    )
    numbers, texts = spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(1,), (2,)], "id int")
    checks = table_constraints("t", df, ["n", "t"], {"f": (numbers, "id"), "g": (texts, "id")}, ["n", "g"])
    found = {r["test"]: r["resultado"] for r in checks.collect()}
    assert found == {"pk t.n": 1, "pk t.t": 1, "fk t.f": 1, "fk t.g": 2, "not null t.n": 1, "not null t.g": 1}
    assert "cast(n#" not in checks._jdf.queryExecution().executedPlan().toString()


def test_good_items_are_read_but_not_moved(raw):
    """soiled_fact_amounts: all items were dealt out by product, seller and order before their amounts were looked at."""
    price = F.when((F.col("order_id") == "o1") & (F.col("order_item_id") == "2"), "-1").otherwise(F.col("price"))
    checks = quality.fact_amounts(plan_star({**raw, "order_items": raw["order_items"].withColumn("price", price)}))
    found = verdicts(checks)
    assert found["price < 0"] == (1, "FAIL") and found["date_sk NULL"] == (0, "PASS")
    lines = checks._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    looked_at = next(n for n, line in enumerate(lines) if "Filter" in line and "< 0.00" in line)
    assert "hashpartitioning(product_id#" in next(line for line in reversed(lines[:looked_at]) if "Exchange" in line)


def test_violations_of_rows_with_nulls_and_of_repeated_rows(spark):
    """A rule that is NULL for a row hides no other rule of it, a row that breaks two rules counts for both."""
    data = [(None, 1), (-1, None), (-1, None), (None, None), (-2, 5), (3, 3)]
    df = spark.createDataFrame(data, "v int, w int")
    rules = {"negative": F.col("v") < 0, "missing": F.col("w").isNull(), "above": F.col("w") > F.col("v")}
    for rows_of, expected in ((df, [3, 3, 1]), (df.limit(0), [0, 0, 0]), (df.where("v = 3"), [0, 0, 0])):
        found = {r["test"]: r["resultado"] for r in violations(rows_of, rules).collect()}
        assert list(found.values()) == expected and list(found) == list(rules)
