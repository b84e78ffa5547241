"""Star schema from hand-written files."""

import datetime as dt
from decimal import Decimal

from conftest import rows

from tianguis.operators.keys import first_by_key, keyed_first, with_row_key, with_surrogate_key
from tianguis.plans.quality import star_info
from tianguis.plans.star import ORDER_TIMESTAMPS, dated_orders, dim_customers, dim_orders, plan_star


def test_calendar_is_continuous(star):
    days = rows(star.dim_date, "date_sk")
    assert (days[0]["full_date"], days[-1]["full_date"], len(days)) == (dt.date(2018, 1, 30), dt.date(2018, 4, 30), 91)
    sunday = next(d for d in days if d["full_date"] == dt.date(2018, 4, 1))
    assert sunday == {
        "date_sk": 20180401,
        "full_date": dt.date(2018, 4, 1),
        "year": 2018,
        "quarter": 2,
        "month": 4,
        "month_name": "April",
        "day": 1,
        "day_of_week": 0,
        "day_name": "Sunday",
        "is_weekend": True,
    }


def test_customers_are_cleaned_and_unique(star):
    found = rows(star.dim_customers.drop("customer_sk"), "customer_id")
    assert [(r["customer_id"], r["customer_city"], r["customer_state"]) for r in found] == [
        ("c1", "Mogi-Guacu", "SP"),
        ("c2", "Sant'Ana Do Sul", "RJ"),
        ("c3", "São Paulo", "SP"),
        ("c4", "Rio De Janeiro", "RJ"),
    ]


def test_products_keep_one_translation(star):
    found = rows(star.dim_products, "product_id")
    assert [(r["product_category_name"], r["product_category_name_english"]) for r in found] == [
        ("beleza_saude", "health_beauty"),
        ("sem_traducao", None),
        (None, None),
        ("beleza_saude", "health_beauty"),
    ]
    assert found[1]["product_weight_g"] == Decimal("250.51") and found[3]["product_weight_g"] is None


def test_orders_are_typed(star):
    found = rows(star.dim_orders, "order_id")
    assert [r["order_purchase_timestamp"] for r in found][4] is None
    assert found[0]["order_delivered_customer_date"] == dt.datetime(2018, 2, 1, 1)
    assert [r["order_status"] for r in found].count("canceled") == 1


def test_items_without_a_known_parent_are_dropped(star):
    found = rows(star.fact_order_items, "order_id", "order_item_id")
    assert [(r["order_id"], r["order_item_id"], r["date_sk"], r["total_value"]) for r in found] == [
        ("o1", 1, 20180130, Decimal("110.00")),
        ("o1", 2, 20180130, Decimal("55.50")),
        ("o2", 1, 20180131, Decimal("75.50")),
        ("o3", 1, 20180331, Decimal("21.00")),
        ("o4", 1, 20180415, Decimal("30.00")),
        ("o7", 1, 20180401, Decimal("30.00")),
    ]
    assert len({r["order_item_sk"] for r in found}) == 6


def test_payments_and_reviews_of_unknown_orders_stay(star):
    payments = rows(star.fact_payments, "order_id")
    assert len(payments) == 17 and sum(r["order_sk"] is None for r in payments) == 9
    reviews = rows(star.fact_reviews, "review_id")
    assert [r["order_sk"] is None for r in reviews] == [False, False, False, False, True, False, False]
    assert reviews[1]["review_comment_title"] is None and reviews[2]["review_comment_message"] == "no score"


def test_a_duplicated_order_row_repeats_its_items(raw, star):
    """Items join the text orders, not the de-duplicated dimension."""
    twice = plan_star({**raw, "orders": raw["orders"].unionByName(raw["orders"].where("order_id = 'o1'"))})
    assert twice.dim_orders.count() == star.dim_orders.count()
    assert twice.fact_order_items.where("order_id = 'o1'").count() == 4


def test_keys_do_not_depend_on_the_order_of_rows(spark, raw):
    shuffled = {**raw, "customers": raw["customers"].repartition(5, "customer_zip_code_prefix")}
    assert rows(dim_customers(raw), "customer_id") == rows(dim_customers(shuffled), "customer_id")


def test_surrogate_keys_are_dense(spark):
    df = spark.range(5000).selectExpr("concat('k', id) AS k", "id AS v")
    keyed = with_surrogate_key(df, "k", "sk", buckets=16)
    assert sorted(r[0] for r in keyed.select("sk").collect()) == list(range(1, 5001))
    twice = keyed_first(df.unionByName(df.selectExpr("k", "v + 1 AS v")), "k", "sk", buckets=16)
    assert {tuple(r) for r in twice.collect()} == {tuple(r) for r in keyed.collect()}
    assert keyed_first(df.limit(0), "k", "sk").count() == 0


def test_row_keys_are_dense_and_repeatable(many_partitions):
    df = many_partitions.range(3000).selectExpr("id % 1000 AS a", "CASE WHEN id < 900 THEN 'hot' ELSE concat('k', id % 7) END AS b")
    first = rows(with_row_key(df, "sk", buckets=8), "sk")
    again = rows(with_row_key(df.repartition(11, "b"), "sk", buckets=8), "sk")
    assert first == again and [r["sk"] for r in first] == list(range(1, 3001))


def test_no_window_over_all_rows_gives_keys(star):
    for name in ("fact_order_items", "fact_reviews", "dim_orders"):
        plan = getattr(star, name)._jdf.queryExecution().executedPlan().toString()
        assert "monotonically_increasing_id" not in plan
        windows = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(_bucket" not in line]
        assert all("sum(_n" in line for line in windows)  # one row for each bucket


def test_first_row_per_key_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 'hot' ELSE concat('k', id) END AS k", "id % 7 AS v")
    kept = first_by_key(df, "k")
    assert kept.count() == 2001
    assert kept.where("k = 'hot'").first()["v"] == 0


def numbering(df):
    """The windows of a plan that number rows, as text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Window [row_number()" in line]


def test_a_reading_without_keys_numbers_and_deals_out_nothing_for_them(star):
    """dq_text_lengths: rows of the facts used to be moved once more for keys that nobody asked for."""
    assert numbering(star.fact_order_items.select("order_item_sk"))
    for name in ("fact_order_items", "fact_payments", "fact_reviews"):
        assert numbering(getattr(star, name).select("order_id")) == []
    assert numbering(star.dim_orders.select("order_id", "order_status")) == []


def test_first_rows_are_smallest_by_their_columns_in_order(spark):
    data = [("a", "2", None), ("a", "10", "x"), ("a", "10", "w"), (None, "1", "n"), (None, None, "m"), ("b", None, "z")]
    df = spark.createDataFrame(data, "k string, v string, w string")
    expected = {("a", "10", "w"), (None, None, "m"), ("b", None, "z")}
    assert {tuple(r) for r in first_by_key(df, "k").collect()} == expected
    keyed = keyed_first(df, "k", "sk").collect()
    assert {(r["k"], r["v"], r["w"]) for r in keyed} == expected and sorted(r["sk"] for r in keyed) == [1, 2, 3]
    assert {(r["sk"], r["k"]) for r in keyed_first(df.select("k"), "k", "sk").collect()} == {(r["sk"], r["k"]) for r in keyed}


def test_row_keys_near_a_column_leave_the_rows_where_they_lie(many_partitions):
    """surrogate_keys: rows that lie by a column are numbered there, dense and the same on every run; counts alone are dealt out."""
    df = many_partitions.range(3000).selectExpr("CASE WHEN id < 900 THEN 'hot' ELSE concat('k', id % 700) END AS a", "id % 500 AS b")
    keyed = with_row_key(df.repartition("a"), "sk", buckets=8, near="a")
    first = rows(keyed, "sk")
    again = rows(with_row_key(df.repartition(11, "b"), "sk", buckets=8, near="a"), "sk")
    assert first == again and [r["sk"] for r in first] == list(range(1, 3001))
    assert [(r["a"], r["b"]) for r in first if r["a"] == "hot"] == [("hot", b) for b in sorted(n % 500 for n in range(900))]
    lines = keyed._jdf.queryExecution().executedPlan().toString().splitlines()
    window = next(n for n, line in enumerate(lines) if "Window [row_number()" in line)
    below = next(line for line in lines[window:] if "Exchange" in line)
    assert "hashpartitioning(a#" in below and "REPARTITION_BY_NUM" not in below  # no exchange of rows by bucket
    assert with_row_key(df.limit(0), "sk", near="a").count() == 0


def test_bucket_numbers_do_not_travel(star):
    """dq_info: rows that were dealt out by the bucket of their key carried its number with them."""
    plan = star_info(star)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_bucket#" not in plan and "hashpartitioning(coalesce(pmod(xxhash64(order_id#" in plan
    keys = star.dim_sellers._jdf.queryExecution().executedPlan().toString().split("Window [row_number()")[1]
    assert sum("Exchange" in line and "xxhash64(seller_id#" in line for line in keys.split("BroadcastExchange")[0].splitlines()) == 1


def test_orders_looked_up_by_the_facts_have_the_keys_of_the_dimension(many_partitions, raw):
    """Orders that come twice, without an id or with blank fields: the same row is kept, under the same number."""
    data = [("a", "x", ""), ("a", "x", "2018-01-02 00:00:00"), ("b", None, "2018-01-03 00:00:00"), ("b", "", None), (None, "y", ""), ("", "y", "")]
    odd = many_partitions.createDataFrame([(f"{k}{n}" if k else k, s, t) for n in range(50) for k, s, t in data], "order_id string, order_status string, t string")
    orders = odd.withColumnRenamed("t", ORDER_TIMESTAMPS[0])
    for c in raw["orders"].columns:
        orders = orders if c in orders.columns else orders.selectExpr("*", f"CAST(NULL AS STRING) AS {c}")
    staging = {"orders": orders.select(*raw["orders"].columns).unionByName(raw["orders"])}
    whole = {tuple(r) for r in dim_orders(staging).select("order_sk", "order_id", ORDER_TIMESTAMPS[0]).collect() if r[1] is not None}
    found = dated_orders(staging).collect()
    assert {tuple(r) for r in found if r[1] is not None} == whole and len(found) == len(whole) + 1
