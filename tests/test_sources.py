"""Reading, staging, sinks."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from conftest import FIXTURES, rows
from pyspark.sql import functions as F

from tianguis.functions.display import minute_text, money_text
from tianguis.plans import monthly, reporting, segments
from tianguis.plans.publish import rebuild
from tianguis.plans.quality import staging_counts
from tianguis.plans.star import build_star, plan_star
from tianguis.schemas import RAW_COLUMNS, STAR_COLUMNS, text_schema
from tianguis.session import use_checkpoint_folder
from tianguis.sources.raw import manifest, read_raw, read_staging, typed, write_staging
from tianguis.sources.warehouse import (
    read_segments,
    publish_tables,
    read_snapshots,
    register_views,
    star_tables,
    upsert_snapshots,
)


def test_every_raw_column_is_text(raw):
    assert set(raw) == set(RAW_COLUMNS)
    for table, df in raw.items():
        assert df.dtypes == [(c, "string") for c in RAW_COLUMNS[table]]


def test_line_breaks_and_quotes_inside_a_field(raw):
    first = rows(raw["order_reviews"], "review_id")[0]
    assert first["review_comment_title"] == "great, really"
    assert first["review_comment_message"] == 'first line\nsecond "quoted" line'


def test_files_can_be_named(spark):
    only = read_raw(spark, FIXTURES, ["sellers"], {"sellers": "sellers.csv"})
    assert list(only) == ["sellers"] and only["sellers"].count() == 3


def test_typed_projection(frames):
    order = rows(frames.orders, "order_id")[4]
    assert order["order_purchase_timestamp"] is None
    assert order["order_delivered_customer_date"] == dt.datetime(2018, 4, 20)
    assert rows(frames.products, "product_id")[1]["product_weight_g"] == Decimal("250.51")
    assert rows(frames.reviews, "review_id")[2]["review_score"] is None


@pytest.mark.parametrize("column, value", [("price", ""), ("freight_value", "x"), ("order_item_id", "x"), ("order_item_id", "")])
def test_bad_numbers_are_errors(spark, column, value):
    good = {"order_id": "o", "order_item_id": "1", "product_id": "p", "seller_id": "s", "shipping_limit_date": "",
            "price": "1", "freight_value": "1"}
    bad = spark.createDataFrame([tuple({**good, column: value}.values())], text_schema("order_items"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed(bad).collect()


def test_staging_is_replaced(spark, raw, tmp_path):
    write_staging({"sellers": raw["sellers"]}, str(tmp_path))
    write_staging({"sellers": raw["sellers"].limit(1)}, str(tmp_path))
    assert read_staging(spark, str(tmp_path), ["sellers"])["sellers"].count() == 1


def test_manifest_compares_counts(raw):
    found = rows(manifest(staging_counts(raw), {"sellers": 3, "orders": 9, "absent": 1}), "tabla")
    assert [(r["tabla"], r["filas"], r["estado"]) for r in found] == [
        ("staging.absent", 0, "FAIL"),
        ("staging.orders", 8, "FAIL"),
        ("staging.sellers", 3, "PASS"),
    ]


def test_star_round_trip_and_views_by_name(spark, raw, star, tmp_path):
    stored = build_star(spark, raw, str(tmp_path))
    for name, df in star_tables(stored).items():
        declared = [c.strip().split(" ")[0] for c in STAR_COLUMNS[name].split(", ")]
        assert [c for c in df.columns if c != "purchase_month"] == declared
        assert df.count() == getattr(star, name).count()
    register_views(reporting.reporting_views(stored))
    best = spark.sql("SELECT categoria FROM vw_top_categorias_pareto WHERE ranking = 1").first()[0]
    assert best == "health_beauty"
    months = {r[0] for r in stored.fact_order_items.select("purchase_month").distinct().collect()}
    assert months == {201801, 201803, 201804}


def test_tables_are_selectable_by_qualified_name(spark, raw, tmp_path):
    build_star(spark, raw, str(tmp_path))
    publish_tables(spark, "dwh", str(tmp_path), list(STAR_COLUMNS))
    assert spark.sql("SELECT count(*) FROM dwh.fact_order_items WHERE date_sk >= 20180401").first()[0] == 2
    assert spark.sql("SELECT max(full_date) FROM dwh.dim_date").first()[0] == dt.date(2018, 4, 30)
    spark.sql("DROP DATABASE dwh CASCADE")


def test_text_for_readers(spark):
    row = spark.sql("SELECT CAST(1234.5 AS DECIMAL(15,2)) v, TIMESTAMP '2018-08-31 23:59:58' t").select(
        money_text(F.col("v")), money_text(F.col("v"), "R$ ", 0), minute_text(F.col("t"))
    ).first()
    assert tuple(row) == ("$1,234.50", "R$ 1,234", "2018-08-31 23:59")


def test_large_files_are_split_by_default(spark, tmp_path):
    line = "o,1,p,s,2018-01-01 00:00:00,1.0,2.0\n"
    (tmp_path / "order_items.csv").write_text(",".join(RAW_COLUMNS["order_items"]) + "\n" + line * 40_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    items = read_raw(spark, str(tmp_path), ["order_items"])["order_items"]
    assert items.rdd.getNumPartitions() > 3 and items.count() == 40_000
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("multi_line", [(), ("sellers",)])
@pytest.mark.parametrize("fault", ["extra", "missing", "swapped"])
@pytest.mark.parametrize("ask", ["all", "one", "count"])
def test_malformed_files_are_refused(spark, tmp_path, multi_line, fault, ask):
    header = list(RAW_COLUMNS["sellers"])
    row = ["s", "01000", "x", "SP"]
    if fault == "swapped":
        header[0], header[1] = header[1], header[0]
    bad = {"extra": [*row, "more"], "missing": row[:-1], "swapped": row}[fault]
    (tmp_path / "sellers.csv").write_text("\n".join(map(",".join, [header, row, bad])) + "\n")
    frame = read_raw(spark, str(tmp_path), ["sellers"], multi_line=multi_line)["sellers"]
    run = {"all": frame.collect, "one": frame.select("seller_state").collect, "count": frame.count}[ask]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|header|FAILED_READ_FILE"):
        run()


def test_one_month_opens_three_partitions(spark, raw, star, tmp_path):
    stored = build_star(spark, raw, str(tmp_path))
    report = monthly.monthly_report(stored, 2018, 4)
    text = report._jdf.queryExecution().executedPlan().toString()
    scans = [part.split("ReadSchema")[0] for part in text.split("FileScan parquet")[1:]]
    scans = [part for part in scans if "purchase_month" in part]
    assert len(scans) >= 3
    for scan in scans:
        months = re.search(r"PartitionFilters: \[(.*?)\]", scan)[1]
        assert "purchase_month" in months
        assert set(re.findall(r"20\d{4}", months)) <= {"201704", "201803", "201804"}
    assert report.collect() == monthly.monthly_report(star, 2018, 4).collect()


def test_views_are_current_after_a_rebuild(spark, raw, tmp_path):
    total = lambda: spark.sql("SELECT sum(revenue) FROM vw_revenue_mensual").first()[0]
    rebuild(spark, raw, str(tmp_path))
    first = total()
    fewer = {**raw, "order_items": raw["order_items"].where("order_item_id = '1'")}
    rebuild(spark, fewer, str(tmp_path))
    assert total() < first
    rebuild(spark, raw, str(tmp_path))
    assert total() == first


def test_snapshots_are_upserted_by_period(spark, star, tmp_path):
    folder = str(tmp_path / "snapshots")
    assert monthly.refresh_snapshots(star, folder, (2018, 1), (2018, 4)) == 3
    first = rows(read_snapshots(spark, folder), "periodo")
    monthly.refresh_snapshots(star, folder, (2018, 1), (2018, 4))
    again = rows(read_snapshots(spark, folder), "periodo")
    assert [r["periodo"] for r in again] == ["2018-01", "2018-02", "2018-03", "2018-04"]
    for a, b in zip(first, again):
        assert {k: v for k, v in a.items() if k != "fecha_generacion"} == {k: v for k, v in b.items() if k != "fecha_generacion"}

    report = monthly.generate_monthly_report(star, folder, 2018, 4)
    assert report.collect() == monthly.monthly_report(star, 2018, 4).collect()
    assert read_snapshots(spark, folder).count() == 4

    changed = spark.createDataFrame([("2018-02", None, None)], "periodo string, ingresos_totales decimal(15,2), total_ordenes long")
    for column in ("ticket_promedio", "score_satisfaccion", *[f"top_{k}_{i}" for k in ("categoria", "vendedor") for i in (1, 2, 3)]):
        changed = changed.selectExpr("*", f"CAST(NULL AS STRING) AS {column}")
    upsert_snapshots(changed, folder)
    after = rows(read_snapshots(spark, folder), "periodo")
    assert len(after) == 4 and after[1]["ingresos_totales"] == 0 and after[1]["total_ordenes"] == 0
    assert [after[i]["ingresos_totales"] for i in (0, 2, 3)] == [again[i]["ingresos_totales"] for i in (0, 2, 3)]


def test_segments_are_rewritten(spark, star, tmp_path):
    folder = str(tmp_path / "segments")
    segments.refresh_segments(star, folder)
    summary = segments.refresh_segments(star, folder)
    assert read_segments(spark, folder).count() == 2
    assert summary.columns[0] == "segmento"


def test_segmenting_nothing_is_an_error(spark, raw, tmp_path):
    empty = plan_star({**raw, "order_items": raw["order_items"].limit(0)})
    with pytest.raises(segments.NoActiveSellers):
        segments.refresh_segments(empty, str(tmp_path / "none"))


def test_checkpoint_folder_is_stable(spark):
    assert use_checkpoint_folder(spark) == use_checkpoint_folder(spark)
