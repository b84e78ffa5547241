"""Wall time of the headline queries; prints one JSON line.

The star schema is built once from text staging and timed as ``star_build``. Reports, snapshots,
segments and checks then read the stored tables, as they do in production; exploration reads the
typed source frames. Every query runs twice and the second run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tianguis.plans import explore_catalog as catalog
from tianguis.plans import explore_orders as orders
from tianguis.plans import explore_service as service
from tianguis.plans import monthly, quality, reporting, segments
from tianguis.plans.star import build_star
from tianguis.session import build_session
from tianguis.sources.standin import LENGTHS, StandIn

ON_STAR = {
    "monthly_revenue": reporting.monthly_revenue,
    "category_pareto": reporting.category_pareto,
    "seller_ranking": reporting.seller_ranking,
    "delivery_by_state": reporting.delivery_by_state,
    "category_satisfaction": reporting.category_satisfaction,
    "monthly_report_one": lambda star: monthly.monthly_report(star, 2001, 4),
    "monthly_report_batch": lambda star: monthly.monthly_snapshots(star),
    "seller_segments": segments.segment_sellers,
    "segment_summary": lambda star: segments.segment_summary(segments.segment_sellers(star)),
    "dq_info": quality.star_info,
    "dq_checks": quality.star_checks,
    "fk_coverage": quality.fk_coverage,
    "sk_integrity": quality.sk_integrity,
}
ON_FRAMES = {
    "orders_enriched": orders.orders_enriched,
    "eda_monthly": lambda f: orders.orders_by_month(orders.orders_enriched(f)),
    "order_value_stats": orders.order_value_stats,
    "orders_by_state": lambda f: orders.orders_by_state(orders.orders_enriched(f)),
    "eda_category_stats": catalog.category_stats,
    "eda_seller_stats": catalog.seller_stats,
    "lorenz_curve": catalog.lorenz_curve,
    "delivery_histogram_clipped": service.delivery_histogram_clipped,
    "score_by_delivery_bucket": service.score_by_delivery_bucket,
    "dashboard_kpis": lambda f: service.dashboard_kpis(f, orders.filter_orders(orders.orders_enriched(f))),
    "executive_summary": service.executive_summary,
}


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    frames = StandIn(spark, folder)

    stars = []
    for _ in range(2):
        target = tempfile.mkdtemp(prefix="bench-star-")
        seconds = {"star_build": timed(lambda: stars.append(build_star(spark, frames.staging, target, LENGTHS)))}
    cases = [(name, plan, stars[-1]) for name, plan in ON_STAR.items()]
    cases += [(name, plan, frames) for name, plan in ON_FRAMES.items()]
    for name, plan, source in cases:
        for _ in range(2):
            seconds[name] = timed(lambda: plan(source).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries, second run in one session",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
