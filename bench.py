"""Time the headline queries at ``$BENCH_SF_DIR`` and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans.exports import build_exports, write_exports  # noqa: E402
from ledgerline.session import build_session  # noqa: E402
from ledgerline.workloads import QUERIES  # noqa: E402
from ledgerline.workloads.binding import Binding  # noqa: E402

HEADLINE = (
    "order_value_by_tag", "headline_kpis", "rolling_30_day_revenue", "year_over_year_monthly", "repeat_customers",
    "revenue_by_location", "location_table", "top_cuisine", "top_restaurants", "menu_price_by_cuisine",
    "location_profile", "correlation_matrix", "cost_histogram_clipped", "orders_per_day", "weekly_revenue",
    "sliced_headline", "parsed_integers", "parsed_numbers", "parsed_dates", "coercion_counts", "menu_first_listing",
    "quarantined_menu", "orphan_counts", "constraint_violations", "table_profile", "restaurant_columns",
    "described_orders", "orders_ranked_by_price", "load_report", "rfm_segments", "revenue_share_by_segment",
    "top_customers", "user_baskets", "top_order_rules", "churn_features", "purchase_gaps", "churn_threshold",
    "stratified_split", "auc_of_given_scores", "silhouette_by_k", "churn_model_quality", "seasonal_forecast",
    "holdout_errors_by_method",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["headline_kpis"].run(spark, folder).collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    if not only or "full_export" in only:
        # Segments with the whole sweep (7 sizes, 10 restarts each), rules, forecast and festivals.
        start = time.perf_counter()
        exports = build_exports(Binding(spark, folder).model())
        write_exports(exports, tempfile.mkdtemp(prefix="ledgerline-bench-"))
        times["full_export"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
