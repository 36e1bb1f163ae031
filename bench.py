"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidewater import registry
from tidewater.session import get_session

HEADLINE = (
    "q06_durations_in_minutes", "q08_top_ten_by_dense_rank", "q10_percent_of_first_line", "q13_top_categories_by_orders", "q18_two_years_by_month_and_category",
    "q19_busiest_places", "q22_order_card_first_max", "q24_abc_classes", "q25_weighted_average_by_lags", "q27_open_and_finished_counts",
    "q28_hours_with_running_totals", "jn09_interval_counts", "wn14_global_running_sum", "wn16_fill_forward", "ag19_quantiles", "ag23_describe_numeric",
    "dq08_fill_group_mean", "q30_fair_price_by_year", "q31_cleaning_mixed", "q32_price_profile", "ml11_correlation_matrix", "ml13_association_matrix",
    "ml15_knn_classify", "ml24_pca_curve", "ml26_gradient_descent_path", "ds04_box_numbers_by_group", "hx02_links", "ss01_hourly_stream_with_running_totals",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    jobs = registry.queries()
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # starts the executors
    took = {}
    for name in names:
        start = time.time()
        # The no-op sink runs the whole plan without moving rows to the driver.
        jobs[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
