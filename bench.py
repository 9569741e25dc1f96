"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose data and
cores. Each query runs BENCH_RUNS times after one warm-up of the session and the
smallest time counts. A run writes its whole result to Spark's noop sink, so no row is
left out and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from spindrift.queries import load
from spindrift.session import local_session

HEADLINE = (
    "a01_group_having", "a03_count_distinct", "a05_exact_quantiles", "a13_mergeable_stats",
    "jn01_inner", "jn07_star_join", "jn09_self_range_join", "jn13_strategy_matrix", "jn14_preaggregated_join",
    "jn15_salted_join", "jn16_hot_key_join",
    "w01_rank_family", "w03_lag_lead", "w06_trailing_hour_count", "w07_trailing_month_stats", "w10_top_k_per_group",
    "u04_keep_latest", "m01_merge", "m05_scd_type2", "m06_cdc_type2", "m08_change_feed", "m10_apply_feed", "m16_golden_record",
    "c02_rule_suite", "c03_dead_letters", "c09_reconcile", "g04_secure_view",
    "o03_amount_anomaly", "o05_impossible_travel", "o07_components", "o08_composite_risk",
    "o11_daily_sales", "o11_category_margin", "o12_lifetime_value", "o19_monthly_trend", "o22_document_chunks", "o23_vector_top_k",
    "q05_python_udf", "q06_pandas_udf", "q08_three_way_equality",
    "src24_format_comparison", "st03_tumbling_windows", "st09_idempotent_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, app="bench")
    queries, _ = load()
    queries["o11_daily_sales"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
