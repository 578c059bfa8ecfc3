"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs
per query, the median counts).  One untimed round over all queries comes first.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from salesmart import session
from salesmart.plans import bindings, queries
from salesmart.sources.tables import Tables

HEADLINE = [
    "a02_category_margin", "a01_quarter_stats", "a03_sales_by_category", "a08_rollup_time", "a11_cube_cat_channel",
    "a15_pivot_margins", "a17_summary", "w01_dedupe_first", "w02_top3_per_month", "w07_yoy_month",
    "k19_kpi_table", "k20_app_panel", "q10_error_log", "q08_reconcile", "q21_intake_orders", "d09_clean_feed",
    "m08_top_rated", "b02_bench_x1", "b02_bench_x10", "b02_bench_x50", "b03_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.build("bench", cpus)
    build = queries()

    def once(fn) -> float:
        start = time.perf_counter()
        fn()
        return time.perf_counter() - start

    def drain(name: str):
        return lambda: build[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    jobs = {name: drain(name) for name in HEADLINE}
    jobs["etl_star"] = lambda: bindings.build_star(Tables(spark, sf_dir))
    for job in jobs.values():
        job()
    times = {name: round(statistics.median(once(job) for _ in range(runs)), 3) for name, job in jobs.items()}
    session.clear_staging(spark)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
