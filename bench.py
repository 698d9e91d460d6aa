"""Wall time of the headline queries. Prints one JSON line.

BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)
BENCH_RUNS     timed runs per query, the median counts (default 3)

Every run materialises the whole result through the no-op sink.
"""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlens.plans import catalog
from marketlens.session import build_session

HEADLINE = [
    "clean_customers",
    "clean_orders",
    "clean_items",
    "dedup_report_counts",
    "dq_pk_dups",
    "dq_fk_items",
    "mart_daily_category",
    "mart_weekly_city",
    "mart_product_performance",
    "mart_delivery_analysis",
    "kpi_overall",
    "kpi_top_n_categories",
    "kpi_late_vs_promised",
    "cohort_sizes_retention",
    "retention_m0_m1",
    "repeat_customers",
    "rfm_segments",
    "sla_city",
    "sla_category",
    "sla_median_city",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = catalog.queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "marketlens-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("mart_daily_category")
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
