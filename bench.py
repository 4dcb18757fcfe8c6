"""Wall time of the headline queries, one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is run once to
warm up and then ``BENCH_RUNS`` times; the median counts. All rows and columns are computed
and handed to a sink that drops them.
"""

import json
import os
import statistics
import time

from crewlens.session import session
from gate import QUERIES

HEADLINE = (
    "monthly_headcount",
    "headcount_by_country",
    "review_best",
    "review_metrics",
    "training_kpis",
    "quick_scores",
    "cold_impact",
    "absence_by_employee",
    "absence_group_mix",
    "finance_ratios",
    "training_perf_summary",
    "kpi_summary",
    "integrated_employee",
    "data_quality",
    "employee_indicators",
    "governance_summary",
    "training_bands_segment",
    "trend_by_group",
    "tenure_histogram",
    "correlation_pairs",
    "insight_facts",
    "forward_fill",
    "group_baseline",
    "group_mode",
    "latest_per_key",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "crewlens-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
