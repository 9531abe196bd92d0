"""Time the load and the reports; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS (default 8) is the number of cores.
The load (``etl``) is timed once, cold. Every other query runs over the published star or the raw tables, all
its rows computed and thrown away; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starbazaar import catalog  # noqa: E402
from starbazaar.session import local_session  # noqa: E402

HEADLINE = [
    "monthly_revenue_and_avg_ticket", "top10_categories_by_revenue", "delivery_performance_by_state",
    "monthly_review_score_trend", "top10_sellers_by_revenue", "payment_method_distribution", "rfm_analysis",
    "repurchase_rate", "range_bounds", "range_headline_chosen", "range_monthly_chosen", "range_categories_chosen",
    "range_payments_chosen", "range_sellers_chosen", "ntile_scalable", "dominant_payment", "latest_review",
    "issue_summary", "null_profile", "orders_per_month", "top_states", "orphans",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "starbazaar-bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starbazaar-bench-")})
    spark.range(1).count()  # the session is up
    seconds: dict[str, float] = {}

    begin = time.perf_counter()
    catalog.star_of(spark, sf_dir)
    seconds["etl"] = time.perf_counter() - begin

    table = catalog.queries()
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            begin = time.perf_counter()
            table[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = min(runs)
    spark.stop()

    print(json.dumps({
        "metric": "load and reports, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()}, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
