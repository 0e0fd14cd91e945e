"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of tables (default /root/testdata/sf0.1), BENCH_CPUS the
number of local cores (default 8).  Each query runs to its last row into a sink that
keeps nothing; planning and driver-side steps are part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tenura.catalog.queries import QUERIES  # noqa: E402
from tenura.session import local_session  # noqa: E402

HEADLINE = (
    "feature_usage_summary",
    "churn_summary",
    "mrr_monthly_reference",
    "mrr_monthly_calendar",
    "health_score_reference",
    "health_score_corrected",
    "health_affected_window",
    "subscription_lifecycle",
    "usage_dedup_keep_last",
    "usage_clean",
    "plan_revenue",
    "plan_moves",
    "trial_flags",
    "latest_version",
    "delete_insert",
    "backfill_union",
    "dq_results",
    "declarative_checks",
    "profile_columns",
    "account_fact_counts",
)


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus), memory="16g")
    QUERIES["feature_usage_one_month"](spark, data_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(data_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
