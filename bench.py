"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores of the local session (default all)
    BENCH_QUERIES  comma-separated names, or "all"
"""

import json
import os
import time

from tillgrain.plans.catalog import QUERIES
from tillgrain.session import build_session

HEADLINE = (
    "dq_rule_report",
    "dedup_transactions",
    "silver_clean",
    "silver_flow",
    "incident_report",
    "category_sales",
    "customer_features",
    "top_categories",
    "total_revenue",
    "churn_summary",
    "features_encoded",
    "train_test_split",
    "roc_auc",
    "explain_zscore",
    "explain_profile",
    "lookup_customers",
    "answer_questions",
    "run_kpis",
    "bronze_ingest",
    "full_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE if not chosen else tuple(QUERIES) if chosen == "all" else chosen.split(",")
    spark = build_session(
        "tillgrain-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        # The noop sink computes every row and column and keeps nothing.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
