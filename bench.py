"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Every query is planned from
the raw tables and run to the end on its own; the best of two timed runs counts, after one
warm-up run of the flagship query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse import build_session
from workload.queries import QUERIES

HEADLINE = [
    "latest_transaction_live",
    "dim_account",
    "dim_budget_category_scd2",
    "or_key_join",
    "fact_accounting_transaction",
    "fact_vendor_transaction",
    "fact_bank_statement",
    "fact_trip_leg",
    "mart_dashboard",
    "mart_cash_flow",
    "mart_uncleared",
    "mart_ledger_sink",
    "metric_net_worth",
    "metric_income",
    "metric_saving_rate",
    "metric_activity_ma30",
    "metric_expenses",
    "metric_cash_flow_top",
    "uncleared_rows",
    "surrogate_keys",
    "journey_legs",
    "report_sections",
    "lake_roundtrip_dedupe",
    "dq_reconcile",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "metric_net_worth", sf_dir)
    seconds = {name: round(min(run(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
