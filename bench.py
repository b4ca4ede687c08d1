"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is written to the no-op sink, so all of its rows and columns are
computed. Seconds are the median of three runs after one warm-up and include
the writing of staged intermediates.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import QUERIES
from checks.session import local_session

HEADLINE = (
    "retail_category_share",
    "deal_report",
    "transfer_suggestions",
    "transfer_suggestions_tql",
    "export_report",
    "purchase_lines",
    "sales_lines",
    "expected_arrivals",
    "stock_position",
    "supplier_list",
    "monthly_sales_trend",
    "new_items",
)


def run(spark, directory: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(spark, directory, name)
        seconds[name] = round(
            statistics.median(run(spark, directory, name) for _ in range(3)), 3
        )
    print(
        json.dumps(
            {
                "metric": "stock_reports_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
