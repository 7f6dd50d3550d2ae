"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line.

Every query runs once to warm up and is then timed; the value is the sum of the
medians. Results are counted in Spark with a no-op write, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fundmart.session import new_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "split_records",
    "document_lines",
    "decode_dates_raw",
    "decode_bool_int_float",
    "normalise_status",
    "pseudonymise",
    "unknown_codes",
    "trailer_counts",
    "grain_duplicates",
    "orphan_links",
    "contract_report",
    "delivery_checks",
    "newest_first_merge",
    "newest_per_group",
    "row_number_keys",
    "order_check",
    "status_bridge",
    "status_dimension",
    "fact_base",
    "funnel",
    "reasons",
    "fact_reasons",
    "share_per_group",
    "transitions",
    "history",
    "coverage",
    "raw_lines_to_share",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = new_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
