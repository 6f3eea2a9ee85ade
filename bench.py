"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores;
BENCH_QUERIES, a comma list, chooses other queries ("all" for every registered one).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barledger.plans.queries import REGISTRY  # noqa: E402
from barledger.session import build_session  # noqa: E402

HEADLINE = (
    "price_change", "summary_report", "moving_average_50", "moving_average_200", "moving_average_200_trades",
    "topk_per_group", "top_deal_quantity", "audit_partition", "rejection_counts", "frame_admission",
    "admitted_prices", "validate_table", "price_coverage", "deals_ledger", "deal_day_gaps", "chart_decode",
    "reconcile_cells", "reconcile_counts", "fundamentals_gate", "html_actions", "content_hash",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "barledger-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().write.format("noop").mode(
        "overwrite"
    ).save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "lineitem_rows": rows, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
