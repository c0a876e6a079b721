"""Time the build and the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.plans.warehouse import open_warehouse  # noqa: E402
from tallyhouse.registry.queries import registered  # noqa: E402
from tallyhouse.session import build_session, clear_work  # noqa: E402

BUILD = (
    "lines", "store_days", "item_catalog", "stg_orders", "dim_date", "dim_store", "dim_product",
    "dim_destination", "dim_employee", "dim_campaign", "manifest",
    "order_grain", "fact_sale_item", "fact_by_employee",
)

# Every family but the single store-day loads, whose many small folders measure the file system:
# reports, joins, facts, windows, studies, checks, feeds, cleansing, dimensions and incremental runs.
# BENCH_ONLY=all adds the rest; BENCH_ONLY=Q7,M1 picks some.
HEADLINE = "QMPTJDWSABCI"
STORE_DAYS = ("A9", "A10", "A11", "A12", "A14", "A15", "A16", "A24", "I2", "I5")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8)))
    times: dict[str, float] = {}

    warehouse = open_warehouse(spark, sf_dir)
    for name in BUILD:
        start = time.perf_counter()
        getattr(warehouse, name)
        times[f"build_{name}"] = round(time.perf_counter() - start, 3)

    only = os.environ.get("BENCH_ONLY", "")
    for name, query in registered().items():
        chosen = name in only.split(",") or name.split("_")[0] in only.split(",")
        usual = name[0] in HEADLINE and name.split("_")[0] not in STORE_DAYS
        if only != "all" and not (chosen if only else usual):
            continue
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "build the warehouse and run the reports",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "build_sec": round(sum(v for k, v in times.items() if k.startswith("build_")), 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    clear_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
