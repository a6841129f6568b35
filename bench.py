"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the ``noop`` sink (every row produced, nothing collected), after a warm-up that
touches no table and with the cache cleared, so no query profits from an earlier one's data.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "features",
    "inspection_history",
    "cfr_history",
    "load_inspections",
    "upsert_inspections",
    "constraint_violations",
    "inspection_cohort",
    "fei_overlap",
    "survival_intervals",
    "km_curve_by_group",
    "roc_auc",
    "average_precision",
    "letter_listing",
    "letter_pages",
    "letter_detail",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)

    from vigil.registry import queries
    from vigil.session import build_session

    spark = build_session(master=f"local[{cpus}]", app="vigil-bench", shuffle_partitions=max(8, cpus * 2))
    qs = queries()
    spark.range(1_000_000).selectExpr("sum(id % 7)").write.format("noop").mode("overwrite").save()  # the JVM's start-up
    timings = {}
    for name in only:
        spark.catalog.clearCache()  # every query is timed cold
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_time", "value": total, "unit": "sec", "queries": timings,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
