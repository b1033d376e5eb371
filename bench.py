"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.  Each query is forced end to end with the ``noop``
sink (full computation, nothing collected to the driver)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caseload.plans import catalog  # noqa: E402
from caseload.session import get_session  # noqa: E402

HEADLINE = [
    "parse_encounters",
    "visit_counts",
    "visits_and_patients",
    "enriched_visits",
    "enriched_visits_and_patients",
    "result_documents",
    "merge_visit_counts",
    "fuzzy_name",
    "fuzzy_name_transposed",
    "search_with_diagnosis",
    "search_without_diagnosis",
    "batch_search",
    "indexed_search",
    "turned_search",
    "stream_visit_counts",
    "stream_patient_counts",
    "compacted_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    # local mode: executors run inside the driver JVM, whose heap is the only memory
    spark = get_session(f"local[{cpus}]", cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: JVM code paths and Python workers
    catalog.QUERIES["visit_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
