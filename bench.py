"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of cores.  Each query runs once
to warm up and then BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import QUERIES  # noqa: E402
from checks.compare import session  # noqa: E402

HEADLINE = [
    "error_matrix",
    "error_classes",
    "error_type_totals",
    "cell_accuracy",
    "apply_cell_updates",
    "repair_report",
    "pack_dataset",
    "export_values",
    "dataset_variant_named",
    "extract_records",
    "stats_by_file",
    "nested_objects",
    "query_normalise",
    "geocode_join",
    "validate_triples",
    "legacy_clean",
    "align_validated",
    "nearest_candidate",
    "warc_scan",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session(cpus, cpus)
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name} first {taken[0]:.2f} then {times[name]:.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
