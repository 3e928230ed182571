"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every query is run to
the end (all columns of all rows) twice, and the better time counts. `lookups` is the one-time work
all queries of a session share: the definition tables, the taxonomy and the lookup tables.
"""

from __future__ import annotations

import json
import os
import time

from modelweave.plans.queries import registered
from modelweave.plans.workspace import workspace
from modelweave.session import local_session

HEADLINE = (
    "links_per_association", "ordered_links", "unordered_links", "ordered_atomic_values", "unordered_atomic_values",
    "unordered_literal_values", "typed_values", "rebuild_slots", "model_elements", "taxonomy", "effective_attributes",
    "containment_forward", "reference_reverse", "assoc_generalizations", "applied_stereotypes", "export_profile",
    "export_metamodel", "export_model", "unresolved_references", "errors_by_element", "classify_changes",
    "classify_changes_stream", "missing_dependencies",
)
RUNS = 2


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "16g", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def run(name):
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    def lookups():
        w = workspace(spark, folder)
        w.graph.element, w.graph.slot, w.model_input, w.business.changes
        w.all.associations, w.all.effective, w.all.attribute_lookups

    seconds = {"lookups": timed(lookups)}
    for name in HEADLINE:
        seconds[name] = min(timed(lambda: run(name)) for _ in range(RUNS))
    total = sum(seconds.values())
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()}, "sf": os.path.basename(folder.rstrip("/"))[2:],
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
