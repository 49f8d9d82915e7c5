"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Timings are wall-clock seconds, best of ``$BENCH_REPEAT`` (default 2) runs, each run fully
executing the plan (``noop`` sink: every row produced, nothing collected).  The first four
entries are the reference's own measurements on points derived from ``lineitem``: time to
compute standard centres, fair centres, and the fair objective with each set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fairsketch.operators import cluster, fair, objective  # noqa: E402
from fairsketch.plans import queries as Q  # noqa: E402
from fairsketch.session import local_session  # noqa: E402
from fairsketch.sources import tables  # noqa: E402
from fairsketch.sources.points import prepare  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))

# K-means parameters of the reference-style timings.
BENCH_K = 8
BENCH_M = 10
BENCH_SEED = 16

HEADLINE = [
    "standard_objective", "standard_objective_distinct", "fair_objective", "cluster_group_counts",
    "fair_step", "lloyd_fixed_start", "fair_kmeans_fixed_start", "nearest_center_emb",
    "item_frequencies", "cm_cells", "cs_cells", "cm_estimate", "cs_estimate", "heavy_hitter_detail",
    "sketch_accuracy", "cm_merge", "stream_prefix", "stream_report",
    "stream_report_t", "fair_vs_standard", "order_frequencies", "heavy_hitters_orders",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(fn) -> float:
    times = []
    for _ in range(REPEAT):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return round(min(times), 3)


def main() -> None:
    spark = local_session(CPUS, CPUS, app="fairsketch-bench")
    tables.table(spark, SF_DIR, "lineitem").count()  # JVM and file-system warm-up
    timings: dict[str, float] = {}

    # parsed once and cached, like the reference's repartition(L).cache() before its timers
    prep = prepare(tables.pts3(spark, SF_DIR), 3)
    pts = prep.points
    pts.count()
    state: dict = {}

    def standard():
        state["stand"] = cluster.kmeans(pts, BENCH_K, BENCH_M, BENCH_SEED)

    def fair_centres():
        state["fair"] = fair.fair_kmeans(pts, BENCH_K, BENCH_M, BENCH_SEED, persist=False)

    timings["standard_centers"] = best(standard)
    timings["fair_centers"] = best(fair_centres)
    timings["phi_standard"] = best(lambda: objective.fair_objective(pts, state["stand"]).collect())
    timings["phi_fair"] = best(lambda: objective.fair_objective(pts, state["fair"]).collect())
    prep.release()

    for name in HEADLINE:
        def one(name=name):
            run(Q.QUERIES[name](spark, SF_DIR))
        timings[name] = best(one)

    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "total_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else SF_DIR,
                      "cpus": CPUS, "repeat": REPEAT}))


if __name__ == "__main__":
    main()
