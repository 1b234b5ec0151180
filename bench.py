"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
Every query is executed to completion with the ``noop`` sink (the full plan
runs, nothing is collected); each is run once to warm up the JVM and code
paths, then timed twice and the faster run is reported (single runs on a
shared machine vary by 20-30 %).  Cached tables are dropped before each timed
run, so that no run lives on what another one left.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import caprank.plans.lifecycle  # noqa: E402, F401
from caprank.plans.registered import QUERIES  # noqa: E402
from caprank.session import build_session  # noqa: E402

HEADLINE = [
    "rule_ranked_list",
    "topk_metrics",
    "avg_precision",
    "slice_table",
    "stratified_split",
    "kfold_sizes",
    "bootstrap_ci",
    "gate_decision",
    "validation_report",
    "duplicate_rows",
    "duplicate_full_rows",
    "row_ids",
    "cutoff_inspection",
    "group_stats",
    "leakage_scan",
    "ks_drift",
    "psi_drift",
    "model_bundle",
    "ladder_metrics",
    "gbt_ranked_reasons",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", app_name="caprank-bench",
                          shuffle_partitions=int(cpus), extra_conf={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    names = sys.argv[1:] or HEADLINE
    for name in names:
        run = QUERIES[name]
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        best = float("inf")
        for _ in range(2):
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
