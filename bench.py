"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8). Each query is executed in full into the
``noop`` sink (every row computed, nothing collected): one cold run, then
``$BENCH_REPEAT`` (default 2) warm runs; the reported time is the median of
the warm runs. The cold run of every query comes first (one pass over the
whole set), then the warm passes. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "card_features",
    "card_features_volume",
    "txn_enriched",
    "merchants_dim",
    "mcc_mix_topk",
    "card_b2b_index",
    "card_amount_q95",
    "card_household_mcc",
    "card_extended",
    "encode_train_apply",
    "class_profile",
    "split_stratified",
    "standardize_features",
    "roc_auc",
    "classification_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from cardlens.plans.queries import QUERIES
    from cardlens.session import get_session

    spark = get_session(
        f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
        app_name="cardlens-bench",
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    names = only or HEADLINE

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        spark.catalog.clearCache()
        return secs

    # pass 1 over every query is the cold run; the warm runs come after the
    # whole set has run once, so no query's warm time carries JVM warm-up
    cold = {name: round(run(name), 3) for name in names}
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(repeat):
        for name in names:
            runs[name].append(run(name))
    times = {
        name: round(statistics.median(runs[name]), 3) if repeat else cold[name] for name in names
    }
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "cold": cold,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
