"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced end to end with the ``noop`` sink (full computation, no
collection to the driver) and timed wall-clock.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "popularity_eval", "k_core", "sequences_padded", "user_features_full", "item_features", "pit_join",
    "materialize_latest", "psi_skew", "vector_topk", "topk_exclude_seen", "candidate_set", "ranking_matrix",
    "negatives_uniform", "negatives_popularity", "ab_report", "bandit_posterior", "latency_sla",
    "latency_histogram_quantile", "alert_islands", "title_suggest", "stream_bandit", "stream_sessions",
]


def main():
    from kestrel.session import get_spark
    from kestrel.catalog import QUERIES
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
