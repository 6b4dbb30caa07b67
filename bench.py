"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 4) into the ``noop`` sink (the whole plan
runs, nothing is kept) and prints one JSON line. Each query is run once to
warm up (``$BENCH_WARMUP`` rounds over all queries, default 2), then
``$BENCH_RUNS`` times in a row (default 5); the median per query is reported.
``value`` is the flagship (``global_metrics``, every day) median, the
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paymart.plans.queries import QUERIES  # noqa: E402
from paymart.session import build_session  # noqa: E402

HEADLINE = [
    "global_metrics",
    "global_metrics_day",
    "rate_join",
    "envelope_decode",
    "landing_insert_ignore",
    "currency_payload",
    "transactions_conform",
    "transactions_upsert",
    "global_metrics_upsert",
    "load_counters",
    "run_day",
    "run_days",
    "landing_stream",
]


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    warmup = int(os.environ.get("BENCH_WARMUP", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="paymart-bench")
    samples: dict[str, list[float]] = {n: [] for n in names}

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # untimed rounds warm the JVM (class loading, JIT) for every query (the
    # times keep falling over the first runs); then each query is timed in its
    # own block of runs, so a heavy query's garbage does not land in the next
    # query's numbers
    for _ in range(warmup):
        for name in names:
            run(name)
    for name in names:
        samples[name] = [run(name) for _ in range(runs)]
    times = {n: round(statistics.median(v), 4) for n, v in samples.items()}
    spark.stop()
    print(json.dumps({
        "metric": "global_metrics_median_sec",
        "value": times.get("global_metrics", sum(times.values())),
        "unit": "sec",
        "queries": times,
        "total_sec": round(sum(times.values()), 4),
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "runs": runs,
        "warmup_rounds": warmup,
    }))


if __name__ == "__main__":
    main()
