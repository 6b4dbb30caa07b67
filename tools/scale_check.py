"""Time the range pipeline (run_days) on the given tables and on larger
inputs that Spark derives from them: the events copied K times with shifted
event and user ids, written below spark.checkpoint.dir. Prints one line per
size with the time of each stage (the faster of two runs).

    python tools/scale_check.py [sf_dir] [K ...]      # default sf0.1, K = 10 50
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from paymart.plans import jobs  # noqa: E402
from paymart.session import build_session, work_dir  # noqa: E402
from paymart.sources import adapters as A  # noqa: E402


def derive(spark, sf_dir: str, k: int) -> str:
    out = work_dir(spark, f"events-x{k}")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    span = ev.agg(F.max("event_id").alias("m"), F.max("user_id").alias("u")).first()
    step_e, step_u = int(span.m) + 1, int(span.u) + 1
    (ev.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("c"), "*")
       .select((F.col("event_id") + F.col("c") * step_e).alias("event_id"), "ts",
               (F.col("user_id") + F.col("c") * step_u).alias("user_id"), "event_type", "value", "props")
       .write.parquet(f"{out}/events.parquet"))
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.parquet(f"{out}/nation.parquet")
    return out


def time_run(spark, d: str) -> dict:
    best: dict | None = None
    for _ in range(2):
        lake = jobs.Lake(work_dir(spark, "scale"))
        rec, src = A.kafka_records(spark, d), A.src_transactions(spark, d)
        t = {}
        for name, f in [("land", lambda: jobs.land(spark, lake, rec)),
                        ("rates", lambda: jobs.stage_currencies(spark, lake, None)),
                        ("transactions", lambda: jobs.stage_transactions(spark, lake, src, None)),
                        ("mart", lambda: jobs.build_global_metrics(spark, lake, None))]:
            t0 = time.perf_counter()
            f()
            t[name] = round(time.perf_counter() - t0, 1)
        t["total"] = round(sum(t.values()), 1)
        if best is None or t["total"] < best["total"]:
            best = t
    return best


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    ks = [int(a) for a in args if a.isdigit()] or [10, 50]
    spark = build_session("local[8]", 8)
    print("x1", time_run(spark, sf_dir), flush=True)
    for k in ks:
        print(f"x{k}", time_run(spark, derive(spark, sf_dir, k)), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
