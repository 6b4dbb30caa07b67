"""Operators for preparing training data at scale.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which belongs to
it) imports it; the rest of the library works without it.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


WORKER_MEMORY = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}


def let_workers_import(spark: SparkSession) -> None:
    """Have Python workers look for this package where the driver found it (a
    shared or equal path; a package deployed with the job is found anyway)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    # workers live as long as the application: have them give large blocks back to
    # the system when a task is done with them, not keep the most any task has used
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
