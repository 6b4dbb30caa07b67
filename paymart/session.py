"""Spark session settings and the shared work folder.

The jobs rely on a few session settings for correct results (UTC session
zone, dynamic partition overwrite) and on AQE for runtime re-planning.
Everything else is left to whoever submits the job.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators depend on. Applied by ``configure`` to any session.
REQUIRED_CONF = {
    # The day of a message depends on the zone; pin it.
    "spark.sql.session.timeZone": "UTC",
    # every writer replaces only the day partitions it produces
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Defaults that are only applied when the session has no value of its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "paymart") -> SparkSession:
    """Session for tests, benchmarks and local runs (UI off, small shuffles)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("PAYMART_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the job and points at shared
    storage; unset, that is an error. Only a local session, where driver and
    executors are one process, gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="paymart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/paymart/{name}-{uuid.uuid4().hex[:12]}"


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: whatever uses it
    several times sees one snapshot, and its plan ends here."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder or file in whatever file system it lies."""
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no folder."""
    fs, folder = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def write_file_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is there wholly or not at all; False if there is one
    of that name already."""
    fs, target = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    # a rename onto a name that is taken fails or returns false
    done = not fs.exists(target) and fs.rename(aside, target)
    if not done:
        fs.delete(aside, False)
    return done
