"""Landing as a Structured Streaming query.

A drain has two steps:

1. A stateless query appends the raw messages, with their partition and
   offset, to a folder of its own in the checkpoint's inbox. It keeps no state for
   ever and no key meets in one task.
2. The batch job ``plans.jobs.land`` takes the folders in the inbox: first message
   per key by (partition, offset), then those whose key the table's index lacks. So a
   replay from the earliest offset lands nothing twice, and nothing is lost: a drain
   that fails before step 2 is landed by the next, together with the messages it may
   have read again.

A landed drain's folder is removed, so the inbox holds what is not landed yet, and a
drain costs what it brings, not what was landed before.

There is no callback from the JVM to Python and no time limit, unless the
caller sets one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paymart.operators.changes import read_files
from paymart.session import configure, list_folder, remove_folder

# A message as a topic gives it, and in the inbox.
RECORD = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.BinaryType()),
])


def message_stream(spark: SparkSession, fmt: str, options: dict | None = None,
                   path: str | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """The message source. ``fmt='kafka'`` with ``subscribe`` and
    ``startingOffsets='earliest'`` in ``options`` on a cluster; ``fmt='parquet'``
    over a directory of ``RECORD`` files, or ``fmt='text'`` over lines of
    partition, offset and message separated by tabs. Connection data comes only
    from ``options`` and is never logged. ``max_per_trigger`` bounds a
    micro-batch (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``)."""
    reader = spark.readStream.format(fmt)
    if options:
        reader = reader.options(**options)
    if max_per_trigger:
        key = "maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"
        reader = reader.option(key, str(max_per_trigger))
    if fmt == "parquet":
        reader = reader.schema(RECORD)
    stream = reader.load(path) if path else reader.load()
    if fmt == "text":
        part = F.split("value", "\t", 3)
        return stream.select(part[0].cast("int").alias("partition"), part[1].cast("bigint").alias("offset"),
                             F.lit(None).cast("timestamp").alias("timestamp"), part[2].cast("binary").alias("value"))
    return stream


def _inbox_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the checkpoint's inbox, kept beside the checkpoint's own
    files; a new one if there is none (a first or a lost checkpoint)."""
    path = f"{checkpoint.rstrip('/')}/inbox_name"
    try:
        found = spark.read.text(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    if found:
        return found[0][0]
    name = uuid.uuid4().hex
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return name


def drained(q: StreamingQuery, timeout_s: float | None) -> StreamingQuery:
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not drain within {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q


def fill_inbox(spark: SparkSession, lake, stream: DataFrame, checkpoint: str,
               timeout_s: float | None = None) -> list[dict]:
    """Append what is new in the source to a new folder of the
    checkpoint's inbox, then end. Returns the figures of each micro-batch: its
    number, the messages it read and how many of them were null. They are observed
    on the stream and taken from the query's own progress."""
    inbox, drain = _inbox_name(spark, checkpoint), uuid.uuid4().hex
    seen = stream.select(*RECORD.fieldNames()).observe(
        drain, F.count(F.lit(1)).alias("messages"), F.count_if(F.col("value").isNull()).alias("nulls"))
    q = (seen.writeStream.format("parquet").option("path", f"{lake.inbox(inbox)}/{drain}")
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream")
         .outputMode("append").trigger(availableNow=True).start())
    drained(q, timeout_s)
    found = [(p.batchId, p.observedMetrics.get(drain)) for p in q.recentProgress]
    return [{"batch": i, "messages": x.messages if x else 0, "nulls": x.nulls if x else 0} for i, x in found]


def land_stream(spark: SparkSession, lake, stream: DataFrame, checkpoint: str, order: Sequence[str] = ("partition", "offset"),
                run_date=None, timeout_s: float | None = None) -> dict:
    """Run until the source is drained, land the new messages and return
    the landing's counters and, as ``batches``, the figures of each micro-batch.
    ``checkpoint`` (O45) must be on shared storage."""
    from paymart.plans.jobs import land

    configure(spark)
    batches = fill_inbox(spark, lake, stream, checkpoint, timeout_s)
    inbox = lake.inbox(_inbox_name(spark, checkpoint))
    folders = [f"{inbox}/{drain}" for drain in sorted(list_folder(spark, inbox))]  # those since the last landing
    empty = spark.createDataFrame([], RECORD)
    out = land(spark, lake, reduce(DataFrame.unionByName, [read_files(spark, f, RECORD) for f in folders], empty),
               order, run_date)
    for folder in folders:
        remove_folder(spark, folder)
    return {**out, "batches": batches}
