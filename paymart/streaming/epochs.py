"""A sink that acts once per micro-batch, with the batch's number.

``epochs`` is a Python data source for ``writeStream``. Its tasks write their rows as
files; when all have, ``commit`` is called with the number of the micro-batch (the
epoch) and puts one small file in place that names the epoch's files: its entry in the
commit log. Spark calls it in its own Python worker, so unlike ``foreachBatch`` there is
no callback server in the driver and no port.

* An epoch that Spark delivers again after a failure finds its entry there: the first
  delivery stays, the files of the second are removed.
* Files without an entry (of failed tasks or batches) are never read.
* Empty micro-batches have entries too, with no rows.

``each_epoch`` then calls a function once per epoch that it was not called for before, in
their order, with the epoch's rows and number. What it has handled is noted after the
call; a call that fails stops the run, and the next run begins with that epoch.

The folder must be one that driver and executors reach as a path or by a URI that
pyarrow knows (``file:``, ``hdfs:``, ``s3:``, ``gs:``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
import json
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from paymart.operators.changes import read_table

# workers get the classes themselves, wherever this package is installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "paymart_epochs"
EPOCHS = T.StructType([T.StructField("epoch", T.LongType()), T.StructField("rows", T.LongType()),
                       T.StructField("files", T.ArrayType(T.StringType()))])
_HANDLED = T.StructType([T.StructField("epoch", T.LongType())])


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def _open(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> Written:
        import pyarrow.parquet as pq

        system, root = self._open()
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                system.create_dir(f"{root}/data", recursive=True)
                writer = pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is None:
            return Written(None, 0)
        writer.close()
        return Written(name, rows)

    def commit(self, messages: list, batchId: int) -> None:
        system, root = self._open()
        entry, files = f"{root}/log/{batchId:012d}.json", [m.file for m in messages if m and m.file]
        if system.get_file_info(entry).type.name != "NotFound":
            self._remove(system, root, files)
            return
        system.create_dir(f"{root}/log", recursive=True)
        aside = f"{root}/log/.{uuid.uuid4().hex}"
        text = json.dumps({"epoch": batchId, "rows": sum(m.rows for m in messages if m), "files": files})
        with system.open_output_stream(aside) as out:
            out.write(text.encode())
        system.move(aside, entry)

    def abort(self, messages: list, batchId: int) -> None:
        system, root = self._open()
        self._remove(system, root, [m.file for m in messages if m and m.file])

    @staticmethod
    def _remove(system, root: str, files: list[str]) -> None:
        for file in files:
            system.delete_file(f"{root}/data/{file}")


class EpochSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> EpochWriter:
        return EpochWriter(self.options["folder"])


def _uri(folder: str) -> str:
    return folder if ":" in folder.split("/")[0] else f"file://{folder}"


def write_epochs(spark: SparkSession, stream: DataFrame, folder: str, checkpoint: str,
                 timeout_s: float | None = None) -> None:
    """Write what is new in the source as epochs below ``folder``, then end."""
    from paymart.streaming.landing import drained

    spark.dataSource.register(EpochSink)
    drained(stream.writeStream.format(NAME).option("folder", _uri(folder)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(), timeout_s)


def epochs(spark: SparkSession, folder: str) -> DataFrame:
    """The commit log: epoch, its rows and files."""
    from paymart.session import list_folder

    names = [n for n in list_folder(spark, f"{folder}/log") if n.endswith(".json")]
    return spark.read.schema(EPOCHS).json(f"{folder}/log/*.json") if names else spark.createDataFrame([], EPOCHS)


def each_epoch(spark: SparkSession, folder: str, schema: T.StructType,
               action: Callable[[DataFrame, int], object]) -> list[dict]:
    """Call ``action(rows, epoch)`` for each epoch that was not handled yet. Returns
    their numbers, rows and what the calls returned."""
    handled = read_table(spark, f"{folder}/handled", _HANDLED)
    new = epochs(spark, folder).join(handled, "epoch", "left_anti").orderBy("epoch").collect()  # one row a micro-batch
    out = []
    for entry in new:
        files = [f"{folder}/data/{name}" for name in entry.files]
        rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
        out.append({"epoch": entry.epoch, "rows": entry.rows, "result": action(rows, entry.epoch)})
        spark.createDataFrame([(entry.epoch,)], _HANDLED).coalesce(1).write.mode("append").parquet(f"{folder}/handled")
    return out


def land_epochs(spark: SparkSession, lake, stream: DataFrame, folder: str, checkpoint: str) -> list[dict]:
    """Land a stream micro-batch by micro-batch: the first epoch's message of a key
    wins, whatever the offsets of later ones."""
    from paymart.plans.jobs import land
    from paymart.streaming.landing import RECORD

    write_epochs(spark, stream.select(*[F.col(c) for c in RECORD.fieldNames()]), folder, checkpoint)
    return each_epoch(spark, folder, RECORD, lambda rows, epoch: land(spark, lake, rows) if not rows.isEmpty() else None)
