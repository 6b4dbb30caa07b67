"""Tables whose days are replaced together, or not at all.

A commit writes its days to a folder of its own, ``data/version=<id>/<day column>=<day>``,
and then one small file, the table's next pointer: which version each day has. Readers
take the newest pointer and read the folders it names. So a reader sees all days of a
commit or none, a write that fails half way changes nothing, and of two commits at the
same time one fails (``ConcurrentCommitError``), as a pointer's number is taken once.

A folder that a commit replaces is removed by the next commit, so readers that hold
the pointer before can finish. A pointer has an entry per day: its size is bounded by
the calendar. No table format, no lock, nothing but files and a rename.
"""

from __future__ import annotations

from dataclasses import dataclass
import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paymart.functions import as_date
from paymart.session import list_folder, remove_folder, write_file_once

KEPT_POINTERS = 2


class ConcurrentCommitError(RuntimeError):
    """Another commit took the pointer's number first."""


@dataclass(frozen=True)
class Pointer:
    """``days``: version by day folder (``business_date=2024-01-05``); ``retired``:
    (version, day folder) of what the commit replaced; ``notes``: the caller's own."""
    number: int
    days: dict[str, str]
    retired: list[list[str]]
    notes: dict

    def version(self, day_column: str, day: _dt.date | str) -> str | None:
        return self.days.get(f"{day_column}={as_date(day)}")


@dataclass(frozen=True)
class VersionedTable:
    path: str
    schema: T.StructType
    day_column: str

    # ------------------------------------------------------------- pointers

    def pointer(self, spark: SparkSession) -> Pointer:
        numbers = sorted(int(n) for n in list_folder(spark, f"{self.path}/pointer") if n.isdigit())
        if not numbers:
            return Pointer(0, {}, [], {})
        text = spark.read.text(f"{self.path}/pointer/{numbers[-1]:012d}", wholetext=True).first()[0]
        return Pointer(numbers[-1], **json.loads(text))

    def _swap(self, spark: SparkSession, last: Pointer, days: dict, retired: list, notes: dict) -> None:
        number = last.number + 1
        text = json.dumps({"days": days, "retired": retired, "notes": notes})
        if not write_file_once(spark, f"{self.path}/pointer/{number:012d}", text):
            raise ConcurrentCommitError(f"{self.path}: another commit has number {number}")
        for version, day in last.retired:
            remove_folder(spark, f"{self.path}/data/version={version}/{day}")
        remove_folder(spark, f"{self.path}/pointer/{number - KEPT_POINTERS:012d}")

    # ------------------------------------------------------------- use

    def write(self, df: DataFrame) -> str:
        """Write days aside; nobody sees them before ``publish``. Returns the version."""
        version = uuid.uuid4().hex[:12]
        (df.write.mode("errorifexists").partitionBy(self.day_column)
         .parquet(f"{self.path}/data/version={version}"))
        return version

    def publish(self, spark: SparkSession, version: str, last: Pointer, only=None, notes: dict | None = None) -> None:
        """Let readers see the version's days, in place of those of ``last``. With
        ``only``, that day is replaced also if the version has no row of it."""
        days = {name for name in list_folder(spark, f"{self.path}/data/version={version}") if "=" in name}
        gone = {f"{self.day_column}={as_date(only)}"} - days if only is not None else set()
        if not days and not gone & last.days.keys() and notes is None:
            return
        retired = [[last.days[d], d] for d in sorted(days | gone) if d in last.days]
        now = {d: v for d, v in last.days.items() if d not in gone} | dict.fromkeys(days, version)
        self._swap(spark, last, now, retired, last.notes | (notes or {}))

    def replace(self, df: DataFrame, last: Pointer | None = None, only=None, notes: dict | None = None) -> None:
        """Replace every day that ``df`` has rows of (D2); none, and nothing changes
        (D3). ``last``: the pointer that ``df`` was made from; if the table has moved on
        since, the commit fails and nothing changes."""
        spark = df.sparkSession
        last = last or self.pointer(spark)
        self.publish(spark, self.write(df), last, only, notes)

    def read(self, spark: SparkSession, day=None, pointer: Pointer | None = None) -> DataFrame:
        """The table's rows, or those of a day, as of its newest (or the given)
        pointer. Only the folders that the pointer names are listed."""
        days = (pointer or self.pointer(spark)).days
        if day is not None:
            days = {d: v for d, v in days.items() if d == f"{self.day_column}={as_date(day)}"}
        if not days:
            return spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/data/version={version}/{name}" for name, version in sorted(days.items())]
        return (spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*folders)
                .select(*self.schema.fieldNames()))
