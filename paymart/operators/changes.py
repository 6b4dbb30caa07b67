"""Table changes without a table format: insert-ignore, replace by date and
upsert as pure DataFrame functions, plus the one writer that applies them by
rewriting whole day partitions.

Plain Parquet on Spark has no row-level MERGE or DELETE, so a change is
"compute the new content of the touched partitions, then overwrite exactly
those partitions" (dynamic partition overwrite). A rerun gives the same
result; it is not a database transaction (see README).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DuplicateKeyError(ValueError):
    """The source of an upsert has two rows with one key."""


# ---------------------------------------------------------------- pure forms

class MissingOrderError(ValueError):
    """First or last needs a declared order."""


def need_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    order = list(order)
    missing = [c for c in order if c not in df.columns]
    if not order or missing:
        raise MissingOrderError(f"an order is needed to pick a row per key; missing: {missing or 'any column'}")
    return order


def _packed(df: DataFrame, key: list[str], order: list[str]):
    rest = [c for c in df.columns if c not in key and c not in order]
    return F.struct(*[F.col(c) for c in order + rest])


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order`` (D14, deterministic). Raises if
    the order is empty or not in the frame.

    Written as ``min(struct(order..., rest...))`` per key: an aggregate, so
    each task folds its rows of a key before the shuffle and a hot key moves
    one row per task, not all its rows. Ties in ``order`` fall to the
    remaining columns, so the pick never depends on task timing.
    """
    key, order = list(key), need_order(df, order)
    first = df.groupBy(*key).agg(F.min(_packed(df, key, order)).alias("_first"))
    return first.select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in df.columns])


def insert_ignore(existing: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (first writer
    wins, within the batch by ``order`` and across batches by the anti-join).
    Returns only the rows to append; a replayed batch yields nothing (O46).

    The batch is folded once, and one anti-join reads the table's key columns
    only. Spark's own size check picks the join.
    """
    key = list(key)
    return first_per_key(new, key, order).join(existing.select(*key), key, "left_anti")


def replace_by_date(old: DataFrame, new: DataFrame, date_col: str) -> DataFrame:
    """The whole content after replacing every date present in ``new``
    (D2). No new rows: nothing is replaced (D3)."""
    # the set of dates is bounded by the calendar (a few hundred values per
    # year of data), so it is broadcast: the old table is never shuffled by
    # date, which would put a whole (possibly huge) day into one task
    days = F.broadcast(new.select(date_col).distinct())
    return new.unionByName(old.join(days, date_col, "left_anti"))


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``MERGE`` with "update all columns when matched, insert
    when not matched" as ``source UNION (target ANTI JOIN source)``.

    Equality never matches a null key, as in MERGE. Upserts never delete
    (D13). Duplicate keys in ``source`` must be handled first (``check_unique``
    or ``latest_per_key``).
    """
    key = list(key)
    kept = target.join(source.select(*key), key, "left_anti")
    return source.unionByName(kept.select(*source.columns))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (an aggregate, so it
    is folded per task before the shuffle)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1))


def check_unique(df: DataFrame, key: Sequence[str]) -> None:
    """Raise when ``df`` has two rows with one non-null key."""
    cond = F.lit(True)
    for c in key:
        cond = cond & F.col(c).isNotNull()
    dups = duplicate_keys(df.where(cond), key)
    if not dups.isEmpty():
        sample = [r.asDict() for r in dups.limit(5).collect()]
        raise DuplicateKeyError(f"duplicate keys {list(key)} in upsert source, e.g. {sample}")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Opt-in for D5: keep the last row per key by the declared ``order`` (an
    arrival time or number); ties fall to the remaining columns."""
    key, order = list(key), need_order(df, order)
    last = df.groupBy(*key).agg(F.max(_packed(df, key, order)).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in df.columns])


def replace_day(target: DataFrame, source: DataFrame, date_col: str, day) -> DataFrame:
    """D13 opt-in: the target's rows of ``day`` become the source's, so groups
    that no longer qualify go (an upsert keeps them)."""
    day = F.lit(day).cast("date")
    return target.where(~F.col(date_col).eqNullSafe(day)).unionByName(source.where(F.col(date_col) == day))


# ---------------------------------------------------------------- storage

def _read(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame | None:
    """A Parquet folder with its declared schema, or None if there is none."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path).select(*schema.fieldNames())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned Parquet table with its declared schema, columns in
    declared order (the reader puts partition columns last); a table that was
    never written reads as empty."""
    found = _read(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def read_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What lies in a stream's output folder, whether its log names it or not (a
    batch that was repeated may be there twice); empty if there is no folder."""
    found = _read(spark, f"{path.rstrip('/')}/*.parquet", schema)
    return spark.createDataFrame([], schema) if found is None else found


def read_partition(spark: SparkSession, path: str, schema: T.StructType, spec: dict) -> DataFrame:
    """Read one partition (``spec`` = partition column -> value, outermost
    first) of a table by its folder, with ``basePath`` so the partition
    columns are still returned. Only that folder is listed, not every
    partition of the table; a missing partition reads as empty."""
    sub = "/".join(f"{k}={v}" for k, v in spec.items())
    part = f"{path.rstrip('/')}/{sub}"
    found = _read(spark, part, schema, basePath=path)
    return spark.createDataFrame([], schema) if found is None else found


def write_days(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df``.

    Dynamic mode is set on the writer itself: a static overwrite of a path
    that is also read would delete the data before reading it. Output files
    are committed at job end, so a lost executor only reruns its tasks.
    """
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .parquet(path))


def append_rows(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Bulk append (used by the landing's insert-ignore)."""
    df.write.mode("append").partitionBy(*partition_cols).parquet(path)
