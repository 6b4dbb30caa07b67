"""The transaction source (O02): any Spark reader, by format and options."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from paymart.operators.staging import extract_transactions


def read_transactions(spark: SparkSession, fmt: str, options: dict | None = None, path: str | None = None,
                      day: _dt.date | str | None = None, split_column: str | None = None,
                      split_bounds: tuple[str, str] | None = None, splits: int | None = None) -> DataFrame:
    """The source's transactions of ``day`` (all days when None), nine columns.

    The day is a range on the bare time column, so Parquet and JDBC readers
    push it to the source. ``fmt='jdbc'`` reads with one connection unless
    ``split_column`` (a number, date or time), its bounds and the number of
    ``splits`` are given; the bounds only shape the splits, they filter nothing.
    Connection data comes only from ``options`` and is never logged.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if split_column:
        if not split_bounds or not splits:
            raise ValueError("a split column needs its bounds and the number of splits")
        reader = reader.options(partitionColumn=split_column, lowerBound=split_bounds[0],
                                upperBound=split_bounds[1], numPartitions=str(splits))
    return extract_transactions(reader.load(path) if path else reader.load(), day)
