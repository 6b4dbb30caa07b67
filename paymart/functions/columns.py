"""Column expressions used by the operators. All are built-in Spark
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(c: Column | str) -> Column:
    """Binary (or any) message value as text."""
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def day_of(ts: Column | str) -> Column:
    """The date of a timestamp (``x::date``)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c.cast("date")


def to_millis(ts: Column | str) -> Column:
    """Cut a timestamp to milliseconds and keep it zone-less.

    ``date_trunc`` returns a zoned timestamp, so cast back to NTZ (the session
    zone is UTC, so the wall-clock value is unchanged).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("millisecond", c).cast(T.TimestampNTZType())


def try_cast(c: Column | str, dtype: T.DataType) -> Column:
    """Cast that yields null instead of raising (ANSI mode is on)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(dtype)


def as_date(day: _dt.date | str) -> _dt.date:
    if isinstance(day, _dt.datetime):
        return day.date()
    if isinstance(day, _dt.date):
        return day
    return _dt.date.fromisoformat(str(day))


def day_range_predicate(ts: Column | str, day: _dt.date | str) -> Column:
    """``ts::date = day`` written as a half-open range on the bare column, so
    that Parquet row-group statistics can skip data for it."""
    d = as_date(day)
    c = F.col(ts) if isinstance(ts, str) else ts
    lo = F.lit(f"{d.isoformat()} 00:00:00").cast(T.TimestampNTZType())
    hi = F.lit(f"{(d + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast(T.TimestampNTZType())
    return (c >= lo) & (c < hi)


def first_null(cols: list[str], prefix: str = "missing_") -> Column:
    """Name of the first null column, as a reject reason; null if none."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(prefix + c)) for c in cols])
