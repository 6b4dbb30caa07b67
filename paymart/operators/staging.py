"""Staging of source transactions: extract a day, check required fields,
conform to the typed staging row, rename (O02, O14, O15, O23, O24)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.functions import day_range_predicate, first_null, to_millis, try_cast
from paymart.schemas import TRANSACTION_COLUMNS

SOURCE_COLUMNS = [n for n, _ in TRANSACTION_COLUMNS]


def extract_transactions(src: DataFrame, day: _dt.date | str | None = None,
                         keep: dict[str, str] | None = None) -> DataFrame:
    """The nine source columns where ``transaction_dt::date = day``.
    Written as a range on the bare column, so Parquet skips row groups.
    ``keep``: more source columns and their new names."""
    df = src if day is None else src.where(day_range_predicate("transaction_dt", day))
    return df.select(*SOURCE_COLUMNS, *[F.col(c).alias(n) for c, n in (keep or {}).items()])


def _raw_text(cols: list[str]) -> Column:
    """Audit text of a rejected row: values joined by '|', null as empty."""
    parts = []
    for c in cols:
        if c == "transaction_dt":
            ts = F.col(c).try_cast("timestamp_ntz")
            v = F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col(c).cast("string"))
        else:
            v = F.col(c).cast("string")
        parts.append(F.coalesce(v, F.lit("")))
    return F.concat_ws("|", *parts)


def transactions_checked(src: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """O23 + O14 + O15 with a reject reason.

    A null in any of the nine columns rejects the row (O23). Values are then
    cast to the declared types with ``try_cast``; a value that does not cast
    is a reject, not a failed job (O24, D16). The time is cut to milliseconds
    (D6) and renamed ``transaction_dttm`` (O15). Empty text stays as it is (D9).
    """
    typed = {n: try_cast(n, t) for n, t in TRANSACTION_COLUMNS}
    reason = F.coalesce(
        first_null(SOURCE_COLUMNS),
        *[F.when(typed[n].isNull(), F.lit("bad_" + n)) for n in SOURCE_COLUMNS])
    out = [typed[n].alias(n) for n in SOURCE_COLUMNS[:-1]]
    out.append(to_millis(typed["transaction_dt"]).alias("transaction_dttm"))
    return src.select(*keep, *out, reason.alias("reason"), _raw_text(SOURCE_COLUMNS).alias("raw"),
                      typed["transaction_dt"].cast("date").alias("run_date"))


def conform_transactions(src: DataFrame) -> DataFrame:
    """Valid rows in the ``stg_transactions`` shape."""
    return transactions_checked(src).where(F.col("reason").isNull()).drop("reason", "raw", "run_date")


def transaction_rejects(src: DataFrame, run_date: _dt.date | None = None) -> DataFrame:
    c = transactions_checked(src)
    return c.where(F.col("reason").isNotNull()).select(
        F.lit("transactions").alias("stage"), "reason", "raw",
        F.lit(run_date).cast("date").alias("run_date"))


def required_fields(src: DataFrame) -> DataFrame:
    """O23 alone: source rows with none of the nine columns null."""
    cond = F.lit(True)
    for c in SOURCE_COLUMNS:
        cond = cond & F.col(c).isNotNull()
    return src.where(cond).select(*SOURCE_COLUMNS)
