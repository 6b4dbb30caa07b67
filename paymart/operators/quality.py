"""Counters and checks.

Counters are named ``read``, ``valid``, ``rejected`` and ``written``. In a
job they are collected with ``DataFrame.observe`` on the frame that is
written anyway, so counting costs no extra pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observe_split(checked: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
    """Attach read/valid/rejected counters to a ``*_checked`` frame (one with
    a ``reason`` column), and one for each condition of ``more``. The numbers are
    ready after the first action."""
    obs = Observation(name)
    df = checked.observe(
        obs,
        F.count(F.lit(1)).alias("read"),
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        *[F.count_if(condition).alias(counter) for counter, condition in more.items()])
    return df, obs


def observe_rows(df: DataFrame, name: str, counter: str = "written") -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(counter)), obs


def counted(obs: Observation) -> dict:
    """The observed counters (0 where the plan turned out to be empty at run time)."""
    return dict(obs.get)


def counts_by_day(checked: DataFrame, stage: str, day_col) -> DataFrame:
    """Batch form of the counters: one row per (stage, day)."""
    return (checked.groupBy(day_col.alias("run_date"))
            .agg(F.count(F.lit(1)).alias("rows_read"),
                 F.count_if(F.col("reason").isNull()).alias("rows_valid"),
                 F.count_if(F.col("reason").isNotNull()).alias("rows_rejected"))
            .select(F.lit(stage).alias("stage"), "run_date", "rows_read", "rows_valid", "rows_rejected"))


def duplicate_rates(stg_currencies: DataFrame) -> DataFrame:
    """D4 report: rate rows present more than once per (day, base, quoted)."""
    return (stg_currencies.groupBy("date_update", "currency_code", "currency_code_with")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def dedupe_rates(stg_currencies: DataFrame) -> DataFrame:
    """D4 opt-in: one rate per (day, base, quoted): the smallest rate value,
    an aggregate folded per task before the shuffle."""
    return (stg_currencies.groupBy("date_update", "currency_code", "currency_code_with")
            .agg(F.min("currency_code_div").alias("currency_code_div")))


def missing_rates(settled: DataFrame, rates: DataFrame) -> DataFrame:
    """Addition: settled transactions that the mart's inner
    join drops because their (day, currency) has no rate to the base
    currency. ``settled``/``rates`` as from ``mart.settled_transactions`` and
    ``mart.base_rates``. The rate keys per day are few, so Spark's size check
    broadcasts them and the transactions are not shuffled."""
    return settled.join(rates.select("date_update", "currency_code"), ["date_update", "currency_code"],
                        "left_anti")


def is_empty(df: DataFrame) -> bool:
    """Emptiness test without counting every row."""
    return df.isEmpty()
