"""Registered queries: one per operator group of the load, each over the
adapters of the driver's tables (``sources.adapters``), with the DuckDB SQL
that computes the same rows (``plans.oracle.ORACLE``).

Run date of the one-day queries: 2024-01-05 (every scale has all currencies
on it). Queries that need a table on disk write below
``spark.checkpoint.dir`` in a fresh folder per call.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.functions import day_of
from paymart.operators import accounts, changes, mart, messages, quality, staging
from paymart.operators.keys import KeyIndex
from paymart.plans import jobs
from paymart.schemas import MART_KEY, TRANSACTION_KEY
from paymart.session import configure, stored_once, work_dir
from paymart.sources import adapters as A

RUN_DATE = _dt.date(2024, 1, 5)
NO_EVENTS = _dt.date(2031, 1, 1)
REPLACED_DATES = (_dt.date(2024, 1, 5), _dt.date(2024, 1, 6))
# the first drain of the landing holds the messages stamped before this time
FIRST_DRAIN_END = "2024-01-16 00:00:00"
# the days of a small batch: one that was landed before, one that is new
BATCH_DAYS = (_dt.date(2024, 1, 5), _dt.date(2024, 1, 20))
# where the three micro-batches of a stream end
EPOCH_ENDS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
ORDER = ["partition", "offset"]
LANDING_COLUMNS = ["object_id", "object_type", "sent_dttm", "payload"]


# ---------------------------------------------------------------- helpers

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return A.kafka_records(spark, sf_dir)


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table content as a DataFrame (first message per key)."""
    dec = messages.decode_envelope(_records(spark, sf_dir), keep=ORDER)
    return changes.first_per_key(dec, ["object_id"], ORDER).select(*LANDING_COLUMNS)


# ---------------------------------------------------------------- landing

def q_envelope_decode(spark, sf_dir):
    return messages.decode_envelope(_records(spark, sf_dir))


def q_envelope_rejects(spark, sf_dir):
    return messages.envelope_rejects(_records(spark, sf_dir))


def _early() -> Column:
    return F.col("timestamp") < F.lit(FIRST_DRAIN_END).cast("timestamp")


def q_landing_insert_ignore(spark, sf_dir):
    """The first drain's content and what a batch with every message adds to
    it. The batch is decoded once and stored."""
    dec = stored_once(messages.decode_envelope(_records(spark, sf_dir), keep=ORDER + ["timestamp"]), "decoded")
    existing = changes.first_per_key(dec.where(_early()).drop("timestamp"), ["object_id"], ORDER).select(*LANDING_COLUMNS)
    existing = stored_once(existing, "landed")
    added = changes.insert_ignore(existing, dec.drop("timestamp"), ["object_id"], ORDER).select(*LANDING_COLUMNS)
    return existing.unionByName(added)


def _two_drains(spark, sf_dir, second_checkpoint: str) -> jobs.Lake:
    """Two drains of a growing message directory; the second also replays every
    message of the first."""
    from paymart.streaming.landing import land_stream, message_stream

    lake = jobs.Lake(work_dir(spark, "landing_stream"))
    topic = f"{lake.root}/topic"
    recs = _records(spark, sf_dir)
    recs.where(_early()).write.mode("append").parquet(topic)
    land_stream(spark, lake, message_stream(spark, "parquet", path=topic), f"{lake.root}/checkpoint")
    recs.write.mode("append").parquet(topic)               # the rest, plus a replay of the first part
    land_stream(spark, lake, message_stream(spark, "parquet", path=topic), f"{lake.root}/{second_checkpoint}")
    return lake


def q_landing_stream(spark, sf_dir):
    """Two drains with one checkpoint."""
    return _two_drains(spark, sf_dir, "checkpoint").read_landing(spark).select(*LANDING_COLUMNS)


def q_landing_checkpoint_lost(spark, sf_dir):
    """Two drains; the second has lost its checkpoint and starts anew."""
    return _two_drains(spark, sf_dir, "another").read_landing(spark).select(*LANDING_COLUMNS)


def q_landing_key_index(spark, sf_dir):
    """What a batch of two days adds to a landing of the first drain's messages,
    told by the landing's key index: keys that the filters know to be new are never
    looked up, the others in their own shards only."""
    dec = stored_once(messages.decode_envelope(_records(spark, sf_dir), keep=ORDER + ["timestamp"]), "decoded")
    index = KeyIndex(work_dir(spark, "key_index"))
    index.add(dec.where(_early()).select("object_id").distinct())
    batch = dec.where(day_of("timestamp").isin(*BATCH_DAYS)).drop("timestamp")
    return index.insert_ignore(changes.first_per_key(batch, ["object_id"], ORDER)).select(*LANDING_COLUMNS)


def q_landing_micro_batches(spark, sf_dir):
    """A stream landed micro-batch by micro-batch: the first batch's message of a key
    wins. Three parts arrive, each in as many files as it has tasks; a drain after each
    takes all its files as one micro-batch."""
    from paymart.streaming.epochs import land_epochs
    from paymart.streaming.landing import message_stream

    lake = jobs.Lake(work_dir(spark, "landing_epochs"))
    topic = f"{lake.root}/topic"
    recs = stored_once(_records(spark, sf_dir), "records")
    sent, ends = F.col("timestamp"), [F.lit(t).cast("timestamp") for t in EPOCH_ENDS]
    for part in (sent < ends[0], (sent >= ends[0]) & (sent < ends[1]), sent >= ends[1]):
        recs.where(part).write.mode("append").parquet(topic)
        land_epochs(spark, lake, message_stream(spark, "parquet", path=topic), f"{lake.root}/epochs", f"{lake.root}/checkpoint")
    return lake.read_landing(spark).select(*LANDING_COLUMNS)


# ---------------------------------------------------------------- rates

def q_currency_extract(spark, sf_dir):
    return messages.currency_messages(_landing(spark, sf_dir), RUN_DATE)


def q_currency_payload(spark, sf_dir):
    return messages.decode_rates(messages.currency_messages(_landing(spark, sf_dir)))


def q_currency_rejects(spark, sf_dir):
    return messages.rate_rejects(messages.currency_messages(_landing(spark, sf_dir)))


def q_currencies_replace_by_date(spark, sf_dir):
    configure(spark)
    landing = _landing(spark, sf_dir)
    cm = messages.currency_messages(landing).where(day_of("sent_dttm").isin(*REPLACED_DATES))
    new = messages.decode_rates(cm)
    return changes.replace_by_date(A.stg_currencies(spark, sf_dir), new, "date_update")


# ---------------------------------------------------------------- transactions

def q_transactions_extract(spark, sf_dir):
    configure(spark)
    return staging.extract_transactions(A.src_transactions(spark, sf_dir), RUN_DATE)


def q_transactions_required(spark, sf_dir):
    configure(spark)
    return staging.required_fields(A.src_transactions(spark, sf_dir))


def q_transactions_conform(spark, sf_dir):
    configure(spark)
    return staging.conform_transactions(A.src_transactions(spark, sf_dir))


def q_transactions_rejects(spark, sf_dir):
    configure(spark)
    return staging.transaction_rejects(A.src_transactions(spark, sf_dir))


def q_transactions_text_conform(spark, sf_dir):
    """An all-text source: what casts, cast."""
    configure(spark)
    return staging.conform_transactions(A.src_transactions_text(spark, sf_dir))


def q_transactions_text_rejects(spark, sf_dir):
    configure(spark)
    return staging.transaction_rejects(A.src_transactions_text(spark, sf_dir))


def q_transactions_upsert(spark, sf_dir):
    """Target: an earlier load without purchases; source: a new extract of
    the settled rows with corrected amounts."""
    configure(spark)
    conformed = stored_once(staging.conform_transactions(A.src_transactions(spark, sf_dir)), "conformed")
    target = conformed.where(F.col("transaction_type") != "purchase")
    source = (conformed.where(F.col("status") == "done")
              .withColumn("amount", F.col("amount") + 1))
    changes.check_unique(source, TRANSACTION_KEY)
    return changes.upsert(target, source, TRANSACTION_KEY)


# ---------------------------------------------------------------- mart

def q_settled_transactions(spark, sf_dir):
    configure(spark)
    return mart.settled_transactions(A.stg_transactions(spark, sf_dir))


def q_rate_join(spark, sf_dir):
    configure(spark)
    return mart.rate_join(mart.settled_transactions(A.stg_transactions(spark, sf_dir)),
                          mart.base_rates(A.stg_currencies(spark, sf_dir)))


def q_global_metrics(spark, sf_dir):
    configure(spark)
    return mart.global_metrics(A.stg_transactions(spark, sf_dir), A.stg_currencies(spark, sf_dir))


def q_global_metrics_day(spark, sf_dir):
    configure(spark)
    return mart.global_metrics(A.stg_transactions(spark, sf_dir), A.stg_currencies(spark, sf_dir), RUN_DATE)


def q_global_metrics_sql(spark, sf_dir):
    configure(spark)
    return mart.global_metrics_sql(spark, A.stg_transactions(spark, sf_dir), A.stg_currencies(spark, sf_dir),
                                   RUN_DATE)


def q_global_metrics_function(spark, sf_dir):
    configure(spark)
    mart.mart_functions(A.stg_transactions(spark, sf_dir), A.stg_currencies(spark, sf_dir))
    return mart.global_metrics_of(spark, RUN_DATE)


def q_global_metrics_upsert(spark, sf_dir):
    """Target: an earlier build without purchases and without currency 419;
    source: a build that lacks currency 416."""
    configure(spark)
    tx = A.stg_transactions(spark, sf_dir)
    rates = A.stg_currencies(spark, sf_dir)
    target = mart.global_metrics(
        tx.where((F.col("transaction_type") != "purchase") & (F.col("currency_code") != "419")), rates)
    source = stored_once(mart.global_metrics(tx.where(F.col("currency_code") != "416"), rates), "mart-rows")
    return changes.upsert(target, source, MART_KEY)


def q_mart_replace_day(spark, sf_dir):
    """D13 opt-in: one day rebuilt without currency 416, which goes."""
    configure(spark)
    tx, rates = A.stg_transactions(spark, sf_dir), A.stg_currencies(spark, sf_dir)
    source = mart.global_metrics(tx.where(F.col("currency_code") != "416"), rates, RUN_DATE)
    return changes.replace_day(mart.global_metrics(tx, rates), source, "date_update", RUN_DATE)


def q_currencies_deduped(spark, sf_dir):
    """D4 opt-in: one rate per (day, base, quoted)."""
    configure(spark)
    return quality.dedupe_rates(A.stg_currencies_repeated(spark, sf_dir))


def q_emptiness(spark, sf_dir):
    """Whether the settled transactions of a day are none, for a day with
    and one without events."""
    configure(spark)
    tx = A.stg_transactions(spark, sf_dir)
    found = [(d, quality.is_empty(mart.settled_transactions(tx, d))) for d in (RUN_DATE, NO_EVENTS)]
    return spark.createDataFrame(found, "run_date date, is_empty boolean")


def q_accounts_by_month(spark, sf_dir):
    """O36 over months: distinct accounts per currency, put together from the stored
    bitmaps of the days."""
    configure(spark)
    days = stored_once(accounts.day_accounts(mart.settled_transactions(A.stg_transactions(spark, sf_dir))), "day-accounts")
    return (accounts.distinct_accounts(days, F.trunc("date_update", "month"))
            .withColumnRenamed("span", "month"))


def q_mart_refresh(spark, sf_dir):
    """O50 after a late correction of one day's amounts: only that day is built anew."""
    configure(spark)
    lake, src = jobs.Lake(work_dir(spark, "mart_refresh")), A.src_transactions(spark, sf_dir)
    lake.stg_currencies.replace(A.stg_currencies(spark, sf_dir))
    jobs.stage_transactions(spark, lake, src, None)
    jobs.build_global_metrics(spark, lake, None)
    jobs.stage_transactions(spark, lake, src.withColumn("amount", F.col("amount") + 1), RUN_DATE)
    jobs.refresh_global_metrics(spark, lake)
    return lake.read_mart(spark)


# ---------------------------------------------------------------- counters, whole runs

def q_missing_rates(spark, sf_dir):
    """Addition: the settled transactions the mart drops for want of a rate."""
    configure(spark)
    return quality.missing_rates(mart.settled_transactions(A.stg_transactions(spark, sf_dir)),
                                 mart.base_rates(A.stg_currencies(spark, sf_dir)))


def q_load_counters(spark, sf_dir):
    """O39 in batch form: rows read, valid and rejected per stage and day
    (landing by message time, rates by sending day, transactions by
    transaction day)."""
    configure(spark)
    checked = stored_once(messages.envelope_checked(_records(spark, sf_dir), keep=ORDER + ["timestamp"]), "checked")
    landing = quality.counts_by_day(checked, "landing", day_of("timestamp"))
    valid = checked.where(F.col("reason").isNull()).select(*ORDER, *LANDING_COLUMNS)
    cm = messages.currency_messages(changes.first_per_key(valid, ["object_id"], ORDER))
    rates = quality.counts_by_day(messages.rates_checked(cm, keep=["sent_dttm"]),
                                  "currencies", day_of("sent_dttm"))
    txs = quality.counts_by_day(staging.transactions_checked(A.src_transactions(spark, sf_dir)),
                                "transactions", day_of("transaction_dttm"))
    return landing.unionByName(rates).unionByName(txs)


def q_load_totals(spark, sf_dir):
    """The counters of two days' runs with the running totals of each stage."""
    configure(spark)
    lake = jobs.Lake(work_dir(spark, "load_totals"))
    records = stored_once(_records(spark, sf_dir), "records")
    for day in REPLACED_DATES:
        jobs.run_day(spark, lake, records, A.src_transactions(spark, sf_dir), day)
    return lake.read_totals(spark)


def q_run_day(spark, sf_dir):
    configure(spark)
    lake = jobs.Lake(work_dir(spark, "run_day"))
    jobs.run_day(spark, lake, _records(spark, sf_dir), A.src_transactions(spark, sf_dir), RUN_DATE)
    return lake.read_mart(spark)


def q_run_days(spark, sf_dir):
    configure(spark)
    lake = jobs.Lake(work_dir(spark, "run_days"))
    jobs.run_days(spark, lake, _records(spark, sf_dir), A.src_transactions(spark, sf_dir))
    return lake.read_mart(spark)


def q_run_days_rejects(spark, sf_dir):
    """The stored rejects of a run over all days, of a rerun, which stores none a
    second time, and of a run over one day's source, which leaves the others'."""
    configure(spark)
    lake, src = jobs.Lake(work_dir(spark, "run_days_rejects")), A.src_transactions_text(spark, sf_dir)
    for source in (src, src, src.where(F.col("transaction_dt").startswith(str(RUN_DATE)))):
        jobs.run_days(spark, lake, _records(spark, sf_dir), source)
    return lake.read_rejects(spark)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "envelope_decode": q_envelope_decode,
    "envelope_rejects": q_envelope_rejects,
    "landing_insert_ignore": q_landing_insert_ignore,
    "landing_stream": q_landing_stream,
    "landing_checkpoint_lost": q_landing_checkpoint_lost,
    "landing_key_index": q_landing_key_index,
    "landing_micro_batches": q_landing_micro_batches,
    "currency_extract": q_currency_extract,
    "currency_payload": q_currency_payload,
    "currency_rejects": q_currency_rejects,
    "currencies_replace_by_date": q_currencies_replace_by_date,
    "transactions_extract": q_transactions_extract,
    "transactions_required": q_transactions_required,
    "transactions_conform": q_transactions_conform,
    "transactions_rejects": q_transactions_rejects,
    "transactions_text_conform": q_transactions_text_conform,
    "transactions_text_rejects": q_transactions_text_rejects,
    "transactions_upsert": q_transactions_upsert,
    "settled_transactions": q_settled_transactions,
    "rate_join": q_rate_join,
    "global_metrics": q_global_metrics,
    "global_metrics_day": q_global_metrics_day,
    "global_metrics_sql": q_global_metrics_sql,
    "global_metrics_function": q_global_metrics_function,
    "global_metrics_upsert": q_global_metrics_upsert,
    "mart_replace_day": q_mart_replace_day,
    "currencies_deduped": q_currencies_deduped,
    "emptiness": q_emptiness,
    "load_counters": q_load_counters,
    "accounts_by_month": q_accounts_by_month,
    "mart_refresh": q_mart_refresh,
    "load_totals": q_load_totals,
    "missing_rates": q_missing_rates,
    "run_day": q_run_day,
    "run_days": q_run_days,
    "run_days_rejects": q_run_days_rejects,
}
