"""The end-to-end jobs (O47-O51) over a lake of date-partitioned Parquet
tables.

Table layout below ``Lake.root`` (partition columns in brackets):

* ``inbox/<id>/<drain>``                            raw messages of a stream that are not landed yet
* ``landing_keys``                                  the landing's keys and their filters (``operators.keys``)
* ``landing_pending/<load>``                        the new rows of a batch that is being landed
* ``landing``             [object_class, sent_date] key ``object_id``; class ``CURRENCY`` or ``OTHER``
* ``stg_currencies``      (date_update)             replaced by date
* ``stg_transactions``    (business_date)           upsert on (operation_id, transaction_dttm)
* ``mart_global_metrics`` (date_update)             upsert on (date_update, currency_from)
* ``audit``                                         the counters of every run, a row per stage
* ``rejects_landing``                               one row per rejected message; equal ones without a place: one, with ``copies``
* ``rejects/stage=<s>``   [run_date]                rejects of the staging steps

The three tables with a day in round brackets are ``operators.versions`` tables: a
change writes whole days to new folders and then swaps the table's pointer, so readers
see all days of a change or none, and a rerun of a day gives the same tables. The
staged day is stored (``business_date``, ``sent_date``) so that day predicates prune
partitions on both sides of the mart join. A job reads each source once: what is used
several times is written to the shared checkpoint folder first.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.functions import as_date, day_of
from paymart.operators import changes
from paymart.operators.changes import (
    append_rows, check_unique, latest_per_key, read_partition, read_table, upsert, write_days,
)
from paymart.operators.keys import KeyIndex
from paymart.operators.mart import global_metrics
from paymart.operators.messages import currency_messages, envelope_checked, rates_checked
from paymart.operators.quality import dedupe_rates as one_rate_each
from paymart.operators.quality import counted, observe_rows, observe_split
from paymart.operators.staging import extract_transactions, transactions_checked
from paymart.operators.versions import VersionedTable
from paymart.schemas import (
    BUSINESS_DATE, LANDING, MART_GLOBAL_METRICS, MART_KEY, OBJECT_TYPE_CURRENCY, REJECTS,
    STG_CURRENCIES, STG_TRANSACTIONS, TRANSACTION_KEY,
)
from paymart.session import configure, list_folder, remove_folder, stored_once

OTHER_CLASS = "OTHER"
LANDING_STORED = T.StructType(LANDING.fields + [T.StructField("object_class", T.StringType()),
                                                T.StructField("sent_date", T.DateType())])
LANDING_REJECTS = T.StructType(REJECTS.fields + [T.StructField("partition", T.IntegerType()),
                                                 T.StructField("offset", T.LongType()),
                                                 T.StructField("message", T.StringType()),
                                                 T.StructField("copies", T.LongType())])
STG_TRANSACTIONS_STORED = T.StructType(STG_TRANSACTIONS.fields + [T.StructField(BUSINESS_DATE, T.DateType())])
STAGES = ("landing", "currencies", "transactions", "mart")
COUNTERS = ("read", "valid", "rejected", "written")
AUDIT = T.StructType([T.StructField("run", T.StringType()), T.StructField("noted_at", T.TimestampType()),
                      T.StructField("step", T.IntegerType()), T.StructField("stage", T.StringType()),
                      T.StructField("run_date", T.DateType()), *[T.StructField(c, T.LongType()) for c in COUNTERS]])
DEFAULT_ORDER = ("partition", "offset")
UNDATED = "undated"


@dataclass(frozen=True)
class Lake:
    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._p("landing")

    @property
    def stg_currencies(self) -> VersionedTable:
        return VersionedTable(self._p("stg_currencies"), STG_CURRENCIES, "date_update")

    @property
    def stg_transactions(self) -> VersionedTable:
        return VersionedTable(self._p("stg_transactions"), STG_TRANSACTIONS_STORED, BUSINESS_DATE)

    @property
    def mart(self) -> VersionedTable:
        return VersionedTable(self._p("mart_global_metrics"), MART_GLOBAL_METRICS, "date_update")

    @property
    def rejects(self) -> str:
        return self._p("rejects")

    @property
    def landing_rejects(self) -> str:
        return self._p("rejects_landing")

    def inbox(self, name: str) -> str:
        return self._p(f"inbox/{name}")

    @property
    def landing_keys(self) -> KeyIndex:
        return KeyIndex(self._p("landing_keys"))

    @property
    def landing_pending(self) -> str:
        return self._p("landing_pending")

    @property
    def audit(self) -> str:
        return self._p("audit")

    # readers with declared schemas (a table never written reads as empty)
    def read_landing(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.landing, LANDING_STORED)

    def read_currencies(self, spark: SparkSession) -> DataFrame:
        return self.stg_currencies.read(spark)

    def read_transactions(self, spark: SparkSession) -> DataFrame:
        return self.stg_transactions.read(spark)

    def read_mart(self, spark: SparkSession) -> DataFrame:
        return self.mart.read(spark)

    def read_rejects(self, spark: SparkSession) -> DataFrame:
        """Rejects of all stages, a row each; a message's place in its topic is left out."""
        names = REJECTS.fieldNames()
        landing = read_table(spark, self.landing_rejects, LANDING_REJECTS).select(
            *names, F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1))))).select(*names)
        staged = read_table(spark, self.rejects, REJECTS).where(F.col("reason").isNotNull())
        return landing.unionByName(staged.select(*names))

    def read_totals(self, spark: SparkSession) -> DataFrame:
        """The counters of each stage's runs, and how many rows it has read and
        written up to and with that run. A row per run and stage, so the window is
        over as many rows as there were runs."""
        so_far = Window.partitionBy("stage").orderBy("noted_at", "run").rowsBetween(Window.unboundedPreceding, 0)
        return read_table(spark, self.audit, AUDIT).select(
            "stage", F.row_number().over(so_far).alias("run_no"), "run_date",
            *COUNTERS, *[F.sum(F.coalesce(c, F.lit(0))).over(so_far).alias(f"total_{c}") for c in ("read", "written")])

    # one day, read by its folder (no listing of the other partitions)
    def read_transactions_day(self, spark: SparkSession, day) -> DataFrame:
        return self.stg_transactions.read(spark, day)

    def read_currencies_day(self, spark: SparkSession, day) -> DataFrame:
        return self.stg_currencies.read(spark, day)

    def read_mart_day(self, spark: SparkSession, day) -> DataFrame:
        return self.mart.read(spark, day)

    def read_landing_day(self, spark: SparkSession, object_class: str, day) -> DataFrame:
        return read_partition(spark, self.landing, LANDING_STORED,
                              {"object_class": object_class, "sent_date": as_date(day)})


def _write_stage_rejects(spark: SparkSession, lake: Lake, stage: str, checked: DataFrame, day) -> None:
    """The rejects of a staging run replace those of the run before for the days it
    has read, also when there are none now; other days keep theirs. ``checked`` has
    ``reason``, ``raw`` and ``run_date`` of all rows read. Rows without a day are only
    read by range runs: of equal ones as many are kept as any run has had."""
    path = f"{lake.rejects}/stage={stage}"
    rejects = checked.where(F.col("reason").isNotNull()).select("reason", "raw", "run_date")
    if day is not None:
        rejects.drop("run_date").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{path}/run_date={as_date(day)}")
        return
    # a row without a reason stands for "read, no reject": its day is overwritten too
    days = checked.where(F.col("run_date").isNotNull()).select("run_date").distinct()
    marks = days.select(F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("raw"), "run_date")
    undated = rejects.where(F.col("run_date").isNull()).groupBy("reason", "raw").agg(F.count("*").alias("n"))
    before = (read_table(spark, lake.rejects, REJECTS)
              .where((F.col("stage") == F.lit(stage)) & F.col("run_date").isNull() & F.col("reason").isNotNull())
              .groupBy("reason", "raw").agg(F.count("*").alias("n")))
    undated = (undated.unionByName(before).groupBy("reason", "raw").agg(F.max("n").alias("n"))
               .select("reason", "raw", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("n"))
               .select("reason", "raw", F.lit(None).cast("date").alias("run_date")))
    rows = rejects.where(F.col("run_date").isNotNull()).unionByName(marks).unionByName(undated)
    write_days(stored_once(rows, f"{stage}-rejects"), path, ["run_date"])


# ---------------------------------------------------------------- landing

def _placed(order: Sequence[str]) -> Column:
    """Whether a message has a value in every order column."""
    return reduce(and_, [F.col(c).isNotNull() for c in order])


def _message(order: Sequence[str]) -> Column:
    """What tells a rejected message from others: its place, which is enough if
    it is one in a topic (partition, offset); else with a digest of the rest, as
    other order columns need not be unique and any may be null. Never null."""
    place = F.to_json(F.struct(*sorted(order)))
    whole = F.concat(place, F.sha2(F.to_json(F.struct("reason", "raw")), 256))
    return F.when(_placed(order), place).otherwise(whole) if set(DEFAULT_ORDER) <= set(order) else whole


def _new_rejects(spark: SparkSession, lake: Lake, rejects: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rejects that the table lacks. A message with a place is one row however
    often it comes; equal ones without a place are counted, and what is stored is
    how many more there are in this batch than in the table."""
    row = F.struct(*[F.col(c) if c in rejects.columns else F.lit(None).cast(LANDING_REJECTS[c].dataType).alias(c)
                     for c in LANDING_REJECTS.fieldNames() if c not in ("message", "copies")])
    batch = (rejects.select(_message(order).alias("message"), _placed(order).alias("placed"), row.alias("row"))
             .groupBy("message").agg(F.min("row").alias("row"), F.bool_or("placed").alias("placed"), F.count("*").alias("n")))
    # rows stored before there was a ``message`` have their place at most; only
    # what the batch has too is counted
    known = (read_table(spark, lake.landing_rejects, LANDING_REJECTS)
             .select(F.coalesce("message", _message(DEFAULT_ORDER)).alias("message"), "copies")
             .join(rejects.select(_message(order).alias("message")), "message", "left_semi")
             .groupBy("message").agg(F.sum(F.coalesce("copies", F.lit(1))).alias("known")))
    more = F.when(F.col("placed"), F.lit(1)).otherwise(F.col("n")) - F.coalesce("known", F.lit(0))
    return (batch.join(known, "message", "left").withColumn("copies", more.cast("long")).where(F.col("copies") > 0)
            .select("row.*", "message", "copies"))


def _apply_pending(spark: SparkSession, lake: Lake, pending: DataFrame, index: KeyIndex) -> None:
    """Put a batch's new rows into the index and the landing."""
    index.add(pending.select("object_id"))
    # range-partition the new rows by (class, day, key): each landing partition
    # is written by a few tasks in proportion to its size, so a backfill over
    # many days does not leave a small file per task and day
    append_rows(pending.select(*LANDING_STORED.fieldNames()).repartitionByRange("object_class", "sent_date", "object_id"),
                lake.landing, ["object_class", "sent_date"])


def _finish_pending(spark: SparkSession, lake: Lake) -> KeyIndex:
    """The landing's index, after batches that were left half way are finished (their
    rows that the landing lacks are added) and a landing without an index has one."""
    index = lake.landing_keys
    if not index.exists(spark):
        before = lake.read_landing(spark).select("object_id")
        if not before.isEmpty():
            index.add(before)
    for load in list_folder(spark, lake.landing_pending):
        folder = f"{lake.landing_pending}/{load}"
        if "_SUCCESS" in list_folder(spark, folder):  # else nothing was changed yet
            # only now is the whole landing looked at
            pending = read_table(spark, folder, LANDING_STORED)
            index.add(pending.select("object_id"))
            _apply_pending(spark, lake, stored_once(pending.join(
                lake.read_landing(spark).select("object_id"), "object_id", "left_anti"), "landing-rest"), index)
        remove_folder(spark, folder)
    return index


def land(spark: SparkSession, lake: Lake, records: DataFrame,
         order: Sequence[str] = DEFAULT_ORDER, run_date: _dt.date | None = None) -> dict:
    """O47 in batch form: decode, keep the first message per ``object_id``
    (by ``order``, which must be there, within the batch; against the table's key
    index across batches) and append. A replayed batch appends nothing (O46).
    Messages that can't be kept, and kept ones without a usable time (they can
    never be staged, D1), are stored as rejects once per place in ``order``, or,
    without one, as often as the batch has them.

    The new rows are written aside before the index and the landing change, and
    removed there after both. A batch that fails in between is finished by the next
    landing."""
    configure(spark)
    order = changes.need_order(records, order)
    index = _finish_pending(spark, lake)
    checked, obs = observe_split(envelope_checked(records, keep=order), "landing",
                                 undated=F.col("reason").isNull() & F.col("sent_dttm").isNull())
    undated = F.col("reason").isNull() & F.col("sent_dttm").isNull()
    # decoded once; the raw text only where a reject needs it
    batch = stored_once(checked.select(
        *order, "object_id", "object_type", "sent_dttm", "payload", "reason",
        F.when(F.col("reason").isNotNull() | F.col("sent_dttm").isNull(), F.col("raw")).alias("raw")), "landing-batch")
    out = counted(obs)
    valid = batch.where(F.col("reason").isNull()).select(*order, "object_id", "object_type", "sent_dttm", "payload")
    new = index.insert_ignore(changes.first_per_key(valid, ["object_id"], order))
    # a class, not the message's own type, is the folder: a type is free text
    is_rate = F.col("object_type") == F.lit(OBJECT_TYPE_CURRENCY)
    pending = f"{lake.landing_pending}/{uuid.uuid4().hex}"
    new, wobs = observe_rows(new.select(
        "object_id", "object_type", "sent_dttm", "payload",
        F.when(is_rate, F.lit(OBJECT_TYPE_CURRENCY)).otherwise(F.lit(OTHER_CLASS)).alias("object_class"),
        day_of("sent_dttm").alias("sent_date")), "landing_written")
    new.write.parquet(pending)
    out |= counted(wobs)
    if out["written"]:
        _apply_pending(spark, lake, read_table(spark, pending, LANDING_STORED), index)
    remove_folder(spark, pending)
    if out["rejected"] or out["undated"]:
        rejects = batch.where(F.col("reason").isNotNull() | undated).select(
            F.lit("landing").alias("stage"), F.coalesce("reason", F.lit(UNDATED)).alias("reason"), "raw",
            F.lit(run_date).cast("date").alias("run_date"),
            *[F.col(c).cast(LANDING_REJECTS[c].dataType).alias(c) if c in DEFAULT_ORDER else F.col(c).alias(f"order_{c}")
              for c in order])
        names = [c if c in DEFAULT_ORDER else f"order_{c}" for c in order]
        _new_rejects(spark, lake, rejects, names).write.mode("append").parquet(lake.landing_rejects)
    return out


# ---------------------------------------------------------------- staging

def _landing_day(spark: SparkSession, lake: Lake, day) -> DataFrame:
    if day is None:
        landing = lake.read_landing(spark).where(F.col("object_class") == F.lit(OBJECT_TYPE_CURRENCY))
    else:
        landing = lake.read_landing_day(spark, OBJECT_TYPE_CURRENCY, day)
    return currency_messages(landing, day)


def _split(checked: DataFrame, stage: str) -> tuple[DataFrame, dict]:
    """The checked rows, stored once, and their counters."""
    checked, obs = observe_split(checked, stage)
    checked = stored_once(checked, f"{stage}-checked")
    return checked, counted(obs)


def stage_currencies(spark: SparkSession, lake: Lake, day: _dt.date | str | None,
                     dedupe_rates: bool = False) -> dict:
    """Rate messages of ``day`` -> typed rates -> replace every date
    present in the valid rows (D2). No valid rows: nothing changes (D3).
    ``dedupe_rates`` keeps one rate per (day, base, quoted) (D4 opt-in)."""
    configure(spark)
    checked, out = _split(rates_checked(_landing_day(spark, lake, day), keep=["sent_dttm"]), "currencies")
    valid = checked.where(F.col("reason").isNull()).select(
        "date_update", "currency_code", "currency_code_with", "currency_code_div")
    if dedupe_rates:
        valid = one_rate_each(valid).select(*valid.columns)
    valid, wobs = observe_rows(valid, "currencies_written")
    lake.stg_currencies.replace(valid)
    _write_stage_rejects(spark, lake, "currencies",
                         checked.select("reason", "raw", day_of("sent_dttm").alias("run_date")), day)
    return {**out, **counted(wobs)}


def stage_transactions(spark: SparkSession, lake: Lake, src: DataFrame, day: _dt.date | str | None,
                       on_duplicate: str = "error", arrival: Sequence[str] = ()) -> dict:
    """Source rows of ``day`` -> required fields and types -> upsert on
    (operation_id, transaction_dttm) into the day's partition. The source is
    read once.

    ``on_duplicate``: ``error`` (D5, default) raises on a duplicate key in
    the source; ``latest`` keeps the last row per key by the ``arrival``
    columns of the source, which the caller must name.
    """
    configure(spark)
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    if on_duplicate == "latest" and not arrival:
        raise changes.MissingOrderError("on_duplicate='latest' needs the arrival columns of the source")
    keep = [f"arrival_{c}" for c in arrival]
    extract = extract_transactions(src, day, keep=dict(zip(arrival, keep)))
    checked, out = _split(transactions_checked(extract, keep=keep), "transactions")
    source = checked.where(F.col("reason").isNull()).drop("reason", "raw", "run_date")
    if on_duplicate == "error":
        check_unique(source, TRANSACTION_KEY)
    else:
        source = stored_once(latest_per_key(source, TRANSACTION_KEY, keep).drop(*keep), "transactions-latest")
    last = lake.stg_transactions.pointer(spark)
    target = lake.stg_transactions.read(spark, day, last)
    if day is None:
        # range form: only the days the source touches are read and rewritten
        # (a calendar-bounded set, broadcast; the semi-join on the partition
        # column lets dynamic partition pruning skip the other days' files)
        days = F.broadcast(source.select(day_of("transaction_dttm").alias(BUSINESS_DATE)).distinct())
        target = target.join(days, BUSINESS_DATE, "left_semi")
    merged = upsert(target.drop(BUSINESS_DATE), source, TRANSACTION_KEY)
    merged = merged.withColumn(BUSINESS_DATE, day_of("transaction_dttm"))
    if day is None:
        # rows range-partitioned by (day, key): each day is written by a few
        # tasks in proportion to its size, not as a small file from every task
        merged = merged.repartitionByRange(BUSINESS_DATE, "operation_id")
    merged, wobs = observe_rows(merged, "transactions_written")
    lake.stg_transactions.replace(merged, last)
    _write_stage_rejects(spark, lake, "transactions", checked.select("reason", "raw", "run_date"), day)
    return {**out, **counted(wobs)}


# ---------------------------------------------------------------- mart

def _day_versions(spark: SparkSession, lake: Lake) -> dict[str, list]:
    """The versions of the staged transactions and rates of each day: what a mart day
    was built from, as far as one can tell without reading it."""
    found: dict[str, list] = {}
    for i, table in enumerate((lake.stg_transactions, lake.stg_currencies)):
        for name, version in table.pointer(spark).days.items():
            found.setdefault(name.split("=", 1)[1], [None, None])[i] = version
    return found


def build_global_metrics(spark: SparkSession, lake: Lake, day: _dt.date | str | None,
                         replace: bool = False) -> dict:
    """The day's mart rows upserted on (date_update, currency_from).
    Groups that no longer qualify stay as they were (D13), unless ``replace``
    (a day is needed then): the day's rows become exactly the new ones.
    The join with the rates runs once; its result is a row per day and currency."""
    configure(spark)
    if day is None and replace:
        raise ValueError("replace needs a day")
    return _build_days(spark, lake, None if day is None else [as_date(day)], replace)


def refresh_global_metrics(spark: SparkSession, lake: Lake) -> dict:
    """O50 for the days that need it: those whose staged transactions or rates have
    another version than the mart's rows were built from. Which these are is told by
    the tables' pointers; only these days are read. Returns the rows written and the
    days."""
    configure(spark)
    built = lake.mart.pointer(spark).notes.get("built_from", {})
    changed = sorted(d for d, versions in _day_versions(spark, lake).items() if built.get(d) != versions)
    days = [_dt.date.fromisoformat(d) for d in changed if d[:1].isdigit()]  # rows without a day are in no mart
    if not days:
        return {"written": 0, "days": []}
    return {**_build_days(spark, lake, days, False), "days": days}


def _build_days(spark: SparkSession, lake: Lake, days: list[_dt.date] | None, replace: bool) -> dict:
    last, staged = lake.mart.pointer(spark), _day_versions(spark, lake)
    tx, rates = lake.read_transactions(spark), lake.read_currencies(spark)
    target = lake.mart.read(spark, None, last)
    if days is not None and len(days) == 1:
        source = global_metrics(lake.read_transactions_day(spark, days[0]), lake.read_currencies_day(spark, days[0]), days[0])
        target = lake.mart.read(spark, days[0], last)
    elif days is not None:
        source = global_metrics(tx.where(F.col(BUSINESS_DATE).isin(days)), rates.where(F.col("date_update").isin(days)))
        target = target.where(F.col("date_update").isin(days))
    else:
        source = global_metrics(tx, rates)
    source = stored_once(source, "mart-rows")
    if days is None:
        # only the days the source has (a calendar-bounded set: broadcast)
        target = target.join(F.broadcast(source.select("date_update").distinct()), "date_update", "left_semi")
    merged, wobs = observe_rows(source if replace else upsert(target, source, MART_KEY), "mart_written")
    done = staged if days is None else {str(d): staged[str(d)] for d in days if str(d) in staged}
    notes = {"built_from": last.notes.get("built_from", {}) | done}
    lake.mart.replace(merged, last, only=days[0] if replace else None, notes=notes)
    return counted(wobs)


# ---------------------------------------------------------------- whole day

def take_in(spark: SparkSession, lake: Lake, messages: DataFrame, order: Sequence[str] = DEFAULT_ORDER,
            run_date: _dt.date | None = None, checkpoint: str | None = None) -> dict:
    """Land what is new: a stream is drained from its checkpoint, a static
    frame is landed as it is."""
    if messages.isStreaming:
        from paymart.streaming.landing import land_stream

        if not checkpoint:
            raise ValueError("a stream needs its checkpoint folder")
        return land_stream(spark, lake, messages, checkpoint, order=order, run_date=run_date)
    return land(spark, lake, messages, order, run_date)


def _load_day(spark: SparkSession, lake: Lake, src: DataFrame, d: _dt.date) -> dict:
    return {
        "currencies": stage_currencies(spark, lake, d),
        "transactions": stage_transactions(spark, lake, src, d),
        "mart": build_global_metrics(spark, lake, d),
    }


def _noted(spark: SparkSession, lake: Lake, out: dict, run_date: _dt.date | None) -> dict:
    """The counters of a run, appended to the lake's audit table, a row a stage."""
    begun = _dt.datetime.now(_dt.timezone.utc)
    rows = [(uuid.uuid4().hex, begun, i, stage, run_date, *(out[stage].get(c) for c in COUNTERS))
            for i, stage in enumerate(STAGES) if stage in out]
    spark.createDataFrame(rows, AUDIT).coalesce(1).write.mode("append").parquet(lake.audit)
    return out


def run_day(spark: SparkSession, lake: Lake, messages: DataFrame, src: DataFrame, day: _dt.date | str,
            order: Sequence[str] = DEFAULT_ORDER, checkpoint: str | None = None) -> dict:
    """Land what is new, then stage rates and transactions, then build the
    mart. A failing step raises (D10, D11)."""
    d = as_date(day)
    out = {"landing": take_in(spark, lake, messages, order, d, checkpoint), **_load_day(spark, lake, src, d)}
    return _noted(spark, lake, out, d)


def run_days(spark: SparkSession, lake: Lake, messages: DataFrame, src: DataFrame,
             days: Iterable[_dt.date | str] | None = None,
             order: Sequence[str] = DEFAULT_ORDER, checkpoint: str | None = None) -> dict:
    """Range form: messages are landed once; with ``days=None`` every day is
    loaded by one job per stage (the grouping already contains the day); else
    day by day."""
    landing = take_in(spark, lake, messages, order, None, checkpoint)
    if days is not None:
        out = {"landing": landing}
        _noted(spark, lake, out, None)
        for d in map(as_date, days):
            out[str(d)] = _noted(spark, lake, _load_day(spark, lake, src, d), d)
        return out
    return _noted(spark, lake, {
        "landing": landing,
        "currencies": stage_currencies(spark, lake, None),
        "transactions": stage_transactions(spark, lake, src, None),
        "mart": build_global_metrics(spark, lake, None),
    }, None)
