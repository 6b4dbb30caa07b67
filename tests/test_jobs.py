"""End-to-end jobs on a lake of day-partitioned Parquet tables (O47-O51):
writes replace whole days, reruns give the same tables, a range run equals
the day runs."""

import datetime as dt
from functools import reduce
from operator import and_

import pytest
from pyspark.sql import functions as F

from paymart.operators.changes import DuplicateKeyError, MissingOrderError

from paymart.plans import jobs
from paymart.sources import adapters as A

from .conftest import SF_SMALL

DAYS = [dt.date(2024, 1, 4), dt.date(2024, 1, 5)]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _inputs(spark):
    return A.kafka_records(spark, SF_SMALL), A.src_transactions(spark, SF_SMALL)


def test_run_day_is_repeatable_and_keeps_other_days(spark, scratch):
    lake = jobs.Lake(scratch)
    records, src = _inputs(spark)
    out = jobs.run_day(spark, lake, records, src, DAYS[0])
    assert out["landing"]["rejected"] > 0 and out["landing"]["written"] > 0
    assert out["landing"]["undated"] > 0
    assert out["currencies"]["valid"] >= 8 and out["currencies"]["rejected"] >= 1
    jobs.run_day(spark, lake, records, src, DAYS[1])
    snap = {n: _rows(getattr(lake, f"read_{n}")(spark))
            for n in ("landing", "currencies", "transactions", "mart")}
    assert {r[0] for r in snap["mart"]} == set(DAYS)
    again = jobs.run_day(spark, lake, records, src, DAYS[1])
    assert again["landing"]["written"] == 0                        # replay adds nothing (O46)
    for n, rows in snap.items():
        assert _rows(getattr(lake, f"read_{n}")(spark)) == rows, n
    # one broken rate message per staged day, stored once, whatever is rerun
    rej = lake.read_rejects(spark).where("stage = 'currencies' AND reason = 'missing_currency_with_div'")
    assert rej.count() == 2


def test_range_run_equals_day_runs(spark, scratch):
    records, src = _inputs(spark)
    by_day = jobs.Lake(scratch + "/by_day")
    for d in DAYS:
        jobs.run_day(spark, by_day, records, src, d)
    ranged = jobs.Lake(scratch + "/ranged")
    jobs.run_days(spark, ranged, records, src)
    got = ranged.read_mart(spark).where(F.col("date_update").isin(*DAYS))
    assert _rows(got) == _rows(by_day.read_mart(spark))
    assert ranged.read_mart(spark).select("date_update").distinct().count() == 30


def test_no_rates_for_the_day_leaves_tables_alone(spark, scratch):
    lake = jobs.Lake(scratch)
    records, src = _inputs(spark)
    jobs.run_day(spark, lake, records, src, DAYS[0])
    before = _rows(lake.read_currencies(spark)), _rows(lake.read_mart(spark))
    out = jobs.stage_currencies(spark, lake, dt.date(2030, 1, 1))          # D3
    assert out["read"] == 0
    jobs.build_global_metrics(spark, lake, dt.date(2030, 1, 1))
    assert (_rows(lake.read_currencies(spark)), _rows(lake.read_mart(spark))) == before


def test_mart_upsert_keeps_groups_that_no_longer_qualify(spark, scratch):
    lake = jobs.Lake(scratch)
    records, src = _inputs(spark)
    jobs.run_day(spark, lake, records, src, DAYS[0])
    mart_before = {(r.date_update, r.currency_from) for r in lake.read_mart(spark).collect()}
    # a new source where every transaction of the day failed: no group qualifies
    failed = src.withColumn("status", F.lit("failed"))
    jobs.stage_transactions(spark, lake, failed, DAYS[0])
    jobs.build_global_metrics(spark, lake, DAYS[0])                        # D13: nothing deleted
    assert {(r.date_update, r.currency_from) for r in lake.read_mart(spark).collect()} == mart_before
    st = lake.read_transactions(spark).where(F.col("business_date") == DAYS[0])
    assert st.where(F.col("status") != "failed").count() == 0              # upsert replaced them


def test_duplicate_source_key_fails_fast(spark, scratch):
    lake = jobs.Lake(scratch)
    _, src = _inputs(spark)
    dup = src.unionByName(src.where(F.col("operation_id") == "5"))
    day = dup.where(F.col("operation_id") == "5").select(F.col("transaction_dt").cast("date")).first()[0]
    with pytest.raises(DuplicateKeyError):                                   # D5
        jobs.stage_transactions(spark, lake, dup, day)
    with pytest.raises(MissingOrderError):
        jobs.stage_transactions(spark, lake, dup, day, on_duplicate="latest")
    dup = dup.withColumn("arrived", F.lit(1)).unionByName(
        src.where(F.col("operation_id") == "5").withColumns({"arrived": F.lit(2), "amount": F.lit(-7).cast("bigint")}))
    out = jobs.stage_transactions(spark, lake, dup, day, on_duplicate="latest", arrival=["arrived"])
    assert out["written"] == out["valid"] - 2
    last = lake.read_transactions_day(spark, day).where("operation_id = '5'").collect()
    assert [r.amount for r in last] == [-7]                                  # the latest, not the largest


def test_order_of_days_does_not_matter(spark, scratch):
    records, src = _inputs(spark)
    fwd, rev = jobs.Lake(scratch + "/fwd"), jobs.Lake(scratch + "/rev")
    for d in DAYS:
        jobs.run_day(spark, fwd, records, src, d)
    for d in reversed(DAYS):
        jobs.run_day(spark, rev, records, src, d)
    for n in ("landing", "currencies", "transactions", "mart"):
        assert _rows(getattr(fwd, f"read_{n}")(spark)) == _rows(getattr(rev, f"read_{n}")(spark)), n


def _env(oid, payload="{}", kind="CURRENCY", sent='"2024-01-05T06:00:00"'):
    return (f'{{"object_id":"{oid}","object_type":"{kind}","sent_dttm":{sent},"payload":"{payload}"}}').encode()


RECORDS = "partition int, offset bigint, value binary"


def test_land_first_wins_by_offset_then_table_wins(spark, scratch):
    """Differing duplicates: within a batch the smallest (partition, offset)
    wins; across batches the row already in the table wins (O05, D14)."""
    lake = jobs.Lake(scratch)
    first = spark.createDataFrame([(0, 7, _env("a", "late")), (0, 3, _env("a", "early")),
                                   (1, 1, _env("b", "b1")), (0, 9, b"junk")], RECORDS)
    out = jobs.land(spark, lake, first)
    assert out["written"] == 2 and out["rejected"] == 1
    assert jobs.land(spark, lake, spark.createDataFrame([], RECORDS))["written"] == 0
    second = spark.createDataFrame([(0, 1, _env("a", "even earlier")), (0, 2, _env("c", "c1"))], RECORDS)
    assert jobs.land(spark, lake, second)["written"] == 1
    got = {r.object_id: r.payload for r in lake.read_landing(spark).collect()}
    assert got == {"a": "early", "b": "b1", "c": "c1"}
    with pytest.raises(MissingOrderError):
        jobs.land(spark, lake, second, order=["arrived"])


def test_each_bad_message_is_stored_once(spark, scratch):
    lake = jobs.Lake(scratch)
    one = spark.createDataFrame([(0, 1, b"junk"), (0, 2, _env("x", sent='"soon"'))], RECORDS)
    two = spark.createDataFrame([(0, 3, b"junk"), (0, 1, b"junk")], RECORDS)
    for batch in (one, two, one, two):
        jobs.land(spark, lake, batch)
    rejects = sorted((r.reason, r.raw) for r in lake.read_rejects(spark).collect())
    assert [r[0] for r in rejects] == ["malformed_json", "malformed_json", "undated"]


def test_a_clean_rerun_clears_the_rejects_of_its_day(spark, scratch):
    lake = jobs.Lake(scratch)
    _, src = _inputs(spark)
    bad = src.withColumn("country", F.when(F.col("operation_id").cast("bigint") % 2 == 0, F.col("country")))
    for d in DAYS:
        assert jobs.stage_transactions(spark, lake, bad, d)["rejected"] > 0
    stored = lake.read_rejects(spark).groupBy("run_date").count().collect()
    assert {r.run_date for r in stored} == set(DAYS)
    good = src.where("country IS NOT NULL")
    assert jobs.stage_transactions(spark, lake, good, DAYS[0])["rejected"] == 0
    assert {r.run_date for r in lake.read_rejects(spark).select("run_date").collect()} == {DAYS[1]}


def test_empty_type_stays_empty_and_types_make_no_folders(spark, scratch):
    lake = jobs.Lake(scratch)
    kinds = ["", "typo 1", "typo 2", "CURRENCY"]
    jobs.land(spark, lake, spark.createDataFrame([(0, i, _env(f"k{i}", kind=k)) for i, k in enumerate(kinds)], RECORDS))
    got = {(r.object_type, r.object_class) for r in lake.read_landing(spark).collect()}
    assert got == {("", "OTHER"), ("typo 1", "OTHER"), ("typo 2", "OTHER"), ("CURRENCY", "CURRENCY")}


def test_replace_builds_the_day_anew(spark, scratch):
    lake = jobs.Lake(scratch)
    records, src = _inputs(spark)
    jobs.run_day(spark, lake, records, src, DAYS[0])
    jobs.stage_transactions(spark, lake, src.withColumn("status", F.lit("failed")), DAYS[0])
    jobs.build_global_metrics(spark, lake, DAYS[0], replace=True)
    assert lake.read_mart(spark).collect() == []                             # D13 opt-in


def test_jobs_read_their_source_once(spark, scratch):
    """Each job reads its source in one stage of its plan: what a task counts
    equals the source's rows."""
    lake = jobs.Lake(scratch)
    _, src = _inputs(spark)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    day = src.where(F.col("transaction_dt").cast("date") == DAYS[0])
    jobs.stage_transactions(spark, lake, day.mapInArrow(count, src.schema), DAYS[0])
    assert seen.value == day.count()
    jobs.stage_transactions(spark, lake, src.mapInArrow(count, src.schema), None)
    assert seen.value == day.count() + src.count()


def test_landing_rejects_by_any_order(spark, scratch):
    """Each rejected message is kept once, whatever the order columns are
    called and whether they have values, also when the batch comes again."""
    good = '{"object_id": "a", "object_type": "CURRENCY", "sent_dttm": "2022-10-01 00:00:00", "payload": "{}"}'
    raws = ["{bad", "{worse", None, "{bad", good, "{bad"]

    def rejects(name, rows, schema, order, again=()):
        lake = jobs.Lake(f"{scratch}/{name}")
        df = spark.createDataFrame(rows, schema)
        for batch in (df, df, df.unionByName(spark.createDataFrame(list(again), schema)), df):
            jobs.land(spark, lake, batch, order=order)
        return sorted((r.reason, r.raw or "") for r in lake.read_rejects(spark).collect())

    bad, empty, worse = ("malformed_json", "{bad"), ("empty_value", ""), ("malformed_json", "{worse")
    every = [empty, bad, bad, bad, worse]
    assert rejects("seq", list(enumerate(raws)), "seq long, value string", ["seq"]) == every
    # a time isn't unique: equal messages of one time are one message
    assert rejects("time", [(7, r) for r in raws], "at long, value string", ["at"]) == [empty, bad, worse]
    # no place: as many as the largest batch had
    nulls = [(None, None, r) for r in raws]
    schema = "partition int, offset long, value string"
    assert rejects("nulls", nulls, schema, ["partition", "offset"]) == every
    assert rejects("more", nulls, schema, ["partition", "offset"], [(None, None, "{bad")]) == [empty] + [bad] * 4 + [worse]
    assert rejects("raw", [(i, r, r) for i, r in enumerate(raws)], "stage long, raw string, value string", ["stage"]) == every
    # a message's place in a topic is enough
    assert rejects("topic", [(0, 1, "{bad"), (0, 1, "{bad"), (0, 2, "{bad")], schema, ["partition", "offset"]) == [bad, bad]


def test_a_range_run_keeps_the_rejects_of_other_days(spark, scratch):
    lake = jobs.Lake(scratch)
    src = A.src_transactions_text(spark, SF_SMALL)
    of_day = lambda d: src.where(F.col("transaction_dt").startswith(str(d)))
    whole = [F.col(c).isNotNull() for c in src.columns]
    bad = lambda d: (of_day(d).where(reduce(and_, whole)).orderBy("operation_id").limit(1)
                     .withColumns({"amount": F.lit("x"), "account_number_from": F.lit("1"), "account_number_to": F.lit("2")}))
    kept = lambda: sorted((str(r.run_date), r.reason) for r in lake.read_rejects(spark).collect())
    jobs.stage_transactions(spark, lake, bad(DAYS[0]), DAYS[0])
    jobs.stage_transactions(spark, lake, bad(DAYS[1]), None)                  # a range run over another day
    assert kept() == [(str(DAYS[0]), "bad_amount"), (str(DAYS[1]), "bad_amount")]
    good = bad(DAYS[0]).withColumn("amount", F.lit("5"))
    jobs.stage_transactions(spark, lake, good, None)                          # none of that day now
    assert kept() == [(str(DAYS[1]), "bad_amount")]
    undated = bad(DAYS[0]).withColumn("transaction_dt", F.lit("never"))
    for rows in (undated, undated, bad(DAYS[0]), undated.unionByName(undated)):
        jobs.stage_transactions(spark, lake, rows, None)
    assert kept() == sorted([(str(DAYS[0]), "bad_amount"), (str(DAYS[1]), "bad_amount"), *[("None", "bad_amount")] * 2])


def test_totals_run_on(spark, scratch):
    lake = jobs.Lake(scratch)
    records, src = _inputs(spark)
    out = [jobs.run_day(spark, lake, records, src, d) for d in (*DAYS, DAYS[1])]
    for stage in jobs.STAGES:
        rows = lake.read_totals(spark).where(F.col("stage") == stage).orderBy("run_no").collect()
        assert [r.run_no for r in rows] == [1, 2, 3] and [r.run_date for r in rows] == [*DAYS, DAYS[1]]
        assert [r.written for r in rows] == [o[stage]["written"] for o in out]
        assert rows[-1].total_written == sum(o[stage]["written"] for o in out)
