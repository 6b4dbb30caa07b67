"""Structured Streaming landing over a growing directory (O01, O43-O47) and
plan checks: pushed filters, broadcast join, partition pruning, no Python
in any plan."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from paymart.operators import mart
from paymart.plans import jobs
from paymart.sources import adapters as A
from paymart.streaming.landing import land_stream, message_stream

from .conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _env(oid, ts="2024-01-05T06:00:00"):
    return f'{{"object_id":"{oid}","object_type":"CURRENCY","sent_dttm":"{ts}","payload":"{{}}"}}'


def _send(spark, topic, messages, start=0):
    """Lines of partition, offset and message."""
    lines = [(f"0\t{start + i}\t{m}",) for i, m in enumerate(messages)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(topic)


def _drain(spark, lake, topic, checkpoint, **how):
    return land_stream(spark, lake, message_stream(spark, "text", path=topic, **how), f"{lake.root}/{checkpoint}")


def _keys(spark, lake):
    return sorted(r.object_id for r in lake.read_landing(spark).collect())


def test_stream_two_drains_and_replay(spark, scratch):
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    _send(spark, topic, [_env("a"), _env("b"), "not json", _env("a", "2024-01-06T06:00:00")])
    assert _drain(spark, lake, topic, "c1")["written"] == 2
    _send(spark, topic, [_env("b", "2024-02-01T00:00:00"), _env("c"), _env("a")], start=4)
    out = _drain(spark, lake, topic, "c1")
    assert out["read"] == 3 and out["written"] == 1                # only what is new is read
    assert _keys(spark, lake) == ["a", "b", "c"]
    assert {r.sent_date for r in lake.read_landing(spark).collect()} == {dt.date(2024, 1, 5)}   # the first ones
    assert _drain(spark, lake, topic, "c1")["read"] == 0           # nothing new
    rej = lake.read_rejects(spark).collect()
    assert [(r.stage, r.reason, r.raw) for r in rej] == [("landing", "malformed_json", "not json")]


def test_a_lost_checkpoint_loses_and_repeats_nothing(spark, scratch):
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    _send(spark, topic, [_env("a"), _env("b"), "junk"])
    _drain(spark, lake, topic, "c1")
    _send(spark, topic, [_env("c"), _env("a", "2024-01-07T00:00:00"), _env("d")], start=3)
    assert _drain(spark, lake, topic, "c2")["written"] == 2        # a fresh checkpoint reads from the start
    assert _keys(spark, lake) == ["a", "b", "c", "d"]
    _send(spark, topic, [_env("e")], start=6)
    assert _drain(spark, lake, topic, "c2")["written"] == 1
    assert lake.read_rejects(spark).count() == 1


def test_a_drain_that_was_not_landed_is_landed_by_the_next(spark, scratch):
    from paymart.streaming.landing import fill_inbox
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    _send(spark, topic, [_env("a")])
    checkpoint = f"{lake.root}/c1"
    fill_inbox(spark, lake, message_stream(spark, "text", path=topic), checkpoint)   # then the job dies
    _send(spark, topic, [_env("b")], start=1)
    _drain(spark, lake, topic, "c1")
    assert _keys(spark, lake) == ["a", "b"]


def test_run_day_drains_a_stream(spark, scratch):
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    A.kafka_records(spark, SF_SMALL).write.parquet(topic)
    day, src = dt.date(2024, 1, 5), A.src_transactions(spark, SF_SMALL)
    stream = lambda: message_stream(spark, "parquet", path=topic)
    first = jobs.run_day(spark, lake, stream(), src, day, checkpoint=f"{lake.root}/c")
    again = jobs.run_day(spark, lake, stream(), src, day, checkpoint=f"{lake.root}/c")
    assert first["landing"]["read"] > 1000 and again["landing"]["read"] == 0
    want = mart.global_metrics(lake.read_transactions(spark), lake.read_currencies(spark), day)
    assert sorted(map(tuple, lake.read_mart(spark).collect())) == sorted(map(tuple, want.collect())) != []


def test_mart_plan_broadcasts_rates_and_has_no_python(spark):
    df = mart.global_metrics(A.stg_transactions(spark, SF_SMALL), A.stg_currencies(spark, SF_SMALL))
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    for py in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert py not in plan


def test_day_predicates_prune_partitions_on_both_mart_inputs(spark, scratch):
    lake = jobs.Lake(scratch)
    jobs.run_day(spark, lake, A.kafka_records(spark, SF_SMALL), A.src_transactions(spark, SF_SMALL),
                 dt.date(2024, 1, 5))
    df = mart.global_metrics(lake.read_transactions(spark), lake.read_currencies(spark), "2024-01-05")
    text = _plan(df)
    assert "(business_date#" in text and "= 2024-01-05)]" in text
    assert "PartitionFilters: [isnotnull(date_update" in text
    assert "EqualTo(status,done)" in text and "EqualTo(currency_code,420)" in text
    assert "LessThan(transaction_dttm,2024-01-06T00:00)" in text
    assert "BroadcastHashJoin" in text


def test_transaction_extract_pushes_day_range(spark):
    from paymart.operators.staging import extract_transactions
    src = A.read_table(spark, SF_SMALL, "events").select(F.col("ts").alias("transaction_dt"), "*")
    plan = _plan(src.where(F.col("transaction_dt").isNotNull()).transform(
        lambda d: d.where(F.col("transaction_dt") >= F.lit("2024-01-05").cast("timestamp_ntz"))))
    assert "PushedFilters" in plan
    df = extract_transactions(A.src_transactions(spark, SF_SMALL), "2024-01-05")
    plan = _plan(df)
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan and "LessThan(ts,2024-01-06T00:00)" in plan


def test_no_python_cartesian_or_nested_loop_in_any_registered_plan(spark):
    from paymart.plans.queries import QUERIES
    for name, q in QUERIES.items():
        plan = _plan(q(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                    "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_hot_keys_are_folded_before_the_shuffle(spark):
    """A key holding most rows moves one row per task: the first aggregate
    below each exchange is a partial one."""
    from paymart.operators import changes
    df = spark.range(0, 1000, numPartitions=4).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS object_id", "0 AS partition", "id AS offset", "'p' AS payload")
    plan = _plan(changes.first_per_key(df, ["object_id"], ["partition", "offset"]))
    assert "partial_min(struct(" in plan
    plan = _plan(mart.global_metrics(A.stg_transactions(spark, SF_SMALL), A.stg_currencies(spark, SF_SMALL)))
    assert "partial_sum(amount_base" in plan and "partial_count(distinct account_number_from" in plan


def test_range_form_target_is_pruned_to_touched_days(spark, scratch):
    """The range-form upsert reads only the partitions of the days the source
    touches: dynamic partition pruning from the broadcast set of days."""
    from paymart.functions import day_of
    from paymart.operators import changes, staging
    lake = jobs.Lake(scratch)
    jobs.stage_transactions(spark, lake, A.src_transactions(spark, SF_SMALL), None)
    src = A.src_transactions(spark, SF_SMALL).where(F.col("transaction_dt") < F.lit("2024-01-03").cast("timestamp_ntz"))
    source = staging.conform_transactions(src)
    days = F.broadcast(source.select(day_of("transaction_dttm").alias("business_date")).distinct())
    target = lake.read_transactions(spark).join(days, "business_date", "left_semi")
    plan = _plan(changes.upsert(target.drop("business_date"), source, ["operation_id", "transaction_dttm"]))
    assert "dynamicpruningexpression(business_date" in plan


def test_micro_batches_of_one_drain(spark, scratch):
    """maxFilesPerTrigger=1 splits one drain into several micro-batches; a key
    repeated in later files is still written once."""
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    for n, keys in enumerate((["a", "b"], ["b", "c"], ["a", "c", "d"])):
        _send(spark, topic, [_env(k) for k in keys], start=10 * n)
    _drain(spark, lake, topic, "c1", max_per_trigger=1)
    assert _keys(spark, lake) == ["a", "b", "c", "d"]


def test_parameterised_query_prunes_both_tables(spark, scratch):
    lake = jobs.Lake(scratch)
    jobs.run_day(spark, lake, A.kafka_records(spark, SF_SMALL), A.src_transactions(spark, SF_SMALL), dt.date(2024, 1, 5))
    df = mart.global_metrics_sql(spark, lake.read_transactions(spark), lake.read_currencies(spark), "2024-01-05")
    plan = _plan(df)
    assert plan.count("= 2024-01-05)]") >= 2 and "business_date" in plan
    want = mart.global_metrics(lake.read_transactions(spark), lake.read_currencies(spark), "2024-01-05")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


def test_table_functions_prune_both_tables(spark, scratch):
    lake, day = jobs.Lake(scratch), dt.date(2024, 1, 5)
    lake.stg_currencies.replace(A.stg_currencies(spark, SF_SMALL))
    jobs.stage_transactions(spark, lake, A.src_transactions(spark, SF_SMALL), None)
    mart.mart_functions(lake.read_transactions(spark), lake.read_currencies(spark))
    df = mart.global_metrics_of(spark, day)
    plan = _plan(df)
    assert "(business_date#" in plan and plan.count("= 2024-01-05)]") >= 2
    want = mart.global_metrics(lake.read_transactions(spark), lake.read_currencies(spark), day)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect())) != []


def test_insert_ignore_folds_once_and_joins_once(spark):
    """Besides the fold's own shuffle, at most two more for the join."""
    from paymart.operators import changes
    new = spark.range(1000).selectExpr("CAST(id AS STRING) AS object_id", "id AS offset", "'p' AS payload")
    table = spark.range(500).selectExpr("CAST(id AS STRING) AS object_id")
    plan = _plan(changes.insert_ignore(table, new, ["object_id"], ["offset"]))
    tree = plan[:plan.index("\n\n")]
    assert tree.count("Exchange") <= 3 and tree.count("Join") == 1


def test_source_reader_pushes_the_day(spark, scratch):
    from paymart.sources.transactions import read_transactions
    path = f"{scratch}/src"
    A.src_transactions(spark, SF_SMALL).write.parquet(path)
    df = read_transactions(spark, "parquet", path=path, day="2024-01-05")
    assert "LessThan(transaction_dt,2024-01-06T00:00)" in _plan(df) and df.count() > 0
