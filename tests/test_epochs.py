"""The per-micro-batch sink (O44, O46) and the micro-batches' figures."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.operators import changes, messages
from paymart.plans import jobs, queries
from paymart.session import list_folder
from paymart.sources import adapters
from paymart.streaming.epochs import EpochWriter, Written, each_epoch, epochs, land_epochs, write_epochs
from paymart.streaming.landing import message_stream

from .test_streaming_plans import _drain, _env, _keys, _send

ROW = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])


def _stream(spark, topic):
    return message_stream(spark, "text", path=topic, max_per_trigger=1)


def test_one_call_per_micro_batch_in_order(spark, scratch):
    topic, folder = f"{scratch}/topic", f"{scratch}/epochs"
    for n in range(3):
        _send(spark, topic, [_env(f"{n}-{i}") for i in range(n + 1)], start=10 * n)
    write_epochs(spark, _stream(spark, topic).select(*ROW.fieldNames()), folder, f"{scratch}/cp")
    assert [(r.epoch, r.rows) for r in epochs(spark, folder).orderBy("epoch").collect()] == [(0, 1), (1, 2), (2, 3)]
    seen = []

    def fails_at_1(rows, epoch):
        if epoch == 1 and len(seen) == 1:
            raise OSError("down")
        seen.append((epoch, sorted(r.offset for r in rows.collect())))

    with pytest.raises(OSError):
        each_epoch(spark, folder, ROW, fails_at_1)
    fails = seen.copy()
    seen.append(None)                                       # the next run does not fail
    each_epoch(spark, folder, ROW, fails_at_1)
    assert fails == [(0, [0])] and seen[2:] == [(1, [10, 11]), (2, [20, 21, 22])]
    assert each_epoch(spark, folder, ROW, fails_at_1) == []
    _send(spark, topic, [_env("x")], start=40)
    write_epochs(spark, _stream(spark, topic).select(*ROW.fieldNames()), folder, f"{scratch}/cp")
    assert [e["epoch"] for e in each_epoch(spark, folder, ROW, fails_at_1)] == [3]


def test_an_epoch_that_comes_twice_stays_as_it_was(spark, scratch):
    import pyarrow as pa

    writer = EpochWriter(f"file://{scratch}")
    batch = lambda n: pa.RecordBatch.from_pydict({"partition": pa.array([0], pa.int32()), "offset": pa.array([n])})
    writer.commit([writer.write(iter([batch(1)])), writer.write(iter([])), None], 0)
    writer.commit([writer.write(iter([batch(1)])), writer.write(iter([batch(2)]))], 0)     # delivered again
    writer.abort([writer.write(iter([batch(3)]))], 1)
    writer.write(iter([batch(4)]))                                                         # its task's stage failed
    writer.commit([Written(None, 0)], 1)                                                   # empty
    got = each_epoch(spark, scratch, ROW, lambda rows, epoch: [r.offset for r in rows.collect()])
    assert [(e["epoch"], e["rows"], e["result"]) for e in got] == [(0, 1, [1]), (1, 0, [])]
    assert len(list_folder(spark, f"{scratch}/data")) == 2


def test_a_replay_lands_once(spark, scratch):
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    _send(spark, topic, [_env("a"), _env("b"), "junk"])
    _send(spark, topic, [_env("b", "2024-02-01T00:00:00"), _env("c")], start=3)
    first = land_epochs(spark, lake, _stream(spark, topic), f"{scratch}/epochs", f"{scratch}/cp")
    assert [e["result"]["written"] for e in first] == [2, 1]
    again = land_epochs(spark, lake, _stream(spark, topic), f"{scratch}/epochs2", f"{scratch}/cp2")  # all again
    assert [e["result"]["written"] for e in again] == [0, 0]
    assert _keys(spark, lake) == ["a", "b", "c"] and lake.read_rejects(spark).count() == 1


def test_figures_of_each_micro_batch(spark, scratch):
    lake, topic = jobs.Lake(f"{scratch}/lake"), f"{scratch}/topic"
    for n, keys in enumerate((["a", "b"], ["c"], [])):
        _send(spark, topic, [_env(k) for k in keys], start=10 * n)
    out = _drain(spark, lake, topic, "c1", max_per_trigger=1)
    batches = out["batches"]
    assert sum(b["messages"] for b in batches) == out["read"] == 3
    assert 0 in [b["messages"] for b in batches] and [b["batch"] for b in batches] == list(range(len(batches)))
    assert not list_folder(spark, f"{lake.root}/inbox") or all(
        not list_folder(spark, f"{lake.root}/inbox/{n}") for n in list_folder(spark, f"{lake.root}/inbox"))


def test_each_part_of_the_stream_is_written_by_many_tasks(spark, scratch, monkeypatch):
    types = ("error", "signup", "click")
    ev = spark.range(0, 600, numPartitions=4).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:30:00' + make_dt_interval(int(id % 30), int(id % 23))").alias("ts"),
        (F.col("id") % 40).alias("user_id"), F.element_at(F.array(*map(F.lit, types)), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        (F.col("id") / 7).alias("value"))
    # the same key again in each part, with offsets that fall as the parts go on
    again = ev.where("event_id < 60").select((F.col("event_id") % 2).alias("event_id"), "ts", "user_id", "event_type", "value")
    ev.unionByName(again).write.parquet(f"{scratch}/events.parquet")
    spark.range(0, 25, numPartitions=1).selectExpr("id n_nationkey", "concat('N', id) n_name").write.parquet(f"{scratch}/nation.parquet")
    monkeypatch.setattr(queries, "work_dir", lambda spark, name: f"{scratch}/lake")
    got = queries.q_landing_micro_batches(spark, scratch)

    ends = [F.lit(t).cast("timestamp") for t in queries.EPOCH_ENDS]
    epoch = F.when(F.col("timestamp") < ends[0], 0).when(F.col("timestamp") < ends[1], 1).otherwise(2)
    sent = adapters.kafka_records(spark, scratch).withColumn("epoch", epoch)
    keep = ["epoch", "partition", "offset"]
    want = changes.first_per_key(messages.decode_envelope(sent, keep=keep), ["object_id"], keep)
    rows = lambda df: sorted(map(tuple, df.select(*queries.LANDING_COLUMNS).collect()), key=repr)
    assert rows(got) == rows(want) and len(rows(got)) > 600
    assert [(r.epoch, r.rows) for r in epochs(spark, f"{scratch}/lake/epochs").orderBy("epoch").collect()] == [
        (r.epoch, r["count"]) for r in sent.groupBy("epoch").count().orderBy("epoch").collect()]
    tasks = [int(n.split("-")[1]) for n in list_folder(spark, f"{scratch}/lake/topic") if n.startswith("part-")]
    assert len(tasks) > 6 and max(tasks) > 1                # was: three files, each by one task that read all
