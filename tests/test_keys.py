"""The key index: exact against a plain anti-join, reads few files, shuffles no keys,
and a landing that failed half way is finished."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from paymart.operators.keys import KeyIndex, _is_set, _words
from paymart.plans import jobs

from .test_jobs import RECORDS, _env


def _keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "object_id string")


def test_known_keys_are_exact(spark, scratch):
    for n, bits in enumerate((1 << 20, 32_768)):            # with a roomy and with a full filter
        index = KeyIndex(f"{scratch}/{n}", shards=4, buckets=2, bits=bits)
        assert not index.exists(spark)
        have = [f"k{i}" for i in range(0, 9000, 2)] + ["", "é", "x" * 1000]
        index.add(_keys(spark, have[:3000]))
        index.add(_keys(spark, have[3000:]))
        index.add(_keys(spark, have[:10]))                  # a repeated batch
        asked = [f"k{i}" for i in range(12_000)] + ["", "é", "ä"]
        got = {r.object_id for r in index.known(_keys(spark, asked)).collect()}
        assert got == set(asked) & set(have)
        assert index.exists(spark)


def test_a_few_keys_read_few_files_and_the_keys_are_not_shuffled(spark, scratch):
    index = KeyIndex(scratch, shards=8, buckets=4)
    index.add(_keys(spark, [f"k{i}" for i in range(5000)]))
    files = index.table(spark).inputFiles()
    assert len(files) == 32
    asked = _keys(spark, ["k17", "new1", "new2"])
    assert [r.object_id for r in index.maybe_known(asked).collect()] == ["k17"]
    known = index.known(asked)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        known.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [(shard" in plan or "shard#" in plan
    read = {f for f in known.inputFiles() if "/keys/" in f}
    assert known.collect()[0].object_id == "k17"
    shard = index.maybe_known(asked).first().shard
    assert {f for f in read if f"shard={shard}/" in f} and shard in range(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            index.known(_keys(spark, [f"k{i}" for i in range(100)])).explain()
        tree = buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the join's side with the keys goes from its scan to the join without an exchange
    keys_side = [part for part in tree.split("+- ") + tree.split(":- ") if "Bucketed: true" in part]
    assert keys_side and "SortMergeJoin" in tree
    scan = tree.index("Bucketed: true")
    above = tree[tree.index("SortMergeJoin"):scan]
    assert above.count("Exchange") == 0 or above.index("Exchange") > above.rfind("Sort [object_id")


def test_a_new_session_finds_the_index(spark, scratch):
    index = KeyIndex(scratch, shards=2, buckets=2)
    index.add(_keys(spark, ["a", "b"]))
    spark.sql(f"DROP TABLE {index._name}")                  # an external table: the files stay
    assert [r.object_id for r in index.known(_keys(spark, ["b", "c"])).collect()] == ["b"]
    index.add(_keys(spark, ["c"]))
    assert sorted(r.object_id for r in index.known(_keys(spark, ["b", "c", "d"])).collect()) == ["b", "c"]


@pytest.mark.parametrize("step", ["index", "landing", "done"])
def test_a_landing_that_failed_is_finished_by_the_next(spark, scratch, monkeypatch, step):
    lake = jobs.Lake(scratch)
    records = lambda *rows: spark.createDataFrame([(0, i, _env(k)) for i, k in rows], RECORDS)
    jobs.land(spark, lake, records((0, "a")))

    def fail(*args, **kw):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        if step == "index":
            m.setattr(KeyIndex, "add", fail)
        else:
            m.setattr(jobs, "append_rows" if step == "landing" else "remove_folder", fail)
        with pytest.raises(OSError):
            jobs.land(spark, lake, records((1, "a"), (2, "b"), (3, "c")))
    out = jobs.land(spark, lake, records((4, "c"), (5, "d")))
    assert out["written"] == 1
    assert sorted(r.object_id for r in lake.read_landing(spark).collect()) == ["a", "b", "c", "d"]
    assert jobs.land(spark, lake, records((1, "a"), (2, "b"), (3, "c"), (4, "d")))["written"] == 0


def test_a_landing_without_an_index_gets_one(spark, scratch):
    lake = jobs.Lake(scratch)
    day = "CURRENCY", None
    old = spark.createDataFrame([("a", "CURRENCY", None, "{}", *day)], jobs.LANDING_STORED)
    jobs.append_rows(old, lake.landing, ["object_class", "sent_date"])
    out = jobs.land(spark, lake, spark.createDataFrame([(0, 1, _env("a")), (0, 2, _env("b"))], RECORDS))
    assert out["written"] == 1


def test_a_bit_of_a_page_is_looked_up_by_arithmetic(spark, scratch):
    index = KeyIndex(scratch, shards=1, buckets=1, bits=32_768)
    bits = [0, 1, 7, 8, 62, 63, 64, 127, 20_000, 32_767]
    page = spark.createDataFrame([(b,) for b in bits], "bit long").agg(F.bitmap_construct_agg("bit").alias("bits"))
    page = page.select(_words("bits").alias("words"))
    found = spark.range(32_768).join(page).where(_is_set("words", F.col("id"))).orderBy("id")
    assert [r.id for r in found.collect()] == bits
    index.add(_keys(spark, ["a", "b"]))
    plan = index.maybe_known(_keys(spark, ["a", "c"]))._jdf.queryExecution().optimizedPlan().toString()
    by_key = plan[:plan.index("\n", plan.index("Join "))]    # the join and its condition
    assert "shiftright(" in by_key or ">>" in by_key, by_key
    assert "forall(" not in by_key and "conv(" not in by_key


def test_the_keys_of_a_batch_are_written_by_more_tasks_than_buckets(spark, scratch):
    index = KeyIndex(scratch, shards=8, buckets=1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index.add(_keys(spark, [f"k{i}" for i in range(2000)]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f.rsplit("/", 1)[1] for f in index.table(spark).inputFiles()]
    assert len(files) == 8                                              # a file a shard and bucket
    assert len({f.split("-")[1] for f in files}) > 1                    # not all by one task


def test_very_many_maybe_known_keys_are_not_joined_by_bucket(spark, scratch, monkeypatch):
    index = KeyIndex(scratch, shards=4, buckets=1)
    index.add(_keys(spark, [f"k{i}" for i in range(0, 600, 2)]))
    asked = _keys(spark, [f"k{i}" for i in range(600)])
    monkeypatch.setattr("paymart.operators.keys.TASK_KEYS", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = index.known(asked)
        plan = known._jdf.queryExecution().toString()
        assert {r.object_id for r in known.collect()} == {f"k{i}" for i in range(0, 600, 2)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("== Physical Plan =="):]
    join = join[join.index("SortMergeJoin"):]
    assert join.count("Exchange hashpartitioning(object_id") == 2 and "SinglePartition" not in join
