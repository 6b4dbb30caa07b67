"""insert-ignore, replace by date and upsert."""

import datetime as dt

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paymart.operators import changes

KV = "k string, d date, v bigint"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_per_key_is_deterministic_and_first(spark):
    df = spark.createDataFrame(
        [("a", 0, 5, "late"), ("a", 0, 2, "first"), ("a", 1, 0, "other partition"), ("b", 0, 9, "only")],
        "object_id string, partition int, offset bigint, payload string")
    got = {r.object_id: r.payload for r in
           changes.first_per_key(df, ["object_id"], ["partition", "offset"]).collect()}
    assert got == {"a": "first", "b": "only"}


def test_first_per_key_hot_key(spark):
    # one key holding most rows: folded per task before the shuffle
    df = spark.range(0, 20000, numPartitions=8).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 'hot' ELSE CAST(id AS STRING) END AS object_id",
        "0 AS partition", "20000 - id AS offset", "CAST(id AS STRING) AS payload")
    out = changes.first_per_key(df, ["object_id"], ["partition", "offset"])
    hot = out.where("object_id = 'hot'").collect()
    assert len(hot) == 1 and hot[0].payload == "19996"   # largest hot id, smallest offset
    assert out.count() == 1 + 6000


def test_insert_ignore_first_writer_wins_and_replay_adds_nothing(spark):
    existing = spark.createDataFrame([("a", 0, 1, "old")], "object_id string, partition int, offset bigint, payload string")
    new = spark.createDataFrame([("a", 0, 7, "new"), ("b", 0, 9, "b2"), ("b", 0, 8, "b1")],
                                "object_id string, partition int, offset bigint, payload string")
    add = changes.insert_ignore(existing, new, ["object_id"], ["partition", "offset"])
    assert [(r.object_id, r.payload) for r in add.collect()] == [("b", "b1")]
    table = existing.unionByName(add)
    assert changes.insert_ignore(table, new, ["object_id"], ["partition", "offset"]).count() == 0


def test_replace_by_date(spark):
    old = spark.createDataFrame([("x", dt.date(2024, 1, 1), 1), ("y", dt.date(2024, 1, 2), 2)], KV)
    new = spark.createDataFrame([("z", dt.date(2024, 1, 2), 3)], KV)
    once = changes.replace_by_date(old, new, "d")
    assert _rows(once) == [("x", dt.date(2024, 1, 1), 1), ("z", dt.date(2024, 1, 2), 3)]
    assert _rows(changes.replace_by_date(once, new, "d")) == _rows(once)          # twice = once
    empty = spark.createDataFrame([], KV)
    assert _rows(changes.replace_by_date(old, empty, "d")) == _rows(old)          # D3


def test_check_unique(spark):
    ok = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), (None, dt.date(2024, 1, 1), 2),
                                (None, dt.date(2024, 1, 1), 3)], KV)
    changes.check_unique(ok, ["k", "d"])                     # null keys never collide
    bad = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 1, 1), 2)], KV)
    with pytest.raises(changes.DuplicateKeyError):
        changes.check_unique(bad, ["k", "d"])
    latest = changes.latest_per_key(bad, ["k", "d"], ["v"]).collect()
    assert [r.v for r in latest] == [2]


def _duck_merge(target, source):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, d DATE, v BIGINT)")
    con.execute("CREATE TABLE s (k VARCHAR, d DATE, v BIGINT)")
    if target:
        con.executemany("INSERT INTO t VALUES (?, ?, ?)", target)
    if source:
        con.executemany("INSERT INTO s VALUES (?, ?, ?)", source)
    con.execute("""MERGE INTO t USING s ON t.k = s.k AND t.d = s.d
                   WHEN MATCHED THEN UPDATE SET v = s.v
                   WHEN NOT MATCHED THEN INSERT (k, d, v) VALUES (s.k, s.d, s.v)""")
    return sorted(con.execute("SELECT * FROM t").fetchall(), key=repr)


_key = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([dt.date(2024, 1, 1), dt.date(2024, 1, 2)]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_key, st.integers(0, 9)), max_size=6, unique_by=lambda x: x[0]),
       st.lists(st.tuples(_key, st.integers(10, 19)), max_size=6, unique_by=lambda x: x[0]))
def test_upsert_equals_merge(spark, target, source):
    # keys unique per side (D5 is checked separately); null keys allowed
    tgt = [(k, d, v) for (k, d), v in target]
    src = [(k, d, v) for (k, d), v in source]
    got = changes.upsert(spark.createDataFrame(tgt, KV), spark.createDataFrame(src, KV), ["k", "d"])
    assert sorted([tuple(r) for r in got.collect()], key=repr) == _duck_merge(tgt, src)


def test_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 1, 1), 2)], KV)
    s = spark.createDataFrame([("b", dt.date(2024, 1, 1), 20), ("c", dt.date(2024, 1, 1), 30)], KV)
    once = changes.upsert(t, s, ["k", "d"])
    assert _rows(changes.upsert(once, s, ["k", "d"])) == _rows(once)


def test_read_partition_and_missing_tables(spark, scratch):
    path = f"{scratch}/t"
    assert changes.read_table(spark, path, spark.createDataFrame([], KV).schema).count() == 0
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 1, 2), 2)], KV)
    changes.write_days(df, path, ["d"])
    one = changes.read_partition(spark, path, df.schema, {"d": dt.date(2024, 1, 2)})
    assert one.columns == ["k", "d", "v"] and [tuple(r) for r in one.collect()] == [("b", dt.date(2024, 1, 2), 2)]
    assert changes.read_partition(spark, path, df.schema, {"d": dt.date(2030, 1, 1)}).count() == 0
    # a second write of one day replaces that day only
    changes.write_days(spark.createDataFrame([("c", dt.date(2024, 1, 2), 3)], KV), path, ["d"])
    assert _rows(changes.read_table(spark, path, df.schema)) == [("a", dt.date(2024, 1, 1), 1),
                                                                 ("c", dt.date(2024, 1, 2), 3)]


def test_first_and_latest_need_a_declared_order(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    for pick in (changes.first_per_key, changes.latest_per_key):
        for order in ([], ["arrival"]):
            with pytest.raises(changes.MissingOrderError):
                pick(df, ["k"], order)


def test_upsert_never_matches_a_null_key(spark):
    target = spark.createDataFrame([(None, 1), (2, 1)], "k int, v int")
    source = spark.createDataFrame([(None, 9), (2, 9)], "k int, v int")
    assert sorted(map(tuple, changes.upsert(target, source, ["k"]).collect()), key=str) == [(2, 9), (None, 1), (None, 9)]


def test_replace_day_drops_groups_that_went(spark):
    import datetime as dt
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    target = spark.createDataFrame([(d1, "a"), (d1, "b"), (d2, "a"), (None, "c")], "d date, k string")
    source = spark.createDataFrame([(d1, "a"), (d2, "z")], "d date, k string")
    got = changes.replace_day(target, source, "d", d1).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(d1, "a"), (d2, "a"), (None, "c")], key=str)


def test_dedupe_rates_keeps_one_per_pair(spark):
    from paymart.operators import quality
    df = spark.createDataFrame([("d", "420", "416", 2), ("d", "420", "416", 1), ("d", "420", "417", 3)],
                               "date_update string, currency_code string, currency_code_with string, currency_code_div int")
    assert sorted(r.currency_code_div for r in quality.dedupe_rates(df).collect()) == [1, 3]
