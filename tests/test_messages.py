"""Envelope and rate payload decoding on hand-made edge rows (FIXTURES 3.1, 3.2)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from paymart.operators import messages

ENV = '{{"object_id":{oid},"object_type":"CURRENCY","sent_dttm":{ts},"payload":{p}}}'


def env(oid='"a"', ts='"2022-10-01T06:00:00"', p='"{}"'):
    return ENV.format(oid=oid, ts=ts, p=p)


def _records(spark, values):
    schema = T.StructType([T.StructField("offset", T.LongType()), T.StructField("value", T.StringType())])
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], schema)


def _checked(spark, values):
    rows = messages.envelope_checked(_records(spark, values), keep=["offset"]).collect()
    return {r.offset: r for r in rows}


def test_envelope_edge_rows(spark):
    values = [
        env(),                                                    # 0 well formed
        env(p='{"a":1, "b":1.50}'),                               # 1 payload as an object
        env(ts='"not a time"'),                                   # 2 bad sent_dttm
        '{"object_id"="x"}',                                      # 3 broken JSON
        '{"object_id":"x","object_type":"CUR',                    # 4 cut-off JSON
        "plain text",                                             # 5
        "",                                                       # 6 empty
        "   ",                                                    # 7 blank
        None,                                                     # 8 null value
        '{"object_type":"CURRENCY"}',                             # 9 no object_id
        '{"OBJECT_ID":"x"}',                                      # 10 keys are case-sensitive
        env(oid="42"),                                            # 11 numeric object_id
        env(oid='""'),                                            # 12 empty object_id
        '{"object_id":"a","extra":1}',                            # 13 extra key
        env(ts='"2022-10-01T23:30:00+03:00"'),                    # 14 offset -> UTC
        env(ts='"2022-10-01 05:06:07.123456"'),                   # 15 microseconds
        env(ts="1664582400"),                                     # 16 epoch seconds
    ]
    c = _checked(spark, values)
    assert c[0].reason is None and c[0].object_id == "a" and c[0].payload == "{}"
    assert c[0].sent_dttm == dt.datetime(2022, 10, 1, 6, 0)
    assert c[1].reason is None and c[1].payload.replace(" ", "") in ('{"a":1,"b":1.5}', '{"a":1,"b":1.50}')
    assert c[2].reason is None and c[2].sent_dttm is None                       # D1: kept, null time
    for i in (3, 4, 5):
        assert c[i].reason in ("malformed_json", "missing_object_id"), i
    for i in (6, 7, 8):
        assert c[i].reason == "empty_value", i
    assert c[9].reason == "missing_object_id"
    assert c[10].reason == "missing_object_id"
    assert c[11].reason is None and c[11].object_id == "42"
    assert c[12].reason is None and c[12].object_id == ""
    assert c[13].reason is None
    assert c[14].sent_dttm == dt.datetime(2022, 10, 1, 20, 30)                  # D7
    assert c[15].sent_dttm == dt.datetime(2022, 10, 1, 5, 6, 7, 123456)
    assert c[16].sent_dttm == dt.datetime(2022, 10, 1, 0, 0)


def test_decode_and_rejects_split_all_rows(spark):
    values = [env(), "junk", None, env(oid='"b"')]
    recs = _records(spark, values)
    assert messages.decode_envelope(recs).count() == 2
    rej = messages.envelope_rejects(recs, dt.date(2024, 1, 5)).collect()
    assert len(rej) == 2
    assert {r.stage for r in rej} == {"landing"}
    assert {r.run_date for r in rej} == {dt.date(2024, 1, 5)}


def _payloads(spark, payloads):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("payload", T.StringType())])
    df = spark.createDataFrame(list(enumerate(payloads)), schema)
    return {r.k: r for r in messages.rates_checked(df, keep=["k"]).collect()}


def test_rate_payload_edge_rows(spark):
    p = _payloads(spark, [
        '{"date_update":"2024-01-05","currency_code":420,"currency_code_with":"416","currency_with_div":0.98}',
        '{"date_update":"2024-01-05","currency_code":"420","currency_code_with":null,"currency_with_div":"1"}',
        '{"date_update":"2024-01-05","currency_code":"420","currency_code_with":"416"}',
        '{"date_update":"","currency_code":"","currency_code_with":"","currency_with_div":""}',
        '{"date_update":"2024-01-05","currency_code":"420","currency_code_with":"416","currency_with_div":0}',
        '{"date_update":"2024-01-05","currency_code":"420","currency_code_with":"416","currency_with_div":"1e-2"}',
        '{"date_update":"2024-01-05",',
        None,
        '{"date_update":"2024-01-05","currency_code":"420","currency_code_with":"416","currency_with_div":"x"}',
    ])
    assert p[0].reason is None and p[0].currency_code == "420" and p[0].currency_code_div == Decimal("0.980000")
    assert p[0].date_update == dt.date(2024, 1, 5)
    assert p[1].reason == "missing_currency_code_with"
    assert p[2].reason == "missing_currency_with_div"
    assert p[3].reason == "bad_date_update"                  # empty strings pass the null test (D9)
    assert p[4].reason is None and p[4].currency_code_div == Decimal("0")
    assert p[5].reason is None and p[5].currency_code_div == Decimal("0.010000")
    assert p[6].reason == "malformed_payload"
    assert p[7].reason == "missing_payload"
    assert p[8].reason == "bad_currency_with_div"


def test_currency_messages_day_filter(spark):
    schema = "object_id string, object_type string, sent_dttm timestamp_ntz, payload string"
    df = spark.createDataFrame([
        ("a", "CURRENCY", dt.datetime(2024, 1, 5, 23, 59, 59, 999999), "{}"),
        ("b", "CURRENCY", dt.datetime(2024, 1, 6, 0, 0), "{}"),
        ("c", "TRANSACTION", dt.datetime(2024, 1, 5, 6, 0), "{}"),
        ("d", "CURRENCY", None, "{}"),
    ], schema)
    got = {r.object_id for r in messages.currency_messages(df, "2024-01-05").collect()}
    assert got == {"a"}
    assert {r.object_id for r in messages.currency_messages(df).collect()} == {"a", "b", "d"}


def test_times_by_the_kind_of_their_value(spark):
    def one(ts, rest=""):
        return f'{{"object_id":"a","payload":{{"sent_dttm":"x"}},"sent_dttm":{ts}{rest}}}'

    day = dt.datetime(2022, 10, 1)
    cases = [(one("1664582400"), day),                                    # a quoted time inside the payload
             (one('"1664582400"'), None),
             (one("1664582400000"), None),                                # milliseconds: year 54718
             (one("1664582400.25"), dt.datetime(2022, 10, 1, 0, 0, 0, 250000)),
             (one("1.6645824e9"), day),
             (one("true"), None), (one("null"), None), (one("{}"), None), (one("[1]"), None),
             (one("-62135596800"), dt.datetime(1, 1, 1)), (one("-62135596801"), None),
             (one("253402300799"), dt.datetime(9999, 12, 31, 23, 59, 59)), (one("253402300800"), None),
             (one("1e300"), None), (one("123456789012345678901234567890"), None),
             (one('"9999-12-31T23:00:00-05:00"'), None), (one('"0000-05-05T00:00:00"'), None),
             (one('"+54718-01-01T00:00:00"'), None), (one('" 2022-10-01 "'), day), (one('"10:30:00-05"'), None),
             (one('"2022"'), None), (one('"2022-10"'), day), (one('"ab12-10-01"'), None),
             (one("1664582400", ',"new_key":{"sent_dttm":"2020-01-01"}'), day)]
    got = _checked(spark, [c for c, _ in cases])
    assert [(cases[i][0], got[i].sent_dttm) for i in range(len(cases))] == cases
    assert all(r.reason is None and r.payload == '{"sent_dttm":"x"}' for r in got.values())
