"""Adapters: the load's input tables, derived by Spark from the driver's
tables (``events`` and ``nation``), so their size grows with the data.

Each Spark adapter has a DuckDB twin in ``ORACLE_CTES`` (same rows, same
types) that the oracle queries build on.

Fixed values of the adapters (made up for the test data, except the base
currency 420, status ``done`` and type ``authorisation`` of the load itself):

* transaction currencies: 416, 417, 418, 419, 420 (``416 + event_id % 5``)
* rate rows per day: k = 0..9; base ``420`` for k < 5 else ``430``;
  quoted currency ``415 + k % 5``; rate ``(100 + k) / 100``
* rate message k = 8 is broken JSON, k = 9 lacks ``currency_with_div``
* status ``failed`` for event type ``error``, else ``done``;
  type ``authorisation`` for event type ``signup``
* transaction messages of ``error`` events are sent twice; the second, with the
  larger offset, differs (status ``replayed``)
* every 20th event has one more message on partition 2, each with one fault or
  peculiarity (``ODD_KINDS``)
* the text-typed source has a fault in every 10th row (``TEXT_FAULTS``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.functions import day_of, to_millis
from paymart.schemas import RATE_DECIMAL

RATE_SLOTS = 10
BROKEN_RATE_SLOT = 8
NO_DIV_RATE_SLOT = 9


# One peculiarity per message of partition 2, by (event_id / 20) % their number.
ODD_KINDS = ("null_value", "blank_value", "no_object_id", "bad_time", "offset_time", "epoch_time", "quoted_digits",
             "empty_type", "null_payload", "bad_payload", "bad_date", "bad_rate", "no_date", "no_code", "no_quoted_code",
             "nested_time", "epoch_millis")
ODD_EVERY = 20
# One fault per faulty row of the text-typed source: column and its text.
TEXT_FAULTS = (("operation_id", None), ("account_number_from", "x"), ("account_number_to", ""), ("currency_code", None),
               ("status", None), ("transaction_type", None), ("amount", "12.5x"), ("transaction_dt", "never"),
               ("amount", None), ("account_number_from", None), ("account_number_to", None), ("transaction_dt", None))
TEXT_FAULT_EVERY = 10

_LOADED: dict[tuple[int, str], DataFrame] = {}


def _memo(build):
    """Define an adapter once per session and input folder: its plan is
    analysed once and later queries reuse the same (lazy) DataFrame."""
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (id(spark), f"{build.__name__}:{sf_dir.rstrip('/')}")
        df = _LOADED.get(key)
        if df is None or df.sparkSession is not spark:
            df = _LOADED[key] = build(spark, sf_dir)
        return df
    wrapper.__name__ = build.__name__
    wrapper.__doc__ = build.__doc__
    return wrapper


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's read-only input tables. The loaded DataFrame is
    kept per session and path, so its file listing and footer read happen
    once and every adapter reading it shares one relation."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _LOADED.get(key)
    if df is None or df.sparkSession is not spark:
        df = _LOADED[key] = spark.read.parquet(path)
    return df


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names by a bigint key, one row per key. Spark's size check
    broadcasts it; because the key is unique, Catalyst drops the outer join
    altogether when no nation column is used (as in the mart)."""
    return (read_table(spark, sf_dir, "nation")
            .select(F.col("n_nationkey").cast("bigint").alias("nation_key"), "n_name")
            .groupBy("nation_key").agg(F.min("n_name").alias("n_name")))


def _with_nation(spark: SparkSession, sf_dir: str, ev: DataFrame, modulus: int,
                 unique: bool = True) -> DataFrame:
    """Left join of nation names on ``user_id % modulus``. ``unique=False``
    skips the aggregate that proves the key unique (for callers that use the
    name anyway, so the join can never be dropped)."""
    ev = ev.withColumn("nation_key", F.col("user_id") % modulus)
    nation = _nation(spark, sf_dir) if unique else (
        read_table(spark, sf_dir, "nation")
        .select(F.col("n_nationkey").cast("bigint").alias("nation_key"), "n_name"))
    return ev.join(nation, "nation_key", "left")


def _tx_columns(ts: Column) -> list[Column]:
    e = F.col
    return [
        e("event_id").cast("string").alias("operation_id"),
        e("user_id").alias("account_number_from"),
        (e("user_id") + 1).alias("account_number_to"),
        (F.lit(416) + e("event_id") % 5).cast("string").alias("currency_code"),
        e("n_name").alias("country"),
        F.when(e("event_type") == "error", F.lit("failed")).otherwise(F.lit("done")).alias("status"),
        F.when(e("event_type") == "signup", F.lit("authorisation"))
         .otherwise(e("event_type")).alias("transaction_type"),
        F.round(e("value") * 100).cast("bigint").alias("amount"),
        ts,
    ]


@_memo
def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged transactions (``STAGING.transactions`` shape), one per event."""
    j = _with_nation(spark, sf_dir, read_table(spark, sf_dir, "events"), 25)
    return j.select(*_tx_columns(to_millis("ts").alias("transaction_dttm")))


@_memo
def src_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source transactions (``public.transactions`` shape): microsecond times,
    and no nation for user keys 25 and 26 of ``user_id % 27`` (null country,
    so the required-field check has rows to reject)."""
    j = _with_nation(spark, sf_dir, read_table(spark, sf_dir, "events"), 27)
    return j.select(*_tx_columns(F.col("ts").alias("transaction_dt")))


def _rate_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last event day x rate slots k
    (generators over one global aggregate, not a join)."""
    span = read_table(spark, sf_dir, "events").agg(F.min(day_of("ts")).alias("lo"),
                                                   F.max(day_of("ts")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_update"))
    return days.select("date_update", F.explode(F.sequence(F.lit(0), F.lit(RATE_SLOTS - 1))).alias("k"))


def _rate_values(k: Column) -> tuple[Column, Column, Column]:
    code = F.when(k < 5, F.lit("420")).otherwise(F.lit("430"))
    code_with = (F.lit(415) + k % 5).cast("string")
    div = ((F.lit(100) + k).cast(RATE_DECIMAL) / F.lit(100)).cast(RATE_DECIMAL)
    return code, code_with, div


@_memo
def stg_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rates (``STAGING.currencies`` shape)."""
    s = _rate_slots(spark, sf_dir)
    code, code_with, div = _rate_values(F.col("k"))
    return s.select("date_update", code.alias("currency_code"),
                    code_with.alias("currency_code_with"), div.alias("currency_code_div"))


def _json_text(c: Column) -> Column:
    """Escape a text for use inside a JSON string (the adapters only need
    quotes escaped)."""
    return F.replace(c, F.lit('"'), F.lit('\\"'))


def _envelope(object_id: Column, object_type: Column, sent: Column, payload: Column) -> Column:
    return F.concat(F.lit('{"object_id":"'), object_id, F.lit('","object_type":"'), object_type,
                    F.lit('","sent_dttm":"'), sent, F.lit('","payload":"'), _json_text(payload),
                    F.lit('"}'))


@_memo
def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message stream records as a Kafka source gives them:
    ``partition int, offset bigint, timestamp timestamp, value binary``.

    Partition 0 carries one rate message per (day, k); partition 1 one
    transaction message per event, and right after those of ``error`` events a
    replay that differs from them; partition 2 the odd messages (``ODD_KINDS``).
    """
    s = _rate_slots(spark, sf_dir)
    k = F.col("k")
    code, code_with, _ = _rate_values(k)
    day_text = F.col("date_update").cast("string")
    div_text = ((F.lit(100) + k) / F.lit(100)).cast(T.DecimalType(5, 2)).cast("string")
    payload = F.concat(
        F.lit('{"date_update":"'), day_text, F.lit('","currency_code":'), code,
        F.lit(',"currency_code_with":"'), code_with, F.lit('"'),
        F.when(k == NO_DIV_RATE_SLOT, F.lit("")).otherwise(F.concat(F.lit(',"currency_with_div":'), div_text)),
        F.lit("}"))
    object_id = F.concat(day_text, F.lit("/"), k.cast("string"))
    env = _envelope(object_id, F.lit("CURRENCY"), F.concat(day_text, F.lit("T06:00:00")), payload)
    # broken JSON: '=' instead of the first ':'
    s = s.withColumn("env", env)
    env = (F.when(k == BROKEN_RATE_SLOT, F.concat(F.lit('{"object_id"='), F.expr("substring(env, 14)")))
           .otherwise(F.col("env")))
    rates = s.select(
        F.lit(0).alias("partition"),
        (F.unix_date(F.col("date_update")).cast("bigint") * RATE_SLOTS + k).alias("offset"),
        F.concat(day_text, F.lit(" 06:00:00")).cast(T.TimestampType()).alias("timestamp"),
        env.alias("value"))

    ev = read_table(spark, sf_dir, "events")
    tx = _with_nation(spark, sf_dir, ev, 25, unique=False)
    # copy 0 is the original; messages of error events get copy 1, a differing
    # replay right after it (one scan of events, no self-union)
    copies = F.when(F.col("event_type") == "error", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    t = tx.select("event_id", "event_type", "ts", *_tx_columns(F.col("ts").alias("transaction_dt")),
                  F.explode(copies).alias("copy"))
    ts_text = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    status = F.when(F.col("copy") == 1, F.lit("replayed")).otherwise(F.col("status"))
    tx_payload = F.concat(
        F.lit('{"operation_id":"'), F.col("operation_id"),
        F.lit('","account_number_from":'), F.col("account_number_from").cast("string"),
        F.lit(',"account_number_to":'), F.col("account_number_to").cast("string"),
        F.lit(',"currency_code":"'), F.col("currency_code"),
        F.lit('","country":"'), F.col("country"),
        F.lit('","status":"'), status,
        F.lit('","transaction_type":"'), F.col("transaction_type"),
        F.lit('","amount":'), F.col("amount").cast("string"),
        F.lit(',"transaction_dt":"'), ts_text, F.lit('"}'))
    txm = t.select(
        F.lit(1).alias("partition"),
        (F.col("event_id") * 2 + F.col("copy")).alias("offset"),
        (F.col("ts").cast(T.TimestampType()) + F.make_dt_interval(secs=F.col("copy"))).alias("timestamp"),
        _envelope(F.col("operation_id"), F.lit("TRANSACTION"), ts_text, tx_payload).alias("value"))
    odd = ev.where(F.col("event_id") % ODD_EVERY == 0).select(
        F.lit(2).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast(T.TimestampType()).alias("timestamp"),
        _odd_value().alias("value"))
    records = rates.unionByName(txm).unionByName(odd)
    return records.select("partition", "offset", "timestamp", F.col("value").cast("binary").alias("value"))


def _odd_value() -> Column:
    """The text of the message with the event's peculiarity."""
    kind = F.element_at(F.array(*map(F.lit, ODD_KINDS)),
                        ((F.col("event_id") / ODD_EVERY).cast("int") % len(ODD_KINDS)) + 1)
    day = F.col("ts").cast("date").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    sent = (F.when(kind == "bad_time", F.lit('"soon"'))
            .when(kind == "offset_time", quoted(F.concat(day, F.lit("T01:30:00+03:00"))))
            .when(kind.isin("epoch_time", "nested_time"), F.lit("1704067200"))
            .when(kind == "epoch_millis", F.lit("1704067200000"))
            .when(kind == "quoted_digits", F.lit('"1704067200"'))
            .otherwise(quoted(F.concat(day, F.lit("T07:00:00")))))
    parts = [(F.when(kind == "bad_date", F.lit("someday")).otherwise(day), "date_update", "no_date"),
             (F.lit("430"), "currency_code", "no_code"), (F.lit("416"), "currency_code_with", "no_quoted_code"),
             (F.when(kind == "bad_rate", F.lit("1,5")).otherwise(F.lit("1.5")), "currency_with_div", "")]
    payload = F.concat(*[F.when(kind == without, F.lit("")).otherwise(
        F.concat(F.lit(f'\\"{name}\\":\\"'), value, F.lit('\\",'))) for value, name, without in parts])
    payload = F.concat(F.lit('"{'), payload, F.lit('\\"end\\":1}"'))
    is_rate = kind.isin("null_payload", "bad_payload", "bad_date", "bad_rate", "no_date", "no_code", "no_quoted_code")
    text = F.concat(
        F.when(kind == "no_object_id", F.lit("{")).otherwise(
            F.concat(F.lit('{"object_id":"odd/'), F.col("event_id").cast("string"), F.lit('",'))),
        F.lit('"object_type":"'), F.when(is_rate, F.lit("CURRENCY")).when(kind == "empty_type", F.lit("")).otherwise(F.lit("NOTE")),
        F.lit('","sent_dttm":'), sent, F.lit(',"payload":'),
        F.when(kind == "null_payload", F.lit("null")).when(kind == "bad_payload", F.lit('"{oops"'))
        .when(kind == "nested_time", F.lit('{"sent_dttm":"x"}')).otherwise(payload),
        F.lit("}"))
    return F.when(kind == "null_value", F.lit(None).cast("string")).when(kind == "blank_value", F.lit("  ")).otherwise(text)


@_memo
def src_transactions_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source transactions as an untyped source gives them: all text, with
    a fault in every ``TEXT_FAULT_EVERY``th row."""
    src = src_transactions(spark, sf_dir)
    key = F.col("operation_id").cast("bigint")
    fault = F.when(key % TEXT_FAULT_EVERY == 7, (key / TEXT_FAULT_EVERY).cast("int") % len(TEXT_FAULTS))
    out = []
    for c in src.columns:
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c == "transaction_dt" else F.col(c).cast("string")
        for n, (column, value) in enumerate(TEXT_FAULTS):
            if column == c:
                text = F.when(fault.eqNullSafe(F.lit(n)), F.lit(value).cast("string")).otherwise(text)
        out.append(text.alias(c))
    return src.select(*out)


@_memo
def stg_currencies_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rates of which some come twice, the second time one higher."""
    rates = stg_currencies(spark, sf_dir)
    again = rates.where(F.col("currency_code_with") != "416").withColumn(
        "currency_code_div", (F.col("currency_code_div") + 1).cast(RATE_DECIMAL))
    return rates.unionByName(again)


# --------------------------------------------------------------------------
# DuckDB twins (same rows and types), used as CTEs by the oracle queries.
# --------------------------------------------------------------------------

_TX_COLUMNS_SQL = """
        CAST(e.event_id AS VARCHAR) AS operation_id,
        e.user_id AS account_number_from,
        e.user_id + 1 AS account_number_to,
        CAST(416 + e.event_id % 5 AS VARCHAR) AS currency_code,
        n.n_name AS country,
        CASE WHEN e.event_type = 'error' THEN 'failed' ELSE 'done' END AS status,
        CASE WHEN e.event_type = 'signup' THEN 'authorisation' ELSE e.event_type END AS transaction_type,
        CAST(round(e.value * 100) AS BIGINT) AS amount"""

_RATE_SLOTS_SQL = """
    SELECT date_update, unnest(range(0, 10)) AS k
    FROM (
        SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_update
        FROM (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events) span
    ) d"""



def _text_sql(column: str) -> str:
    text = ("strftime(transaction_dt, '%Y-%m-%d %H:%M:%S.%f')" if column == "transaction_dt"
            else f"CAST({column} AS VARCHAR)")
    faults = [(n, v) for n, (c, v) in enumerate(TEXT_FAULTS) if c == column]
    whens = " ".join(f"WHEN fault = {n} THEN " + ("NULL" if v is None else f"'{v}'") for n, v in faults)
    return f"CASE {whens} ELSE {text} END AS {column}" if whens else f"{text} AS {column}"


_TEXT_SQL = ", ".join(map(_text_sql, [
    "operation_id", "account_number_from", "account_number_to", "currency_code", "country", "status",
    "transaction_type", "amount", "transaction_dt"]))

ORACLE_CTES = f"""
stg_tx AS (
    SELECT {_TX_COLUMNS_SQL},
        date_trunc('millisecond', e.ts) AS transaction_dttm
    FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
),
src_tx AS (
    SELECT {_TX_COLUMNS_SQL},
        e.ts AS transaction_dt
    FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 27
),
rate_slots AS ({_RATE_SLOTS_SQL}
),
stg_rates AS (
    SELECT date_update,
        CASE WHEN k < 5 THEN '420' ELSE '430' END AS currency_code,
        CAST(415 + k % 5 AS VARCHAR) AS currency_code_with,
        CAST(CAST(100 + k AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6)) AS currency_code_div
    FROM rate_slots
),
rate_msgs AS (
    SELECT k, date_update,
        CAST(date_update AS VARCHAR) || '/' || CAST(k AS VARCHAR) AS object_id,
        '{{"date_update":"' || CAST(date_update AS VARCHAR) || '","currency_code":'
            || CASE WHEN k < 5 THEN '420' ELSE '430' END
            || ',"currency_code_with":"' || CAST(415 + k % 5 AS VARCHAR) || '"'
            || CASE WHEN k = 9 THEN '' ELSE ',"currency_with_div":'
                 || CAST(CAST((100 + k) / 100 AS DECIMAL(5,2)) AS VARCHAR) END
            || '}}' AS payload
    FROM rate_slots
),
rate_envelopes AS (
    SELECT k, date_update,
        '{{"object_id":"' || object_id || '","object_type":"CURRENCY","sent_dttm":"'
            || CAST(date_update AS VARCHAR) || 'T06:00:00","payload":"'
            || replace(payload, '"', '\\"') || '"}}' AS env
    FROM rate_msgs
),
tx_msgs AS (
    SELECT e.event_id, e.event_type, e.ts, {_TX_COLUMNS_SQL},
        strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text
    FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
),
tx_envelopes AS (
    SELECT event_id, copy, ts,
        '{{"object_id":"' || operation_id || '","object_type":"TRANSACTION","sent_dttm":"' || ts_text
            || '","payload":"' || replace(
                '{{"operation_id":"' || operation_id
                || '","account_number_from":' || CAST(account_number_from AS VARCHAR)
                || ',"account_number_to":' || CAST(account_number_to AS VARCHAR)
                || ',"currency_code":"' || currency_code
                || '","country":"' || country
                || '","status":"' || CASE WHEN copy = 1 THEN 'replayed' ELSE status END
                || '","transaction_type":"' || transaction_type
                || '","amount":' || CAST(amount AS VARCHAR)
                || ',"transaction_dt":"' || ts_text || '"}}', '"', '\\"') || '"}}' AS env
    FROM tx_msgs, (VALUES (0), (1)) c(copy)
    WHERE copy = 0 OR event_type = 'error'
),
odd AS (
    SELECT event_id, ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
        [{', '.join(f"'{k}'" for k in ODD_KINDS)}][(event_id // {ODD_EVERY}) % {len(ODD_KINDS)} + 1] AS kind
    FROM events WHERE event_id % {ODD_EVERY} = 0
),
odd_payloads AS (
    SELECT *, '{{' || CASE WHEN kind = 'no_date' THEN '' ELSE '\\"date_update\\":\\"'
                 || CASE WHEN kind = 'bad_date' THEN 'someday' ELSE day END || '\\",' END
            || CASE WHEN kind = 'no_code' THEN '' ELSE '\\"currency_code\\":\\"430\\",' END
            || CASE WHEN kind = 'no_quoted_code' THEN '' ELSE '\\"currency_code_with\\":\\"416\\",' END
            || '\\"currency_with_div\\":\\"' || CASE WHEN kind = 'bad_rate' THEN '1,5' ELSE '1.5' END || '\\",'
            || '\\"end\\":1}}' AS payload
    FROM odd
),
odd_messages AS (
    SELECT event_id, ts, CASE WHEN kind = 'null_value' THEN NULL WHEN kind = 'blank_value' THEN '  ' ELSE
        '{{' || CASE WHEN kind = 'no_object_id' THEN '' ELSE '"object_id":"odd/' || CAST(event_id AS VARCHAR) || '",' END
        || '"object_type":"' || CASE WHEN kind = 'empty_type' THEN ''
             WHEN kind IN ('null_payload', 'bad_payload', 'bad_date', 'bad_rate', 'no_date', 'no_code', 'no_quoted_code')
             THEN 'CURRENCY' ELSE 'NOTE' END
        || '","sent_dttm":' || CASE kind WHEN 'bad_time' THEN '"soon"'
             WHEN 'offset_time' THEN '"' || day || 'T01:30:00+03:00"'
             WHEN 'epoch_time' THEN '1704067200' WHEN 'nested_time' THEN '1704067200'
             WHEN 'epoch_millis' THEN '1704067200000' WHEN 'quoted_digits' THEN '"1704067200"'
             ELSE '"' || day || 'T07:00:00"' END
        || ',"payload":' || CASE kind WHEN 'null_payload' THEN 'null' WHEN 'bad_payload' THEN '"{{oops"'
             WHEN 'nested_time' THEN '{{"sent_dttm":"x"}}' ELSE '"' || payload || '"' END || '}}' END AS env
    FROM odd_payloads
),
records AS (
    SELECT 0 AS "partition",
        CAST(date_diff('day', DATE '1970-01-01', date_update) AS BIGINT) * 10 + k AS "offset",
        CAST(date_update AS TIMESTAMP) + INTERVAL 6 HOUR AS "timestamp",
        CASE WHEN k = 8 THEN '{{"object_id"=' || substr(env, 14) ELSE env END AS value
    FROM rate_envelopes
    UNION ALL
    SELECT 1, event_id * 2 + copy, ts + copy * INTERVAL 1 SECOND, env FROM tx_envelopes
    UNION ALL
    SELECT 2, event_id, ts, env FROM odd_messages
),
src_text AS (
    SELECT {_TEXT_SQL}
    FROM (SELECT *, CASE WHEN CAST(operation_id AS BIGINT) % {TEXT_FAULT_EVERY} = 7
                    THEN (CAST(operation_id AS BIGINT) // {TEXT_FAULT_EVERY}) % {len(TEXT_FAULTS)} END AS fault FROM src_tx)
),
stg_rates_repeated AS (
    SELECT * FROM stg_rates
    UNION ALL
    SELECT date_update, currency_code, currency_code_with, CAST(currency_code_div + 1 AS DECIMAL(18,6))
    FROM stg_rates WHERE currency_code_with <> '416'
)"""
