"""Fixed, hand-declared schemas of the load (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Envelope of one stream message (JSON text in the binary ``value``).
ENVELOPE = T.StructType([
    T.StructField("object_id", T.StringType()),
    T.StructField("object_type", T.StringType()),
    T.StructField("sent_dttm", T.TimestampType()),
    T.StructField("payload", T.StringType()),
])

# Landing table: one row per object_id, first arrival wins.
LANDING = T.StructType([
    T.StructField("object_id", T.StringType()),
    T.StructField("object_type", T.StringType()),
    T.StructField("sent_dttm", T.TimestampNTZType()),
    T.StructField("payload", T.StringType()),
])

# Rate payload: every value is read as text, then cast with try_cast.
RATE_PAYLOAD = T.StructType([
    T.StructField("date_update", T.StringType()),
    T.StructField("currency_code", T.StringType()),
    T.StructField("currency_code_with", T.StringType()),
    T.StructField("currency_with_div", T.StringType()),
])

RATE_DECIMAL = T.DecimalType(18, 6)

STG_CURRENCIES = T.StructType([
    T.StructField("date_update", T.DateType()),
    T.StructField("currency_code", T.StringType()),
    T.StructField("currency_code_with", T.StringType()),
    T.StructField("currency_code_div", RATE_DECIMAL),
])

# Typed staging row of a transaction (nine columns, declared types).
TRANSACTION_COLUMNS = [
    ("operation_id", T.StringType()),
    ("account_number_from", T.LongType()),
    ("account_number_to", T.LongType()),
    ("currency_code", T.StringType()),
    ("country", T.StringType()),
    ("status", T.StringType()),
    ("transaction_type", T.StringType()),
    ("amount", T.LongType()),
    ("transaction_dt", T.TimestampNTZType()),
]

SRC_TRANSACTIONS = T.StructType([T.StructField(n, t) for n, t in TRANSACTION_COLUMNS])

STG_TRANSACTIONS = T.StructType(
    [T.StructField(n, t) for n, t in TRANSACTION_COLUMNS[:-1]]
    + [T.StructField("transaction_dttm", T.TimestampNTZType())])

TRANSACTION_KEY = ["operation_id", "transaction_dttm"]

MART_GLOBAL_METRICS = T.StructType([
    T.StructField("date_update", T.DateType()),
    T.StructField("currency_from", T.StringType()),
    T.StructField("amount_total", T.DecimalType(38, 6)),
    T.StructField("cnt_transactions", T.LongType()),
    T.StructField("avg_transactions_per_account", T.DoubleType()),
    T.StructField("cnt_accounts_make_transactions", T.LongType()),
])

MART_KEY = ["date_update", "currency_from"]

# One reject schema for every stage.
REJECTS = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("run_date", T.DateType()),
])

# Stored partition column of the staged transactions (never in results).
BUSINESS_DATE = "business_date"

# Fixed values of the load (must stay as they are for equal results).
STATUS_SETTLED = "done"
TYPE_EXCLUDED = "authorisation"
BASE_CURRENCY = "420"
OBJECT_TYPE_CURRENCY = "CURRENCY"
