"""Transaction staging (O14, O15, O23, D6, D9) and the mart (O19-O37, D4),
on hand-made rows (FIXTURES 3.3)."""

import datetime as dt
from decimal import Decimal

from paymart.operators import mart, quality, staging

SRC_TEXT = ("operation_id string, account_number_from string, account_number_to string, "
            "currency_code string, country string, status string, transaction_type string, "
            "amount string, transaction_dt string")
STG = ("operation_id string, account_number_from bigint, account_number_to bigint, currency_code string, "
       "country string, status string, transaction_type string, amount bigint, transaction_dttm timestamp_ntz")
RATES = "date_update date, currency_code string, currency_code_with string, currency_code_div decimal(18,6)"


def test_conform_casts_truncates_and_rejects(spark):
    rows = [
        ("1", "10", "11", "416", "X", "done", "buy", "100", "2024-01-05 10:00:00.123456"),
        ("2", None, "11", "416", "X", "done", "buy", "100", "2024-01-05 10:00:00"),
        ("3", "ten", "11", "416", "X", "done", "buy", "100", "2024-01-05 10:00:00"),
        ("4", "10", "11", "416", "", "done", "buy", "100", "2024-01-05 10:00:00"),
        ("5", "10", "11", "416", "X", "done", "buy", "", "2024-01-05 10:00:00"),
        ("6", "10", "11", "416", "X", "done", "buy", "7", "not a time"),
    ]
    src = spark.createDataFrame(rows, SRC_TEXT)
    checked = {r.operation_id: r for r in staging.transactions_checked(src).collect()}
    assert checked["1"].reason is None
    assert checked["1"].transaction_dttm == dt.datetime(2024, 1, 5, 10, 0, 0, 123000)   # D6
    assert checked["2"].reason == "missing_account_number_from"
    assert checked["3"].reason == "bad_account_number_from"
    assert checked["4"].reason is None and checked["4"].country == ""                   # D9
    assert checked["5"].reason == "bad_amount"
    assert checked["6"].reason == "bad_transaction_dt"
    valid = staging.conform_transactions(src)
    assert valid.columns[-1] == "transaction_dttm" and valid.count() == 2               # O15
    rej = staging.transaction_rejects(src, dt.date(2024, 1, 5)).collect()
    assert len(rej) == 4 and all(r.stage == "transactions" for r in rej)
    assert staging.required_fields(src).count() == 5


def test_extract_day_boundaries(spark):
    rows = [("a", 1, 2, "416", "X", "done", "buy", 1, dt.datetime(2024, 1, 5, 23, 59, 59, 999999)),
            ("b", 1, 2, "416", "X", "done", "buy", 1, dt.datetime(2024, 1, 6, 0, 0))]
    schema = STG.replace("transaction_dttm", "transaction_dt")
    src = spark.createDataFrame(rows, schema)
    assert [r.operation_id for r in staging.extract_transactions(src, "2024-01-05").collect()] == ["a"]
    assert [r.operation_id for r in staging.extract_transactions(src, "2024-01-06").collect()] == ["b"]


def _tx(spark, rows):
    return spark.createDataFrame(rows, STG)


D = dt.datetime(2024, 1, 5, 12, 0)


def test_mart_filters_join_and_measures(spark):
    tx = _tx(spark, [
        ("1", 1, 2, "416", "X", "done", "buy", 100, D),
        ("2", 1, 2, "416", "X", "done", "buy", 50, D),
        ("3", 2, 2, "416", "X", "done", "buy", 10, D),
        ("4", 3, 2, "416", "X", "failed", "buy", 1000, D),          # not settled
        ("5", 3, 2, "416", "X", "done", "authorisation", 1000, D),  # excluded type
        ("6", 3, 2, "416", "X", "done", None, 1000, D),             # null type is dropped
        ("7", 0, 2, "416", "X", "done", "buy", 1000, D),            # account 0
        ("8", -1, 2, "416", "X", "done", "buy", 1000, D),           # negative account
        ("9", 4, 2, "417", "X", "done", "buy", 1000, D),            # no rate for 417
        ("10", 4, 2, "420", "X", "done", "buy", 1000, D),           # 420 itself has no rate row
        ("11", 5, 2, "416", "X", "done", "buy", 7, dt.datetime(2024, 1, 6, 0, 0)),   # next day
    ])
    rates = spark.createDataFrame([
        (dt.date(2024, 1, 5), "420", "416", Decimal("0.5")),
        (dt.date(2024, 1, 5), "430", "417", Decimal("2")),           # other base currency
        (dt.date(2024, 1, 6), "420", "416", Decimal("1")),
    ], RATES)
    got = {(r.date_update, r.currency_from): r for r in mart.global_metrics(tx, rates).collect()}
    assert set(got) == {(dt.date(2024, 1, 5), "416"), (dt.date(2024, 1, 6), "416")}
    r = got[(dt.date(2024, 1, 5), "416")]
    assert r.amount_total == Decimal("80.000000")
    assert r.cnt_transactions == 3 and r.cnt_accounts_make_transactions == 2
    assert r.avg_transactions_per_account == 1.5
    one_day = mart.global_metrics(tx, rates, "2024-01-05").collect()
    assert [(x.date_update, x.currency_from) for x in one_day] == [(dt.date(2024, 1, 5), "416")]


def test_duplicate_rates_multiply_sum_and_count_not_accounts(spark):
    tx = _tx(spark, [("1", 1, 2, "416", "X", "done", "buy", 100, D), ("2", 2, 2, "416", "X", "done", "buy", 100, D)])
    rate = (dt.date(2024, 1, 5), "420", "416", Decimal("1"))
    single = mart.global_metrics(tx, spark.createDataFrame([rate], RATES)).first()
    double = mart.global_metrics(tx, spark.createDataFrame([rate, rate], RATES)).first()
    assert double.amount_total == 2 * single.amount_total
    assert double.cnt_transactions == 2 * single.cnt_transactions
    assert double.cnt_accounts_make_transactions == single.cnt_accounts_make_transactions
    dups = quality.duplicate_rates(spark.createDataFrame([rate, rate], RATES)).collect()
    assert len(dups) == 1 and dups[0].n == 2
    assert quality.dedupe_rates(spark.createDataFrame([rate, rate], RATES)).count() == 1


def test_mart_types(spark):
    tx = _tx(spark, [("1", 1, 2, "416", "X", "done", "buy", 100, D)])
    rates = spark.createDataFrame([(dt.date(2024, 1, 5), "420", "416", Decimal("1.1"))], RATES)
    types = dict(mart.global_metrics(tx, rates).dtypes)
    assert types == {"date_update": "date", "currency_from": "string", "amount_total": "decimal(38,6)",
                     "cnt_transactions": "bigint", "avg_transactions_per_account": "double",
                     "cnt_accounts_make_transactions": "bigint"}


def test_accounts_of_a_span_are_exact(spark):
    """Bitmaps of days put together, against a plain distinct count; far numbers too."""
    from pyspark.sql import functions as F
    from paymart.operators.accounts import distinct_accounts, day_accounts

    far = [2**32 - 1, 2**32, 2**32 + 1, 2**62, 2**63 - 1]
    rows = [(f"2024-0{m}-{d:02d}", str(416 + (a or 0) % 2), a) for m in (1, 2) for d in (1, 2, 3)
            for a in [*range(1, 70_000, 977 * d), 32_767, 32_768, 32_769, *far[:d + 2], None]]
    settled = spark.createDataFrame(rows * 2 + [("2024-01-01", None, 5)], "d string, currency_code string, account_number_from long")
    settled = settled.withColumn("date_update", F.to_date("d"))
    month = F.trunc("date_update", "month")
    want = settled.groupBy(month.alias("span"), F.col("currency_code").alias("currency_from")).agg(
        F.count_distinct("account_number_from").alias("accounts"))
    for dense in (2**32, 40_000, 1):
        got = distinct_accounts(day_accounts(settled, dense), month)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted((tuple(r) for r in want.collect() if r.accounts), key=repr)
