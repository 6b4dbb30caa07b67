"""O36 over any span of days: exact numbers of distinct accounts from stored days.

A distinct count of a month can't be added up from the counts of its days. What can be
put together is a set: each day keeps, per currency, its accounts as bitmaps of 32,768
neighbouring account numbers (``bitmap_construct_agg``, 4 KB each), and a span of days
is the "or" of its bitmaps (``bitmap_or_agg``), counted by their bits. So a month is
counted from a few bitmaps per day, without the transactions and without a shuffle of
accounts.

Numbers from ``DENSE`` on, which lie too far apart for bitmaps (a number of its own in
each would take 4 KB), are kept as numbers, one row per day, currency and account, and
counted as such. Both are exact; the parts of a currency never overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DENSE = 1 << 32
DAY_ACCOUNTS = "date_update date, currency_from string, bucket long, bitmap binary, account long"


def day_accounts(settled: DataFrame, dense: int = DENSE) -> DataFrame:
    """The accounts of each day and currency: rows with a ``bucket`` and its
    ``bitmap``, or with an ``account``. ``settled`` has date_update, currency_code and
    account_number_from (positive); null accounts don't count, as in a distinct count."""
    rows = settled.where(F.col("account_number_from").isNotNull()).select(
        "date_update", F.col("currency_code").alias("currency_from"), F.col("account_number_from").alias("account"))
    near = F.col("account") < F.lit(dense)
    bitmaps = (rows.where(near)
               .select("date_update", "currency_from", F.bitmap_bucket_number("account").alias("bucket"),
                       F.bitmap_bit_position("account").alias("bit"))
               .groupBy("date_update", "currency_from", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
               .withColumn("account", F.lit(None).cast("long")))
    far = (rows.where(~near).distinct()
           .select("date_update", "currency_from", F.lit(None).cast("long").alias("bucket"),
                   F.lit(None).cast("binary").alias("bitmap"), "account"))
    return bitmaps.unionByName(far)


def distinct_accounts(days: DataFrame, span: Column) -> DataFrame:
    """Distinct accounts per currency and span of days (``span``: an expression of
    ``date_update``, such as its month): (span, currency_from, accounts)."""
    days = days.withColumn("span", span)
    near = (days.where(F.col("bitmap").isNotNull()).groupBy("span", "currency_from", "bucket")
            .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
            .select("span", "currency_from", F.bitmap_count("bitmap").alias("n")))
    far = (days.where(F.col("account").isNotNull()).select("span", "currency_from", "account").distinct()
           .select("span", "currency_from", F.lit(1).cast("long").alias("n")))
    return near.unionByName(far).groupBy("span", "currency_from").agg(F.sum("n").alias("accounts"))
