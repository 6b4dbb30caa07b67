"""Replacing days together, or not at all (O06), and what the pointers are good for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.operators.versions import ConcurrentCommitError, VersionedTable
from paymart.plans import jobs
from paymart.session import list_folder
from paymart.sources import adapters as A

from .conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType()), T.StructField("v", T.IntegerType())])
D = [dt.date(2024, 1, i) for i in range(1, 4)]


def _df(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_days_are_replaced_and_others_stay(spark, scratch):
    table = VersionedTable(scratch, SCHEMA, "d")
    assert table.read(spark).count() == 0 and table.read(spark, D[0]).count() == 0
    table.replace(_df(spark, ("a", D[0], 1), ("b", D[1], 2), ("c", None, 3)))
    table.replace(_df(spark, ("x", D[1], 9)))
    assert _rows(table.read(spark)) == [("a", D[0], 1), ("c", None, 3), ("x", D[1], 9)]
    assert _rows(table.read(spark, D[1])) == [("x", D[1], 9)]
    number = table.pointer(spark).number
    table.replace(_df(spark))                                            # D3: nothing to replace
    assert table.pointer(spark).number == number
    table.replace(_df(spark), only=D[0])                                 # a day that has become empty
    assert _rows(table.read(spark)) == [("c", None, 3), ("x", D[1], 9)]


def test_a_write_that_fails_half_way_changes_nothing(spark, scratch):
    table = VersionedTable(scratch, SCHEMA, "d")
    table.replace(_df(spark, ("a", D[0], 1), ("b", D[1], 1)))
    # the first rows are written before a later one fails
    bad = (_df(spark, *[("n", d, i) for d in D for i in range(50)]).repartitionByRange(3, "d")
           .withColumn("v", F.when((F.col("d") == D[2]) & (F.col("v") == 40), F.raise_error(F.lit("lost")).cast("int"))
                       .otherwise(F.col("v"))))
    with pytest.raises(Exception, match="lost"):
        table.replace(bad)
    assert _rows(table.read(spark)) == [("a", D[0], 1), ("b", D[1], 1)]
    # written wholly, but the process ends before the pointer is swapped
    table.write(_df(spark, ("n", D[0], 2), ("n", D[1], 2)))
    assert _rows(table.read(spark)) == [("a", D[0], 1), ("b", D[1], 1)]
    table.replace(_df(spark, ("n", D[0], 3)))
    assert _rows(table.read(spark)) == [("b", D[1], 1), ("n", D[0], 3)]


def test_a_reader_keeps_its_days_through_the_next_commit(spark, scratch):
    table = VersionedTable(scratch, SCHEMA, "d")
    table.replace(_df(spark, ("a", D[0], 1), ("b", D[1], 1)))
    reader = table.read(spark)
    table.replace(_df(spark, ("a", D[0], 2), ("b", D[1], 2)))
    assert _rows(reader) == [("a", D[0], 1), ("b", D[1], 1)]             # both old, not one of each
    table.replace(_df(spark, ("a", D[0], 3)))
    versions = [v for v in list_folder(spark, f"{scratch}/data") if list_folder(spark, f"{scratch}/data/{v}")]
    assert len(table.pointer(spark).days) == 2 and len(list_folder(spark, f"{scratch}/pointer")) <= 3 and len(versions) <= 3


def test_one_of_two_commits_at_the_same_time_fails(spark, scratch):
    table = VersionedTable(scratch, SCHEMA, "d")
    table.replace(_df(spark, ("a", D[0], 1)))
    last = table.pointer(spark)
    table.replace(_df(spark, ("a", D[0], 2)), last)
    with pytest.raises(ConcurrentCommitError):
        table.replace(_df(spark, ("a", D[0], 3)), last)
    assert _rows(table.read(spark)) == [("a", D[0], 2)]


def test_refresh_builds_only_the_days_that_changed(spark, scratch):
    lake, src = jobs.Lake(scratch), A.src_transactions(spark, SF_SMALL)
    lake.stg_currencies.replace(A.stg_currencies(spark, SF_SMALL))
    jobs.stage_transactions(spark, lake, src, None)
    first = jobs.refresh_global_metrics(spark, lake)
    assert len(first["days"]) == 30
    assert jobs.refresh_global_metrics(spark, lake) == {"written": 0, "days": []}
    before = lake.mart.pointer(spark).days
    late = dt.date(2024, 1, 9)
    jobs.stage_transactions(spark, lake, src.withColumn("amount", F.col("amount") + 1), late)
    assert jobs.refresh_global_metrics(spark, lake)["days"] == [late]
    after = lake.mart.pointer(spark).days
    assert [d for d in after if after[d] != before[d]] == [f"date_update={late}"]
    from paymart.operators.mart import global_metrics
    assert _rows(lake.read_mart(spark)) == _rows(global_metrics(lake.read_transactions(spark), lake.read_currencies(spark)))
    # a new rate of a day is seen too
    lake.stg_currencies.replace(lake.read_currencies_day(spark, D[1]).withColumn(
        "currency_code_div", (F.col("currency_code_div") + 1).cast("decimal(18,6)")))
    assert jobs.refresh_global_metrics(spark, lake)["days"] == [D[1]]
