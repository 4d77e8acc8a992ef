"""Plan shapes that have to hold at scale."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.registry import Tables
from ledgerlake.operators import latest, predicates, windows

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


REPORTS = [n for n in entry.queries() if n.startswith(("r", "customer"))]


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_stay_in_the_jvm_and_avoid_products(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for forbidden in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in text


def test_latest_prunes_before_the_shuffle(spark):
    text = plan(latest.latest_per_key(Tables(spark, FOLDER).orders, "o_custkey", ["o_orderdate", "o_orderkey"]))
    first, second = text.index("Final"), text.index("Partial")
    assert text.count("WindowGroupLimit") == 2 and first < text.index("Exchange") < second


def test_running_values_share_one_shuffle_of_the_rows(spark):
    orders = Tables(spark, FOLDER).orders
    df = windows.row_numbers(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "f", "l", "year")
    # rows once by (key, chunk), chunk counts once by (key, chunk) and once by key
    assert plan(df).count("Exchange hashpartitioning") <= 4


def test_date_filter_and_columns_reach_the_scan(spark):
    import datetime as dt

    events = Tables(spark, FOLDER).events
    text = plan(predicates.last_n_days(events, "ts", 3, dt.date(2024, 1, 20)).select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_global_window_is_a_scalar_not_one_task(spark):
    part = Tables(spark, FOLDER).part
    text = plan(windows.with_global(part, {"top": F.max("p_size")}))
    assert "Window" not in text and "Subquery" in text


def test_watermark_of_a_table_comes_from_statistics_or_the_newest_day(spark, tmp_path, monkeypatch):
    import datetime as dt

    from ledgerlake.operators import incremental

    path = str(tmp_path / "t")
    rows = spark.sql("SELECT id, date'2024-01-01' + cast(id % 5 AS int) AS d, timestamp'2024-01-01' + make_interval(0,0,0,cast(id % 5 AS int)) AS ts FROM range(100)")
    rows.withColumn("date", F.date_format("d", "yyyyMMdd")).write.partitionBy("date").parquet(path)
    plans, files = [], []
    plain = incremental.high_watermark

    def seen(df, field):
        found = plain(df, field)
        plans.append(plan(found))
        files.append(df.inputFiles())
        return found

    monkeypatch.setattr(incremental, "high_watermark", seen)
    assert incremental.high_watermark_of(spark, path, "id") == 99
    assert incremental.high_watermark_of(spark, path, "d") == dt.date(2024, 1, 5)
    assert "PushedAggregation: [MAX(id)]" in plans[0] and "PushedAggregation: [MAX(d)]" in plans[1]
    assert incremental.high_watermark_of(spark, path, "ts", "date") == dt.datetime(2024, 1, 5)
    assert len(files) == 3 and files[2] and all("date=20240105" in name for name in files[2])
    # a newest day without any change time is passed over
    spark.sql("SELECT 1L AS id, cast(NULL AS date) AS d, cast(NULL AS timestamp) AS ts, '20240109' AS date").write.mode("append").partitionBy("date").parquet(path)
    assert incremental.high_watermark_of(spark, path, "ts", "date") == dt.datetime(2024, 1, 5)
    assert incremental.high_watermark_of(spark, str(tmp_path / "none"), "ts", "date") is None
