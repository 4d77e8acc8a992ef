"""Conforming and parsing on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import dates, numbers, text
from ledgerlake.operators import conform, incremental, quality
from tests.conftest import rows

NOW = dt.datetime(2024, 3, 9, 10, 30)


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2024-09-16T03:41:17Z", dt.datetime(2024, 9, 16, 3, 41, 17)),
        ("2024-09-16T03:41:17.123+0100", dt.datetime(2024, 9, 16, 2, 41, 17, 123000)),
        ("2024-09-16", dt.datetime(2024, 9, 16)),
        ("202409090450", dt.datetime(2024, 9, 9, 4, 50)),
        ("Sep 16, 2024, 03:41:17 AM", dt.datetime(2024, 9, 16, 3, 41, 17)),
        ("7/30/2024 6:27:00 PM", dt.datetime(2024, 7, 30, 18, 27)),
        ("2024-07-30 18:27:00", dt.datetime(2024, 7, 30, 18, 27)),
        ("30-07-2024 18:27:00", dt.datetime(2024, 7, 30, 18, 27)),
        (None, None),
    ],
)
def test_parse_ts_multi(spark, raw, expected):
    assert one(spark, dates.parse_ts_multi("x"), raw) == expected


def test_parse_ts_multi_raises_or_gives_null(spark):
    with pytest.raises(Exception, match="no timestamp format fits: soon"):
        one(spark, dates.parse_ts_multi("x"), "soon")
    assert one(spark, dates.parse_ts_multi("x", on_fail="null"), "soon") is None


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("£1,250.00", 1250.0), ("1.2.3", None), ("n/a", None), ("", None), (None, None), ("£5", 5.0)],
)
def test_parse_currency(spark, raw, expected):
    assert one(spark, numbers.parse_currency("x"), raw) == expected


@pytest.mark.parametrize(("raw", "expected"), [("3", 3), (" 4 ", 4), ("nan", None), ("3.5", None), ("", None), (None, None)])
def test_safe_int(spark, raw, expected):
    assert one(spark, numbers.safe_int("x"), raw) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("21/03/2024", "2024-03-21"), ("3 Mar 2024", "2024-03-03"), ("2190-01-01", None), ("x", None), (None, None)],
)
def test_parse_date_guarded(spark, raw, expected):
    assert one(spark, dates.parse_date_guarded("x"), raw) == expected


@pytest.mark.parametrize(
    ("raw", "expected"), [("a.b@c.de", "a.b@c.de"), ("a@b", ""), ("none", ""), ("", ""), (None, "")]
)
def test_email(spark, raw, expected):
    assert one(spark, text.valid_email_or_blank("x"), raw) == expected


@pytest.mark.parametrize(("raw", "expected"), [("", None), (" <NA> ", None), ("nan", None), ("None", None), (" a ", "a")])
def test_clean_null(spark, raw, expected):
    assert one(spark, text.clean_null("x"), raw) == expected


def test_repeated_hour_counts_as_summer_time(spark):
    moment = F.to_timestamp(F.lit("2024-10-27 01:30:00"))
    assert one(spark, dates.local_to_utc(moment), None) == dt.datetime(2024, 10, 27, 0, 30)


def test_clean_text_halves_blanks_once_and_reaches_nested_text(spark):
    df = spark.sql("SELECT 'a\\n\\tb    c' AS s, array('x\\ry') AS l, named_struct('t', 'p\\nq', 'n', 1) AS r, map('k', 'v\\tw') AS m")
    row = text.clean_text(df).first()
    assert row["s"] == "a b  c" and row["l"] == ["x y"] and row["r"]["t"] == "p q" and row["m"] == {"k": "v w"}


def test_flatten_structs_and_arrays(spark):
    df = spark.sql(
        "SELECT 1 AS id, named_struct('a', 1, 'b', named_struct('c', 'x')) AS s, "
        "array(named_struct('v', 1), named_struct('v', 2)) AS l UNION ALL "
        "SELECT 2, NULL, array()"
    )
    flat = conform.flatten(df)
    assert flat.columns == ["id", "s_a", "s_b_c", "l_0_v", "l_1_v"]
    assert rows(flat) == [(1, 1, "x", 1, 2), (2, None, None, None, None)]


def test_names_that_collide_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="collide"):
        conform.normalize_columns(df)


def test_names():
    assert text.snake_case("createdDate") == "created_date"
    assert text.snake_case("HTTPCode") == "h_ttpcode"
    assert text.ascii_name("Été (€)") == "ete" and text.ascii_name("€") == "col"


def test_apply_schema_fills_bad_numbers_or_keeps_null(spark):
    df = spark.createDataFrame([("x", "False")], "N string, Flag string")
    schema = {"n": "int", "flag": "boolean"}
    assert rows(conform.apply_schema(df, schema)) == [(0, False)]
    assert rows(conform.apply_schema(df, schema, numeric_fill=None)) == [(None, False)]


def test_select_schema_orders_and_adds(spark):
    df = spark.createDataFrame([("1", "b")], "x string, y string")
    out = conform.select_schema(df, {"y": "string", "x": "int", "z": "timestamp"}, today=dt.date(2024, 3, 9))
    assert out.dtypes == [("y", "string"), ("x", "int"), ("z", "timestamp"), ("year", "int"), ("month", "int"), ("day", "int")]
    assert rows(out) == [("b", 1, None, 2024, 3, 9)]


def test_partition_date_needs_a_date(spark):
    with pytest.raises(ValueError, match="dateHourMinute"):
        conform.partition_date(spark.createDataFrame([("x",)], "country string"))
    assert rows(conform.partition_date(spark.createDataFrame([("20240309",)], "date string"))) == [("2024-03-09",)]


def test_add_meta_without_change_field(spark):
    out = conform.add_meta(spark.range(1), NOW)
    assert rows(out) == [(0, "20240309", NOW)]


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "id int, ts timestamp, day date")
    assert incremental.high_watermark(empty, "ts").first()["high_watermark"] is None
    assert incremental.plan_days(empty, dt.date(2024, 3, 9)).count() == 30
    same = quality.reconcile_counts(empty, empty, "day")
    assert same.count() == 0


def test_plan_days_with_targets(spark):
    stored = spark.createDataFrame([(dt.date(2024, 3, 1),)], "day date")
    targets = [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    assert rows(incremental.plan_days(stored, NOW.date(), targets=targets)) == [(dt.date(2024, 3, 2),)]
    assert incremental.plan_days(stored, NOW.date(), overwrite=True, targets=targets).count() == 2
    assert incremental.plan_days(stored, NOW.date(), overwrite=True).count() == 30


def test_one_sided_groups_are_mismatches(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, id int")
    b = spark.createDataFrame([("x", 1)], "k string, id int")
    out = quality.reconcile_counts(a, b, "k")
    assert rows(out, "k", "match", "all_match") == [("x", True, False), ("y", False, False)]


def test_slices_are_small_and_complete(spark):
    start = dt.datetime(2024, 1, 1)
    moments = [(start + dt.timedelta(seconds=s * s % 86400),) for s in range(700)]
    df = spark.createDataFrame(moments, "ts timestamp")
    out = incremental.balanced_slices(df, "ts", start, start + dt.timedelta(days=1), max_rows=50, depth=16).collect()
    assert sum(r["rows"] for r in out) == 700 and all(r["rows"] < 50 for r in out)
    ordered = sorted(out, key=lambda r: r["slice_start"])
    assert all(a["slice_end"] <= b["slice_start"] for a, b in zip(ordered, ordered[1:]))


def test_fingerprint_sees_contents_and_not_order(spark):
    from ledgerlake.operators import quality

    kind = "id int, name string, m map<string,int>, s struct<x:int,y:array<string>>"
    data = [(1, "a", {"p": 1, "q": None}, (1, ["u", None])), (2, None, None, None), (2, None, None, None), (3, "", {}, (None, []))]
    rows = spark.createDataFrame(data, kind)
    turned = [(i, n, dict(reversed(m.items())) if m else m, s) for i, n, m, s in reversed(data)]
    other = spark.createDataFrame(turned, kind).repartition(3).select("s", "m", F.col("name").alias(" NAME"), "id")
    assert quality.same_contents(rows, other) == (True, (4, 4))
    for at, value in ((0, (1, "a", {"p": 1, "q": 0}, (1, ["u", None]))), (1, (2, "", None, None)), (3, (3, "", None, (None, []))), (3, (3, "", {}, None)), (0, (1, "a", {"p": 1, "q": None}, (1, [None, "u"])))):
        changed = [*data]
        changed[at] = value
        assert quality.same_contents(rows, spark.createDataFrame(changed, kind))[0] is False, value
    # another type: compared as text; another set of columns is another table
    assert quality.same_contents(rows.select("id"), rows.select(F.col("id").cast("string")))[0]
    assert not quality.same_contents(rows.select("id"), rows.select(F.col("id").alias("no")))[0]
    assert quality.same_contents(rows.limit(0), other.limit(0)) == (True, (0, 0))
    # values that move to the next column change the sums
    two = "a string, b string"
    assert not quality.same_contents(spark.createDataFrame([("x", None)], two), spark.createDataFrame([(None, "x")], two))[0]
