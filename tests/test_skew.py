"""Window and join operators against brute force when one key holds most of the rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import aggregate, joins, windows
from tests.conftest import rows

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def moves(spark):
    rng = random.Random(7)
    data = []
    for i in range(1200):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        ts = None if rng.random() < 0.02 else START + dt.timedelta(hours=rng.randrange(2000))
        data.append((key, ts, i, rng.randrange(100)))
    return data, spark.createDataFrame(data, "k string, ts timestamp, i int, v int").repartition(5)


def by_key(data):
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    for key, group in groups.items():
        yield key, sorted(group, key=lambda r: (r[1] is None, r[1] or START, r[2]))


def test_running_sum(moves):
    data, df = moves
    expected = []
    for _, group in by_key(data):
        total = 0
        for row in group:
            total += row[3]
            expected.append((row[2], total))
    got = windows.running_sum(df, "k", ["ts", "i"], "v", "run", grain="week")
    assert rows(got, "i", "run") == sorted(expected, key=repr)


def test_row_numbers_both_ways(moves):
    data, df = moves
    expected = []
    for _, group in by_key(data):
        backwards = sorted(group, key=lambda r: (r[1] is not None, r[1] or START, r[2]), reverse=True)
        last = {r[2]: n for n, r in enumerate(backwards, start=1)}
        expected += [(r[2], n, last[r[2]]) for n, r in enumerate(group, start=1)]
    got = windows.rank_both(df, "k", ["ts", "i"], grain="day")
    assert rows(got, "i", "rn_first", "rn") == sorted(expected, key=repr)


def test_with_next_crosses_chunks(moves):
    data, df = moves
    expected = []
    for _, group in by_key(data):
        following = [r[2] for r in group[1:]] + [None]
        expected += [(r[2], n) for r, n in zip(group, following)]
    got = windows.with_next(df, "k", ["ts", "i"], {"i": "next_i"}, grain="day")
    assert rows(got, "i", "next_i") == sorted(expected, key=repr)


def test_group_totals_keep_null_keys(moves):
    data, df = moves
    totals = {k: sum(r[3] for r in g) for k, g in by_key(data)}
    got = windows.with_group_totals(df, "k", {"t": F.sum("v")})
    assert rows(got, "i", "t") == sorted(((r[2], totals[r[0]]) for r in data), key=repr)


def test_numeric_order_column(spark):
    df = spark.range(0, 500).select(F.lit("x").alias("k"), F.col("id"), F.lit(1).alias("v"))
    got = windows.running_sum(df, "k", ["id"], "v", "run", grain=64)
    assert all(r["run"] == r["id"] + 1 for r in got.collect())


def test_left_join_many_keeps_hot_and_lonely_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, n string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 99)], "k int, v int")
    got = joins.left_join_many(left, right, "k")
    expected = left.join(right, "k", "left").select(got.columns)
    assert rows(got) == rows(expected)


@pytest.mark.parametrize(
    ("listed", "kept"),
    [([2], [1, 3]), ([2, None], []), ([], [1, 2, 3, None])],
)
def test_exclude_keys_follows_not_in(spark, listed, kept):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    keys = spark.createDataFrame([(x,) for x in listed], "k int")
    got = joins.exclude_keys(df, keys, "k")
    assert rows(got) == sorted(((x,) for x in kept), key=repr)
    df.createOrReplaceTempView("probe"), keys.createOrReplaceTempView("listed")
    assert rows(got) == rows(spark.sql("SELECT k FROM probe WHERE k NOT IN (SELECT k FROM listed)"))


def test_full_compare_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, n int")
    b = spark.createDataFrame([(None, 1), ("y", 3)], "k string, n int")
    assert rows(joins.full_compare(a, b, "k")) == sorted(
        [(None, 1, 1), ("x", 2, None), ("y", None, 3)], key=repr
    )


def test_attach_row_refuses_two_rows(spark):
    two = spark.range(2)
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        joins.attach_row(spark.range(1).select(F.lit(1).alias("a")), two).collect()


def test_nested_children_are_paged_not_dropped(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1, i) for i in range(25)], "k int, i int")
    got = aggregate.nest_children(parent, child, "k", ["i"], ["i"], page_size=10, grain=4.0)
    pages = {(r["k"], r["page"]): [x["i"] for x in r["records"] or []] for r in got.collect()}
    assert pages == {
        (1, 0): list(range(10)),
        (1, 1): list(range(10, 20)),
        (1, 2): list(range(20, 25)),
        (2, 0): [],
    }


def test_string_agg_counts_repeats(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "z"), ("b", None), ("b", "y")], "k string, s string")
    assert rows(aggregate.string_agg_ordered(df, "k", "s", "t")) == [("a", "z, x, x"), ("b", "y")]
    assert rows(aggregate.string_agg_ordered(df, "k", "s", "t", distinct=True)) == [("a", "z, x"), ("b", "y")]


@pytest.fixture(scope="module")
def tied(spark):
    """A hot key whose order values are a third null and a third equal; some rows are alike in every column."""
    rng = random.Random(11)
    data = []
    for i in range(2000):
        key = "hot" if i % 5 else rng.choice(["a", None])
        ts = (None, START, START + dt.timedelta(hours=rng.randrange(500)))[i % 3]
        data.append((key, ts, rng.choice([None, "x", "y"]), 1 if i < 50 else i))
    return data, spark.createDataFrame(data, "k string, ts timestamp, tag string, v int").repartition(5)


def in_order(group, down=False):
    """Rows by ts and tag, nulls last in both directions."""
    for at in (2, 1):
        present = [r for r in group if r[at] is not None]
        group = sorted(present, key=lambda r: r[at], reverse=down) + [r for r in group if r[at] is None]
    return group


def test_quantile_chunks_divide_nulls_and_ties(tied):
    from ledgerlake.operators import chunks

    data, df = tied
    for down in (False, True):
        cut = chunks.by_quantiles(chunks.stored(df), "k", ["ts", "tag"], 64, down)
        sizes = {tuple(r["_grp"]): r["n"] for r in cut.groupBy("_grp").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert sum(sizes.values()) == 2000 and max(sizes.values()) < 6 * 64
        assert len([1 for k, _ in sizes if k == "hot"]) > 10


@pytest.mark.parametrize("per_chunk", [40, 100_000])
def test_windows_by_quantiles_against_brute_force(tied, per_chunk):
    """Rows equal in all order values may come in any order: compare what is the same in each."""
    data, df = tied
    ranked = windows.rank_both(df, "k", ["ts", "tag"], rows_per_chunk=per_chunk).collect()
    for key in ("hot", "a", None):
        group = [r for r in data if r[0] == key]
        for name, down in (("rn_first", False), ("rn", True)):
            mine = sorted((r for r in ranked if r["k"] == key), key=lambda r: r[name])
            assert [r[name] for r in mine] == list(range(1, len(group) + 1))
            assert [(r["ts"], r["tag"]) for r in mine] == [(r[1], r[2]) for r in in_order(group, down)]
    # with the value as the last order column every order is the same but for equal rows
    total = windows.running_sum(df, "k", ["ts", "tag", "v"], "v", "run", rows_per_chunk=per_chunk).collect()
    following = windows.with_next(df, "k", ["ts", "tag", "v"], {"v": "next"}, rows_per_chunk=per_chunk).collect()
    for key in ("hot", "a", None):
        group = in_order(sorted((r for r in data if r[0] == key), key=lambda r: r[3]))
        sums, run = [], 0
        for r in group:
            run += r[3]
            sums.append((r[3], run))
        assert sorted((r["v"], r["run"]) for r in total if r["k"] == key) == sorted(sums)
        nexts = [(a[3], b[3] if b else None) for a, b in zip(group, [*group[1:], None])]
        assert sorted(((r["v"], r["next"]) for r in following if r["k"] == key), key=repr) == sorted(nexts, key=repr)
