"""State kept from a change stream."""

from __future__ import annotations

import datetime as dt

import pytest

from ledgerlake.session import build_session, partitions_for
from ledgerlake.streaming import landing
from tests.conftest import rows

SCHEMA = "k string, ts timestamp, v int"


def put(spark, path, *data):
    spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_upsert_over_several_runs(spark, tmp_path):
    src, target, checkpoint = (str(tmp_path / n) for n in ("src", "state", "progress"))
    day = lambda d: dt.datetime(2024, 1, d)

    def run():
        schema = spark.createDataFrame([], SCHEMA).schema
        stream = landing.stream_files(spark, src, schema, max_files=1)
        landing.stream_upsert(stream, "k", "ts", target, checkpoint, ["v"], buckets=4)
        return rows(landing.read_state(spark, target, schema), "k", "v")

    put(spark, src, ("a", day(1), 1), ("a", day(2), 2), ("b", day(1), 3), (None, day(1), 4))
    assert run() == [("a", 2), ("b", 3), (None, 4)]
    # an older change loses, an equal time is settled by the tie column, other keys stay
    put(spark, src, ("a", day(1), 9), ("b", day(1), 7), ("c", day(3), 5))
    assert run() == [("a", 2), ("b", 7), ("c", 5), (None, 4)]
    assert run() == [("a", 2), ("b", 7), ("c", 5), (None, 4)]


def upserts(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "state")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(checkpoint, **more):
        stream = landing.stream_files(spark, src, schema, max_files=1)
        landing.stream_upsert(stream, "k", "ts", target, str(tmp_path / checkpoint), ["v"], **{"buckets": 4} | more)

    return src, target, run, lambda: rows(landing.read_state(spark, target, schema), "k", "v")


DAY = [dt.datetime(2024, 1, d) for d in range(1, 10)]


def test_a_lost_checkpoint_loses_no_state(spark, tmp_path):
    src, target, run, state = upserts(spark, tmp_path)
    for d in range(3):
        put(spark, src, ("a", DAY[d], d), ("b", DAY[d], d))
    run("one")
    assert state() == [("a", 2), ("b", 2)]
    put(spark, src, ("a", DAY[5], 5), ("c", DAY[5], 5))
    run("two")  # reads all files again, numbered from 0
    assert state() == [("a", 5), ("b", 2), ("c", 5)]
    put(spark, src, ("b", DAY[6], 6))
    run("one")  # the first checkpoint goes on as well
    assert state() == [("a", 5), ("b", 6), ("c", 5)]


def test_a_batch_that_dies_half_way_is_not_seen(spark, tmp_path, monkeypatch):
    src, target, run, state = upserts(spark, tmp_path)
    put(spark, src, ("a", DAY[0], 1))
    run("one")
    put(spark, src, ("a", DAY[1], 2), ("b", DAY[1], 2))
    publish = landing.publish_text

    def dies(*_):
        raise OSError("killed after the data was written")

    monkeypatch.setattr(landing, "publish_text", dies)
    with pytest.raises(Exception, match="killed"):
        run("one")
    assert state() == [("a", 1)]  # the data is there, no manifest names it
    monkeypatch.setattr(landing, "publish_text", publish)
    run("one")
    assert state() == [("a", 2), ("b", 2)]


def test_a_batch_published_before_its_checkpoint_is_not_applied_twice(spark, tmp_path, monkeypatch):
    src, target, run, state = upserts(spark, tmp_path)
    put(spark, src, ("a", DAY[0], 1))
    publish = landing.publish_text

    def dies_late(*args):
        publish(*args)
        raise OSError("killed after the manifest was published")

    monkeypatch.setattr(landing, "publish_text", dies_late)
    with pytest.raises(Exception, match="killed"):
        run("one")
    monkeypatch.setattr(landing, "publish_text", publish)
    before = landing._manifests(spark, target)
    run("one")
    assert landing._manifests(spark, target) == before and state() == [("a", 1)]


def test_a_second_writer_fails_and_other_bucket_counts_are_refused(spark, tmp_path, monkeypatch):
    src, target, run, state = upserts(spark, tmp_path)
    put(spark, src, ("a", DAY[0], 1))
    run("one")
    put(spark, src, ("a", DAY[1], 2))
    newest = landing._newest
    monkeypatch.setattr(landing, "_newest", lambda *x: (newest(*x)[0] - 1, newest(*x)[1]))  # read before another one published
    with pytest.raises(Exception, match="another writer"):
        run("one")
    monkeypatch.setattr(landing, "_newest", newest)
    with pytest.raises(Exception, match="buckets"):
        run("one", buckets=8)
    run("one")
    assert state() == [("a", 2)]


def test_compaction_leaves_the_newest_state(spark, tmp_path):
    src, target, run, state = upserts(spark, tmp_path)
    for d in range(4):
        put(spark, src, ("a", DAY[d], d), (f"only{d}", DAY[d], d))
    run("one")
    expected = state()
    put(spark, f"{target}/data/halfwritten/bucket=0", ("x", DAY[0], 0))
    removed = landing.compact_state(spark, target, keep=1)
    assert "halfwritten" in removed and state() == expected and len(landing._manifests(spark, target)) == 1
    put(spark, src, ("a", DAY[8], 8))
    run("one")
    assert ("a", 8) in state() and len(state()) == len(expected)


def test_empty_state(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert landing.read_state(spark, str(tmp_path / "none"), schema).count() == 0


def test_shuffles_are_sized_to_the_input():
    assert partitions_for(1) == 200
    assert partitions_for(100 * 10**12) > 400_000
    assert build_session.__doc__
