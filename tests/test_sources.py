"""Files: encodings, archives, backlog, conversion, report files."""

from __future__ import annotations

import datetime as dt
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import jobs
from ledgerlake.sources import readers, sinks
from tests.conftest import rows


def put(path, data: bytes):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def test_encodings_are_told_apart(spark, tmp_path):
    text = "id,name\n1,naïve – €5\n2,plain\n"
    put(tmp_path / "u8.csv", text.encode("utf-8"))
    put(tmp_path / "sig.csv", text.encode("utf-8-sig"))
    put(tmp_path / "u16.csv", text.encode("utf-16"))
    put(tmp_path / "cp.csv", text.encode("cp1252"))
    put(tmp_path / "l1.csv", b"id,name\n1,\x81\xe9\n")
    found = {r["path"].rsplit("/", 1)[-1]: r["encoding"] for r in readers.detect_encodings(spark, str(tmp_path)).collect()}
    assert found == {
        "u8.csv": "UTF-8", "sig.csv": "UTF-8", "u16.csv": "UTF-16", "cp.csv": "windows-1252", "l1.csv": "ISO-8859-1",
    }
    got = readers.read_csv_any_encoding(spark, str(tmp_path))
    assert rows(got, "id", "name").count(("1", "naïve – €5")) == 4
    assert ("1", "\x81é") in rows(got, "id", "name")


def test_encodings_are_read_in_one_scan(spark, tmp_path):
    """Headers and cells of several encodings, columns in any order; UTF-16 alone is read apart."""
    put(tmp_path / "u8.csv", "näme,id\nżółć €,1\n\"a, ü\",2\n".encode())
    put(tmp_path / "sig.csv", "id,näme\n3,ß\n".encode("utf-8-sig"))
    put(tmp_path / "cp.csv", "id,näme,more\n4,“€”,ž\n5,,\n".encode("cp1252"))
    put(tmp_path / "l1.csv", "id,näme\n6,\x81é\n".encode("latin1"))
    put(tmp_path / "wide.csv", "id,näme\n7,Ǆ中\n".encode("utf-16"))
    got = readers.read_csv_any_encoding(spark, str(tmp_path))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "id", "näme", "more") == sorted(
        [("1", "żółć €", None), ("2", "a, ü", None), ("3", "ß", None), ("4", "“€”", "ž"), ("5", None, None), ("6", "\x81é", None), ("7", "Ǆ中", None)], key=repr
    )
    assert text.count("FileScan csv") == 2


def test_archives_zip_gzip_and_plain(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", 'id,name\n1,"a, b"\n2,\n3,x,too many\n')
        z.writestr("two.csv", "id,other\n4,é\n".encode("cp1252"))
        z.writestr("readme.txt", "no")
    put(tmp_path / "b.csv.gz", gzip.compress(b"id,name\n5,e\n"))
    put(tmp_path / "c.csv", b"id,name\n6\n")
    got = readers.read_csv_archive(spark, str(tmp_path))
    assert rows(got, "member", "id", "name", "other") == sorted(
        [
            ("one.csv", "1", "a, b", None),
            ("one.csv", "2", None, None),
            ("two.csv", "4", None, "é"),
            ("b.csv", "5", "e", None),
            ("c.csv", "6", None, None),
        ],
        key=repr,
    )


def test_archives_of_many_cells(spark, tmp_path, monkeypatch):
    """Members larger than a cell, many in one archive, stored and deflated, with end marks and quotes across pieces."""
    import random

    from ledgerlake.sources import archives

    pick, expected = random.Random(3), []
    with zipfile.ZipFile(tmp_path / "many.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for m in range(12):
            lines = [(str(i), "".join(pick.choice('abé\n",;') for _ in range(pick.randrange(60)))) for i in range(1500 if m < 3 else 20)]
            text = "id,v\r\n" + "".join(f'{i},"{v.replace(chr(34), chr(34) * 2)}"\r\n' for i, v in lines)
            expected += [(f"d/{m}.csv", i, v or None) for i, v in lines]
            encoding = ("utf-8", "utf-16", "cp1252")[m % 3]
            z.writestr(f"d/{m}.csv", text.encode(encoding), zipfile.ZIP_STORED if m % 2 else zipfile.ZIP_DEFLATED)
    text = "id,v\n" + "".join(f"{i},{pick.random()}\n" for i in range(3000))
    expected += [(n, *line.split(",")) for n in ("plain.csv", "packed.bin", "last.csv") for line in text.split()[1:]]
    put(tmp_path / "plain.csv", text.encode("utf-8-sig"))
    put(tmp_path / "packed.bin", gzip.compress(text[:9000].encode()) + gzip.compress(text[9000:].encode()))
    put(tmp_path / "last.csv.gz", gzip.compress(text.rstrip("\n").encode()))
    put(tmp_path / "u16.csv", "id,v\n1,\u0a0a".encode("utf-16"))
    put(tmp_path / "empty.csv", b"")
    expected.append(("u16.csv", "1", "\u0a0a"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = readers.read_csv_archive(spark, str(tmp_path), ["id", "v"])
        assert rows(got, "member", "id", "v") == sorted(expected, key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_large_member_is_read_in_bounded_memory():
    """200 MB of text in one member; what is held at a time stays far below that."""
    import io
    import tracemalloc

    import pandas as pd

    from ledgerlake.sources import archives

    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z, z.open("big.csv", "w") as member:
        member.write(b"id,v\n")
        for _ in range(200):
            member.write(b"1,abcdefghijklmnop\n" * 55_000)
    data = held.getvalue()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        (info,) = z.infolist()
    names = ["path", "member", "start", "size", "kind", "encoding", "at", "data"]
    pieces = (
        pd.DataFrame([("p", "big.csv", 0, info.compress_size, archives.DEFLATED, "utf-8-sig", at, data[at : at + 4096])], columns=names)
        for at in range(0, len(data), 4096)
    )
    tracemalloc.start()
    n = sum(len(x) for x in archives._rows(pieces))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200 * 55_000 and peak < 30 << 20


def test_zip_without_csv_is_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("readme.txt", "no")
    with pytest.raises(Exception, match="no CSV inside"):
        readers.read_csv_archive(spark, str(tmp_path), ["id"]).collect()


def test_backlog_takes_recent_files_oldest_first(spark, tmp_path):
    for name in ("Visits_1_05_01_2024.zip", "Visits_2_09_01_2024.zip", "Visits_3_01_01_2024.zip", "Visits_4_99_01_2024.zip", "Else_09_01_2024.zip"):
        put(tmp_path / name, b"x")
    got = readers.files_in_backlog(spark, str(tmp_path), "Visits", 5, dt.date(2024, 1, 10))
    assert [r["file_name"] for r in got.collect()] == ["Visits_1_05_01_2024.zip", "Visits_2_09_01_2024.zip"]


def test_screen_visits_land_by_file_date(spark, tmp_path):
    for day, value in (("08", "a"), ("09", "b")):
        with zipfile.ZipFile(tmp_path / f"Visits_{day}_01_2024.zip", "w") as z:
            z.writestr("v.csv", f"User Id,Écran\n1,{value}\n")
    out = str(tmp_path / "out")
    for _ in range(2):
        jobs.land_screen_visits(spark, str(tmp_path), out, "Visits", dt.date(2024, 1, 10), overwrite=True)
    got = spark.read.parquet(out)
    assert rows(got, "user_id", "ecran", "date", "day") == [("1", "a", "2024-01-08", 8), ("1", "b", "2024-01-09", 9)]
    nothing = jobs.land_screen_visits(spark, str(tmp_path), out, "Other", dt.date(2024, 1, 10))
    assert nothing["written"] is False


def test_tolerant_csv_can_capture(spark, tmp_path):
    put(tmp_path / "x.csv", b"id,v\n1,2.5\n2,oops\n")
    schema = "id int, v double"
    assert rows(readers.read_csv_tolerant(spark, str(tmp_path), schema)) == [(1, 2.5)]
    kept = readers.read_csv_tolerant(spark, str(tmp_path), schema, bad="capture")
    assert rows(kept, "id", "v", "_corrupt_record") == [(1, 2.5, None), (2, None, "2,oops")]


def test_csv_tree_to_parquet_archives_after_the_check(spark, tmp_path):
    src, dst, archive = (tmp_path / n for n in ("table", "parquet", "archive"))
    put(src / "date=20240101" / "a.csv", b"id,created_date,v\n1,2024-01-01 10:00:00,1.5\n")
    put(src / "date=20240102" / "b.csv", b"id,created_date,extra\n2,junk,x\n")
    verdict = jobs.csv_to_parquet(spark, str(src), str(dst), str(archive))
    assert verdict["ok"] and verdict["rows"] == (2, 2)
    got = spark.read.parquet(str(dst))
    assert dict(got.dtypes) == {"id": "int", "created_date": "timestamp", "v": "double", "extra": "string"}
    assert (archive / "date=20240101" / "a.csv").exists() and not (src / "date=20240101" / "a.csv").exists()


def test_csv_tree_is_scanned_once(spark, tmp_path):
    """Fifty headers, columns in any order, short and long lines, quotes, blank lines, lines like the header."""
    expected = []
    for i in range(50):
        names = [f"c{i}", "id", "Name"] if i % 2 else ["id", "name", f"c{i}", "c0"]
        body = [",".join(names), f'x{i},"a, ""b""",{i}', "", ",".join(names), "only", "1,2,3,4,5,6"]
        put(tmp_path / f"d={i % 7}" / f"f {i}.csv", ("\n".join(body) + "\n").encode("utf-8-sig" if i % 3 == 0 else "utf-8"))
        whole = spark.read.option("header", True).csv(str(tmp_path / f"d={i % 7}" / f"f {i}.csv"))
        lower = [c.lower() for c in whole.columns]
        expected += [{c: v for c, v in zip(lower, r) if v is not None} for r in whole.collect()]
    put(tmp_path / "none.csv", b"")
    got = readers.read_csv_tree(spark, str(tmp_path))
    assert len(got.columns) == 50 + 2 + 2 + 1  # c0, and c02 and c03 for the header that repeats it
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    found = [{c.lower(): v for c, v in r.asDict().items() if v is not None and c != "source_path"} for r in got.collect()]
    key = lambda d: sorted(d.items())
    assert sorted(found, key=key) == sorted(expected, key=key)
    paths = {r["source_path"].split("file:", 1)[-1] for r in got.select("source_path").distinct().collect()}
    assert {p.rsplit("/", 1)[-1] for p in paths} == {f"f {i}.csv" for i in range(50)}


def test_header_names_are_those_of_the_reader(spark, tmp_path):
    for i, line in enumerate(["a,b", "a,,A,b", '"x, y",z', "a,a,a", " a , b"]):
        put(tmp_path / f"{i}.csv", (line + "\n1\n").encode())
        assert readers.header_names(line) == spark.read.option("header", True).csv(str(tmp_path / f"{i}.csv")).columns


def test_only_the_first_bytes_of_a_file_are_read(spark, tmp_path, monkeypatch):
    put(tmp_path / "big.csv", b"id,v\n" + b"1,2\n" * 500_000)
    read = []
    plain = readers.read_bytes
    monkeypatch.setattr(readers, "read_bytes", lambda s, p, start, n: read.append(n) or plain(s, p, start, n))
    assert readers.first_line(spark, str(tmp_path / "big.csv")) == b"id,v" and sum(read) <= 1 << 15


def test_sql_text_with_parameters(spark, tmp_path):
    put(tmp_path / "q.sql", b"SELECT id FROM {t}\nWHERE id > :low;\n")
    got = readers.read_sql_file(spark, str(tmp_path / "q.sql"), {"low": 1}, t=spark.range(3))
    assert rows(got) == [(2,)]


def test_report_csv_is_one_named_file_when_small(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, name string")
    out = str(tmp_path / "report")
    assert sinks.write_report_csv(df, out, ["id"])["single_file"]
    sinks.name_single_file(spark, out, str(tmp_path / "report.csv"))
    assert (tmp_path / "report.csv").read_text() == "id,name\n1,a\n2,b\n"


def test_large_report_stays_parallel(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4)
    result = sinks.write_report_csv(df, str(tmp_path / "big"), single_file_bytes=10)
    assert not result["single_file"] and result["rows"] == 1000
    assert spark.read.option("header", True).csv(str(tmp_path / "big")).count() == 1000


def test_report_of_many_parts_is_one_ordered_file(spark, tmp_path):
    """More rows than a part file takes: joined in order behind one header, with nothing else in the folder."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        df = spark.range(0, 5000, 1, 16).select(F.col("id").alias("an id"), F.concat(F.lit('x, "'), "id").alias("b"), F.lit(None).cast("string").alias("c"))
        result = sinks.write_report_csv(df.orderBy(F.rand(1)), str(tmp_path / "r"), ["an id"])
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert result["single_file"] and result["rows"] == 5000
    assert sorted(p.name for p in (tmp_path / "r").iterdir() if not p.name.startswith(".")) == ["part-00000.csv"]
    lines = (tmp_path / "r" / "part-00000.csv").read_text().splitlines()
    assert lines[0] == "an id,b,c" and lines[1:] == [f'{i},"x, \\"{i}",' for i in range(5000)]
    sinks.write_report_csv(df.limit(0), str(tmp_path / "r"), ["an id"])
    assert (tmp_path / "r" / "part-00000.csv").read_text() == "an id,b,c\n"


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, date string")
    sinks.land(df, path)
    sinks.land(spark.createDataFrame([(3, "b")], "v int, date string"), path, "overwrite_partitions")
    assert rows(spark.read.schema("v int, date string").parquet(path)) == [(1, "a"), (3, "b")]
    sinks.land(spark.createDataFrame([(4, "c")], "v int, date string"), path, "overwrite")
    assert rows(spark.read.schema("v int, date string").parquet(path)) == [(4, "c")]


def test_max_rows_per_file(spark, tmp_path):
    sinks.land(spark.range(100).coalesce(1), str(tmp_path / "t"), partition_by=(), max_rows=30)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 4


def test_unknown_mode_and_format(spark, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        sinks.land(spark.range(1), str(tmp_path / "t"), "replace", ())
    with pytest.raises(ValueError, match="format"):
        sinks.land(spark.range(1), str(tmp_path / "t"), "append", (), fmt="xml")


def test_publish_stops_on_null_partitions(spark, tmp_path):
    catalog = {"v": {"type": "int", "comment": ""}}
    config = {"d": {"query": "SELECT * FROM {t}", "catalog": catalog, "partition_cols": ["p"]}}
    t = spark.createDataFrame([(1, None)], "v int, p string")
    with pytest.raises(ValueError, match="nulls"):
        jobs.publish(spark, config, str(tmp_path), dt.date(2024, 1, 1), t=t)


def test_json_lines_keep_microseconds(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.123456' AS t")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert rows(readers.read_jsonl(spark, str(tmp_path / "j"), "t timestamp")) == rows(df)


def test_files_of_one_array(spark, tmp_path):
    put(tmp_path / "a.json", b'[\n {"a": 1},\n {"a": 2}\n]')
    assert rows(readers.read_json_array(spark, str(tmp_path)).select(F.col("a").cast("int"))) == [(1,), (2,)]


def test_a_write_by_partition_does_not_sort_what_a_task_holds(spark, tmp_path, monkeypatch):
    """More values than files at once come out whole, and the session's own setting is as before."""
    during, save = [], sinks._save
    monkeypatch.setattr(sinks, "_save", lambda *given: (during.append(int(spark.conf.get(sinks._OPEN_FILES))), save(*given)))
    data = spark.range(500).selectExpr("id", "if(id % 5 = 0, null, id % 50) AS part")
    before = spark.conf.get(sinks._OPEN_FILES)
    sinks.land(data.coalesce(1), str(tmp_path / "t"), "overwrite_partitions", ("part",))
    assert during == [sinks.OPEN_FILES] and spark.conf.get(sinks._OPEN_FILES) == before
    back = spark.read.schema("id long, part long").parquet(str(tmp_path / "t"))
    assert rows(back) == rows(data)


def test_constant_partitions_are_not_moved(spark, tmp_path):
    data = spark.range(0, 100, 1, 4).selectExpr("id", "'2024-03-09' AS date")
    moved = sinks.dealt(data, ["date"])._jdf.queryExecution().optimizedPlan().toString()
    still = sinks.dealt(data, ["date"], ["date"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Rebalance" in moved and "Rebalance" not in still
    config = {"d": {"query": "SELECT * FROM {t}", "catalog": {"id": {"type": "bigint"}}}}
    found = jobs.publish(spark, config, str(tmp_path), dt.date(2024, 3, 9), t=data.drop("date"))
    assert found["d"]["rows"] == 100
    assert len(list((tmp_path / "d" / "date=2024-03-09").glob("part-*.parquet"))) == 4  # as the rows lay
