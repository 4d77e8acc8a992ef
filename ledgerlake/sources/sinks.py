"""Writers for lake tables and report files."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.conform import cast_null_columns, keep_columns
from ledgerlake.operators.setops import union_evolving
from ledgerlake.session import fresh_path
from ledgerlake.sources.files import delete, file_system, join_files, names_in

log = logging.getLogger(__name__)

ROWS_PER_FILE = 400_000

# files of partition values that a task writes side by side; only a task with more of them sorts the rest
OPEN_FILES = 16
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column comments as field metadata."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
            for c in df.columns
        ]
    )


@contextmanager
def open_files(spark: SparkSession, most: int = OPEN_FILES) -> Iterator[None]:
    """Writes inside do not sort a task's rows by partition value, which would hold them all; other settings stay."""
    before = spark.conf.get(_OPEN_FILES)
    if int(before) < 1:
        spark.conf.set(_OPEN_FILES, most)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, before)


def dealt(df: DataFrame, partition_by: Sequence[str], constant: Sequence[str] = ()) -> DataFrame:
    """Few, evenly sized files per partition value; AQE splits a value that is too large.

    Where every partition column is ``constant`` the rows are one partition as they stand, and are not moved.
    """
    if set(partition_by) <= set(constant):
        return df
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str], max_rows: int, constant: Sequence[str] = ()):
    if mode not in ("append", "overwrite", "overwrite_partitions"):
        raise ValueError(f"unknown mode {mode}")
    df = dealt(df, partition_by, constant)
    writer = df.write.mode("append" if mode == "append" else "overwrite").option("maxRecordsPerFile", max_rows)
    writer = writer.option(
        "partitionOverwriteMode", "dynamic" if mode == "overwrite_partitions" else "static"
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


# text formats keep microseconds
_TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _save(writer, path: str, fmt: str) -> None:
    if fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        writer.options(**_TEXT_TIMES).option("header", True).option("escape", "\\").csv(path)
    elif fmt == "json":
        writer.options(**_TEXT_TIMES).json(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def land(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = ("date",),
    max_rows: int = ROWS_PER_FILE,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    comments: Mapping[str, str] | None = None,
    skip_empty: bool = False,
    fallback: bool = False,
    constant: Sequence[str] = (),
) -> dict[str, object]:
    """Write a table folder and report how many rows went out.

    ``overwrite_partitions`` replaces only the partitions present in ``df``. With ``fallback`` a failed
    write is saved as JSON lines under ``<path>_fallback`` and the error is raised again. ``constant`` names
    partition columns with one value in all rows.
    """
    if columns:
        df = keep_columns(df, columns)
    df = cast_null_columns(df)
    if comments:
        df = with_comments(df, comments)
    if skip_empty and df.isEmpty():
        return {"path": path, "rows": 0, "written": False}
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        with open_files(df.sparkSession):
            _save(_writer(observed, mode, partition_by, max_rows, constant), path, fmt)
    except Exception:
        log.error("write to %s failed", path)
        if fallback:
            safe = [c for c in partition_by if c in df.columns]
            _save(_writer(df, "append", safe, max_rows), f"{path.rstrip('/')}_fallback", "json")
        raise
    return {"path": path, "rows": seen.get["rows"], "written": True}


def land_by_day(df: DataFrame, day_col: str, path: str, mode: str = "overwrite_partitions") -> dict[str, object]:
    """One folder per day, named ``day=dd-MM-yyyy``; days in ``df`` are replaced."""
    dated = df.withColumn("day", F.date_format(F.col(day_col), "dd-MM-yyyy"))
    return land(dated, path, mode, partition_by=("day",))


def land_batches(
    batches: Sequence[DataFrame], path: str, partition_by: Sequence[str], overwrite_first: bool
) -> dict[str, object]:
    """Several batches in one write: partitions are replaced once, or everything is appended."""
    mode = "overwrite_partitions" if overwrite_first else "append"
    return land(union_evolving(batches), path, mode, partition_by)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> dict[str, object]:
    return land(df, path, mode, partition_by=(), fmt="json")


def folder_bytes(spark: SparkSession, path: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()["b"]


def write_report_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[str] = (),
    single_file_bytes: int | None = None,
) -> dict[str, object]:
    """Headed CSV extract as one file, ``<path>/part-00000.csv``.

    The report is computed in parallel to a staging table, then its parts are written in parallel, in order and
    without headers, and joined as a stream behind one header: neither a task nor the driver holds the report. A
    report larger than ``single_file_bytes`` stays headed part files, for readers that take a folder.
    """
    spark = df.sparkSession
    staging = fresh_path(spark, "report")
    rows = land(df, staging, "overwrite", partition_by=())["rows"]
    staged = spark.read.schema(df.schema).parquet(staging)
    ordered = staged.orderBy(*order_by) if order_by else staged
    if single_file_bytes is not None and folder_bytes(spark, staging) > single_file_bytes:
        ordered.write.mode("overwrite").option("header", True).csv(path)
        return {"path": path, "rows": rows, "single_file": False}
    parts, head = f"{staging}-parts", f"{staging}-head"
    ordered.write.option("header", False).csv(parts)
    # the names as one row, quoted as the writer does
    places = ", ".join(f"_{i} string" for i in range(len(df.columns)))
    spark.createDataFrame([tuple(df.columns)], places).coalesce(1).write.option("header", False).csv(head)
    delete(spark, path)
    join_files(spark, [f"{folder}/{name}" for folder in (head, parts) for name in names_in(spark, folder)], f"{path}/part-00000.csv")
    for folder in (staging, parts, head):
        delete(spark, folder)
    return {"path": path, "rows": rows, "single_file": True}


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; the target folder is made when missing."""
    fs, src = file_system(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def name_single_file(spark: SparkSession, folder: str, target: str) -> None:
    """Give the only part file of a report folder its hand-off name."""
    fs, _ = file_system(spark, folder)
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    parts = [s.getPath().toString() for s in fs.globStatus(glob)]
    if len(parts) != 1:
        raise ValueError(f"{folder} holds {len(parts)} part files")
    move_file(spark, parts[0], target)
