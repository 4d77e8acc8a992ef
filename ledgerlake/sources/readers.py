"""Scans: parameterised SQL, CSV trees, unknown encodings, archives, JSON."""

from __future__ import annotations

import csv
import datetime as dt
from collections import Counter
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.setops import union_evolving
from ledgerlake.sources.archives import read_csv_archive  # noqa: F401
from ledgerlake.session import materialize
from ledgerlake.sources.files import each_file, read_bytes


def read_sql(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None, **tables) -> DataFrame:
    """SQL over catalog tables with bound ``:name`` parameters; frames may be passed as ``{name}``."""
    return spark.sql(sql, args=dict(params or {}), **tables)


def read_sql_file(
    spark: SparkSession, path: str, params: Mapping[str, object] | None = None, **tables
) -> DataFrame:
    """A query kept in a text file, on any file system Spark can read."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return read_sql(spark, text.strip().rstrip(";"), params, **tables)


def read_parquet(spark: SparkSession, path: str, merge: bool = True) -> DataFrame:
    """Parquet with the columns of all files merged."""
    return spark.read.option("mergeSchema", merge).parquet(path)


def read_csv_tolerant(
    spark: SparkSession, path: str | Sequence[str], schema: str | None = None, bad: str = "drop", quote: str = '"'
) -> DataFrame:
    """Headed CSV; malformed lines are dropped, or kept in ``_corrupt_record`` with ``bad="capture"``."""
    reader = spark.read.option("header", True).option("quote", quote)
    if schema is None:
        fields = reader.csv(path).schema
    else:
        fields = T.StructType.fromDDL(schema)
    if bad == "drop":
        return reader.schema(fields).option("mode", "DROPMALFORMED").csv(path)
    marked = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    return (
        reader.schema(marked)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )


# Encodings in the order they are tried.
ENCODINGS = ("UTF-8", "UTF-16", "windows-1252", "ISO-8859-1")

# windows-1252 differs from ISO-8859-1 only in these bytes.
_C1 = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_LATIN1_CHARS = "".join(map(chr, _C1))
_CP1252_CHARS = bytes(_C1).decode("cp1252")


def detect_encodings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file with the first encoding its bytes allow.

    Reads every byte as splittable text lines; bytes are only validated, never decoded.
    """
    raw = F.col("value").cast("binary")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.is_valid_utf8("value").alias("utf8"),
        F.substring(F.hex(raw), 1, 4).isin("FFFE", "FEFF").alias("bom16"),
        F.hex(raw).rlike("^(..)*(81|8D|8F|90|9D)").alias("unmapped"),
    )
    facts = lines.groupBy("path").agg(
        F.min("utf8").alias("utf8"), F.max("bom16").alias("bom16"), F.max("unmapped").alias("unmapped")
    )
    utf8, utf16, cp1252, latin1 = (F.lit(e) for e in ENCODINGS)
    return facts.select(
        "path",
        F.when(F.col("utf8"), utf8)
        .when(F.col("bom16"), utf16)
        .when(~F.col("unmapped"), cp1252)
        .otherwise(latin1)
        .alias("encoding"),
    )


# how Python calls the encodings whose lines end at one byte
_CODECS = {"UTF-8": "utf-8", "windows-1252": "cp1252", "ISO-8859-1": "latin1"}


def read_csv_any_encoding(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Headed CSV files of mixed encodings as one frame.

    One scan takes the bytes of all files but UTF-16 ones as they are, by position, and decodes each cell by its
    file's encoding. UTF-16 cannot be split at lines; its files are read whole, each by one task.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("url"))
    kinds = materialize(files.join(detect_encodings(spark, path).withColumnRenamed("path", "url"), "url"), "encodings")
    found = {r["path"]: (r["url"], r["encoding"]) for r in kinds.toLocalIterator()}
    if not found:
        raise FileNotFoundError(f"no files under {path}")
    parts = []
    plain = [p for p, (_, encoding) in found.items() if encoding in _CODECS]
    rows = []
    for name, line in each_file(plain, lambda p: first_line(spark, p)):
        url, encoding = found[name]
        text = None if line is None else line.decode(_CODECS[encoding])
        if text and text.strip():
            rows.append((url, name, header_names(text), encoding))
    if rows:
        heads = materialize(spark.createDataFrame(rows, "url string, source_path string, header array<string>, encoding string"), "headers")
        reader = spark.read.option("encoding", "ISO-8859-1")
        kind = F.col("encoding")

        def decoded(cell: Column) -> Column:
            utf8 = F.decode(F.encode(cell, "ISO-8859-1"), "UTF-8")
            return F.when(kind == "UTF-8", utf8).when(kind == "windows-1252", F.translate(cell, _LATIN1_CHARS, _CP1252_CHARS)).otherwise(cell)

        parts.append(_by_position(reader, path, heads, decoded).drop("source_path"))
    wide = [p for p, (_, encoding) in found.items() if encoding == "UTF-16"]
    if wide:
        part = spark.read.option("header", True).option("encoding", "UTF-16").option("multiLine", True).csv(wide)
        parts.append(part.toDF(*[c.lstrip("\ufeff") for c in part.columns]))
    return union_evolving(parts)


def list_files(spark: SparkSession, path: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Paths, names, sizes and times of files under a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified_at"),
    )


def files_in_backlog(
    spark: SparkSession, path: str, prefix: str, days: int, today: dt.date, suffix: str = ".zip"
) -> DataFrame:
    """Files whose name carries a ``dd_MM_yyyy`` date of the last ``days`` days, oldest first."""
    return backlog_of(list_files(spark, path), "file_name", prefix, days, today, suffix).orderBy(
        "file_date", "path"
    )


def backlog_of(
    files: DataFrame, name_col: str, prefix: str, days: int, today: dt.date, suffix: str = ".zip"
) -> DataFrame:
    """The file-name date filter on any listing."""
    pattern = rf"(\d{{2}}_\d{{2}}_\d{{4}}){suffix.replace('.', chr(92) + '.')}$"
    found = files.filter(F.col(name_col).startswith(prefix)).withColumn(
        "file_date",
        F.try_to_timestamp(
            F.nullif(F.regexp_extract(name_col, pattern, 1), F.lit("")), F.lit("dd_MM_yyyy")
        ).cast("date"),
    )
    return found.filter(F.datediff(F.lit(today), F.col("file_date")) <= days)


def first_line(spark: SparkSession, path: str, step: int = 1 << 14) -> bytes | None:
    """The first line of a text file, without a UTF-8 mark; only its bytes are read, and some behind."""
    data = b""
    while b"\n" not in data and b"\r" not in data:
        more = read_bytes(spark, path, len(data), step)
        if not more:
            break
        data += more
        step *= 2
    found = data.removeprefix(b"\xef\xbb\xbf").splitlines()
    return found[0] if found else None


def header_names(line: str) -> list[str]:
    """Column names of a header as Spark's CSV reader makes them: no empty ones, repeated ones numbered."""
    raw = next(csv.reader([line], escapechar="\\", doublequote=False))
    counts = Counter(name.lower() for name in raw)
    return [f"_c{i}" if not name else f"{name}{i}" if counts[name.lower()] > 1 else name for i, name in enumerate(raw)]


def tree_headers(spark: SparkSession, base: str) -> DataFrame:
    """One small row for each ``.csv`` below a folder: its names in the scan and outside, and its columns."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
    files = spark.read.format("binaryFile").options(**options).load(base).where("length > 0")
    urls = {r["path"]: r["url"] for r in files.select("path", F.col("_metadata.file_path").alias("url")).toLocalIterator()}
    heads = each_file(urls, lambda path: first_line(spark, path))
    rows = [(urls[path], path, header_names(line.decode(errors="replace"))) for path, line in heads if line and line.strip()]
    return spark.createDataFrame(rows, "url string, source_path string, header array<string>")


def _by_position(reader, path: str | Sequence[str], heads: DataFrame, decoded: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """One scan of headed CSV files whose headers (url, source_path, header) differ, as text columns by name."""
    widest = heads.agg(F.max(F.size("header"))).first()[0]
    found = heads.select(F.explode("header").alias("name")).groupBy(F.lower("name")).agg(F.min("name").alias("name"))
    names = [r["name"] for r in found.orderBy("name").select("name").toLocalIterator()]
    place = lambda name: F.array_position(F.transform("header", F.lower), F.lit(name.lower())).cast("int") - 1
    more = [c for c in heads.columns if c != "header"]
    heads = heads.select(*more, F.array(*(place(n) for n in names)).alias("places"))
    by_place = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(widest)])
    scan = reader.schema(by_place).option("header", True).csv(path)
    scan = scan.select(F.array(*(f"_{i}" for i in range(widest))).alias("cells"), F.col("_metadata.file_path").alias("url"))
    rows = scan.join(heads, "url")
    cell = lambda i: F.when(F.col("places")[i] >= 0, decoded(F.get("cells", F.col("places")[i])))
    return rows.select(*(cell(i).alias(n) for i, n in enumerate(names)), "source_path")


def read_csv_tree(spark: SparkSession, base: str) -> DataFrame:
    """Every ``.csv`` below a folder as text columns plus ``source_path``; files may differ in header.

    The first bytes of each file give its header. Then the tree is scanned once, by position, and each row takes its
    columns from where its file's header has them.
    """
    heads = materialize(tree_headers(spark, base), "headers")
    if heads.isEmpty():
        raise FileNotFoundError(f"no .csv files under {base}")
    return _by_position(spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.csv"), base, heads)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Files that hold one JSON array (or one object spread over lines)."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)
