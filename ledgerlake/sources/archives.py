"""CSV members of zip, gzip and plain files, each member read as a stream by one task.

The index of a zip (its central directory) is read by seeking, without the data. The bytes of all files come through
Spark's splittable text scan: a line ends at byte 10 only, so lines joined by it are the file again. Their offsets
follow from the sizes of the splits before. Pieces of the files meet their members by cell of the file, and a task
inflates, decodes and parses a member piece by piece, so neither an archive nor a member is ever held whole.
"""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialize
from ledgerlake.sources.files import RemoteFile, each_file, read_bytes

CELL = 1 << 18  # bytes of a file that travel as one row
_STEP = 1 << 16  # bytes inflated at once
ROWS = 2000

# how the bytes of a member are stored
PLAIN, DEFLATED, GZIPPED, ZIPPED = "plain", "deflated", "gzip", "zip member"
MEMBERS = "path string, member string, start long, stop long, size long, kind string"


def _listed(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def members_of(spark: SparkSession, path: str, length: int) -> list[tuple]:
    """Members of one file by its first bytes: path, member, first and last byte, stored size, kind."""
    head = read_bytes(spark, path, 0, 4)
    name = _listed(path)
    if head[:2] == b"PK":
        with zipfile.ZipFile(io.BufferedReader(RemoteFile(spark, path, length), 1 << 16)) as archive:
            found = []
            for info in archive.infolist():
                if not info.filename.lower().endswith(".csv"):
                    continue
                if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or info.flag_bits & 1:
                    raise ValueError(f"{info.filename} in {name} is encrypted or compressed in another way than deflate")
                # the local header has a name and an extra field of up to 65,535 bytes each
                most = min(archive.start_dir, info.header_offset + 30 + 2 * 65_535 + info.compress_size)
                kind = ZIPPED if info.compress_type == zipfile.ZIP_STORED else DEFLATED
                found.append((path, info.filename, info.header_offset, most, info.compress_size, kind))
        if not found:
            raise ValueError(f"no CSV inside {name}")
        return found
    gzipped = head[:2] == b"\x1f\x8b"
    if gzipped and path.endswith(".gz"):  # Spark's scan inflates it as it reads
        return [(path, name.removesuffix(".gz"), 0, None, None, PLAIN)]
    return [(path, name, 0, length, length, GZIPPED if gzipped else PLAIN)] if length else []


def archive_members(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One small row for each member of the files."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    lengths = {r["path"]: r["length"] for r in files.toLocalIterator()}
    found = each_file(lengths, lambda p: members_of(spark, p, lengths[p]))
    return spark.createDataFrame([m for _, ms in found for m in ms], MEMBERS)


def file_pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The bytes of the files: path, cell, offset and bytes of at most a cell's length, cut at the cells."""
    scan = spark.read.option("lineSep", "\n").text(list(paths))
    lines = scan.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )
    totals = lines.groupBy("file", "block").agg(F.sum(F.octet_length("value") + F.lit(1)).alias("n"))
    order = Window.partitionBy("file").orderBy("block")
    bases = {(r["file"], r["block"]): r["base"] for r in totals.select("file", "block", (F.sum("n").over(order) - F.col("n")).alias("base")).toLocalIterator()}

    def cut(file: str, at: int, data: bytes) -> Iterator[tuple]:
        place = 0
        while place < len(data):
            cell = (at + place) // CELL
            size = min(len(data) - place, (cell + 1) * CELL - at - place)
            yield file, cell, at + place, data[place : place + size]
            place += size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in zip(batch["file"], batch["block"], batch["value"]))
        for (file, block), found in groupby(rows, lambda row: row[:2]):
            at, held, size = bases[(file, block)], [], 0
            for _, _, value in found:
                held += [value, b"\n"]
                size += len(value) + 1
                if size >= CELL:
                    yield pd.DataFrame(cut(file, at, b"".join(held)), columns=["file", "cell", "at", "data"])
                    at, held, size = at + size, [], 0
            if held:
                yield pd.DataFrame(cut(file, at, b"".join(held)), columns=["file", "cell", "at", "data"])

    return lines.mapInPandas(run, "file string, cell long, at long, data binary")


def _payload(start: int, size: int | None, kind: str, pieces: Iterable[tuple[int, bytes]]) -> Iterator[bytes]:
    """The stored bytes of a member, without a zip's local header, from pieces (offset, bytes) in order."""
    skip, left, head = 0, size, b""
    in_zip = kind in (DEFLATED, ZIPPED)
    for at, data in pieces:
        data = data[max(0, start - at) :]
        if in_zip and skip == 0:
            head += data
            if len(head) < 30:
                continue
            skip = 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
            data, skip = head[skip:], max(skip - len(head), 0) or -1
            head = b""
        elif skip > 0:
            data, skip = data[skip:], max(skip - len(data), 0) or -1
        if left is not None:
            data, left = data[:left], left - len(data[:left])
        if data:
            yield data


def _inflated(kind: str, stored: Iterable[bytes]) -> Iterator[bytes]:
    if kind in (PLAIN, ZIPPED):
        yield from stored
        return
    make = (lambda: zlib.decompressobj(31)) if kind == GZIPPED else (lambda: zlib.decompressobj(-15))
    inflate = make()
    for data in stored:
        while data:
            if inflate.eof:  # gzip files may be several one after another
                if kind != GZIPPED:
                    return
                inflate = make()
            out = inflate.decompress(data, _STEP)
            data = inflate.unconsumed_tail or (inflate.unused_data if inflate.eof else b"")
            if out:
                yield out
    while out := inflate.decompress(inflate.unconsumed_tail, _STEP):
        yield out


def encoding_of(parts: Iterable[bytes]) -> str:
    """UTF-16 by its mark, else the first of UTF-8, windows-1252 and ISO-8859-1 that all bytes allow."""
    utf8, unmapped, head = codecs.getincrementaldecoder("utf-8")(), False, b""
    valid = True
    for data in parts:
        if len(head) < 2:
            head += data[:2]
            if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
                return "utf-16"
        unmapped = unmapped or any(b in data for b in (b"\x81", b"\x8d", b"\x8f", b"\x90", b"\x9d"))
        if valid:
            try:
                utf8.decode(data)
            except UnicodeDecodeError:
                valid = False
    if valid:
        try:
            utf8.decode(b"", True)
            return "utf-8-sig"
        except UnicodeDecodeError:
            pass
    return "latin1" if unmapped else "cp1252"


def _lines(parts: Iterable[bytes], encoding: str) -> Iterator[str]:
    """Text lines with their ends, so that a quoted field may hold one."""
    decode, rest = codecs.getincrementaldecoder(encoding)(), ""
    for data in parts:
        text = rest + decode.decode(data)
        # an end of line at the very end may be half of a longer one
        lines = io.StringIO(text, newline="").readlines()
        rest = lines.pop() if lines else ""
        yield from lines
    if encoding != "utf-16":  # the scan may have ended the last line with a byte of its own
        rest += decode.decode(b"", True)
    if rest:
        yield from io.StringIO(rest, newline="")


def _streams(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """Path, member, start and encoding of members with their inflated bytes, for rows sorted by member and offset."""
    names = ["path", "member", "start", "size", "kind", "encoding", "at", "data"]
    rows = (row for batch in batches for row in batch[names].itertuples(index=False, name=None))
    for key, found in groupby(rows, lambda row: row[:3]):
        first = next(found)
        start, size, kind = int(first[2]), None if pd.isna(first[3]) else int(first[3]), first[4]
        pieces = (x for part in ([first], found) for x in ((row[6], row[7]) for row in part))
        yield (*key, first[5]), _inflated(kind, _payload(start, size, kind, pieces))


def _encodings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for (path, member, start, _), parts in _streams(batches):
        yield pd.DataFrame([(path, member, start, encoding_of(parts))], columns=["path", "member", "start", "encoding"])


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "member", "header", "values"]
    for (path, member, _, encoding), parts in _streams(batches):
        rows = csv.reader(_lines(parts, encoding))
        header = next(rows, None)
        if not header:
            continue
        out = []
        for row in rows:
            if not row or len(row) > len(header):
                continue
            out.append((path, member, header, [v if v != "" else None for v in row] + [None] * (len(header) - len(row))))
            if len(out) == ROWS:
                yield pd.DataFrame(out, columns=names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names)


def read_csv_archive(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """CSV members of zip, gzip or plain files, told apart by their first bytes.

    All columns are text; lines with too many fields are skipped. ``path`` and ``member`` say where a row came from.
    One member is one unit of work, in bounded memory; it is inflated once to find its encoding and once to be read.
    """
    members = materialize(archive_members(spark, path), "members")
    files = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("file"))
    # the list of paths is what the scan itself needs on the driver
    paths = [r["path"] for r in members.select("path").distinct().toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], "path string, member string" + "".join(f", `{c}` string" for c in columns or ()))
    pieces = file_pieces(spark, paths).join(files, "file").drop("file")
    cells = F.sequence((F.col("start") / F.lit(CELL)).cast("long"), ((F.col("stop") - 1) / F.lit(CELL)).cast("long"))
    ranged = members.where("stop IS NOT NULL").withColumn("cell", F.explode(cells))
    whole = members.where("stop IS NULL")  # their length is known when they are inflated
    columns_of = [c for c in members.columns if c != "path"]
    met = pieces.join(ranged, ["path", "cell"]).select("path", "at", "data", *columns_of).unionByName(
        pieces.join(whole, "path").select("path", "at", "data", *columns_of)
    )
    met = materialize(met.where("stop IS NULL OR at < stop"), "pieces")

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition("path", "member", "start").sortWithinPartitions("path", "member", "start", "at")

    found = dealt(met.withColumn("encoding", F.lit(None).cast("string"))).mapInPandas(_encodings, "path string, member string, start long, encoding string")
    rows = dealt(met.join(materialize(found, "encodings"), ["path", "member", "start"])).mapInPandas(
        _rows, "path string, member string, header array<string>, values array<string>"
    )
    if columns is None:
        names = rows.select(F.explode("header").alias("c")).distinct().orderBy("c")
        columns = [r["c"] for r in names.toLocalIterator()]
    by_name = F.map_from_arrays("header", "values")
    return rows.select("path", "member", *[by_name[c].alias(c) for c in columns])
