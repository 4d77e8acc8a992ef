"""Removal of long strings that occur more than once, by refining buckets of positions.

A string of `length` bytes is told by the buckets of its two halves: positions that start with equal halves share a
bucket, and a bucket is refined by the bucket identifier found half a length further on. The halves' buckets come from
the same refinement: buckets of 25-byte grams, refined by the identifiers 25, 50 and 100 bytes further on, each round
reusing the last one's. Identifiers are 64-bit hashes, not ranks, so equal strings of different texts have the same one
without a sort of all positions, and two of them together tell strings apart. Only positions that can matter are
refined to the full length:

1. Every string of `length` bytes has one anchor, the leftmost of its halves with the least identifier, which equal
   strings have at the same place. The strings of one anchor are a run of starts. Runs fall into buckets by their
   anchor's half; a bucket of one run holds no repeat and is dropped. A run is named by the buckets of its first
   and last string, so runs of one name repeat as a whole.
2. The other runs of such buckets are cut into blocks of starts at fixed distances from the anchor. A block's
   bucket is what all of its strings share; blocks alone in their bucket are dropped, equal ones repeat as a whole.
3. The strings of the blocks that are left are counted one by one.

Each step groups by identifiers with partial sums, so neither a passage that a third of the texts hold nor a run of
one letter meets in one task. Texts move twice: for step 2, and to be cut.

Defined results: null is empty; a text shorter than `length` keeps all its bytes. Two rows alike in id and text are
two documents, each a repeat of the other. What is left of a text may be invalid UTF-8; only its bytes' digest is
returned. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.scratch import Scratch

U64 = np.uint64
SEGMENT = 1 << 19  # starts that are looked at together in a long text


@dataclass(frozen=True)
class Settings:
    length: int = 400
    block: int = 16

    @property
    def half(self) -> int:
        return self.length // 2


def bucket_ids(data: np.ndarray, size: int, least: int = 32) -> np.ndarray:
    """Identifier of the string of `size` bytes at every position.

    Buckets of short strings (of `size` halved down to `least` or to an odd length) are refined by the identifiers of
    the same round at the later offset, and each round's identifiers are the next one's, until they stand for `size`.
    """
    if len(data) < size:
        return np.empty(0, U64)
    if size > least and size % 2 == 0:
        ids = bucket_ids(data, size // 2, least)
        return refined(ids, slice(len(ids) - size // 2), size // 2)
    return gram_ids(data, size)


def gram_ids(data: np.ndarray, size: int) -> np.ndarray:
    """Initial buckets: a hash of the `size` bytes at every position."""
    power, inverse = W._grow(len(data))
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(W._BYTE_VALUES[data] * power[: len(data)], out=total[1:])
    n = len(data) - size + 1
    return W.mix((total[size:] - total[:n]) * inverse[:n])


def refined(ids: np.ndarray, at: np.ndarray | slice, further: int) -> np.ndarray:
    """Buckets of the positions (a slice: as many from the first on), refined by the buckets `further` on."""
    later = slice(further, at.stop + further) if isinstance(at, slice) else at + further
    return W.mix(ids[at] * U64(3) + ids[later])


def leftmost_least(ids: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least identifier among the `width` from every position."""
    n = len(ids)
    # high bits of the identifier, then the position
    packed = (ids & ~U64(SEGMENT * 2 - 1)) | np.arange(n, dtype=U64)
    rows = -(-n // width)
    padded = np.full(rows * width, ~U64(0))
    padded[:n] = packed
    padded = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    k = n - width + 1
    return (np.minimum(behind[:k], ahead[width - 1 : width - 1 + k]) & U64(SEGMENT * 2 - 1)).astype(np.int64)


def segments(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of a text that overlap, so that each start is in one of them with its whole string."""
    for at in range(0, len(data) - length + 1, SEGMENT):
        yield at, data[at : at + SEGMENT + length - 1]


def runs(data: np.ndarray, settings: Settings) -> Iterator[tuple[int, np.ndarray, ...]]:
    """(offset, identifiers, anchors, first starts, numbers of starts) of every segment."""
    half = settings.half
    for offset, part in segments(data, settings.length):
        ids = bucket_ids(part, half)
        anchor = leftmost_least(ids, settings.length - half + 1)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        yield offset, ids, anchor[first], first, np.diff(np.append(first, len(anchor)))


_KEYS = [("k1", pa.int64()), ("k2", pa.int32())]
_RUNS = pa.schema([*_KEYS, ("bucket", pa.int64()), ("name", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])
_BLOCKS = pa.schema([*_KEYS, ("bucket", pa.int64()), ("name", pa.int64()), ("start", pa.int64()), ("strings", pa.list_(pa.int64()))])


def _encoded(text: str | None) -> bytes:
    return (text or "").encode(errors="replace")


def _batch(schema: pa.Schema, columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), f.type) for c, f in zip(columns, schema)], schema=schema
    )


def find_runs(keyed: DataFrame, settings: Settings) -> DataFrame:
    """Runs of starts of every text with their bucket and name (no shuffle)."""
    half = settings.half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[] for _ in _RUNS]
        held = 0
        for k1, k2, text in W.rows(batches, "k1", "k2", "text"):
            data = np.frombuffer(_encoded(text), np.uint8)
            for offset, ids, anchor, first, n in runs(data, settings):
                ends = W.mix(refined(ids, first, half) * U64(5) + refined(ids, first + n - 1, half))
                name = W.mix(ends + (anchor - first).astype(U64) * U64(1 << 20) + n.astype(U64))
                values = (np.full(len(n), k1), np.full(len(n), k2), ids[anchor].view(np.int64), name.view(np.int64), first + offset, n)
                for column, value in zip(out, values):
                    column.append(value)
                held += len(n)
            if held > 50_000:
                yield _batch(_RUNS, out)
                out, held = [[] for _ in _RUNS], 0
        yield _batch(_RUNS, out)

    return keyed.mapInArrow(run, "k1 long, k2 int, bucket long, name long, start long, n int")


def cut_blocks(marked: DataFrame, settings: Settings) -> DataFrame:
    """Blocks of the marked runs (columns k1, k2, text, starts): bucket, name, first start and its strings."""
    half, length, size = settings.half, settings.length, settings.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for k1, k2, text, starts in W.rows(batches, "k1", "k2", "text", "starts"):
            data, wanted = np.frombuffer(_encoded(text), np.uint8), np.array(starts)
            for offset, ids, anchors, firsts, counts in runs(data, settings):
                for i in np.flatnonzero(np.isin(firsts + offset, wanted)):
                    anchor, first, n = int(anchors[i]), int(firsts[i]), int(counts[i])
                    strings = refined(ids, np.arange(first, first + n), half)
                    # distances from the anchor, least first, in blocks of fixed borders
                    block = np.arange((anchor - first - n + 1) // size, (anchor - first) // size + 1)
                    a = np.maximum(first, anchor - (block + 1) * size + 1)
                    b = np.minimum(first + n - 1, anchor - block * size)
                    # what all strings of the full block share, from its last start to the end of its first string
                    shared = refined(ids, anchor - block * size, half - size + 1)
                    bucket = W.mix(shared + ids[anchor : anchor + 1] * U64(7) + block.astype(U64))
                    ends = strings[a - first] * U64(5) + strings[b - first] + (b - a).astype(U64)
                    name = W.mix(ends + (anchor - a).astype(U64) * U64(1 << 20))
                    for x, y, low, high in zip(bucket.view(np.int64).tolist(), name.view(np.int64).tolist(), a.tolist(), b.tolist()):
                        rows.append((k1, k2, x, y, low + offset, strings[low - first : high - first + 1].view(np.int64)))
            if len(rows) > 4000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCKS)], schema=_BLOCKS)

    return marked.select("k1", "k2", "text", "starts").mapInArrow(
        run, "k1 long, k2 int, bucket long, name long, start long, strings array<long>"
    )


def cut_spans(data: bytes, starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs of bytes, and the bytes left."""
    if not len(starts):
        return [], data
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], (starts + counts - 1 + length)[order]
    b = np.maximum.accumulate(b)
    new = np.concatenate(([True], a[1:] > b[:-1]))
    spans = list(zip(a[new].tolist(), b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)].tolist()))
    left, at = [], 0
    for x, y in spans:
        left.append(data[at:x])
        at = y
    left.append(data[at:])
    return spans, b"".join(left)


def _repeated(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Rows whose bucket holds several, with `alike`: all of the bucket have one name."""
    buckets = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min("name").alias("low"), F.max("name").alias("high"))
    buckets = buckets.where("rows > 1").select("bucket", (F.col("low") == F.col("high")).alias("alike"))
    buckets = scratch.write(f"{name}-buckets", buckets)
    return rows.join(buckets, "bucket")


def row_keys() -> list[Column]:
    """96 bits that tell rows apart; rows alike in id and text share them, and all that is found of them."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2")]


def repeats(documents: DataFrame, settings: Settings, scratch: Scratch) -> DataFrame:
    """(k1, k2, start, n): starts of strings that also start elsewhere."""
    keyed = documents.select(*row_keys(), "text")
    found = scratch.write("runs", find_runs(keyed, settings))
    several = scratch.write("several", _repeated(found, scratch, "runs"))
    scratch.drop("runs", "runs-buckets")
    place = ["k1", "k2", "start", "n"]
    whole = several.where("alike").select(*place)

    # runs of mixed buckets: equal ones repeat, and one of each name is refined
    mixed = several.where("NOT alike")
    names = scratch.write(
        "names",
        mixed.groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("k1", "k2", "start")).alias("one")),
    )
    equal = mixed.join(names.where("rows > 1").select("bucket", "name"), ["bucket", "name"], "left_semi").select(*place)
    starts = names.groupBy("one.k1", "one.k2").agg(F.collect_list("one.start").alias("starts"))
    # rows alike in id and text give their strings once
    marked = keyed.join(starts, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    blocks = scratch.write("blocks", cut_blocks(marked, settings))
    scratch.drop()
    again = scratch.write("again", _repeated(blocks, scratch, "blocks"))
    scratch.drop("blocks", "blocks-buckets")
    whole_blocks = again.where("alike").select("k1", "k2", "start", F.size("strings").alias("n"))

    # single strings of the blocks that differ somewhere
    strings = again.where("NOT alike").select("k1", "k2", "bucket", "start", F.posexplode("strings").alias("step", "string"))
    strings = scratch.write("strings", strings.select("k1", "k2", "bucket", "string", (F.col("start") + F.col("step")).alias("start")))
    counts = strings.groupBy("bucket", "string").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("bucket", "string")
    counts = scratch.write("counts", counts)
    single = strings.join(counts, ["bucket", "string"], "left_semi").select("k1", "k2", "start", F.lit(1).alias("n"))

    spans = whole.union(equal).union(whole_blocks).union(single)
    # rows alike in id and text find the same spans: each is held once
    packed = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("found"))
    packed = scratch.write("spans", packed)
    scratch.drop("several", "names", "again", "strings", "counts")
    return packed


def remove_repeats(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (bytes) of every document."""
    scratch = Scratch(documents.sparkSession)
    found = repeats(documents, settings, scratch)
    length = settings.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
                for text, marks in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
                    data, marks = _encoded(text), marks or []
                    starts = np.array([m["start"] for m in marks], np.int64)
                    spans, left = cut_spans(data, starts, np.array([m["n"] for m in marks], np.int64), length)
                    out["n_bytes"].append(len(data))
                    out["n_removed"].append(len(data) - len(left))
                    out["n_spans"].append(len(spans))
                    out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                    out["spans"].append([{"start": a, "stop": b} for a, b in spans])
                span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                columns = [pa.array(v, span if k == "spans" else pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *out])

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select(*row_keys(), "doc_id", "text").join(found, ["k1", "k2"], "left")
    return texts.select("doc_id", "text", "found").mapInArrow(
        run,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>",
    )
