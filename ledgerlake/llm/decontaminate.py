"""Benchmark decontamination with one Aho-Corasick automaton over the normalised test items.

Items and texts are normalised alike: A-Z lower-cased, words are runs of ASCII letters and digits and of any
character beyond ASCII, joined by one blank. Every window of consecutive item words is a pattern with a blank in
front and behind; a text is scanned once, and what is found is mapped back to the places of its words and to the
characters of the original text. A match adds the pattern's place to two arrays, so its cost does not depend on
how many windows overlap.

The automaton is sent to every task, so its size is bounded: benchmarks with more windows than `block_windows`
are scanned in blocks of items against all rows, and the blocks' hits are merged.

Defined results: a null text or item, or one without a word, has no words and no windows. Equal windows of several
items count for all of them. An item id that is null is left out of the list of ids but its windows count as hits.
Repeated rows are scanned each. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words as W


@dataclass(frozen=True)
class Settings:
    window: int = 10
    block_windows: int = 40_000


#: A-Z to a-z, separators to a blank; every byte of a character beyond ASCII belongs to a word.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def normalised(text: str | None) -> bytes:
    return (text or "").encode(errors="replace").translate(_WORD)


def windows(text: str | None, size: int) -> set[bytes]:
    """Distinct windows of an item; fewer words than `size` make one window."""
    words = normalised(text).split()
    if not words:
        return set()
    n = max(len(words) - size + 1, 1)
    return {b" ".join(words[i : i + size]) for i in range(n)}


def build(found: dict[bytes, list[str]]) -> ahocorasick.Automaton:
    """Patterns as text of one character a byte; each knows its number of words and its items."""
    automaton = ahocorasick.Automaton()
    for window, items in found.items():
        automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(items)))
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton: ahocorasick.Automaton | None):
    """Number of words, the words hit (True or False each), places of the words in bytes, and the items found."""
    data = normalised(text)
    starts, ends = W.spans(np.frombuffer(data, np.uint8) != 32)
    n = len(starts)
    hit, items = np.zeros(n, bool), set()
    if n and automaton is not None:
        joined = b" " + b" ".join(data.split()) + b" "
        change, last = None, None
        for end, (size, ids) in automaton.iter(joined.decode("latin-1")):
            if change is None:
                change = np.zeros(n + 1, np.int64)
                # the blank behind word i stands at lengths of words 0..i plus i + 1
                last = np.cumsum(ends - starts + 1)
            word = int(np.searchsorted(last, end))
            change[word - size + 1] += 1
            change[word + 1] -= 1
            items.update(ids)
        if change is not None:
            hit = np.cumsum(change[:n]) > 0
    return n, hit, starts, ends, items


def characters(text: str, places: np.ndarray) -> np.ndarray:
    """Byte places of the UTF-8 text as places of characters."""
    data = np.frombuffer(text.encode(errors="replace"), np.uint8)
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[places]


_OUT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("hit_spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("words", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _blocks(benchmark: DataFrame, settings: Settings) -> Iterator[dict[bytes, list[str]]]:
    """Windows with their items, at most `block_windows` and one item more at a time, streamed to the driver."""
    found: dict[bytes, list[str]] = {}
    for item in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        for window in windows(item.text, settings.window):
            ids = found.setdefault(window, [])
            if item.item_id is not None and item.item_id not in ids:
                ids.append(item.item_id)
        if len(found) >= settings.block_windows:
            yield found
            found = {}
    if found:
        yield found


def _together(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches joined until they have as many rows or bytes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= rows or sum(x.nbytes for x in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def matches(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with n_words, hit_spans (characters of the original text, words in it) and item ids.

    Spans are maximal runs of hit words, in order and apart.
    """
    context = documents.sparkSession.sparkContext
    spans = T.StructType().add("start", "long").add("stop", "long").add("words", "long")
    schema = T.StructType([documents.schema[c] for c in keep]).add("n_words", "long").add("hit_spans", T.ArrayType(spans))
    schema = schema.add("items", T.ArrayType(T.StringType()))
    # several blocks are several automata over one reading of the texts
    sent = [context.broadcast(block) for block in _blocks(benchmark, settings)]
    read = "text" if "text" in keep else "_text"  # a text that is kept travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(sent) <= 1:
            first = build(sent[0].value) if sent else None
        # an automaton takes some 4 kB a window, so several are built anew for each slice of rows
        step = 256 if len(sent) <= 1 else 8192
        for batch in batches if len(sent) <= 1 else _together(batches, step, 1 << 26):
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = part.column(read).to_pylist()
                results = [None] * len(texts)
                for block in sent or [None]:
                    automaton = first if len(sent) <= 1 else build(block.value)
                    for i, text in enumerate(texts):
                        n, hit, starts, ends, items = scan(text, automaton)
                        if results[i] is not None:
                            hit, items = hit | results[i][1], items | results[i][4]
                        results[i] = (n, hit, starts, ends, items)
                rows = {"n_words": [], "hit_spans": [], "items": []}
                for text, (n, hit, starts, ends, items) in zip(texts, results):
                    a, b = W.spans(hit)
                    spans = []
                    if len(a):
                        marks = characters(text, np.concatenate((starts[a], ends[b - 1])))
                        spans = [
                            {"start": int(x), "stop": int(y), "words": int(k)}
                            for x, y, k in zip(marks[: len(a)], marks[len(a) :], b - a)
                        ]
                    rows["n_words"].append(n)
                    rows["hit_spans"].append(spans)
                    rows["items"].append(sorted(items))
                tail = pa.RecordBatch.from_pydict(rows, schema=_OUT)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + tail.columns, [*keep, *_OUT.names]
                )

    return documents.select(*keep, *([] if read in keep else [F.col("text").alias(read)])).mapInArrow(run, schema)


def report(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counts of hit words and items of every document, and the digest of its item ids."""
    found = matches(documents, benchmark, settings)
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, x: total + x["words"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    """What `report` gives as items_sha256 for these item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
