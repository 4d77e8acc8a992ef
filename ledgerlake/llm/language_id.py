"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram of three letters is the product of its letters'
vectors, each permuted (rotated) by the letter's place. A text is the sum of its n-grams' vectors, a language
the sum of its texts' unit vectors, and a text gets the language whose prototype is nearest by cosine.

Defined results: `und` with score 0 for a null text, one without a letter, or when no language was learned.
Ties go to the first language in order of name. Rows with a null language are labelled but not learned from.
Repeated documents count each. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words as W
from ledgerlake.llm.quality import held_out

DIMENSIONS = 1024
SYMBOLS = 64  # 0 stands for what is no letter, 1 to 26 for a to z, the others share the rest
UNKNOWN = "und"
_SCALE = 1 << 24  # prototypes are sums of whole numbers, so that no order of adding changes them


@functools.cache
def _symbols() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            table[code] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return table


class Grams:
    """Vectors of the n-grams seen so far; at most SYMBOLS ** 3 of them, of one byte a dimension."""

    def __init__(self, dimensions: int):
        letters = np.random.default_rng(4).choice(np.array([-1, 1], np.int8), (SYMBOLS, dimensions))
        self.places = [np.roll(letters, shift, axis=1) for shift in (2, 1, 0)]
        self.row = np.full(SYMBOLS**3, -1, np.int32)
        self.vectors = np.empty((1024, dimensions), np.int8)
        self.used = 0

    def of(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self.row[grams] < 0]
        if len(new):
            while self.used + len(new) > len(self.vectors):
                self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
            a, b, c = new // SYMBOLS**2, new // SYMBOLS % SYMBOLS, new % SYMBOLS
            at = np.arange(self.used, self.used + len(new))
            self.vectors[at] = self.places[0][a] * self.places[1][b] * self.places[2][c]
            self.row[new] = at
            self.used += len(new)
        return self.vectors[self.row[grams]]


@functools.cache
def _grams(dimensions: int) -> Grams:
    return Grams(dimensions)


def profile(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """The text's unit vector, or None if it has no letter."""
    if not text:
        return None
    table, parts = _symbols(), []
    for at in range(0, len(text), W.BLOCK):  # blocks share two characters, so no n-gram is lost or doubled
        part = ("\n" if at == 0 else "") + text[max(at - 2, 0) : at + W.BLOCK] + ("\n" if at + W.BLOCK >= len(text) else "")
        symbols = table[np.frombuffer(part.encode("utf-32-le", "replace"), "<u4")].astype(np.int32)
        grams = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
        # an n-gram needs a letter in the middle or at both ends
        grams = grams[(symbols[1:-1] != 0) | ((symbols[:-2] != 0) & (symbols[2:] != 0))]
        parts.append(np.unique(grams, return_counts=True))
    grams, counts = parts[0]
    if len(parts) > 1:
        grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([n for _, n in parts]))
    if not len(grams):
        return None
    weights = counts.astype(np.float32)
    total = np.zeros(dimensions, np.float32)
    for at in range(0, len(grams), 4096):
        total += weights[at : at + 4096] @ _grams(dimensions).of(grams[at : at + 4096]).astype(np.float32)
    size = float(np.linalg.norm(total))
    return total / size if size else None


def fit(documents: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of every language, learned from the documents outside the held-out third.

    Tasks add up their own texts, Spark adds the tasks' sums; the driver receives one vector a language.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for lang, text in W.rows(batches, "lang", "text"):
            vector = profile(text, dimensions)
            if vector is not None:
                sums[lang] = sums.get(lang, 0) + np.rint(vector * _SCALE).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"lang": list(sums), "total": list(sums.values())},
                schema=pa.schema([("lang", pa.string()), ("total", pa.list_(pa.int64()))]),
            )

    known = documents.where(F.col("lang").isNotNull() & ~held_out()).select("lang", "text")
    places = known.mapInArrow(bundle, "lang string, total array<long>").select("lang", F.posexplode("total").alias("place", "value"))
    sums = places.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("total")).collect()
    found = {r.lang: np.array([x.value for x in r.total], np.float64) for r in rows}
    return {lang: v / max(np.linalg.norm(v), 1e-12) for lang, v in sorted(found.items())}


def predict(documents: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score for every document; no shuffle."""
    names = list(prototypes)
    matrix = np.array([prototypes[x] for x in names], np.float32)
    sent = documents.sparkSession.sparkContext.broadcast(matrix)
    read = "text" if "text" in keep else "_text"  # a text that is kept travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for (text,) in W.rows([batch], read):
                vector = profile(text, sent.value.shape[1]) if names else None
                near = sent.value @ vector if vector is not None else np.zeros(1)
                best = int(near.argmax())
                langs.append(names[best] if vector is not None else UNKNOWN)
                scores.append(min(max(float(near[best]), 0.0), 1.0))
            columns = [batch.column(c) for c in keep] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    schema = T.StructType([documents.schema[c] for c in keep]).add("lang_pred", "string").add("score", "double")
    return documents.select(*keep, *([] if read in keep else [F.col("text").alias(read)])).mapInArrow(run, schema)


def identify(documents: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    marked = documents.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    return predict(marked, fit(documents, dimensions), ("doc_id", "held_out"))
