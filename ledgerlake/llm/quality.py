"""Quality classifier: logistic regression over hashed word n-grams, fitted with follow-the-regularised-leader.

Words are runs of letters and digits, or runs of other visible characters. A text's sparse vector holds the
shares of its hashed single words, word pairs, shapes of one to three words, and echoes (a word that comes
again one to four places later, whatever the word is). A score is the sparse dot product with the weights
through the logistic function.

Defined results: a null or empty text has no n-grams, so its score is that of the bias alone. Labels that are
null are no labels; several labels of one document count as the lowest. Repeated documents are scored each.
With no labelled row at all the weights are zero and every score is 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W

U64 = np.uint64
_ASCII = np.arange(256)
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_UPPER = (_ASCII >= 65) & (_ASCII <= 90)
_LOWER = (_ASCII >= 97) & (_ASCII <= 122)
_BLANK = (_ASCII <= 32) | (_ASCII == 127)
# 0 blank, 1 part of a word, 2 other visible character
_CLASS = np.where(_BLANK, 0, np.where(_DIGIT | _UPPER | _LOWER | (_ASCII >= 128), 1, 2)).astype(np.uint8)


@dataclass(frozen=True)
class Settings:
    """`train_rows` bounds the labelled sample (documents with the smallest hashes of their ids)."""

    bits: int = 17
    train_rows: int = 16384
    shards: int = 8
    passes: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0001
    l2: float = 0.0001
    scale: float = 8.0


def ngrams(text: str | None, bits: int) -> tuple[np.ndarray, int]:
    """Bucket of every n-gram occurrence of a text, and its number of words."""
    data = np.frombuffer((text or "").encode(errors="replace"), np.uint8)
    kind = _CLASS[data]
    change = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    if not len(change):
        return np.empty(0, np.int64), 0
    starts, ends = change[:-1], change[1:]
    seen = kind[starts] != 0
    starts, ends = starts[seen], ends[seen]
    n = len(starts)
    word = W.span_hashes(data, starts, ends)
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    lower = np.concatenate(([0], np.cumsum(_LOWER[data])))
    length = ends - starts
    ups, lows = upper[ends] - upper[starts], lower[ends] - lower[starts]
    # kind of word, its case, and whether it is short, as one small number
    shape = (kind[starts].astype(np.int64) * 3 + np.where(ups == 0, 0, np.where(ups == 1, 1, 2))) * 8
    shape = (shape + np.minimum(length, 3) * 2 + (lows > 0)).astype(U64)
    parts = [word, W.mix(shape + U64(1 << 40))]
    if n > 1:
        parts.append(W.mix(word[:-1] * U64(3) + word[1:]))
        parts.append(W.mix(shape[:-1] * U64(97) + shape[1:] + U64(1 << 41)))
    if n > 2:
        parts.append(W.mix((shape[:-2] * U64(97) + shape[1:-1]) * U64(97) + shape[2:] + U64(1 << 42)))
    for gap in range(1, 5):
        if n > gap:
            again = int(np.count_nonzero(word[:-gap] == word[gap:]))
            parts.append(np.full(again, W.mix(np.full(1, gap, U64) + U64(1 << 43))[0], U64))
    return (np.concatenate(parts) & U64((1 << bits) - 1)).astype(np.int64), n


def sparse(text: str | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The text's sparse vector: buckets and their values."""
    grams, n = ngrams(text, settings.bits)
    buckets, counts = np.unique(grams, return_counts=True)
    return buckets, counts * (settings.scale / max(n, 1))


def follow_the_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> np.ndarray:
    """Weights after per-coordinate regularised-leader updates over the rows; the last weight is the bias."""
    size = (1 << settings.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - settings.l1, 0)
        return -shrunk / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for label, buckets, values in rows:
            at = np.append(buckets, size - 1)
            x = np.append(values, 1.0)
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label
            step = error * x
            sigma = (np.sqrt(n[at] + step * step) - np.sqrt(n[at])) / settings.alpha
            z[at] += step - sigma * w
            n[at] += step * step
    return weights(slice(None)).astype(np.float32)


def held_out(column: str = "doc_id"):
    """True for the third of the documents that nothing is learned from."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def fit(documents: DataFrame, labels: DataFrame, target: str = "quality", settings: Settings = Settings()) -> np.ndarray:
    """Fit on at most `train_rows` labelled documents outside the held-out third.

    Every shard of the sample runs its own updates in a Spark task; the driver averages `shards` weight
    vectors, whose size `bits` fixes.
    """
    chosen = (
        labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(target).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.train_rows)
    )

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, label, shard, text in W.rows(batches, "doc_id", "label", "shard", "text"):
            buckets, values = sparse(text, settings)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "doc_id": [str(doc_id)], "label": [label], "buckets": [buckets], "vals": [values]},
                schema=pa.schema(
                    [("shard", pa.int64()), ("doc_id", pa.string()), ("label", pa.int32()), ("buckets", pa.list_(pa.int64())), ("vals", pa.list_(pa.float64()))]
                ),
            )

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(order=pd.util.hash_array(part.doc_id.to_numpy(object))).sort_values(["order", "doc_id"])
        rows = [(int(y), np.asarray(b, np.int64), np.asarray(v)) for y, b, v in zip(part.label, part.buckets, part.vals)]
        return pd.DataFrame({"n": [len(rows)], "weights": [follow_the_leader(rows, settings).tolist()]})

    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(settings.shards)).alias("shard")
    vectors = sample.select("doc_id", "label", shard, "text").mapInArrow(
        featurise, "shard long, doc_id string, label int, buckets array<long>, vals array<double>"
    )
    found = vectors.groupBy("shard").applyInPandas(train, "n long, weights array<float>").collect()
    if not found:
        return np.zeros((1 << settings.bits) + 1, np.float32)
    return np.average([r.weights for r in found], axis=0, weights=[r.n for r in found]).astype(np.float32)


def score(documents: DataFrame, weights: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; no shuffle."""
    sent = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            scores = []
            for (text,) in W.rows([batch], "text"):
                grams, n = ngrams(text, settings.bits)
                total = float(w[grams].sum(dtype=np.float64)) * settings.scale / max(n, 1) + float(w[-1])
                scores.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def classify(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return score(documents, fit(documents, labels, settings=settings), settings)
