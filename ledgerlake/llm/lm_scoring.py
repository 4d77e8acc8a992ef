"""Language-model scores by masked pseudo-likelihood of a bidirectional window network, trained in numpy.

Words are hashed into `classes`. The network predicts a word's class from the two words on each side: the context
vectors, weighted by place, add up to a hidden layer, and the class is predicted in two steps of the square root of
`classes` (a softmax over the class's group, then one over the class inside it). A word's probability is that of its
class given both sides, times that of the word in its class: its count in the corpus by the counts of all words of
the class and one more, which is the share of a word that the corpus does not hold. A text's score is the sum over
all of its words of the logarithm of that product.

Training goes over all texts in every round, with a share of the words of each text masked as targets; after
`masked` rounds each word was a target once. Workers train on their own texts from the round's weights and send
their weights after every `send_after` words; Spark adds them up, weighted by words, and the mean is the next
round's start. Only weights and the totals of the classes, whose number the settings fix, come to the driver.

The vocabulary is a Spark table that grows with the corpus. Texts are dealt into chunks; a chunk asks for each of its
words once, so a common word costs one row a chunk. Words are known by 64-bit hashes. A task holds one chunk at a time,
however many it has: the answers to a chunk come as sorted rows, not as one list, and Arrow batches are bounded.

Defined results: a null text or one without a word has n_words 0, score 0 and a null mean. At the edges the missing
neighbours are one special word. Without any text the weights stay as they were drawn. Repeated documents count
each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.scratch import Scratch
from ledgerlake.session import bounded_batches, materialize

U64 = np.uint64
PLACES = (-2, -1, 1, 2)
_PART = 1024  # weights sent in one row
#: Chunks in one file of their table: Parquet's writer holds up to 100 rows of any size, its reader a file's rows at once.
_CHUNKS_A_FILE = 8


@dataclass(frozen=True)
class Settings:
    """Every `masked`-th word of a text is a target in a round of training, others in the next; all are when scoring.

    With at least `masked` rounds every word is a target. A chunk ends after `chunk_words` words.
    """

    groups: int = 32  # classes = groups * groups
    inputs: int = 4096
    width: int = 16
    rounds: int = 2
    masked: int = 2
    rate: float = 0.15
    batch: int = 2048
    send_after: int = 1_000_000
    chunk_words: int = 1 << 19

    @property
    def shapes(self) -> dict[str, tuple[int, ...]]:
        g, d = self.groups, self.width
        return {
            "words": (self.inputs + 1, d),
            "places": (len(PLACES), d),
            "hidden": (d,),
            "group": (d, g),
            "group_bias": (g,),
            "gate": (g, d),
            "inside": (d, g),
            "inside_bias": (g, g),
        }


Weights = dict[str, np.ndarray]


def drawn(settings: Settings) -> Weights:
    random = np.random.default_rng(3)
    weights = {k: (random.standard_normal(s) * 0.1).astype(np.float32) for k, s in settings.shapes.items()}
    for name in ("hidden", "group_bias", "inside_bias"):
        weights[name][:] = 0
    weights["places"][:] = 1
    weights["gate"][:] = 1
    return weights


def flat(weights: Weights, settings: Settings) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in settings.shapes])


def unflat(values: np.ndarray, settings: Settings) -> Weights:
    out, at = {}, 0
    for name, shape in settings.shapes.items():
        n = int(np.prod(shape))
        out[name] = values[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def inputs_of(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    return (hashes % U64(settings.inputs)).astype(np.int32)


def word_hashes(text: str | None) -> np.ndarray:
    return W.blank_words((text or "").encode(errors="replace"))


def classes_of(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    return ((hashes >> U64(32)) % U64(settings.groups**2)).astype(np.int32)


def targets(n_words: int, turn: int, settings: Settings) -> slice:
    """The words of a text that are targets in a round."""
    return slice((n_words + turn) % settings.masked, None, settings.masked)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Of every column; what is below e^-60 of the largest counts as that, since much smaller numbers are slow."""
    logits -= logits.max(axis=0)
    np.maximum(logits, -60, out=logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def forward(weights: Weights, around: np.ndarray, target: np.ndarray, settings: Settings):
    """Neighbours' vectors, hidden layer, the two steps' probabilities, and the targets'.

    `around` has a row a target; the other arrays have a column a target, so that sums over a few classes run along
    whole rows.
    """
    near = weights["words"][around]
    total = np.einsum("nkd,kd->nd", near, weights["places"])
    total += weights["hidden"]
    hidden = np.tanh(np.ascontiguousarray(total.T))
    every = np.arange(len(target))
    group = target // settings.groups
    inside = target - group * settings.groups
    first = _softmax(weights["group"].T @ hidden + weights["group_bias"][:, None])
    # products with the groups' marks pick each target's column without jumps in memory
    is_group = np.zeros((settings.groups, len(target)), np.float32)
    is_group[group, every] = 1
    gate = weights["gate"].T @ is_group
    gated = hidden * gate
    logits = weights["inside"].T @ gated
    logits += weights["inside_bias"].T @ is_group
    second = _softmax(logits)
    return near, hidden, gate, gated, first, second, group, inside, is_group, first[group, every], second[inside, every]


def _sums_of_inputs(around: np.ndarray, rows: np.ndarray, places: np.ndarray, inputs: int) -> np.ndarray:
    """Gradient of every input's vector: the rows (one for each dimension) by the inputs around, weighted by place."""
    index = around.T.ravel().astype(np.intp)  # place by place, so that a product runs along a whole row
    out = np.empty((len(rows), inputs))
    for sums, row, place in zip(out, rows, places.T):
        sums[:] = np.bincount(index, (place[:, None] * row).ravel(), inputs)
    return out.T


def train_step(weights: Weights, past: Weights, around: np.ndarray, target: np.ndarray, settings: Settings) -> None:
    """One step of gradient descent, each weight's rate divided by the root of its past squares."""
    n = np.float32(len(target))
    near, hidden, gate, gated, first, second, group, inside, is_group, _, _ = forward(weights, around, target, settings)
    every = np.arange(len(target))
    first[group, every] -= 1
    second[inside, every] -= 1
    d_gated = weights["inside"] @ second
    d_hidden = weights["group"] @ first + d_gated * gate
    d_total = d_hidden * (1 - hidden * hidden)

    def move(name: str, gradient: np.ndarray, at=slice(None)) -> None:
        gradient = gradient / n
        past[name][at] += gradient * gradient
        weights[name][at] -= settings.rate * gradient / np.sqrt(past[name][at] + 1e-8)

    d_words = _sums_of_inputs(around, d_total, weights["places"], settings.inputs + 1)
    d_places = np.einsum("nkd,nd->kd", near, np.ascontiguousarray(d_total.T))
    gates = np.unique(group)
    move("group", hidden @ first.T)
    move("group_bias", first.sum(axis=1))
    move("inside", gated @ second.T)
    move("inside_bias", (is_group @ second.T)[gates], gates)
    move("gate", (is_group @ (d_gated * hidden).T)[gates], gates)
    move("places", d_places)
    move("hidden", d_total.sum(axis=1))
    move("words", d_words.astype(np.float32, order="C"))


def neighbours(inputs: np.ndarray, settings: Settings, n_words: np.ndarray | None = None) -> np.ndarray:
    """Inputs at the places around every word; the special word beyond the edges of its text (of `n_words` words)."""
    n_words = np.array([len(inputs)]) if n_words is None else n_words
    padded = np.full(len(inputs) + 2 * len(n_words) + 2, settings.inputs, np.int32)
    at = np.arange(len(inputs)) + 2 * np.repeat(np.arange(1, len(n_words) + 1), n_words)
    padded[at] = inputs
    return padded[at[:, None] + np.array(PLACES)]


def are_targets(n_words: np.ndarray, turn: int, settings: Settings) -> np.ndarray:
    """For every word of texts of so many words, whether it is a target in a round."""
    starts = np.repeat(np.cumsum(n_words) - n_words, n_words)
    return (np.arange(int(n_words.sum())) - starts - np.repeat(n_words, n_words) - turn) % settings.masked == 0


def _places(at: pa.BinaryScalar, n_words: np.ndarray) -> np.ndarray:
    """Places among a chunk's words, from 2 or 4 bytes a word of the texts."""
    held = at.as_buffer()
    return np.frombuffer(held, np.uint16 if held.size == 2 * n_words.sum() else np.uint32)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of each chunk, and its texts' numbers of words."""
    for batch in batches:
        for k in range(batch.num_rows):
            n_words, words = (batch.column(c)[k].values.to_numpy() for c in ("n_words", "words"))
            yield words.view(U64)[_places(batch.column("at")[k], n_words)], n_words


def _trained(held: DataFrame, start: np.ndarray, turn: int, settings: Settings) -> np.ndarray:
    sent = held.sparkSession.sparkContext.broadcast(start)
    size = len(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = unflat(sent.value, settings)
        past = {k: np.full_like(v, 1e-4) for k, v in weights.items()}
        words = 0

        def message():
            values = flat(weights, settings).astype(np.float64) * words
            values = np.concatenate((values, [words]))
            parts = [values[at : at + _PART] for at in range(0, len(values), _PART)]
            return pa.RecordBatch.from_pydict(
                {"part": list(range(len(parts))), "vals": parts},
                schema=pa.schema([("part", pa.int32()), ("vals", pa.list_(pa.float64()))]),
            )

        for hashes, n_words in _held(batches):
            # another share of the words in every text and round
            chosen = are_targets(n_words, turn, settings)
            around = neighbours(inputs_of(hashes, settings), settings, n_words)[chosen]
            target = classes_of(hashes[chosen], settings)
            for at in range(0, len(target), settings.batch):
                train_step(weights, past, around[at : at + settings.batch], target[at : at + settings.batch], settings)
            words += len(hashes)
            if words >= settings.send_after:
                yield message()
                words = 0
        if words:
            yield message()

    sums = (
        held.select("n_words", "words", "at")
        .mapInArrow(run, "part int, vals array<double>")
        .select("part", F.posexplode("vals").alias("place", "value"))
        .groupBy("part", "place")
        .agg(F.sum("value").alias("value"))
    )
    total = np.zeros(size + 1)
    for r in sums.collect():  # as many rows as the network has weights
        total[r.part * _PART + r.place] = r.value
    return total[:-1] / total[-1] if total[-1] else start


def fit(documents: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    return fit_words(words_of(documents, settings), settings)


def fit_words(held: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Weights trained on the chunks of :func:`words_of`."""
    weights = flat(drawn(settings), settings).astype(np.float64)
    for turn in range(settings.rounds):
        weights = _trained(held, weights, turn, settings)
    return weights


def log_probabilities(text: str | None, weights: Weights, settings: Settings) -> np.ndarray:
    """Logarithm of the conditional probability of every word's class."""
    hashes = word_hashes(text)
    return _log_probabilities(hashes, np.array([len(hashes)]), weights, settings)


def _log_probabilities(hashes: np.ndarray, n_words: np.ndarray, weights: Weights, settings: Settings) -> np.ndarray:
    around, classes = neighbours(inputs_of(hashes, settings), settings, n_words), classes_of(hashes, settings)
    out = [np.empty(0, np.float32)]
    for at in range(0, len(classes), settings.batch):
        *_, first, second = forward(weights, around[at : at + settings.batch], classes[at : at + settings.batch], settings)
        out.append(np.log(np.maximum(first * second, 1e-30)))
    return np.concatenate(out)


def score(documents: DataFrame, values: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, score (summed log-probabilities of classes) and mean of every document; no shuffle."""
    sent = documents.sparkSession.sparkContext.broadcast(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = unflat(sent.value, settings)
        for batch in batches:
            counts, sums = [], []
            for (text,) in W.rows([batch], "text"):
                logs = log_probabilities(text, weights, settings)
                counts.append(len(logs))
                sums.append(float(logs.sum(dtype=np.float64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums, pa.float64())], ["doc_id", "n_words", "score"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, score double")
    return scored.withColumn("mean", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))


def words_of(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Chunks of documents: their words with counts, and of every document its id and number of words.

    `at` has the place of every word of the chunk's texts among its words, which are in unsigned order. Texts are read
    and hashed here only; training and scoring go on from the chunks.
    """
    bounded_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, held = [], [], 0

        def chunk():
            nonlocal ids, hashes, held
            words, at, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            id_type = ids[0].type
            columns = {
                "ids": (pa.concat_arrays(ids), id_type),
                "n_words": ([len(x) for x in hashes], pa.int64()),
                "words": (words.view(np.int64), pa.int64()),
                "counts": (counts, pa.int64()),
            }
            ids, hashes, held = [], [], 0
            arrays = []
            for found, sort in columns.values():
                flat_values = found if isinstance(found, pa.Array) else pa.array(found, sort)
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat_values)], pa.int32()), flat_values))
            # bytes: Spark passes them on whole, a list it encodes value by value
            arrays.append(pa.array([at.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32).tobytes()], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, [*columns, "at"])

        for batch in batches:
            texts = batch.column("text")
            for k in range(batch.num_rows):
                ids.append(batch.column("doc_id").slice(k, 1))
                hashes.append(word_hashes(texts[k].as_py()))
                held += len(hashes[-1]) + 1
                if held >= settings.chunk_words:
                    yield chunk()
        if ids:
            yield chunk()

    shape = f"ids array<{kind}>, n_words array<long>, words array<long>, counts array<long>, at binary"
    chunks = documents.select("doc_id", "text").mapInArrow(run, shape).withColumn("chunk", F.monotonically_increasing_id())
    return Scratch(documents.sparkSession).write("chunks", chunks, maxRecordsPerFile=_CHUNKS_A_FILE)


def with_scores(
    held: DataFrame, values: np.ndarray, settings: Settings = Settings(), columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Chunks with `scores`, the log-probability of the classes of every document's words.

    `columns`: those of the chunks that come back; without it all.
    """
    sent = held.sparkSession.sparkContext.broadcast(values)
    columns = tuple(held.columns) if columns is None else columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: Weights = {}
        for batch in batches:
            weights = weights or unflat(sent.value, settings)
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                ((hashes, n_words),) = _held(iter([part]))
                logs = _log_probabilities(hashes, n_words, weights, settings)
                sums = np.bincount(np.repeat(np.arange(len(n_words)), n_words), logs, len(n_words))
                scores = pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), pa.array(sums, pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), scores], [*columns, "scores"])

    fields = ", ".join(f"{c} {held.schema[c].dataType.simpleString()}" for c in columns)
    read = dict.fromkeys((*columns, "n_words", "words", "at"))
    return held.select(*read).mapInArrow(run, f"{fields}, scores array<double>")


def chunked(documents: DataFrame, values: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """Chunks of documents with their scores, as one written table."""
    return materialize(with_scores(words_of(documents, settings), values, settings), "scored-chunks")


def vocabulary(chunks: DataFrame) -> DataFrame:
    """Every word of the chunks and its count."""
    each = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("x"))
    return materialize(each.groupBy(F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n")), "vocabulary")


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, pa.Scalar], np.ndarray, np.ndarray]]:
    """Each chunk's row, the words it asked for and their counts, from rows in order of the chunk.

    A chunk's rows may go on over batches; one, without a word, holds the chunk.
    """
    now, row, words, counts = None, None, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        chunk = batch.column("chunk").to_numpy()
        asked = batch.column("word").is_valid().to_numpy(zero_copy_only=False)
        found = [batch.column(c).fill_null(0).to_numpy() for c in ("word", "n")]
        edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1), len(chunk)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if row is not None and chunk[a] != now:
                yield row, np.concatenate(words), np.concatenate(counts)
                row, words, counts = None, words[:1], counts[:1]
            now, own = chunk[a], asked[a:b]
            for k in a + np.flatnonzero(~own):
                row = {c: batch.column(c)[k] for c in ("ids", "n_words", "scores", "at")}
            for held, values in zip((words, counts), found):
                held.append(values[a:b][own])
    if row is not None:
        yield row, np.concatenate(words), np.concatenate(counts)


def score_words(
    chunks: DataFrame, vocabulary: DataFrame, settings: Settings = Settings(), held: DataFrame | None = None
) -> DataFrame:
    """doc_id, n_words, score (summed log-probabilities of words) and mean of every document of the chunks.

    `held`: the written chunks without scores; words are asked for from there, so that scores are made once.
    """
    classes = settings.groups**2
    totals = np.ones(classes)  # one more for words that the corpus does not hold
    of = F.expr(f"shiftrightunsigned(word, 32) % {classes}").alias("class")
    for r in vocabulary.groupBy(of).agg(F.sum("n").alias("n")).collect():  # as many rows as there are classes
        totals[r["class"]] += r.n
    sent = chunks.sparkSession.sparkContext.broadcast(totals)
    kind = chunks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, words, counts in _answered(batches):
            n_words = row["n_words"].values.to_numpy()
            total = row["scores"].values.to_numpy()
            if len(words):
                words = words.view(U64)
                order = np.argsort(words)
                logs = np.log(np.maximum(counts, 1) / sent.value[classes_of(words, settings)])[order]
                which = np.repeat(np.arange(len(n_words)), n_words)
                total = total + np.bincount(which, logs[_places(row["at"], n_words)], len(n_words))
            yield pa.RecordBatch.from_arrays(
                [row["ids"].values, pa.array(n_words, pa.int64()), pa.array(total, pa.float64())], ["doc_id", "n_words", "score"]
            )

    asked = (chunks if held is None else held).select("chunk", F.explode("words").alias("word"))
    known = asked.join(vocabulary.hint("merge"), "word", "left").select("chunk", "word", F.coalesce("n", F.lit(0)).alias("n"))
    whole = chunks.select("chunk", F.struct("ids", "n_words", "scores", "at").alias("row"))
    dealt = whole.unionByName(known, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk")
    # Arrow's lists are slow at rows of null: each looks at all before it
    lists = (F.coalesce(f"row.{c}", F.array().cast(chunks.schema[c].dataType)).alias(c) for c in ("ids", "n_words", "scores"))
    scored = dealt.select("chunk", "word", "n", *lists, "row.at").mapInArrow(run, f"doc_id {kind}, n_words long, score double")
    return scored.withColumn("mean", F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")))
