"""Best-fit packing of documents into token sequences by linear grouping.

1. Documents become pieces of at most `capacity` tokens. Lengths are whole numbers up to the capacity, so their
   histogram has a fixed size and is all that the driver sees.
2. Linear grouping: the large pieces, longest first, fall into groups of equal cardinality, and each is rounded
   up to the longest of its group.
3. For these few sizes a linear programme over configurations (multisets of sizes that fit one sequence) is solved
   by column generation: a knapsack prices the next configuration.
4. Whole multiples of the configurations are used, the actual lengths replace the rounded ones, what the rounding
   left over and the small pieces go best-fit: each into the fullest sequence that still takes it.

Everything is done on counts: a run of sequences that hold the same lengths is one entry with its multiplicity,
so the plan's size depends on the capacity and not on the number of documents. Spark then gives each piece its
rank among the pieces of its length, taken within (length, chunk) with the chunks' totals as offsets, and the plan
maps (length, rank) to a place.

Defined results: a null text is empty, so its document is the separator alone. Repeated rows are packed each.
Which of two pieces of one length gets which of their places is not defined. A vocabulary file that splits or
merges in another way raises a ValueError. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import functools
import json
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialize


@dataclass(frozen=True)
class Settings:
    """Pieces longer than `small` tokens are grouped into `groups` sizes; the others are filled in.

    A configuration is kept where the actual lengths leave at most `slack` tokens of room.
    """

    capacity: int = 2048
    separator: int = 0
    small: int = 400
    groups: int = 64
    slack: int = 8
    chunk_rows: int = 20_000


def byte_ranks(tokenizer_path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Byte strings of a byte-level vocabulary file with their ids, which rank the merges, and ids of added tokens.

    Only files that split and merge as assumed here are taken; others raise a ValueError.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        whole = json.load(file)
    model, split = whole["model"], whole.get("pre_tokenizer") or {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        raise ValueError("the file's pre-tokenizer is not the plain byte-level one")
    if model.get("type") != "BPE" or whole.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("the file's model is not a plain byte-pair encoding")
    if any(model.get(x) for x in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix")):
        raise ValueError("the file's model marks words")
    vocab = model["vocab"]
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        raise ValueError("the file's merges are not in the order of their ids")
    # byte-level files write bytes that are no visible Latin-1 character as the characters from 256 on
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}
    added = {x["content"]: x["id"] for x in whole.get("added_tokens", [])}
    if any(x.get(k) for x in whole.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("the file's added tokens take in what is around them")
    return {bytes(byte[c] for c in token): n for token, n in vocab.items() if token not in added}, added


#: The split of byte-level vocabularies, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The fast encoder's split gives up on runs of white space that are much longer than this.
_LONG_BLANK = re.compile(r"\s{50000}")


class Encoder:
    """The ids that `tokenizers` gives for a vocabulary file, in a fifth of the time where the text allows it.

    An added token written out in a text is that token, as in the file's tokenizer.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken

        ranks, added = byte_ranks(tokenizer_path)
        self.path = tokenizer_path
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    @functools.cached_property
    def plain(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if len(text) >= 50_000 and _LONG_BLANK.search(text):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")


@functools.cache
def encoding(tokenizer_path: str) -> Encoder:
    return Encoder(tokenizer_path)


_PIECE = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def tokenised(documents: DataFrame, tokenizer_path: str, settings: Settings = Settings()) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    capacity, separator = settings.capacity, settings.separator
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [x or "" for x in part.column("text").to_pylist()]
                which, piece, start, length, crc = [], [], [], [], []
                for row, text in enumerate(texts):
                    ids = np.append(encoder.ids(text), separator).astype("<u4")
                    cut = len(ids) % capacity or min(capacity, len(ids))
                    edges = [0, *range(cut, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        which.append(row)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(which, pa.int32())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names,
                )

    return documents.select("doc_id", "text").mapInArrow(run, _PIECE.format(kind=kind))


# --- the plan: histogram in, runs of equal sequences out -------------------------------------------------------


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 400) -> list[tuple[list[int], float]]:
    """Configurations and how often the linear programme uses each (Gilmore and Gomory's column generation)."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    amounts = inverse @ np.array(demand, float)
    each = np.array(sizes)
    for _ in range(rounds):
        prices = inverse.sum(axis=0)  # every configuration costs one sequence
        # unbounded knapsack: the best price for each room
        best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(int(each.min()), capacity + 1):
            value = np.where(each <= room, best[room - each] + prices, 0)
            choice = int(value.argmax())
            if value[choice] > best[room - 1] + 1e-12:
                best[room], taken[room] = value[choice], choice
            else:
                best[room] = best[room - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        while room > 0:
            if taken[room] < 0:
                room -= 1
            else:
                column[taken[room]] += 1
                room -= sizes[taken[room]]
        direction = inverse @ column
        positive = direction > 1e-9
        ratio = np.where(positive, amounts / np.where(positive, direction, 1), np.inf)
        leaving = int(ratio.argmin())
        amounts = amounts - ratio[leaving] * direction
        amounts[leaving] = ratio[leaving]
        basis[:, leaving] = column
        inverse = np.linalg.inv(basis)
    return [(basis[:, i].astype(int).tolist(), float(amounts[i])) for i in range(k) if amounts[i] > 1e-9]


class Runs:
    """Runs of sequences that hold the same lengths, found by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
        self.rooms: list[int] = []

    def add(self, count: int, lengths: tuple[int, ...]) -> None:
        room = self.capacity - sum(lengths)
        if room not in self.by_room:
            self.by_room[room] = []
            bisect.insort(self.rooms, room)
        self.by_room[room].append((count, lengths))

    def fill(self, length: int, count: int) -> None:
        """Best fit for `count` pieces: the least room that takes one, then new sequences."""
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                if count >= each:
                    self.add(count // each, (length,) * each)
                    count %= each
                if count:
                    self.add(1, (length,) * count)
                return
            room = self.rooms[at]
            n, lengths = self.by_room[room].pop()
            if not self.by_room[room]:
                del self.by_room[room]
                del self.rooms[at]
            each = min(room // length, max(1, count // n))
            used = min(n, count // each)
            if used < n:
                self.add(n - used, lengths)
            self.add(used, lengths + (length,) * each)
            count -= used * each

    def all(self) -> list[tuple[int, tuple[int, ...]]]:
        return [run for room in self.rooms for run in self.by_room[room]]


def plan(histogram: dict[int, int], settings: Settings) -> list[tuple[int, tuple[int, ...]]]:
    """Runs (how many sequences, the lengths each holds) for a histogram of piece lengths."""
    capacity, runs = settings.capacity, Runs(settings.capacity)
    left = dict(histogram)
    if left.get(capacity):
        runs.add(left.pop(capacity), (capacity,))
    large = sorted((x for x in left if x > settings.small), reverse=True)
    total = sum(left[x] for x in large)
    if total:
        # linear grouping: equal cardinality, longest first; a group is its lengths with their counts
        groups: list[list[list[int]]] = [[]]
        per = math.ceil(total / settings.groups)
        held = 0
        for length in large:
            n = left[length]
            while n:
                if held == per:
                    groups.append([])
                    held = 0
                part = min(n, per - held)
                groups[-1].append([length, part])
                held += part
                n -= part
        # neighbours with one rounded size are one size
        sizes, members = [], []
        for group in groups:
            if sizes and sizes[-1] == group[0][0]:
                members[-1] += group
            else:
                sizes.append(group[0][0])
                members.append(list(group))
        demand = [sum(n for _, n in m) for m in members]
        substituted: list[tuple[int, tuple[int, ...]]] = []
        for column, amount in sorted(configurations(sizes, demand, capacity), key=lambda x: -x[1]):
            slots = [j for j, n in enumerate(column) for _ in range(n)]
            want = math.floor(amount + 1e-9)
            # substitute actual lengths: a stretch of sequences that take the same ones is one run
            while want and slots:
                need: dict[int, int] = {}
                for j in slots:
                    need[j] = need.get(j, 0) + 1
                if any(not members[j] for j in need):
                    break
                stretch = min([want, *(members[j][0][1] // n for j, n in need.items())])
                taken: list[int] = []
                if stretch:
                    for j, n in need.items():
                        taken += [members[j][0][0]] * n
                        members[j][0][1] -= n * stretch
                else:  # a length runs out inside one sequence: fill this one from the next lengths too
                    stretch = 1
                    if any(sum(n for _, n in members[j]) < n_need for j, n_need in need.items()):
                        break
                    for j, n in need.items():
                        for _ in range(n):
                            while not members[j][0][1]:
                                members[j].pop(0)
                            taken.append(members[j][0][0])
                            members[j][0][1] -= 1
                for j in need:
                    while members[j] and not members[j][0][1]:
                        members[j].pop(0)
                substituted.append((stretch, tuple(taken)))
                want -= stretch
        for length in large:
            left[length] = 0
        for count, lengths in substituted:
            if capacity - sum(lengths) <= settings.slack:
                runs.add(count, lengths)
            else:  # rounding left too much room: these pieces go best-fit like the others
                for length in lengths:
                    left[length] += count
        for group in members:
            for length, n in group:
                left[length] += n
    for length in sorted((x for x in left if left[x]), reverse=True):
        runs.fill(length, left[length])
    return runs.all()


def places(runs: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """For each length, columns first rank, first sequence and offset, in order of rank."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for count, lengths in runs:
        offset = 0
        for length in lengths:
            first = rank.get(length, 0)
            rows.setdefault(length, []).append((first, sequence, offset))
            rank[length] = first + count
            offset += length
        sequence += count
    return {length: np.array(x, np.int64).T for length, x in rows.items()}


def chunked(pieces: DataFrame, chunk_rows: int) -> DataFrame:
    """Pieces with a `chunk` of their length of about `chunk_rows` rows; pieces alike in all else differ in `row`."""
    chunks = F.greatest(F.ceil(F.col("n") / F.lit(chunk_rows)), F.lit(1)).cast("long")
    sizes = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))  # one row a length
    return pieces.join(F.broadcast(sizes), "length").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row"), chunks)
    )


def ranked(pieces: DataFrame, chunk_rows: int) -> DataFrame:
    """`rank` from 0 among the pieces of one length; a task holds about `chunk_rows` rows of a length."""
    cut = chunked(pieces, chunk_rows)
    totals = cut.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("m"))
    before = totals.select(
        "length", "chunk", (F.sum("m").over(Window.partitionBy("length").orderBy("chunk")) - F.col("m")).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32", "row")) - 1
    return (
        cut.withColumn("inside", inside.cast("long"))
        .join(before, ["length", "chunk"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("n", "chunk", "inside", "before", "row")
    )


def pack(documents: DataFrame, tokenizer_path: str, settings: Settings = Settings()) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    numbered = tokenised(documents, tokenizer_path, settings).withColumn("row", F.monotonically_increasing_id())
    pieces = materialize(numbered, "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    sent = documents.sparkSession.sparkContext.broadcast(places(plan(histogram, settings)))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                first, base, begin = sent.value[int(length)]
                k = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at] = base[k] + ranks[at] - first[k]
                offset[at] = begin[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return ranked(pieces, settings.chunk_rows).select(*kept, "rank").mapInArrow(
        run, _PIECE.format(kind=kind) + ", sequence_id long, offset long"
    )
