"""How far the word use of each source is from the other sources of its language, and from the language itself.

1. Terms below the minimal document frequency are dropped, and a `CountVectorizer` over the kept ones makes exact
   sparse vectors of every document, one for the terms that it has once, one for those that it has twice and so on. A
   term carries its language in front, so one fit keeps a vocabulary for each language, however many languages there
   are. The vocabulary of one fit is held by the driver and sent to the tasks. Where there are more than `block_terms`
   kept terms, they are fitted and applied in blocks of about that many.
2. The vectors are summed by source over their entries, not as dense rows, so no sum is as wide as the vocabulary.
3. Two sources are compared over the terms that both have. Terms that one or none of them has come from the histogram
   of counts and from the size of the vocabulary.

All numbers are integers. Defined results: null text, lang or source is the empty string, and texts without a term
still make their source a group. A language without kept terms has pairs of value 0 and no terms; a language of one
source has no pairs. Repeated rows count each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.scratch import Scratch
from ledgerlake.session import fresh_path, materialize

#: Bytes of a term: ASCII letters and all bytes of other characters.
_IS_LETTER = np.array([chr(c).isalpha() if c < 128 else True for c in range(256)])
_RANGE = 16  # indices of a range: 2^16
_MASK = (1 << _RANGE) - 1
_HELD = 1 << 22  # entries a task adds up at once
_GROUPS = 256  # rows that the kept terms of a block come to the fit in
COUNTS = "lang string, source string, term string, count long"


@dataclass(frozen=True)
class Settings:
    """`min_docs` of its language a kept term needs; `smoothing` is added to every count; `unit` is probability 1."""

    min_docs: int = 30
    smoothing: int = 5
    unit: int = 1_000_000_000
    top: int = 50
    block_terms: int = 1_000_000


def tokens(documents: DataFrame) -> DataFrame:
    """lang, source and the distinct terms of every document by their count, each term behind its language and a blank.

    `groups` has a row for each count, with the terms that the document has so often. No term has a blank, so language
    and term can be told apart. Terms are cut from the bytes of a few documents at a time, as Arrow arrays.
    """

    def packed(held: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
        codes = np.frombuffer(b" ".join(data for _, _, data in held) + b" ", np.uint8)
        ends = np.cumsum([len(data) + 1 for _, _, data in held])
        starts, stops = W.spans(_IS_LETTER[codes])
        offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int32)
        letters = codes[_IS_LETTER[codes]]
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        bounds = np.concatenate(([0], np.searchsorted(starts, ends))).astype(np.int32)
        owner = np.repeat(np.arange(len(held)), np.diff(bounds))
        words = pc.binary_join_element_wise(pa.array([x[0] for x in held]).take(pa.array(owner)), words, " ")
        found = [words.slice(a, b - a).value_counts() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        counts = pa.concat_arrays([x.field("counts") for x in found]).to_numpy()
        doc = np.repeat(np.arange(len(held)), [len(x) for x in found])
        order = np.lexsort((counts, doc))
        counts, doc = counts[order], doc[order]
        cuts = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(counts, prepend=-1) != 0))
        values = pa.concat_arrays([x.field("values") for x in found]).take(pa.array(order))
        terms = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(doc)).astype(np.int32)), values)
        groups = pa.StructArray.from_arrays([pa.array(counts[cuts].astype(np.int32)), terms], ["count", "terms"])
        widths = pa.array(np.searchsorted(doc[cuts], np.arange(len(held) + 1)).astype(np.int32))
        columns = [pa.array([x[0] for x in held]), pa.array([x[1] for x in held]), pa.ListArray.from_arrays(widths, groups)]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "groups"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for lang, source, text in W.rows(batches, "lang", "source", "text"):
            held.append((lang, source, text.encode(errors="replace").translate(W.LOWER)))
            size += len(held[-1][2])
            if size >= W.BLOCK or len(held) >= 512:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    plain = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    kinds = "lang string, source string, groups array<struct<count: int, terms: array<string>>>"
    return documents.select(*plain).mapInArrow(run, kinds)


def kept_terms(held: DataFrame, settings: Settings) -> DataFrame:
    """Terms of at least `min_docs` documents (column term): the vocabulary depends on documents, not on repeats in one."""
    each = held.select(F.explode(F.flatten("groups.terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return each.where(F.col("n") >= settings.min_docs).select("term")


def block_counts(lists: DataFrame, kept: DataFrame) -> DataFrame:
    """Counts by source of the kept terms of one block (columns source, term, count).

    `lists`: source, count and the terms that a document has so often, each of its terms once.
    """
    # the documents of each term are counted by now, so the fit sees a term once; it takes all of them
    seen = kept.groupBy(F.pmod(F.xxhash64("term"), F.lit(_GROUPS)).alias("part")).agg(F.collect_list("term").alias("terms"))
    fitted = CountVectorizer(inputCol="terms", outputCol="vector", minDF=1, minTF=1, vocabSize=2**31 - 1).fit(seen)
    path = fresh_path(lists.sparkSession, "vocabulary")
    fitted.save(path)  # read back as a table, so that the terms are not sent one by one from the driver
    vocabulary = lists.sparkSession.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "term"))
    vector = F.unwrap_udt("vector")
    entries = fitted.transform(lists).select("source", "count", vector["indices"].alias("indices"))
    return group_sums(entries).join(vocabulary, "index").select("source", "term", "count")


def group_sums(entries: DataFrame) -> DataFrame:
    """Sum of the sparse vectors (indices of one value, columns indices and count) of each source: source, index, count.

    A task adds up what it holds of a source, and sends it in ranges of indices; a range is added up in one array of
    fixed length, so no sum is as wide as the vocabulary.
    """

    def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, values = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[starts], np.add.reduceat(values, starts)

    def sent(names: list[str | None], held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, values = added(held)
        cuts = np.flatnonzero(np.diff(keys >> _RANGE, prepend=-1))
        ends = [*cuts[1:].tolist(), len(keys)]
        at = keys[cuts]
        rows = [(keys[i:j] & _MASK, values[i:j]) for i, j in zip(cuts.tolist(), ends)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[k] for k in (at >> 32).tolist()], pa.string()),
                pa.array((at & 0xFFFFFFFF) >> _RANGE, pa.int32()),
                pa.array([k.astype(np.int32).tobytes() for k, _ in rows], pa.binary()),
                pa.array([v.tobytes() for _, v in rows], pa.binary()),
            ],
            ["source", "range", "indices", "values"],
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            which = np.array([codes.setdefault(s, len(codes)) for s in batch.column("source").to_pylist()], np.int64)
            lists = batch.column("indices")
            keys = np.repeat(which << 32, np.diff(lists.offsets.to_numpy())) | lists.flatten().to_numpy().astype(np.int64)
            if len(keys):
                held.append((keys, np.repeat(batch.column("count").to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy()))))
                n += len(keys)
            if n >= _HELD:
                held = [added(held)]
                n = len(held[0][0])
                if 2 * n >= _HELD:
                    yield sent(list(codes), held)
                    codes, held, n = {}, [], 0
        if held:
            yield sent(list(codes), held)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = W.rows(batches, "source", "range", "indices", "values")
        for (source, place), parts in groupby(rows, lambda row: row[:2]):
            sums = np.zeros(_MASK + 1, np.int64)
            for _, _, indices, values in parts:
                sums[np.frombuffer(indices, np.int32)] += np.frombuffer(values, np.int64)
            found = np.flatnonzero(sums)
            columns = [pa.array([source]).take(pa.array(np.zeros(len(found), np.int32))), pa.array(found + (place << _RANGE), pa.int32()), pa.array(sums[found])]
            yield pa.RecordBatch.from_arrays(columns, ["source", "index", "count"])

    parts = entries.mapInArrow(partial, "source string, range int, indices binary, values binary")
    dealt = parts.repartition("source", "range").sortWithinPartitions("source", "range")
    return dealt.mapInArrow(total, "source string, index int, count long")


def term_counts(held: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """How often each source has each kept term that it has."""
    spark = held.sparkSession
    kept = scratch.write("kept", kept_terms(held, settings))
    blocks = -(-kept.count() // settings.block_terms)
    counts = spark.createDataFrame([], COUNTS)
    lists = held.select("source", F.inline("groups"))
    for block in range(blocks):
        part, mine = lists, kept
        if blocks > 1:
            of = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)) == block
            part = lists.select("source", "count", F.filter("terms", of).alias("terms"))
            mine = kept.where(of(F.col("term")))
            if mine.isEmpty():
                continue
        found = block_counts(part, mine)
        lang = F.regexp_extract("term", r"(?s)^(.*) [^ ]+$", 1)
        found = found.select(lang.alias("lang"), "source", F.substring_index("term", " ", -1).alias("term"), "count")
        counts = counts.union(scratch.write("counts", found))
    return counts


def smoothed(count: Column, total: Column, terms: Column, settings: Settings) -> Column:
    """1 + floor(unit * (count + s) / (total + s * terms)), exact."""
    above = F.lit(settings.unit).cast("decimal(12,0)") * (count + F.lit(settings.smoothing)).cast("decimal(19,0)")
    below = (total + F.lit(settings.smoothing) * terms).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", above, below).cast("long")


def pair_values(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Sum over the kept terms of |p - q| for every two sources of a language, in both directions.

    A pair is V * |a - b| for terms that both lack (a and b are their p of a count of 0), and corrections for the
    terms that the first, the second or both have.
    """
    side = lambda df, name, *more: df.select("lang", *(F.col(c).alias(f"{c}_{name}") for c in ("source", "p0", *more)))
    both = side(groups.select("lang", "source", "p0", "terms"), "a", "terms").join(side(groups, "b"), "lang").where("source_a < source_b")
    base = both.select("lang", "source_a", "source_b", (F.col("terms_a") * F.abs(F.col("p0_a") - F.col("p0_b"))).alias("value"))

    levels = found.groupBy("lang", "source", "p0", "p").agg(F.count(F.lit(1)).alias("n"))
    one = side(levels, "x", "p", "n").join(side(groups, "y"), "lang").where("source_x <> source_y")
    alone = one.groupBy(
        "lang", F.least("source_x", "source_y").alias("source_a"), F.greatest("source_x", "source_y").alias("source_b")
    ).agg(F.sum(F.expr("n_x * (abs(p_x - p0_y) - abs(p0_x - p0_y))")).alias("value"))

    a = found.select("lang", "term", F.col("source").alias("source_a"), F.col("p").alias("p_a"), F.col("p0").alias("p0_a"))
    b = found.select("lang", "term", F.col("source").alias("source_b"), F.col("p").alias("p_b"), F.col("p0").alias("p0_b"))
    shared = a.join(b, ["lang", "term"]).where("source_a < source_b")
    shared = shared.groupBy("lang", "source_a", "source_b").agg(
        F.sum(F.expr("abs(p_a - p_b) - abs(p_a - p0_b) - abs(p0_a - p_b) + abs(p0_a - p0_b)")).alias("value")
    )
    sums = base.union(alone).union(shared).groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value"))
    end = lambda source, item: F.struct(F.col(source).alias("source"), F.col(item).alias("item"))
    ends = F.array(end("source_a", "source_b"), end("source_b", "source_a"))
    return sums.select("lang", F.inline(ends), "value")


def audit(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value and rank."""
    scratch = Scratch(documents.sparkSession)
    held = materialize(tokens(documents), "terms")
    counts = term_counts(held, scratch, settings)
    per_lang = counts.groupBy("lang", "term").agg(F.sum("count").alias("count"))
    sizes = per_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("count").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = held.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.fillna(0, ["terms", "lang_total", "total"])
    empty = smoothed(F.lit(0), F.col("total"), F.col("terms"), settings)
    groups = scratch.write("groups", groups.withColumn("p0", F.when(F.col("terms") > 0, empty).otherwise(F.lit(0))))

    p = smoothed(F.col("count"), F.col("total"), F.col("terms"), settings)
    found = counts.join(groups, ["lang", "source"]).withColumn("p", p).select("lang", "source", "term", "p", "p0")
    found = scratch.write("found", found)
    q = smoothed(F.col("count"), F.col("lang_total"), F.col("terms"), settings)
    lang_p = per_lang.join(sizes, "lang").select("lang", "term", q.alias("q"))
    above = found.join(lang_p, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pair_values(groups, found), "pair").union(ranked(above, "term").where(F.col("rank") <= settings.top))
