"""From raw documents to packed training sequences: five stages, each over all rows its predecessor kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from ledgerlake.llm.queries import tokenizer_file
from ledgerlake.session import bounded_batches, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    """The stage with bounded Arrow batches, so that a task's memory does not follow the length of 10,000 texts."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


def _carried(docs: DataFrame) -> DataFrame:
    """Rows as one column beside what an operator reads, so that no other column's name can clash."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"], docs["text"])


def _beside_text(docs: DataFrame) -> DataFrame:
    """As `_carried`, for operators that pass rows through Python: the text stands there once."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("row"), docs["text"])


def _rows_of(found: DataFrame, columns: list[str]) -> DataFrame:
    """The columns again as they were in front of `_beside_text`."""
    return found.select(*(found["text"] if c == "text" else found["row"].getField(c).alias(c) for c in columns))


def _only(keyed: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys (null matches null) are among the kept; of rows alike in all keys one stays."""
    counts = materialize(kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")), "kept-keys")
    right = counts.select(*(F.col(k).alias(f"_kept_{k}") for k in keys), F.col("copies").alias("_copies"))
    found = keyed.join(right, functools.reduce(Column.__and__, (keyed[k].eqNullSafe(right[f"_kept_{k}"]) for k in keys)))
    single = found.where("_copies = 1").select("row")
    if counts.where("copies > 1").isEmpty():
        return single.select("row.*")
    repeated = found.where("_copies > 1").groupBy(*keys).agg(F.first("row").alias("row")).select("row")
    return single.union(repeated).select("row.*")


def _row_key(docs: DataFrame, hashed: Callable[..., Column] = F.xxhash64) -> Column:
    """A number of doc_id and text, the same for rows alike in both and, which is checked, for no others."""
    parts = F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")
    content = F.struct("doc_id", F.sha2(F.col("text").cast("binary"), 256)).alias("content")
    for seed in range(8):
        key = hashed(F.lit(seed), *parts)
        contents = docs.select(key.alias("key"), content).groupBy("key").agg(F.min("content").alias("a"), F.max("content").alias("b"))
        if contents.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty():
            return key
    raise RuntimeError("different documents have one key under every seed")


@_in_small_batches
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter go."""
    seen = language_id.predict(_beside_text(docs), language_id.fit(docs), ("row", "text"))
    return _rows_of(seen.where(F.col("lang_pred") != language_id.UNKNOWN), docs.columns)


@_in_small_batches
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    kept = exact_dedup.exact_groups(docs).where("kept").select("doc_id", "text_sha256")
    digest = F.sha2(exact_dedup.normalised(F.col("text")).cast("binary"), 256)
    return _only(_carried(docs).withColumn("text_sha256", digest), kept, ["doc_id", "text_sha256"])


@_in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest id.

    Rows are compared by a key of id and text, so that rows without an id or with a repeated one count each.
    """
    keyed = _carried(docs).withColumn("key", _row_key(docs))
    found = near_dedup.classes(keyed.select(F.col("key").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    ids = materialize(keyed.select("key", "doc_id"), "row-keys")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    kept = found.distinct().join(ids.distinct(), "key").groupBy("component_id").agg(F.min(first).alias("first")).select("first.key")
    return _only(keyed, ids.join(kept, "key", "left_semi"), ["key"])


@_in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.matches(_beside_text(docs), benchmark, keep=("row", "text"))
    return _rows_of(found.where(F.size("hit_spans") == 0), docs.columns)


@_in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language", keep_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Language prototypes, MinHash and tokens are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
