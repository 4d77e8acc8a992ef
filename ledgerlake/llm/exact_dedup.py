"""Exact de-duplication through content-defined chunk recipes, in DataFrame functions only.

A normalised text is cut where its content says so: a chunk ends behind three characters of one class each, or
at the longest length. Equal texts therefore have equal chunks in equal order, and one edit changes a chunk or
two. Chunks are de-duplicated once, by content, into verified identifiers; a document becomes the ordered list
of its chunks' identifiers (its recipe), and only recipes are compared. No text moves after that.

An identifier is the chunk's 64-bit fingerprint and a number that tells apart different chunks of one
fingerprint. That number is 0 nearly always; only documents that hold a chunk of a shared fingerprint look it up
by content.

Defined results: null counts as the empty text, whose recipe is empty; empty texts are a group. Of equal texts
the row with the smallest doc_id stays; several rows of that same doc_id all have it as keep_id, and the flag
`kept` is theirs alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialize


@dataclass(frozen=True)
class Cuts:
    """Chunk lengths in characters. `remainders` choose the three characters in front of a cut: code mod 8."""

    shortest: int = 512
    longest: int = 2048
    remainders: tuple[int, int, int] = (5, 0, 4)

    def pattern(self) -> str:
        classes = "".join(f"[{''.join(f'\\x{{{c:x}}}' for c in range(8, 127) if c % 8 == r)}]" for r in self.remainders)
        return f"(?s).{{{self.shortest - 3},{self.longest - 3}}}?{classes}|.{{1,{self.longest}}}"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space; null becomes the empty text."""
    # a single space stays as it is, so only the other runs are matched
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_groups(
    documents: DataFrame, cuts: Cuts = Cuts(), fingerprint: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """Every document with keep_id, group_size, kept, text_sha256 and its number of chunks."""
    pattern = F.lit(cuts.pattern())
    texts = documents.select("doc_id", normalised(F.col("text")).alias("norm"))
    cut = texts.select(
        "doc_id",
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.regexp_extract_all("norm", pattern, F.lit(0)).alias("chunks"),
    )

    # 1. every chunk once: the partial aggregate drops repeats in front of the only shuffle of text
    held = cut.select(F.explode("chunks").alias("chunk")).select(fingerprint(F.col("chunk")).alias("print"), "chunk")
    contents = held.groupBy("print", "chunk").agg(F.count(F.lit(1)).alias("uses"))
    shared = contents.groupBy("print").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("print")
    shared = materialize(shared, "shared-prints")

    # 2. recipes; no text in them
    recipes = materialize(
        cut.select("doc_id", "text_sha256", F.transform("chunks", lambda x: fingerprint(x)).alias("prints")), "recipes"
    )
    if shared.isEmpty():  # every fingerprint is verified to stand for one content
        recipe = recipes.select("doc_id", "text_sha256", F.col("prints").alias("recipe"))
    else:
        recipe = _told_apart(cut, recipes, shared, fingerprint)

    # 3. equal recipes; a group's rows meet only as one row a task
    groups = materialize(
        recipe.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups"
    )
    return recipe.join(groups, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
        F.size("recipe").cast("long").alias("n_chunks"),
    )


def _told_apart(cut: DataFrame, recipes: DataFrame, shared: DataFrame, fingerprint: Callable[[Column], Column]) -> DataFrame:
    """Recipes whose identifiers carry the number of the content wherever a fingerprint stands for several.

    Rows are matched by their digest and fingerprints, so documents without such a chunk keep theirs.
    """
    occurrences = cut.select(F.explode("chunks").alias("chunk")).select(fingerprint(F.col("chunk")).alias("print"), "chunk")
    several = occurrences.join(shared, "print", "left_semi").distinct()
    numbers = materialize(
        several.select("print", "chunk", F.row_number().over(Window.partitionBy("print").orderBy("chunk")).alias("number")),
        "numbers",
    )
    # rows that read alike (same id, same text) are one here
    places = cut.select("doc_id", "text_sha256", F.posexplode("chunks").alias("place", "chunk"))
    places = places.withColumn("print", fingerprint(F.col("chunk")))
    found = places.join(numbers, ["print", "chunk"]).select(
        "doc_id", "text_sha256", F.struct("place", "number").alias("at")
    )
    tags = materialize(
        found.groupBy("doc_id", "text_sha256").agg(F.array_sort(F.collect_set("at")).alias("numbers")), "tags"
    )
    tagged = recipes.join(
        tags, recipes.doc_id.eqNullSafe(tags.doc_id) & (recipes.text_sha256 == tags.text_sha256), "left"
    ).select(recipes.doc_id, recipes.text_sha256, "prints", "numbers")
    # number of fingerprints, fingerprints, then places and numbers: equal exactly for equal contents
    extra = F.coalesce(
        F.flatten(F.transform("numbers", lambda x: F.array(x["place"].cast("long"), x["number"].cast("long")))),
        F.array().cast("array<long>"),
    )
    return tagged.select("doc_id", "text_sha256", F.concat(F.array(F.size("prints").cast("long")), "prints", extra).alias("recipe"))
