"""Near-duplicate documents: banded MinHash candidates with sequential Bayesian verification.

1. A document's word shingles are reduced to a signature. Documents of one and the same set become one node, the
   row with the smallest doc_id, before anything is compared.
2. Bands of signature values put nodes into buckets. A bucket of up to `block` nodes is compared inside one task.
3. A pair is compared batch by batch of its signatures. After each batch it is dropped when, given the agreements
   so far and a uniform prior, the probability that its similarity reaches the threshold falls below `miss`. It
   goes on only from the first band that its nodes share, so no pair is verified twice.
4. What survives is verified on the full shingle sets, and the links' connected components are the classes.
5. Larger buckets are first held together by links to a few leaders, linear in the bucket. Then blocks of nodes are
   compared with each other, only pairs of different components. A large group of near copies that the leaders
   connect costs no further pair, and nothing is capped.

Defined results: a null text, or one without a word, has the empty set and is linked with nothing. A text of fewer
words than a shingle is one shingle. Rows of one doc_id are one node. A row without doc_id has component_id of its
class where that has one, else null. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.components import components
from ledgerlake.session import materialize

U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """`bands` times `rows` hashes; `percent` is the least similarity; `miss` the chance to drop a pair a batch.

    Nodes of buckets of more than `block` nodes get `deep` hashes more, which tell their many pairs apart better.
    """

    shingle: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 6
    miss: float = 1e-4
    block: int = 128
    leaders: int = 2
    deep: int = 512

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    return np.unique(W.shingles(W.blank_words((text or "").encode(errors="replace")), size))


def signature(shingles: np.ndarray, hashes: int, seed: int = 8) -> bytes:
    """Low 16 bits of the least value under each hash function."""
    factors = np.random.default_rng(seed).integers(1, 1 << 62, hashes, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    least = np.full(hashes, (1 << 32) - 1, U64)
    for at in range(0, len(shingles), 512):
        values = (shingles[None, at : at + 512] * factors[:, None]) >> U64(32)
        np.minimum(least, values.min(axis=1), out=least)
    return (least & U64(0xFFFF)).astype("<u2").tobytes()


@functools.cache
def thresholds(hashes: int, batch: int, percent: int, miss: float) -> tuple[tuple[int, int], ...]:
    """(hashes compared, least agreements to go on) after each batch."""
    t, found = percent / 100, []
    for n in sorted({*range(batch, hashes, batch), hashes}):
        # with a uniform prior, P(similarity >= t | m of n agree) = P(Binomial(n + 1, t) <= m)
        total, m = 0.0, -1
        while total < miss:
            m += 1
            ways = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
            total += math.exp(ways + m * math.log(t) + (n + 1 - m) * math.log(1 - t))
        found.append((n, m))
    return tuple(found)


def survivors(left: np.ndarray, right: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], settings: Settings):
    """The pairs (indices into left and right signatures) that pass every batch."""
    a, b = pairs
    agreed, done = np.zeros(len(a), np.int32), 0
    for n, least in thresholds(left.shape[1], 4 * settings.rows, settings.percent, settings.miss):
        agreed = agreed + (left[a, done:n] == right[b, done:n]).sum(axis=1, dtype=np.int32)
        keep = agreed >= least
        a, b, agreed, done = a[keep], b[keep], agreed[keep], n
    return a, b


def first_shared_band(left: np.ndarray, right: np.ndarray, settings: Settings) -> np.ndarray:
    same = (left[:, : settings.hashes] == right[:, : settings.hashes]).reshape(-1, settings.bands, settings.rows).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), -1)


def sketches(documents: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, number of shingles, digest of the set and signature of every row (null digest: empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, keys, signatures = [], [], []
                for text in part.column("text").to_pylist():
                    found = shingle_set(text, settings.shingle)
                    sizes.append(len(found))
                    keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest() if len(found) else None)
                    signatures.append(signature(found, settings.hashes) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()), pa.array(signatures, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "signature"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, set_key string, signature binary"
    )


def _signatures(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<u2").reshape(len(values), -1)


def compare_inside(groups: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """Surviving pairs (u < v) of the nodes inside each group of bounded size (columns band, nodes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for band, nodes in W.rows([batch], "band", "nodes"):
                found = _signatures([x["signature"] for x in nodes])
                names = [x["node"] for x in nodes]
                a, b = survivors(found, found, np.triu_indices(len(names), 1), settings)
                mine = first_shared_band(found[a], found[b], settings) == band
                left += [min(names[i], names[j]) for i, j in zip(a[mine], b[mine])]
                right += [max(names[i], names[j]) for i, j in zip(a[mine], b[mine])]
            yield pa.RecordBatch.from_arrays([pa.array(left, _arrow(kind)), pa.array(right, _arrow(kind))], ["u", "v"])

    return groups.select("band", "nodes").mapInArrow(run, f"u {kind}, v {kind}").where("u <> v")


def compare_across(block_pairs: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """Surviving pairs of different components between two blocks (columns band, same, left, right)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_u, out_v = [], []
            for band, same, left, right in W.rows([batch], "band", "same", "left", "right"):
                one, two = _signatures([x["signature"] for x in left]), _signatures([x["signature"] for x in right])
                roots = np.array([x["root"] for x in left]), np.array([x["root"] for x in right])
                differ = roots[0][:, None] != roots[1][None, :]
                a, b = survivors(one, two, np.nonzero(np.triu(differ, 1) if same else differ), settings)
                mine = first_shared_band(one[a], two[b], settings) == band
                for i, j in zip(a[mine], b[mine]):
                    x, y = left[i]["node"], right[j]["node"]
                    out_u.append(min(x, y))
                    out_v.append(max(x, y))
            yield pa.RecordBatch.from_arrays([pa.array(out_u, _arrow(kind)), pa.array(out_v, _arrow(kind))], ["u", "v"])

    return block_pairs.mapInArrow(run, f"u {kind}, v {kind}").where("u <> v")


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def verified(pairs: DataFrame, texts: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold.

    Texts travel, not their sets, which are larger. The joins shuffle at every size, so that nothing that grows
    with the pairs is broadcast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small_set = functools.lru_cache(1024)(lambda text: shingle_set(text, settings.shingle))
        for batch in batches:
            left, right = [], []
            for u, v, one, two in W.rows([batch], "u", "v", "one", "two"):
                x, y = (small_set(t) if len(t) < 20_000 else shingle_set(t, settings.shingle) for t in (one, two))
                # similarity is at most the ratio of the sizes
                if 100 * min(len(x), len(y)) < settings.percent * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= settings.percent * (len(x) + len(y) - both):
                    left.append(u)
                    right.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(left, _arrow(kind)), pa.array(right, _arrow(kind))], ["u", "v"])

    one = texts.select(F.col("node").alias("u"), F.col("text").alias("one"))
    two = texts.select(F.col("node").alias("v"), F.col("text").alias("two"))
    joined = pairs.hint("merge").join(one, "u").hint("merge").join(two, "v")
    return joined.select("u", "v", "one", "two").mapInArrow(run, f"u {kind}, v {kind}")


def classes(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = materialize(sketches(documents, settings), "sketches")
    nodes = materialize(
        rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")),
        "nodes",
    )

    # buckets of two nodes or more; only hashes move to find them
    width = 2 * settings.rows
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(settings.bands - 1)),
        lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.substring("signature", b * width + 1, F.lit(width))).alias("bucket")),
    )
    places = nodes.select("node", F.inline(bands))
    sizes = materialize(places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = materialize(places.join(sizes, "bucket"), "members")
    wanted = members.select("node").distinct()
    # the texts that may be verified, moved once
    texts = documents.select(F.col("doc_id").alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    texts = materialize(texts.join(wanted.hint("merge"), "node", "left_semi"), "texts")
    signed = nodes.join(wanted, "node", "left_semi").select("node", "signature")
    signed = materialize(signed, "signed")

    item = F.struct("node", "signature")
    small = members.where(F.col("n") <= settings.block).join(signed, "node")
    groups = small.groupBy("bucket", "band").agg(F.collect_list(item).alias("nodes"))
    pairs = materialize(compare_inside(groups, kind, settings), "pairs")
    links = materialize(verified(pairs, texts, kind, settings), "links")
    large = members.where(F.col("n") > settings.block)
    if not large.isEmpty():
        links = _large_buckets(materialize(large, "large"), signed, texts, links, kind, settings)
    found = materialize(components(links), "components")

    # every row gets the class of its node
    rooted = nodes.select("set_key", "node").join(found, "node", "left")
    rooted = materialize(rooted.select("set_key", F.coalesce("root", "node").alias("root")), "rooted")
    out = rows.drop("signature").join(rooted, "set_key", "left")
    component = F.coalesce("root", "doc_id").alias("component_id")
    return out.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _with_roots(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _deep(signed: DataFrame, texts: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """Longer signatures: those at hand and `deep` hashes more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longer = [
                short + signature(shingle_set(text, settings.shingle), settings.deep, 9)
                for short, text in W.rows([batch], "signature", "text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(longer, pa.binary())], ["node", "signature"])

    return texts.join(signed.hint("merge"), "node").select("node", "signature", "text").mapInArrow(run, f"node {kind}, signature binary")


def _large_buckets(large: DataFrame, signed: DataFrame, texts: DataFrame, links: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """The links with those of the large buckets that join components (columns bucket, node, band, n)."""
    wanted = materialize(large.select("node").distinct(), "large-nodes")
    texts = materialize(texts.join(wanted.hint("merge"), "node", "left_semi"), "large-texts")
    signed = materialize(_deep(signed.join(wanted, "node", "left_semi"), texts, kind, settings), "deep")
    a, b = signed.select(F.col("node").alias("u"), F.col("signature").alias("one")), signed.select(
        F.col("node").alias("v"), F.col("signature").alias("two")
    )
    # a few leaders, others in each band: as many rows a member
    chosen = F.array(*(F.min_by("node", F.xxhash64("node", "band", F.lit(k))) for k in range(settings.leaders)))
    leaders = large.groupBy("bucket").agg(F.array_distinct(chosen).alias("leaders"))
    leaders = materialize(leaders.select("bucket", F.explode("leaders").alias("leader")), "leaders")
    stars = (
        large.join(leaders, "bucket")
        .where("node <> leader")
        .select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v"))
        .distinct()
    )
    stars = materialize(_agreeing(stars.join(a, "u").join(b, "v"), kind, settings), "stars")
    links = materialize(links.union(verified(stars, texts, kind, settings)), "links")
    found = materialize(components(links), "components")
    # blocks by component: the members of the bucket's largest class never meet each other again
    here = _with_roots(large, found)
    each = here.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("in_root"))
    main = materialize(each.groupBy("bucket").agg(F.max_by("root", "in_root").alias("main"), F.max("in_root").alias("n_main"), F.count(F.lit(1)).alias("roots")).where("roots > 1"), "main")
    here = here.join(main, "bucket").withColumn("is_main", F.col("root") == F.col("main"))
    blocks = F.greatest(F.ceil(F.when(F.col("is_main"), F.col("n_main")).otherwise(F.col("n") - F.col("n_main")) / F.lit(settings.block)), F.lit(1))
    here = here.withColumn("block", F.pmod(F.xxhash64("node"), blocks.cast("long")))
    packs = here.join(signed, "node").groupBy("bucket", "band", "is_main", "block").agg(
        F.collect_list(F.struct("node", "root", "signature")).alias("nodes")
    )
    packs = materialize(packs, "packs")
    left = packs.where(~F.col("is_main")).select("bucket", "band", F.col("block").alias("block_a"), F.col("nodes").alias("left"))
    right = packs.select("bucket", "is_main", F.col("block").alias("block_b"), F.col("nodes").alias("right"))
    both = left.join(right, "bucket").where(F.col("is_main") | (F.col("block_a") <= F.col("block_b"))).select(
        "band", (~F.col("is_main") & (F.col("block_a") == F.col("block_b"))).alias("same"), "left", "right"
    )
    pairs = materialize(compare_across(both, kind, settings), "cross-pairs")
    return links.union(verified(pairs, texts, kind, settings))


def _agreeing(pairs: DataFrame, kind: str, settings: Settings) -> DataFrame:
    """Pairs (u, v with signatures one, two) that pass the sequential test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (_signatures(batch.column(c).to_pylist()) for c in ("one", "two"))
                every = np.arange(batch.num_rows)
                keep, _ = survivors(one, two, (every, every), settings)
                kept = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], ["u", "v"])

    return pairs.select("u", "v", "one", "two").mapInArrow(run, f"u {kind}, v {kind}")
