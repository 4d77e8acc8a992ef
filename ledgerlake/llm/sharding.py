"""Sharding by balanced label propagation, in DataFrame functions only.

Documents with equal texts are linked. Every document starts in a shard that its id's hash chooses. In each
round the linked documents of a group ask to move to the shard that holds most of their neighbours among those
with room; a shard lets in what its quota of rows leaves, larger groups first, where the rows asking to leave it
count as gone. Groups larger than a quota move in part. At last the surplus of each shard, documents without
links first, fills the free places, so that the counts of rows are at most one apart whatever the rounds did.

Only counts by shard (and by shard and power of two of the group size) come to the driver; ranks are taken within
(shard, chunk) with the chunks' totals as offsets, so no task holds a shard.

Defined results: a null text is empty (size 16, crc32 0) and linked with the other empty ones. Repeated rows are
rows of their own. Which of two rows that are alike in every column gets which slot is not defined. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialize


@dataclass(frozen=True)
class Settings:
    shards: int = 40
    rounds: int = 6
    chunk_rows: int = 20_000
    row_bytes: int = 16


def measured(documents: DataFrame, row_bytes: int) -> DataFrame:
    """What the rest needs of a document, without its text."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(
        "doc_id",
        (F.octet_length(data).cast("long") + F.lit(row_bytes)).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.sha2(data, 256).alias("text_key"),
    )


def lookup(values: dict, *keys: Column, default=0) -> Column:
    """A literal map of bounded size; the keys are joined by a colon."""
    if not values:
        return F.lit(default)
    pairs = [F.lit(x) for k, v in values.items() for x in (":".join(map(str, k)) if isinstance(k, tuple) else str(k), v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.concat_ws(":", *(k.cast("string") for k in keys))), F.lit(default))


def propagate(linked: DataFrame, quota: dict[int, int], settings: Settings) -> DataFrame:
    """Rounds of moves of the linked documents (text_key, seed, shard) under the shards' quotas."""
    most = max(quota.values())
    for turn in range(settings.rounds):
        held = linked.groupBy("text_key", "shard").agg(F.count(F.lit(1)).alias("n"))
        sizes = held.groupBy("text_key").agg(F.sum("n").alias("group_rows"))
        held = materialize(held.join(sizes, "text_key").withColumn("oversized", F.col("group_rows") > most), "sized")
        load = defaultdict(int, {r.shard: r.n for r in held.groupBy("shard").agg(F.sum("n").alias("n")).collect()})
        # of a group that no shard can hold, rows stay where the group fills half a shard, and the others ask
        # for a shard with room; ties between neighbours' shards go by a hash, to spread them
        settled = F.col("oversized") & (F.col("n") * 2 >= most)
        full = [s for s, q in quota.items() if load[s] >= q]
        has_room = ~F.col("shard").isin(full) if full else F.lit(True)
        rank = F.struct((~settled & (has_room | ~F.col("oversized"))).alias("open"), "n", F.xxhash64("text_key", "shard").alias("tie"))
        asked = held.groupBy("text_key", "group_rows", "oversized").agg(
            F.max_by("shard", rank).alias("target"),
            F.max(rank)["n"].alias("there"),
            F.sum(F.when(settled, F.col("n")).otherwise(F.lit(0))).alias("stay"),
        )
        asked = asked.withColumn("moving", F.greatest(F.col("group_rows") - F.col("there") - F.col("stay"), F.lit(0))).withColumn(
            "scale", F.floor(F.log2(F.greatest("group_rows", F.lit(1)))).cast("int")
        )
        asked = materialize(asked, "asked")
        # one number for each shard and power of two: bounded by shards * 63
        wanted = {
            (r.target, r.scale): (r.rows, r.largest)
            for r in asked.where("moving > 0").groupBy("target", "scale").agg(F.sum("moving").alias("rows"), F.max("moving").alias("largest")).collect()
        }
        if not wanted:
            break
        leaving = defaultdict(int)
        moves = held.join(asked.where("moving > 0").select("text_key", "target"), "text_key").where("shard <> target").where(~settled)
        for r in moves.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            leaving[r.shard] = r.n
        share = {}
        for target, goal in quota.items():
            room = goal - load[target] + leaving[target]
            for (at, scale), (rows, largest) in sorted(wanted.items(), key=lambda x: -x[0][1]):
                if at == target:
                    share[(target, scale)] = float(min(1.0, max(0.0, room / rows)))
                    room -= rows
        part = lookup(share, F.col("target"), F.col("scale"), default=0.0)
        chance = lambda *c: F.pmod(F.xxhash64(F.lit(turn), *c), F.lit(1 << 20)) / F.lit(float(1 << 20))
        accepted = asked.where("moving > 0").withColumn("part", part).where("part > 0")
        # a group goes as a whole or not at all, except one that no shard can hold
        accepted = accepted.where(F.col("oversized") | (chance("text_key") < F.col("part"))).select(
            "text_key", "target", F.when(F.col("oversized"), F.col("part")).otherwise(F.lit(1.0)).alias("part")
        )
        strongholds = held.where(settled).select("text_key", "shard", F.lit(True).alias("stays"))
        # both are filters of written tables, so the join can split a large group as it stands
        # at most two groups fill half a shard each: 2 * shards rows
        goes = F.col("target").isNotNull() & F.col("stays").isNull() & (chance("seed") < F.col("part"))
        linked = linked.join(accepted, "text_key", "left").join(F.broadcast(strongholds), ["text_key", "shard"], "left").select(
            "text_key", "seed", F.when(goes, F.col("target")).otherwise(F.col("shard")).alias("shard")
        )
        linked = materialize(linked, "moved")
    return linked


def with_slots(rows: DataFrame, chunks: int) -> DataFrame:
    """A gapless `slot` from 0 in every shard: linked rows first, then the others.

    The number `row` deals rows that are alike in all columns over the chunks too.
    """
    chunk = F.pmod(F.xxhash64("seed", "row"), F.lit(chunks)) + F.when(F.col("link").isNull(), F.lit(chunks)).otherwise(F.lit(0))
    rows = rows.withColumn("chunk", chunk.cast("int"))
    totals = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = totals.select(
        "shard", "chunk", (F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("link", "seed", "doc_id", "row")) - 1
    ranked = rows.withColumn("place", place.cast("long"))
    return ranked.join(before, ["shard", "chunk"]).withColumn("slot", F.col("before") + F.col("place")).drop("chunk", "before", "place")


def shard_documents(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every document with size, text_crc32, shard and slot; row counts of the shards at most one apart."""
    shards = settings.shards
    # rows without a text's bytes; `seed` chooses the first shard and breaks ties
    facts = measured(documents, settings.row_bytes).withColumn("seed", F.xxhash64("doc_id", "text_key"))
    facts = facts.withColumn("row", F.monotonically_increasing_id())
    facts = materialize(facts.withColumn("shard", F.pmod("seed", F.lit(shards)).cast("int")), "facts")
    n = facts.count()
    quota = {s: n // shards + (1 if s < n % shards else 0) for s in range(shards)}

    groups = facts.groupBy("text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text_key")
    groups = materialize(groups, "groups")
    linked = materialize(
        facts.join(groups, "text_key").select("text_key", "seed", "shard"), "linked"
    )
    moved = propagate(linked, quota, settings).groupBy("text_key", "seed").agg(F.max("shard").alias("moved"))
    moved = materialize(moved, "moved-to")
    f, m = facts.alias("f"), moved.alias("m")
    placed = f.join(m, (F.col("f.text_key") == F.col("m.text_key")) & (F.col("f.seed") == F.col("m.seed")), "left").select(
        "f.doc_id", "f.size", "f.text_crc32", "f.seed", "f.row",
        F.when(F.col("m.moved").isNotNull(), F.col("f.text_key")).alias("link"),
        F.coalesce("m.moved", "f.shard").alias("shard"),
    )
    chunks = max(8, math.ceil(n / shards / settings.chunk_rows))
    ranked = materialize(with_slots(placed, chunks), "ranked")

    # surplus rows, those with the last slots, fill the free places in order: numbers of the shards only
    counts = defaultdict(int, {r.shard: r.n for r in ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()})
    over, under, surplus, free = {}, [], 0, 0
    for s, goal in quota.items():
        over[s] = surplus
        surplus += max(0, counts[s] - goal)
        if counts[s] < goal:
            under.append((free, s, counts[s]))
            free += goal - counts[s]
    number = lookup(over, F.col("shard"), default=0) + F.col("slot") - lookup(quota, F.col("shard"), default=0)
    spare = F.col("slot") >= lookup(quota, F.col("shard"), default=0)
    new_shard, new_slot = F.col("shard"), F.col("slot")
    if under:
        starts = F.array(*(F.lit(start) for start, _, _ in under))
        # the last free range that starts at or before the row's number
        which = F.size(F.filter(starts, lambda x: x <= F.col("number")))
        shard_of = F.element_at(F.array(*(F.lit(s) for _, s, _ in under)), which)
        slot_of = F.element_at(F.array(*(F.lit(c - start) for start, _, c in under)), which) + F.col("number")
        ranked = ranked.withColumn("spare", spare).withColumn("number", F.when(spare, number).otherwise(F.lit(0)))
        new_shard = F.when(F.col("spare"), shard_of).otherwise(F.col("shard"))
        new_slot = F.when(F.col("spare"), slot_of).otherwise(F.col("slot"))
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        new_shard.cast("int").alias("shard"),
        new_slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("link").isNotNull().alias("linked"),
    )
