"""Classes of documents whose word n-gram sets overlap, by T-occurrence search over inverted lists.

1. A document is the set of 64-bit hashes of its shingles. Rows of one set are one node.
2. The shingles' inverted lists are built in ranges of the hash space. A shingle of one node alone links nothing; the
   others go back to their nodes with their frequency (up to `hot`). A batch of texts tells its own nodes about a
   shingle that `hot` of them hold and sends on no more than so many of its entries, so a list never travels whole.
3. A node goes on if enough of its shingles are shared to reach the threshold at all. Two nodes that link share one of
   their rarest shingles (all but the last T - 1, rarest first). Nodes held together by those are a family, and links
   never leave it.
4. A family is searched in one task: T-occurrence search by DivideSkip. The node's short lists are merged on a heap,
   with skips, and what occurs often enough there is looked up in the long lists by binary search. A node that has
   been reached is taken out of the lists, so a group of near copies costs no search of all its pairs.
5. A family of more than `block` shingles is divided. Some nodes are in every block; nodes that are not connected to
   the family's largest class after that are searched in each block that has one of their rarest shingles.
6. The links' connected components are the classes.

Every candidate is counted over its full set, so links are exact. Nothing is capped: a shingle of very many nodes that
are not similar makes its search longer, by the length of its list for each of them.

Defined results: a null text, or one without a word, has the empty set and links with nothing. Fewer words than a
shingle are one shingle. Rows without doc_id belong to their class; its id is the smallest doc_id of the class, null
where none has one. Rows of one doc_id are looked at each for itself. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.components import components
from ledgerlake.llm.scratch import Scratch

U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """`percent`: the least similarity. `mu` weighs a probe of long lists against a step of the merge."""

    shingle: int = 4
    percent: int = 85
    bucket: int = 1 << 21
    batch: int = 1 << 20
    hot: int = 32
    block: int = 250_000
    anchors: int = 8
    mu: float = 0.0085

    def least(self, size: int) -> int:
        """Fewest common shingles of a set of this size with any similar set."""
        return -(-self.percent * size // 100)


def shingle_set(text: str | None, settings: Settings) -> np.ndarray:
    return np.unique(W.shingles(W.blank_words((text or "").encode(errors="replace")), settings.shingle))


def node_ids(found: np.ndarray, seed: int) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    digest = hashlib.blake2b(found.tobytes(), digest_size=16, salt=bytes([seed])).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


# ---------------------------------------------------------------- sets and shared shingles


def sized(documents: DataFrame, settings: Settings, seed: int) -> DataFrame:
    """doc_id, n_shingles, node and a second name of the set of every row (no node for the empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [shingle_set(text, settings) for text in part.column("text").to_pylist()]
                names = [node_ids(x, seed) if len(x) else (None, None) for x in found]
                columns = [pa.array(x, pa.int64()) for x in ([len(x) for x in found], *zip(*names))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_shingles", "node", "name"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, node long, name long"
    )


def _places(values: np.ndarray, bits: int) -> np.ndarray:
    """The range of the 64-bit space, of 2^bits, that each value is in."""
    return (values.view(U64) >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)


def _parts(places: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal places."""
    if len(places):
        cuts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(places)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(places[a]), slice(a, b)


def entries(documents: DataFrame, bits: int, settings: Settings, seed: int) -> DataFrame:
    """Entries (shingle, node) packed by range of the shingle, nodes as a list and places in it; `told` ones have a frequency of at least `hot`."""

    def packed(sets: dict[int, np.ndarray], turn: int) -> pa.RecordBatch:
        hashes, names = np.concatenate(list(sets.values())), np.array(list(sets), np.int64)
        which = np.repeat(np.arange(len(names)), [len(x) for x in sets.values()])
        order = np.argsort(hashes, kind="stable")
        hashes, which = hashes[order], which[order]
        starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        rank = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
        told = rank >= settings.hot
        columns: tuple[list, ...] = ([], [], [], [], [])
        for mask, is_told in ((~told, False), (told, True)):
            some, theirs = hashes[mask], which[mask]
            # told entries need no further count: they may pass through any range
            places = _places(some, bits) if not is_told else np.full(len(some), turn % (1 << bits))
            for place, part in _parts(places):
                used = np.zeros(len(names), bool)
                used[theirs[part]] = True
                short = (np.cumsum(used) - 1)[theirs[part]].astype(np.uint16)
                for column, value in zip(columns, (place, is_told, some[part], names[used], short)):
                    column.append(value)
        place, is_told, *arrays = columns
        return pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(is_told, pa.bool_()), *map(_binary, arrays)], ["place", "told", "hashes", "nodes", "which"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, turn = {}, 0, 0
        for (text,) in W.rows(batches, "text"):
            found = shingle_set(text, settings)
            if len(found):
                node, _ = node_ids(found, seed)
                n += 0 if node in held else len(found)
                held[node] = found
            if n >= settings.batch or len(held) == 1 << 16:
                turn = turn * 31 + node
                yield packed(held, turn)
                held, n = {}, 0
        if held:
            yield packed(held, turn * 31 + node)

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(
        run, "place int, told boolean, hashes binary, nodes binary, which binary"
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows by key, for batches sorted by it; each group is to be read before the next one."""
    from itertools import groupby

    n = len(keys)
    for key, found in groupby(W.rows(batches, *keys, *columns), lambda row: row[:n]):
        yield key, (row[n:] for row in found)


def _join_bytes(parts: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def shared(packs: DataFrame, bits: int, settings: Settings) -> DataFrame:
    """The entries of shingles that two nodes hold at least, with their frequency, packed by range of the node."""

    def packed(hashes: np.ndarray, nodes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        home = _places(nodes, bits)
        order = np.argsort(home, kind="stable")
        home, hashes, nodes, counts = home[order], hashes[order], nodes[order], counts[order]
        found = list(_parts(home))
        if found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in found], pa.int32()),
                    *(_binary([x[part] for _, part in found]) for x in (nodes, hashes, counts)),
                ],
                ["home", "nodes", "hashes", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ("place",), ("told", "hashes", "nodes", "which")):
            kept: tuple[list, list] = ([np.zeros(0, U64)], [np.zeros(0, np.int64)])
            for told, *packs in rows:
                hashes, nodes, which = map(np.frombuffer, packs, (U64, np.int64, np.uint16))
                if told:
                    yield from packed(hashes, nodes[which], np.full(len(hashes), settings.hot, np.uint8))
                else:
                    kept[0].append(hashes)
                    kept[1].append(nodes[which])
            hashes, nodes = map(np.concatenate, kept)
            if not len(hashes):
                continue
            order = np.lexsort((nodes, hashes))
            hashes, nodes = hashes[order], nodes[order]
            fresh = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (nodes[1:] != nodes[:-1])))
            hashes, nodes = hashes[fresh], nodes[fresh]
            starts = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            lengths = np.diff(np.append(starts, len(hashes)))
            counts = np.repeat(np.minimum(lengths, settings.hot).astype(np.uint8), lengths)
            keep = counts > 1
            yield from packed(hashes[keep], nodes[keep], counts[keep])

    dealt = packs.repartition("place").sortWithinPartitions("place")
    return dealt.mapInArrow(run, "home int, nodes binary, hashes binary, counts binary")


def candidates(found: DataFrame, sizes: DataFrame, bits: int, settings: Settings) -> DataFrame:
    """Nodes that enough of their shingles may link: node, size, shared shingles (rarest first) and the prefix length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ("home",), ("node", "size", "nodes", "hashes", "counts")):
            size_of, parts = {}, ([], [], [])
            for node, size, *packs in rows:
                if node is not None:
                    size_of[node] = size
                else:
                    for held, pack in zip(parts, packs):
                        held.append(pack)
            nodes, hashes, counts = (_join_bytes(p, k) for p, k in zip(parts, (np.int64, U64, np.uint8)))
            order = np.lexsort((hashes, counts, nodes))
            nodes, hashes, counts = nodes[order], hashes[order], counts[order]
            # copies in several batches report a shingle twice
            fresh = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (nodes[1:] != nodes[:-1])))[: len(nodes)]
            nodes, hashes = nodes[fresh], hashes[fresh]
            out: tuple[list, ...] = ([], [], [], [])
            for node, part in _parts(nodes):
                size = size_of[node]
                spare = part.stop - part.start - settings.least(size)
                if spare >= 0:
                    for column, value in zip(out, (node, size, hashes[part].tobytes(), spare + 1)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.int32()))], ["node", "size", "hashes", "prefix"]
            )

    home = F.shiftrightunsigned("node", 64 - bits).cast("int") if bits else F.lit(0)
    rows = sizes.select(home.alias("home"), "node", "size").unionByName(found, allowMissingColumns=True)
    dealt = rows.repartition("home").sortWithinPartitions("home")
    return dealt.mapInArrow(run, "node long, size long, hashes binary, prefix int")


def prefixes(nodes: DataFrame, *more: str) -> DataFrame:
    """One row for each of the rarest shingles of a node: shingle, node and what else is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(h, np.int64)[:p] for h, p in zip(batch.column("hashes").to_pylist(), batch.column("prefix").to_pylist())]
            if found:
                at = np.repeat(np.arange(len(found)), [len(x) for x in found])
                rest = [batch.column(c).take(pa.array(at)) for c in ("node", *more)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), *rest], ["shingle", "node", *more])

    kinds = "".join(f", {c} {nodes.schema[c].dataType.simpleString()}" for c in more)
    return nodes.select("hashes", "prefix", "node", *more).mapInArrow(run, f"shingle long, node long{kinds}")


# ---------------------------------------------------------------- search


def merge_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """Values that at least `need` of the sorted lists hold, and how many do."""
    heap = [(values[0], k) for k, values in enumerate(lists)]
    heapify(heap)
    place = [0] * len(lists)
    while len(heap) >= need:
        low, popped = heap[0][0], []
        while heap and heap[0][0] == low:
            popped.append(heappop(heap)[1])
        if len(popped) >= need:
            yield low, len(popped)
            target = low + 1
        else:
            while len(popped) < need - 1:
                popped.append(heappop(heap)[1])
            target = heap[0][0]
        for k in popped:
            place[k] = bisect_left(lists[k], target, place[k])
            if place[k] < len(lists[k]):
                heappush(heap, (lists[k][place[k]], k))


class Index:
    """Inverted lists of a block of nodes; nodes are numbered by size, so a list is sorted by size."""

    def __init__(self, sizes: list[int], sets: list[np.ndarray], settings: Settings):
        self.settings = settings
        self.order = np.argsort(np.array(sizes), kind="stable")
        self.sizes = np.array(sizes)[self.order]
        lengths = [len(sets[i]) for i in self.order]
        flat = np.concatenate([sets[i] for i in self.order])
        self.shingles, inverse = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), lengths)
        by_list = np.argsort(inverse, kind="stable")
        self.left = np.bincount(inverse, minlength=len(self.shingles))  # nodes still in each list
        bounds = np.concatenate(([0], np.cumsum(self.left)))
        holders = owner[by_list]
        self.lists = [holders[a:b] for a, b in zip(bounds, bounds[1:])]
        self.of_node = np.split(inverse, np.cumsum(lengths)[:-1])
        self.alive = np.ones(len(sets), bool)

    def remove(self, node: int) -> None:
        self.alive[node] = False
        self.left[self.of_node[node]] -= 1

    def _held(self, number: int) -> np.ndarray:
        found = self.lists[number]
        if len(found) > self.left[number]:
            found = self.lists[number] = found[self.alive[found]]
        return found

    def partners(self, numbers: np.ndarray, size: int) -> list[int]:
        """Nodes in the lists that are similar to a set of these lists and this size."""
        s = self.settings
        need = s.least(size)
        numbers = numbers[self.left[numbers] > 0]
        if len(numbers) < need:
            return []
        # similar sets have a size from percent % of this one's to 100 / percent of it
        low, high = np.searchsorted(self.sizes, (need, 100 * size // s.percent + 1))
        lists = []
        for number in numbers.tolist():
            held = self._held(number)
            a, b = np.searchsorted(held, (low, high))
            if a < b:
                lists.append(held[a:b])
        if len(lists) < need:
            return []
        lists.sort(key=len)
        n_long = min(need - 1, int(need / (s.mu * math.log(len(lists[-1]) + 1) + 1)))
        cut = len(lists) - n_long
        found = list(merge_skip([x.tolist() for x in lists[:cut]], need - n_long))
        if not found:
            return []
        nodes, counts = (np.array(x) for x in zip(*found))
        enough = -(-s.percent * (size + self.sizes[nodes]) // (100 + s.percent))
        for k, long in enumerate(lists[cut:]):
            if k % 16 == 0:
                keep = counts + (n_long - k) >= enough
                nodes, counts, enough = nodes[keep], counts[keep], enough[keep]
                if not len(nodes):
                    return []
            at = np.minimum(np.searchsorted(long, nodes), len(long) - 1)
            counts = counts + (long[at] == nodes)
        return nodes[counts >= enough].tolist()

    def spanning_links(self) -> list[tuple[int, int]]:
        """Links that connect what is connected, as places in the given lists."""
        links = []
        for first in range(len(self.sizes)):
            if not self.alive[first]:
                continue
            self.remove(first)
            waiting = [first]
            while waiting:
                node = waiting.pop()
                for other in self.partners(self.of_node[node], int(self.sizes[node])):
                    self.remove(other)
                    waiting.append(other)
                    links.append((int(self.order[node]), int(self.order[other])))
        return links

    def numbers(self, wanted: np.ndarray) -> np.ndarray:
        """Numbers of the lists of these shingles."""
        at = np.minimum(np.searchsorted(self.shingles, wanted), len(self.shingles) - 1)
        return at[self.shingles[at] == wanted]


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"])


def search_inside(members: DataFrame, settings: Settings) -> DataFrame:
    """Links that connect the nodes of each block (columns root, block, node, size, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ("root", "block"), ("node", "size", "hashes")):
            nodes, sizes, sets = zip(*rows)
            links = Index(list(sizes), [np.frombuffer(x, U64) for x in sets], settings).spanning_links()
            if links:
                yield _pairs([(nodes[a], nodes[b]) for a, b in links])

    dealt = members.select("root", "block", "node", "size", "hashes").repartition("root", "block")
    return dealt.sortWithinPartitions("root", "block").mapInArrow(run, "u long, v long")


def search_across(members: DataFrame, asking: DataFrame, settings: Settings) -> DataFrame:
    """Links of asking nodes with a node of each other class of the block (also columns block and class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, ("root", "block"), ("asks", "node", "size", "hashes", "class")):
            held, index, links = [], None, []
            for asks, node, size, hashes, kind in rows:
                found = np.frombuffer(hashes, U64)
                if not asks:
                    held.append((node, size, found, kind))
                    continue
                index = index or Index([x[1] for x in held], [x[2] for x in held], settings)
                classes = {}
                for other in index.partners(index.numbers(found), size):
                    there = held[int(index.order[other])]
                    classes.setdefault(there[3], there[0])
                links += [(node, other) for c, other in classes.items() if c != kind]
            if links:
                yield _pairs(links)

    columns = "root", "block", "node", "size", "hashes", "class"
    both = members.select(*columns, F.lit(False).alias("asks")).union(asking.select(*columns, F.lit(True)))
    dealt = both.repartition("root", "block").sortWithinPartitions("root", "block", "asks")
    return dealt.mapInArrow(run, "u long, v long")


# ---------------------------------------------------------------- the join


def links_of(nodes: DataFrame, scratch: Scratch, settings: Settings) -> DataFrame:
    """Links (u, v) that connect the nodes (node, size, hashes, prefix) of each class."""
    rare = scratch.write("rare", prefixes(nodes))
    lists = rare.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low")).where("n > 1")
    joined = rare.join(scratch.write("lists", lists), "shingle").where("node <> low")
    families = components(joined.select(F.col("node").alias("u"), F.col("low").alias("v")).distinct())
    members = scratch.write("members", nodes.join(families, "node"))
    totals = members.groupBy("root").agg(F.sum(F.octet_length("hashes") / 8).cast("long").alias("total"))
    totals = totals.select("root", F.ceil(F.col("total") / F.lit(settings.block)).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    placed = scratch.write("placed", members.join(totals, "root").withColumn("block", block))
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return scratch.write("links", search_inside(placed, settings))

    order = Window.partitionBy("root").orderBy(F.xxhash64(F.lit(1), "node"), "node")
    chosen = large.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.anchors).drop("rank")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    chosen = chosen.select("*", every).where("other <> block").withColumn("block", F.col("other")).select(*placed.columns)
    links = scratch.write("links", search_inside(placed.union(chosen), settings))
    # what is not connected to the largest class of its family asks in the other blocks
    classes = scratch.write("classes", components(links).select("node", F.col("root").alias("class")))
    links = classes.where("node <> class").select(F.col("node").alias("u"), F.col("class").alias("v"))  # not searched again
    large = large.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    large = scratch.write("large", large)
    counts = large.groupBy("root", "class").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("root").agg(F.max_by("class", F.struct("n", "class")).alias("main"))
    outside = scratch.write("outside", large.join(main, "root").where("class <> main").drop("main"))
    if outside.isEmpty():
        return links
    there = prefixes(large, "root", "block", "class").drop("node").distinct()
    here = prefixes(outside, "class").withColumnRenamed("class", "own")
    where = there.join(here, "shingle").where("class <> own").select("node", F.col("block").alias("there")).distinct()
    asking = outside.join(scratch.write("where", where), "node").withColumn("block", F.col("there"))
    return links.union(scratch.write("cross", search_across(large, asking, settings)))


def classes(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    scratch = Scratch(documents.sparkSession)
    for seed in range(8):
        rows = scratch.write("rows", sized(documents, settings, seed))
        named = rows.where("node IS NOT NULL").groupBy("node")
        nodes = named.agg(
            F.first("n_shingles").alias("size"), F.min("doc_id").alias("low"), F.min("name").alias("a"), F.max("name").alias("b")
        )
        nodes = scratch.write("nodes", nodes)
        if nodes.where("a <> b").isEmpty():
            break
    else:
        raise RuntimeError("different sets have one name under every seed")
    total = nodes.agg(F.sum("size").alias("n")).first()["n"] or 0
    bits = max(0, math.ceil(math.log2(total / settings.bucket))) if total else 0
    several = shared(entries(documents, bits, settings, seed), bits, settings)
    kept = scratch.write("kept", candidates(several, nodes.select("node", "size"), bits, settings))
    del several
    scratch.drop()  # the shuffles of the entries are read
    found = components(links_of(kept, scratch, settings))

    rooted = nodes.join(found, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    rooted = scratch.write("rooted", rooted)
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch.write("named", rooted.join(lowest, "root").select("node", "component_id"))
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", own)
