"""Connected components of a table of links, by alternating large-star and small-star steps on contracted links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import materialize

_HELD = 1 << 17  # links that a task holds at once


def _stars(pairs: Iterable[tuple]) -> list[tuple]:
    """Every node of the pairs but the least ones, each with the least node that it reaches by them."""
    above: dict = {}

    def least(x):
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for u, v in pairs:
        a, b = least(u), least(v)
        if a != b:
            above[max(a, b)] = min(a, b)
    return [(x, low) for x in above if (low := least(x)) != x]


def _contracted(links: DataFrame) -> DataFrame:
    """What the links of each task connect, as stars of depth one; a row may come from several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kinds = [], None

        def stars() -> pa.RecordBatch:
            found = _stars(held)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kinds[k]) for k in (0, 1)], ["u", "v"])

        for batch in batches:
            kinds = [batch.column(c).type for c in ("u", "v")]
            held += zip(batch.column("u").to_pylist(), batch.column("v").to_pylist())
            if len(held) >= _HELD:
                yield stars()
                held = []
        if held:
            yield stars()

    fields = ", ".join(f"{c} {links.schema[c].dataType.simpleString()}" for c in ("u", "v"))
    return links.select("u", "v").mapInArrow(run, fields)


def _linked_to_least(directed: DataFrame, least: DataFrame) -> DataFrame:
    """Every neighbour of a node linked to the least of the node's neighbourhood."""
    least = materialize(least, "least")  # read anew, so that the join can split a node with very many links
    return directed.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has a link to one lesser node only, that has none itself."""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("v").alias("node"), F.lit(None).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.max("down").alias("down"))
    return ends.where("low <> high OR low IS NOT NULL AND down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """`node` and `root`, the least node it is linked with over any number of links (columns u and v).

    Nodes without a link to another node do not appear. The links are rewritten until every node hangs on its
    root, in a number of rounds that grows with the logarithm of the longest chain. Before each round every task joins
    what its own links connect, up to `_HELD` of them, so only chains over several tasks take rounds.
    """
    down = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialize(_contracted(down), "links")
    # read anew, in as many tasks as the links fill
    while not _all_stars(links := materialize(_contracted(links.coalesce(links.count() // _HELD + 1)), "contracted")):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: the larger neighbours of every node go to the least of its neighbourhood
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        links = materialize(_linked_to_least(both.where("v > u"), least).distinct(), "large-star")
        # small star: the smaller neighbours and the node itself go there
        down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = materialize(down.groupBy("u").agg(F.min("v").alias("low")), "least-below")
        up = down.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        links = materialize(up.union(least.select("u", F.col("low").alias("v"))).distinct(), "small-star")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).distinct().union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
