"""Union forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL`` by column name; every part must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_evolving(parts: Sequence[DataFrame]) -> DataFrame:
    """Append batches whose columns differ; a missing column reads as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stack_rows(df: DataFrame, keep: Sequence[str], rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Several output rows per input row, each described by the same set of named expressions."""
    outs = list(rows[0])
    packed = F.array(*[F.struct(*[row[o].alias(o) for o in outs]) for row in rows])
    exploded = df.select(*keep, F.explode(packed).alias("_r"))
    return exploded.select(*keep, *[F.col(f"_r.{o}").alias(o) for o in outs])
