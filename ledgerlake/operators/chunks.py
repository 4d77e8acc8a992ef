"""Chunks of a key's rows in order, cut at quantiles of the data, so that no task holds a whole hot key.

A fixed grain of the order column leaves rows without an order value, or with equal ones, together. Here the order is
that of all order columns and, last, a row number, so nulls and ties are cut as well. A sample of the rows of each key
that is too large gives its boundaries; keys of one chunk have none.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import Names, group_key
from ledgerlake.session import materialize

ROW = "_row"
_PER_CHUNK = 16  # sampled rows for each chunk


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once, with a number that tells equal ones apart."""
    return materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def _before(a: Column, b: Column, fields: Sequence[str], down: bool) -> Column:
    """Whether one row's order values come before another's, nulls last in both directions."""
    steps = []
    equal = F.lit(True)
    for name in fields:
        x, y = a[name], b[name]
        smaller = x > y if down and name != ROW else x < y
        first = F.coalesce(smaller, x.isNotNull() & y.isNull())
        steps.append(equal & first)
        equal = equal & x.eqNullSafe(y)
    return functools.reduce(Column.__or__, steps)


def by_quantiles(rows: DataFrame, keys: Names, order_by: Sequence[str], rows_per_chunk: int, down: bool = False) -> DataFrame:
    """``rows`` of :func:`stored` with ``_grp``: the key and, in order, the number of the chunk.

    A key has about a chunk for every ``rows_per_chunk`` rows; only sampled order values of the larger keys meet.
    """
    fields = [*order_by, ROW]
    place = F.struct(*[F.col(c) for c in fields])
    keyed = rows.withColumn("_key", group_key(keys))
    large = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_chunk)
    taken = keyed.where(F.pmod(F.xxhash64(ROW), F.lit(max(1, rows_per_chunk // _PER_CHUNK))) == 0)
    taken = taken.select("_key", place.alias("_place")).join(large, "_key")
    order = lambda a, b: F.when(_before(a, b, fields, down), F.lit(-1)).when(_before(b, a, fields, down), F.lit(1)).otherwise(F.lit(0))
    bounds = taken.groupBy("_key").agg(F.collect_list("_place").alias("_taken")).select(
        "_key", F.filter(F.array_sort("_taken", order), lambda x, i: i % _PER_CHUNK == _PER_CHUNK - 1).alias("_bounds")
    )
    joined = keyed.join(materialize(bounds, "bounds"), "_key", "left")
    passed = F.size(F.filter("_bounds", lambda b: _before(b, place, fields, down)))
    chunk = F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(passed)
    return joined.withColumn("_grp", group_key(keys, chunk.alias("_chunk"))).drop("_key", "_bounds")
