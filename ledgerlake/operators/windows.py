"""Window operators that stay parallel when one key holds a large share of the rows.

Running values are computed inside (key, chunk of the order column); the chunk totals, one small row
per key and chunk, carry the offset from one chunk to the next. Totals over a whole key are a partial
aggregate joined back, so adaptive skew handling can split the hot side. Both read their input twice (rows
and totals): after an expensive step, store the rows first (``session.materialize``).

Chunks are of a fixed ``grain`` of the first order column, in one lazy plan, or, with ``rows_per_chunk``, cut at
quantiles of each key's rows: then rows without an order value and ties are divided too, the rows are stored first,
and columns of any order type will do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.chunks import ROW, by_quantiles, stored
from ledgerlake.operators.ordering import Names, ascending, descending, group_key, names


def chunk_of(df: DataFrame, order_col: str, grain: str | float) -> Column:
    """Coarse, order-preserving part of the order column: a date unit, or a step for numbers."""
    kind = df.schema[order_col].dataType
    col = F.col(order_col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_trunc(str(grain), col.cast("timestamp"))
    if isinstance(kind, T.NumericType):
        return F.floor(col / F.lit(float(grain)))
    raise TypeError(f"order column {order_col} must be a date, timestamp or number")


def _chunked(df: DataFrame, keys: Names, order_col: str, grain: str | float) -> DataFrame:
    return df.withColumn("_grp", group_key(keys, chunk_of(df, order_col, grain).alias("_chunk")))


def _chunk_window(keys: Names) -> W:
    return W.partitionBy(*[F.col(f"_grp.{k}") for k in names(keys)])


def running_sum(
    df: DataFrame,
    keys: Names,
    order_by: Sequence[str],
    value: str,
    out: str,
    grain: str | float = "month",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row (row frame, nulls last)."""
    if rows_per_chunk:
        rows = by_quantiles(stored(df), keys, order_by, rows_per_chunk)
        order_by = [*order_by, ROW]
    else:
        rows = _chunked(df, keys, order_by[0], grain)
    inside = W.partitionBy("_grp").orderBy(*ascending(order_by)).rowsBetween(W.unboundedPreceding, 0)
    before = (
        _chunk_window(keys)
        .orderBy(F.col("_grp._chunk").asc_nulls_last())
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy("_grp")
        .agg(F.sum(value).alias("_sum"))
        .select("_grp", F.sum("_sum").over(before).alias("_before"))
    )
    summed = rows.withColumn("_run", F.sum(value).over(inside))
    joined = summed.join(offsets, "_grp", "left")
    total = F.coalesce(F.col("_run") + F.col("_before"), F.col("_run"), F.col("_before"))
    return joined.withColumn(out, total).drop("_grp", "_run", "_before", ROW)


def row_numbers(
    df: DataFrame,
    keys: Names,
    order_by: Sequence[str],
    first: str | None = None,
    last: str | None = None,
    grain: str | float = "month",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Full row numbers per key, ascending (``first``) and / or descending (``last``), nulls last."""
    if rows_per_chunk:
        return _numbered_by_quantiles(stored(df), keys, order_by, first, last, rows_per_chunk).drop(ROW)
    rows = _chunked(df, keys, order_by[0], grain)
    counts = rows.groupBy("_grp").agg(F.count(F.lit(1)).alias("_n"))
    per_key = _chunk_window(keys)
    before = W.unboundedPreceding, -1
    up = per_key.orderBy(F.col("_grp._chunk").asc_nulls_last()).rowsBetween(*before)
    down = per_key.orderBy(F.col("_grp._chunk").desc_nulls_last()).rowsBetween(*before)
    offsets = counts.select(
        "_grp",
        F.coalesce(F.sum("_n").over(up), F.lit(0)).alias("_up"),
        F.coalesce(F.sum("_n").over(down), F.lit(0)).alias("_down"),
    )
    inside = W.partitionBy("_grp")
    numbered = rows
    if first:
        numbered = numbered.withColumn("_first", F.row_number().over(inside.orderBy(*ascending(order_by))))
    if last:
        numbered = numbered.withColumn("_last", F.row_number().over(inside.orderBy(*descending(order_by))))
    joined = numbered.join(offsets, "_grp", "left")
    if first:
        joined = joined.withColumn(first, F.col("_first") + F.col("_up"))
    if last:
        joined = joined.withColumn(last, F.col("_last") + F.col("_down"))
    return joined.drop("_grp", "_first", "_last", "_up", "_down")


def _numbered_by_quantiles(
    rows: DataFrame, keys: Names, order_by: Sequence[str], first: str | None, last: str | None, rows_per_chunk: int
) -> DataFrame:
    """Each direction has chunks of its own: with nulls last in both, neither is the other one reversed."""
    for out, down in ((first, False), (last, True)):
        if not out:
            continue
        cut = by_quantiles(rows, keys, order_by, rows_per_chunk, down)
        counts = cut.groupBy("_grp").agg(F.count(F.lit(1)).alias("_n"))
        before = _chunk_window(keys).orderBy("_grp._chunk").rowsBetween(W.unboundedPreceding, -1)
        offsets = counts.select("_grp", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        order = [*(descending if down else ascending)(order_by), F.col(ROW)]
        numbered = cut.withColumn("_inside", F.row_number().over(W.partitionBy("_grp").orderBy(*order)))
        joined = numbered.join(offsets, "_grp", "left").withColumn(out, F.col("_inside") + F.col("_before"))
        rows = joined.drop("_grp", "_inside", "_before")
    return rows


def rank_both(
    df: DataFrame, keys: Names, order_by: Sequence[str], grain: str | float = "month", rows_per_chunk: int | None = None
) -> DataFrame:
    """First and last rank side by side, as ``rn_first`` and ``rn``."""
    return row_numbers(df, keys, order_by, first="rn_first", last="rn", grain=grain, rows_per_chunk=rows_per_chunk)


def with_next(
    df: DataFrame,
    keys: Names,
    order_by: Sequence[str],
    columns: Mapping[str, str],
    grain: str | float = "month",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Values of the next row of the key: ``columns`` maps source column to output name."""
    if rows_per_chunk:
        rows = by_quantiles(stored(df), keys, order_by, rows_per_chunk)
        order_by = [*order_by, ROW]
    else:
        rows = _chunked(df, keys, order_by[0], grain)
    packed = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    inside = W.partitionBy("_grp").orderBy(*ascending(order_by))
    # the first row of every chunk is what the last row of the chunk before it needs
    heads = (
        rows.withColumn("_rn", F.row_number().over(inside))
        .filter(F.col("_rn") == 1)
        .select("_grp", packed.alias("_head"))
    )
    ordered = _chunk_window(keys).orderBy(F.col("_grp._chunk").asc_nulls_last())
    following = heads.select("_grp", F.lead("_head").over(ordered).alias("_following"))
    led = rows.withColumn("_next", F.lead(packed).over(inside))
    joined = led.join(following, "_grp", "left").withColumn("_next", F.coalesce("_next", "_following"))
    for i, out in enumerate(columns.values()):
        joined = joined.withColumn(out, F.col(f"_next.c{i}"))
    return joined.drop("_grp", "_next", "_following", ROW)


def with_group_totals(df: DataFrame, keys: Names, aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates over the whole key on every row (``agg() over (partition by key)``)."""
    rows = df.withColumn("_grp", group_key(keys))
    totals = rows.groupBy("_grp").agg(*[expr.alias(name) for name, expr in aggregates.items()])
    return rows.join(totals, "_grp", "left").drop("_grp")


def window_agg_if(
    df: DataFrame, keys: Names, specs: Mapping[str, tuple[str, Column, Column]]
) -> DataFrame:
    """Conditional totals per key: ``{out: (function name, condition, value)}`` in one aggregate."""
    return with_group_totals(
        df, keys, {out: getattr(F, fn)(F.when(cond, value)) for out, (fn, cond, value) in specs.items()}
    )


def any_over(df: DataFrame, keys: Names, flags: Mapping[str, Column]) -> DataFrame:
    """True on every row of a key when any of its rows meets the condition."""
    return with_group_totals(
        df, keys, {out: F.max(F.coalesce(cond, F.lit(False))) for out, cond in flags.items()}
    )


def with_group_max(df: DataFrame, keys: Names, columns: Mapping[str, str]) -> DataFrame:
    """Maximum over the key's whole history next to each row."""
    return with_group_totals(df, keys, {out: F.max(c) for c, out in columns.items()})


def first_value_by(
    df: DataFrame, keys: Names, order_by: str | Column, columns: Mapping[str, str], last: bool = False
) -> DataFrame:
    """Value held by the first (or last) row of the key in ``order_by``, on every row."""
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    pick = F.max_by if last else F.min_by
    return with_group_totals(df, keys, {out: pick(F.col(c), order) for c, out in columns.items()})


def with_global(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Whole-table aggregates on every row, as scalar subqueries instead of a one-partition window."""
    packed = df.agg(F.struct(*[e.alias(n) for n, e in aggregates.items()]).alias("g")).scalar()
    wide = df.withColumn("_g", packed)
    return wide.select("*", *[F.col(f"_g.{n}").alias(n) for n in aggregates]).drop("_g")


def latest_running_sum(
    df: DataFrame, keys: Names, order_by: Sequence[str], value: str, out: str
) -> DataFrame:
    """Last value of a running sum: the key's total, with the order columns of its last row."""
    cols = [F.col(c) for c in order_by]
    return (
        df.groupBy(*names(keys))
        .agg(F.sum(value).alias(out), F.max_by(F.struct(*cols), F.struct(*cols)).alias("_last"))
        .select(*names(keys), out, *[F.col(f"_last.{c}").alias(c) for c in order_by])
    )
