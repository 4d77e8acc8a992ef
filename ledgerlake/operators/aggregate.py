"""Grouped aggregation and fixed pivots."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import Names, as_col, names
from ledgerlake.operators.windows import row_numbers


def agg_if(fn: Callable[[Column], Column], cond: Column, value: str | Column, default=None) -> Column:
    """Aggregate of ``value`` over rows that meet ``cond``."""
    case = F.when(cond, as_col(value))
    return fn(case if default is None else case.otherwise(F.lit(default)))


def pivot_fixed(
    df: DataFrame,
    keys: Names,
    col: str,
    values: Mapping[str, str],
    measures: Mapping[str, Column],
    other: str | None = None,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Columns ``<label>_<measure>`` holding the maximum per listed value.

    ``values`` maps the value of ``col`` to its label; rows with any other non-null value go to the
    ``other`` label; ``more`` adds plain aggregates. One grouped aggregate, no dynamic pivot pass.
    """
    listed = F.col(col).isin(list(values))
    buckets = [(label, F.col(col) == value) for value, label in values.items()]
    if other:
        buckets.append((other, ~listed))
    exprs = [
        F.max(F.when(cond, expr)).alias(f"{label}_{measure}")
        for label, cond in buckets
        for measure, expr in measures.items()
    ]
    extra = [expr.alias(name) for name, expr in (more or {}).items()]
    return df.groupBy(*names(keys)).agg(*exprs, *extra)


def pivot_to_row(df: DataFrame, spec: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Whole table to one row: ``{out: (condition, value)}`` with the maximum of matching values."""
    return df.agg(*[F.max(F.when(cond, value)).alias(out) for out, (cond, value) in spec.items()])


def pivot_sum(
    df: DataFrame, keys: Names, conditions: Mapping[str, Column], amount: str | Column
) -> DataFrame:
    """Sum of ``amount`` per key in one column per named condition."""
    return df.groupBy(*names(keys)).agg(
        *[F.sum(F.when(cond, as_col(amount))).alias(out) for out, cond in conditions.items()]
    )


def pivot_max_date(
    df: DataFrame, keys: Names, conditions: Mapping[str, Column], date: str | Column
) -> DataFrame:
    """Latest date per key in one column per named condition, in a single aggregate."""
    return df.groupBy(*names(keys)).agg(
        *[F.max(F.when(cond, as_col(date))).alias(out) for out, cond in conditions.items()]
    )


def string_agg_ordered(
    df: DataFrame, keys: Names, col: str, out: str, sep: str = ", ", desc: bool = True, distinct: bool = False
) -> DataFrame:
    """Values of ``col`` joined in order.

    Repeats are counted before the shuffle and expanded inside the final string, so a group costs one
    row per different value.
    """
    counted = df.filter(F.col(col).isNotNull()).groupBy(*names(keys), col).agg(
        F.count(F.lit(1)).cast("int").alias("_n")
    )
    pairs = F.sort_array(F.collect_list(F.struct(F.col(col).alias("v"), F.col("_n").alias("n"))), asc=not desc)
    repeated = F.flatten(
        F.transform("_p", lambda p: F.array_repeat(p["v"], F.lit(1) if distinct else p["n"]))
    )
    return (
        counted.groupBy(*names(keys))
        .agg(pairs.alias("_p"))
        .select(*names(keys), F.array_join(repeated, sep).alias(out))
    )


def map_agg(
    df: DataFrame, keys: Names, k: str, v: str, out: str, fn: Callable[[Column], Column] = F.max
) -> DataFrame:
    """Map of ``k`` to the aggregate of ``v`` per key; values are reduced per (key, k) first."""
    reduced = df.filter(F.col(k).isNotNull()).groupBy(*names(keys), k).agg(fn(F.col(v)).alias("_v"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.col(k), F.col("_v"))))
    return reduced.groupBy(*names(keys)).agg(entries.alias(out))


def wide_from_map(df: DataFrame, col: str, entries: Mapping[str, str]) -> DataFrame:
    """Map entries as columns; a missing key gives null."""
    return df.select("*", *[F.col(col)[k].alias(out) for k, out in entries.items()]).drop(col)


def collapse_max(df: DataFrame, key: Names, minimum: Sequence[str] = ()) -> DataFrame:
    """One row per key with the maximum of every other column (minimum for those listed)."""
    rest = [c for c in df.columns if c not in names(key)]
    return df.groupBy(*names(key)).agg(
        *[(F.min(c) if c in minimum else F.max(c)).alias(c) for c in rest]
    )


def hourly_sum(df: DataFrame, ts: str, keys: Names, value: str, out: str, hour: str = "hour") -> DataFrame:
    """Measure per key and hour, ascending by the measure."""
    grouped = df.groupBy(*names(keys), F.date_trunc("hour", F.col(ts)).alias(hour)).agg(
        F.sum(value).alias(out)
    )
    return grouped.orderBy(F.col(out).asc_nulls_last(), *names(keys), hour)


def activity_report(
    df: DataFrame,
    dimensions: Mapping[str, Column],
    user: str,
    session: Column,
    ts: str,
    start: str,
    end: str,
) -> DataFrame:
    """Events, users and sessions per dimension tuple between two dates (inclusive).

    Distinct counts run over pre-aggregated (dimension, user) and (dimension, session) pairs.
    """
    days = F.to_date(F.col(ts)).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows = df.filter(days).select(
        *[c.alias(n) for n, c in dimensions.items()], F.col(user).alias("_u"), session.alias("_s")
    )
    return rows.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.countDistinct("_u").alias("total_users"),
        F.countDistinct("_s").alias("sessions"),
    )


def nest_children(
    parent: DataFrame,
    child: DataFrame,
    on: Names,
    columns: Sequence[str],
    order_by: Sequence[str],
    out: str = "records",
    page_size: int = 2000,
    grain: str | float = 1000.0,
) -> DataFrame:
    """Parent rows with their child rows as a sorted array, in pages of ``page_size`` children.

    A parent with more children than one page continues on further rows (``page`` 1, 2, ...), so no
    single row or task has to hold a hot parent; nothing is dropped.
    """
    keys = names(on)
    numbered = row_numbers(child, keys, order_by, first="_rn", grain=grain)
    paged = numbered.withColumn("page", F.floor((F.col("_rn") - 1) / page_size).cast("int"))
    item = F.struct(F.col("_rn"), *[F.col(c) for c in columns])
    pages = paged.groupBy(*keys, "page").agg(F.sort_array(F.collect_list(item)).alias(out))
    cleaned = pages.withColumn(
        out, F.transform(out, lambda x: F.struct(*[x[c].alias(c) for c in columns]))
    )
    lonely = parent.join(child.select(*keys).distinct(), keys, "left_anti")
    return parent.join(cleaned, keys, "inner").unionByName(
        lonely.withColumn("page", F.lit(0)), allowMissingColumns=True
    )


def report_order(df: DataFrame, by: Sequence[Column], ties: Sequence[str]) -> DataFrame:
    """Report sort; the unique tie-break lets range partitioning split a repeated sort value."""
    return df.orderBy(*by, *ties)
