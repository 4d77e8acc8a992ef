"""Join forms the reports are built from. Strategy is left to Catalyst and AQE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.latest import latest_per_key
from ledgerlake.operators.ordering import Names, group_key, names


def join_required(left: DataFrame, right: DataFrame, on: Names) -> DataFrame:
    """Left join whose unmatched rows are dropped: an inner join."""
    return left.join(right, names(on), "inner")


def left_join_many(left: DataFrame, right: DataFrame, on: Names) -> DataFrame:
    """Left join to a fact-like right side that may hold a hot key.

    AQE can split a hot right side of an inner join but not of an outer one, so the join is written
    as matched rows plus the left rows without a partner.
    """
    keys = names(on)
    matched = left.join(right, keys, "inner")
    lonely = left.join(right.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def right_join_many(left: DataFrame, right: DataFrame, on: Names) -> DataFrame:
    """Right join whose left side is fact-like; see :func:`left_join_many`."""
    return left_join_many(right, left, on)


def full_compare(
    left: DataFrame, right: DataFrame, keys: Names, suffixes: tuple[str, str] = ("_left", "_right")
) -> DataFrame:
    """Full outer join on unique keys; other columns get a side suffix. Null keys match each other."""
    key_names = names(keys)
    l_suffix, r_suffix = suffixes

    def side(df: DataFrame, suffix: str) -> DataFrame:
        rest = [c for c in df.columns if c not in key_names]
        return df.select(group_key(key_names).alias("_grp"), *[F.col(c).alias(c + suffix) for c in rest])

    joined = side(left, l_suffix).join(side(right, r_suffix), "_grp", "full_outer")
    return joined.select(*[F.col(f"_grp.{k}").alias(k) for k in key_names], "*").drop("_grp")


def join_latest(
    left: DataFrame, right: DataFrame, on: Names, order_by: Sequence[str | Column], how: str = "left"
) -> DataFrame:
    """Join to the latest right row per key; the right side is reduced before the join."""
    return left.join(latest_per_key(right, on, order_by), names(on), how)


def join_distinct(
    left: DataFrame, right: DataFrame, columns: Sequence[str], on: Names, how: str = "inner"
) -> DataFrame:
    """Join to the distinct projection of a dimension."""
    return left.join(right.select(*columns).distinct(), names(on), how)


def left_join_all(base: DataFrame, parts: Sequence[DataFrame], on: Names) -> DataFrame:
    """Report assembly: left joins of one-row-per-key parts on the same key."""
    return reduce(lambda df, part: df.join(part, names(on), "left"), parts, base)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a relation of at most one row, on every row of ``df``; more than one row is an error."""
    packed = one_row.select(F.struct(*one_row.columns).alias("r")).scalar()
    return (
        df.withColumn("_row", packed)
        .select("*", *[F.col(f"_row.{c}").alias(c) for c in one_row.columns])
        .drop("_row")
    )


def attach_scalar(df: DataFrame, sub: DataFrame, name: str) -> DataFrame:
    """A one-column, one-row query as a column; more than one row is an error."""
    return df.withColumn(name, sub.scalar())


def keep_matching(df: DataFrame, keys: DataFrame, on: Names) -> DataFrame:
    """Rows whose key occurs in ``keys`` (``IN (SELECT ...)``)."""
    return df.join(keys.select(*names(on)).distinct(), names(on), "left_semi")


def exclude_keys(df: DataFrame, keys: DataFrame, col: str, key_col: str | None = None) -> DataFrame:
    """SQL ``col NOT IN (SELECT key_col ...)`` without broadcasting the subquery.

    A null in the subquery empties the result; a null probe is kept only when the subquery is empty.
    """
    listed = keys.select(F.col(key_col or col).alias(col))
    facts = listed.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(col).isNull()).alias("n_null")
        ).alias("f")
    ).scalar()
    known = listed.filter(F.col(col).isNotNull()).distinct()
    kept = df.join(known, col, "left_anti").withColumn("_f", facts)
    return kept.filter(
        (F.col("_f.n_null") == 0) & (F.col(col).isNotNull() | (F.col("_f.n") == 0))
    ).drop("_f")


def without_keys(df: DataFrame, keys: DataFrame, on: Names) -> DataFrame:
    """Rows whose key does not occur in ``keys``; nulls never match and are kept."""
    return df.join(keys.select(*names(on)).distinct(), names(on), "left_anti")


def explode_columns(df: DataFrame, columns: Sequence[str], name: str, keep: Sequence[str]) -> DataFrame:
    """One row per listed column, null elements kept."""
    return df.select(*keep, F.explode(F.array(*[F.col(c) for c in columns])).alias(name))


def bridge(
    customers: DataFrame,
    clients: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    links: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Customer -> client -> account -> transaction, one join per link.

    ``links`` gives the column pairs for ``client`` (customer, client), ``account`` (client, account)
    and ``transaction`` (account, transaction).
    """
    cc, ca, at = links["client"], links["account"], links["transaction"]
    joined = customers.join(clients, customers[cc[0]] == clients[cc[1]], "left")
    joined = joined.join(accounts, clients[ca[0]] == accounts[ca[1]], "left")
    return joined.join(transactions, accounts[at[0]] == transactions[at[1]], "inner")
