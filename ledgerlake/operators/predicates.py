"""Filter helpers."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import as_col


def matches_any(col: str | Column, literals: Sequence[str]) -> Column:
    """True when the text contains any of the literals (literals are escaped)."""
    return as_col(col).rlike("|".join(re.escape(x) for x in literals))


def not_blank(col: str | Column) -> Column:
    return as_col(col).isNotNull() & (as_col(col) != "")


def last_n_days(df: DataFrame, col: str, n: int, today: dt.date) -> DataFrame:
    """Rows from ``today - n`` days on; compares the stored column so the filter reaches the scan."""
    floor = dt.datetime.combine(today - dt.timedelta(days=n), dt.time())
    return df.filter(F.col(col) >= _boundary(df, col, floor))


def since(df: DataFrame, col: str, day: dt.date) -> DataFrame:
    """Rows on or after a fixed date."""
    return df.filter(F.col(col) >= _boundary(df, col, dt.datetime.combine(day, dt.time())))


def _boundary(df: DataFrame, col: str, moment: dt.datetime) -> Column:
    kind = df.schema[col].dataType.simpleString()
    if kind == "string":
        return F.lit(moment.strftime("%Y-%m-%d"))
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast(kind)


def latest_snapshot(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the newest extract: ``ts = (select max(ts) ...)``."""
    return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).dropna()


def select_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns to exclude are not present: {missing}")
    return df.drop(*columns)


def replace_columns(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Computed values take over the columns of the same name and lead the output."""
    rest = [c for c in df.columns if c not in values]
    return df.select(*[expr.alias(name) for name, expr in values.items()], *rest)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])
