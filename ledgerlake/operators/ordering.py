"""Sort keys with explicit null placement (nulls last in both directions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Names = str | Sequence[str]


def names(value: Names) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def descending(keys: str | Column | Iterable[str | Column]) -> list[Column]:
    items = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return [as_col(k).desc_nulls_last() for k in items]


def ascending(keys: str | Column | Iterable[str | Column]) -> list[Column]:
    items = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return [as_col(k).asc_nulls_last() for k in items]


def group_key(keys: Names, *more: Column) -> Column:
    """All key columns as one struct.

    Spark compares structs field by field with null equal to null, so an equality join on this
    column keeps rows whose key is null, and a window and a join on it share one shuffle.
    """
    return F.struct(*[F.col(k) for k in names(keys)], *more)


def join_group_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join two frames that both carry the ``_grp`` struct, then drop it."""
    return left.join(right, "_grp", how).drop("_grp")
