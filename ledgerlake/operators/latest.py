"""Latest / first row per key over append-only change history.

Every ranking is written as ``row_number() <= n``: Spark then puts a group limit in front of the
shuffle, so each map task sends at most ``n`` rows per key and a hot key stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import Names, ascending, descending, names

_RN = "_rn"


def _ranked(df: DataFrame, keys: Names, order: list[Column], n: int) -> DataFrame:
    window = W.partitionBy(*[F.col(k) for k in names(keys)]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) <= n).drop(_RN)


def date_floor(col: str | Column, floor: str = "1900-01-01 00:00:00") -> Column:
    """Sort value of a date text or date column: missing and blank dates rank lowest."""
    text = F.col(col).cast("string") if isinstance(col, str) else col.cast("string")
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(floor))


def latest_per_key(
    df: DataFrame,
    keys: Names,
    order_by: str | Column | Sequence[str | Column],
    n: int = 1,
    floored: Sequence[str] = (),
) -> DataFrame:
    """Keep the ``n`` highest rows per key; columns in ``floored`` use :func:`date_floor` as sort value."""
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    order = [date_floor(k) if isinstance(k, str) and k in floored else k for k in items]
    return _ranked(df, keys, descending(order), n)


def first_per_key(
    df: DataFrame, keys: Names, order_by: str | Column | Sequence[str | Column], n: int = 1
) -> DataFrame:
    """Keep the ``n`` lowest rows per key, nulls last."""
    return _ranked(df, keys, ascending(order_by), n)


def first_of_first(df: DataFrame, inner: Names, outer: Names, order_by: Sequence[str | Column]) -> DataFrame:
    """First row per ``inner`` key, then the first of those per ``outer`` key."""
    return first_per_key(first_per_key(df, inner, order_by), outer, order_by)


def drop_duplicates_by(df: DataFrame, keys: Names, order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key with a stated survivor: the lowest in ``order_by``."""
    return first_per_key(df, keys, order_by)


def dedupe_events(df: DataFrame, identity: Names, order_by: Sequence[str | Column]) -> DataFrame:
    """One row per event identity, the latest one."""
    return latest_per_key(df, identity, order_by)


def latest_extract(
    df: DataFrame, key: Names, extracted_at: str = "timestamp_extracted", ties: Sequence[str | Column] = ()
) -> DataFrame:
    """Row of the latest extract per id."""
    return latest_per_key(df, key, [extracted_at, *ties])


def latest_group(
    df: DataFrame, part: Names, keys: Names, ts: str | Column, out: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """Group by ``part + keys`` with the maximum of ``ts``, then keep the latest group per ``part``."""
    grouped = df.groupBy(*names(part), *names(keys)).agg(
        F.max(F.col(ts) if isinstance(ts, str) else ts).alias(out)
    )
    return latest_per_key(grouped, part, [out, *ties])


def last_with_attr(
    df: DataFrame, key: Names, ts: str, attr: str, out: str, ties: Sequence[str | Column] = ()
) -> DataFrame:
    """Maximum of ``ts`` per key together with another attribute of that row."""
    rows = latest_per_key(df.filter(F.col(ts).isNotNull()), key, [ts, *ties])
    return rows.select(*names(key), F.col(attr), F.col(ts).alias(out))
