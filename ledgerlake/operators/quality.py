"""Reconciliation and table checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.dates import date_parts
from ledgerlake.operators.joins import full_compare
from ledgerlake.operators.ordering import Names, names


def _counts(df: DataFrame, keys: Names, id_col: str) -> DataFrame:
    return df.groupBy(*names(keys)).agg(F.count(id_col).alias("id_count"))


def reconcile_counts(
    source: DataFrame,
    lake: DataFrame,
    keys: Names,
    id_col: str = "id",
    rename: Mapping[str, str] | None = None,
    suffixes: tuple[str, str] = ("_source", "_lake"),
) -> DataFrame:
    """Row counts per group on both sides, a match flag per group and one verdict for the whole run.

    A group found on one side only counts as a mismatch. ``rename`` maps source column names first.
    """
    for old, new in (rename or {}).items():
        source = source.withColumnRenamed(old, new)
    both = full_compare(_counts(source, keys, id_col), _counts(lake, keys, id_col), keys, suffixes)
    left, right = f"id_count{suffixes[0]}", f"id_count{suffixes[1]}"
    marked = both.withColumn("match", F.coalesce(F.col(left) == F.col(right), F.lit(False)))
    return with_global_match(marked, "match", "all_match")


def with_global_match(df: DataFrame, flag: str, out: str = "all_match") -> DataFrame:
    """The conjunction of a flag over the whole frame as a column."""
    return df.withColumn(out, df.agg(F.coalesce(F.bool_and(flag), F.lit(True))).scalar())


def date_profile(df: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    """Selected columns with day, month, quarter and year of a date column."""
    return date_parts(df.select(*keep, col), col)


def _hashable(col: Column, kind: T.DataType) -> list[Column]:
    """Columns that hash by content: maps as sorted entries, and a flag beside each value, as a null leaves a hash as it is."""
    if isinstance(kind, T.MapType):
        pair = lambda x: F.struct(x["key"], *_hashable(x["value"], kind.valueType))
        value = F.transform(F.array_sort(F.map_entries(col)), pair)
    elif isinstance(kind, T.ArrayType):
        value = F.transform(col, lambda x: F.struct(*_hashable(x, kind.elementType)))
    elif isinstance(kind, T.StructType):
        value = F.struct(*[c for f in kind.fields for c in _hashable(col[f.name], f.dataType)])
    else:
        value = col
    return [value, col.isNull()]


def fingerprint(df: DataFrame, as_text: Sequence[str] = ()) -> DataFrame:
    """One row that tells contents apart: number of rows and two sums of row hashes.

    The order of rows and columns, and the case of column names, do not count; repeated rows do. Columns in
    ``as_text`` (trimmed, lower case) are compared as text.
    """
    fields = sorted(df.schema.fields, key=lambda f: f.name.strip().lower())
    cells = []
    for f in fields:
        col = F.col(f"`{f.name}`")
        text = f.name.strip().lower() in as_text
        cells += _hashable(col.cast("string"), T.StringType()) if text else _hashable(col, f.dataType)
    number = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        number(F.xxhash64(*cells) if cells else F.lit(0)).alias("sum_a"),
        number(F.xxhash64(F.lit("second"), *cells)).alias("sum_b"),
    )


def same_contents(a: DataFrame, b: DataFrame) -> tuple[bool, tuple[int, int]]:
    """Whether two frames hold the same rows in any order, and their numbers of rows; one aggregate a side.

    Columns whose types differ are compared as text.
    """
    kinds = [{f.name.strip().lower(): f.dataType for f in df.schema.fields} for df in (a, b)]
    differ = [c for c in kinds[0] if c in kinds[1] and kinds[0][c] != kinds[1][c]]
    one, two = (fingerprint(df, differ).first() for df in (a, b))
    return kinds[0].keys() == kinds[1].keys() and one == two, (one["rows"], two["rows"])


def with_equal_contents(df: DataFrame, other: DataFrame, out: str = "all_match") -> DataFrame:
    """The verdict whether ``df`` holds the same rows as ``other`` as a column."""
    return df.withColumn(out, F.lit(same_contents(df, other)[0]))


def validate_copy(a: DataFrame, b: DataFrame) -> dict[str, object]:
    """Row counts, column sets (trimmed, lower case) and contents of a copied table."""
    def columns(df: DataFrame) -> list[str]:
        return sorted(c.strip().lower() for c in df.columns)

    contents, rows = same_contents(a, b)
    same = rows[0] == rows[1] and columns(a) == columns(b) and contents
    return {"ok": same, "rows": rows, "columns": (columns(a), columns(b)), "contents": contents}


def check_partitions(df: DataFrame, columns: Sequence[str]) -> None:
    """Partition columns must exist and hold no nulls; one aggregate for all of them."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing partition columns: {absent}")
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise ValueError(f"partition columns contain nulls: {bad}")
