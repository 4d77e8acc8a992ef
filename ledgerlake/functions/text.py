"""Text expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.ordering import as_col

# Texts that stand for a missing value.
NULL_MARKERS = ("", "<NA>", "nan", "None")

# Arabic script blocks.
ARABIC = "[\\u0600-\\u06FF\\u0750-\\u077F\\u08A0-\\u08FF\\uFB50-\\uFDFF\\uFE70-\\uFEFF]"

# Fixed value: accepted e-mail shape.
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"


def clean_null(
    col: str | Column, markers: Sequence[str] = NULL_MARKERS, default: str | None = None
) -> Column:
    """Trimmed text with the null markers turned into null, or into ``default``."""
    trimmed = F.trim(as_col(col))
    cleaned = F.when(~trimmed.isin(list(markers)), trimmed)
    return cleaned if default is None else F.coalesce(cleaned, F.lit(default))


def blank_to(col: str | Column, label: str) -> Column:
    """Empty text becomes ``label``; null stays null."""
    return F.when(as_col(col) == "", F.lit(label)).otherwise(as_col(col))


def replace_blank(col: str | Column, label: str = "Unknown") -> Column:
    """Empty or null text becomes ``label``."""
    return F.coalesce(blank_to(col, label), F.lit(label))


def part_of(col: str | Column, sep: str, position: int) -> Column:
    """The ``position``-th piece (from 1) of split text; null when there are fewer pieces."""
    return F.try_element_at(F.split(as_col(col), re.escape(sep)), F.lit(position))


def contains_arabic(col: str | Column) -> Column:
    return as_col(col).rlike(ARABIC)


def valid_email_or_blank(col: str | Column) -> Column:
    text = as_col(col)
    good = text.rlike(EMAIL) & (F.lower(text) != "none")
    return F.when(F.coalesce(good, F.lit(False)), text).otherwise(F.lit(""))


def _clean_leaf(col: Column) -> Column:
    # one pass per replacement, in order: a double blank is halved once, not until none is left
    for found in ("\n", "\r", "\t", "  "):
        col = F.replace(col, F.lit(found), F.lit(" "))
    return col


def _clean_value(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return _clean_leaf(col)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _clean_value(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_clean_value(col[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda _, v: _clean_value(v, kind.valueType))
    return col


def clean_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Line breaks, tabs and double blanks become one blank, also inside arrays, structs and maps."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    wanted = kinds if columns is None else columns
    return df.withColumns({c: _clean_value(F.col(c), kinds[c]) for c in wanted})


def snake_case(name: str) -> str:
    return re.sub(r"(?<!^)([A-Z]+)", r"_\1", name).lower()


def ascii_name(name: str) -> str:
    """Lower-case ASCII name: accents stripped, runs of other characters become one underscore."""
    base = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return "_".join(re.findall(r"[0-9A-Za-z]+", base)).lower() or "col"
