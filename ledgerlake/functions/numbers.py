"""Money, parsing and classification expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import as_col

# Conversion rates to GBP.
GBP_RATES = {"USD": "0.80", "EUR": "0.86", "AED": "0.22", "KWD": "2.65", "SAR": "0.22"}


# texts a number can be read from; anything else is not worth a failed cast, which raises inside
_NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def try_number(col: str | Column, kind: str) -> Column:
    """Number from text, null when the text is no number of that kind."""
    text = as_col(col)
    shape = _WHOLE if kind in ("int", "bigint") else _NUMERIC
    return F.when(text.rlike(shape), text).try_cast(kind)


def money(col: str | Column, scale: int = 3) -> Column:
    return as_col(col).cast(f"decimal(18,{scale})")


def to_gbp(amount: str | Column, currency: str | Column) -> Column:
    """Decimal amount times the fixed rate of its currency; other currencies pass through."""
    value = money(amount)
    case = None
    for code, rate in GBP_RATES.items():
        converted = value * F.lit(rate).cast("decimal(3,2)")
        hit = as_col(currency) == code
        case = F.when(hit, converted) if case is None else case.when(hit, converted)
    return case.otherwise(value).cast("decimal(24,5)")


def midpoint(low: Column, high: Column, scale: int = 3) -> Column:
    """Half of the sum, at a stated scale (division scale differs between engines)."""
    return ((low + high) / F.lit(2)).cast(f"decimal(18,{scale})")


def null_safe_sum(*cols: str | Column) -> Column:
    """Sum of parts where a missing part counts as zero."""
    total = None
    for c in cols:
        part = F.coalesce(as_col(c), F.lit(0))
        total = part if total is None else total + part
    return total


def greatest_case(first: Column, second: Column, third: Column) -> Column:
    """Largest of three as a comparison chain: a null makes the comparison fail, not the value."""
    return (
        F.when((first >= second) & (first >= third), first)
        .when((second >= first) & (second >= third), second)
        .otherwise(third)
    )


def band(col: str | Column, upper_bounds: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first band whose inclusive upper bound holds the value; null stays null."""
    value = as_col(col)
    case = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in upper_bounds:
        case = case.when(value <= bound, F.lit(label))
    return case.otherwise(F.lit(above))


def lookup(col: str | Column, table: Mapping[str, int]) -> Column:
    """Value of a code in a small literal table, null when the code is not listed."""
    entries = ", ".join(f"'{code}', {value}" for code, value in table.items())
    return F.try_element_at(F.expr(f"map({entries})"), as_col(col))


def parse_currency(col: str | Column) -> Column:
    """Number left after removing everything but digits and dots; null when that is not a number."""
    digits = F.regexp_replace(as_col(col), r"[^\d.]", "")
    return try_number(digits, "double")


def safe_int(col: str | Column) -> Column:
    """Whole number from text; blank, ``nan`` and junk give null."""
    return try_number(col, "int")


def parse_bool(col: str | Column) -> Column:
    """``True`` / ``False`` text to boolean; anything else is null."""
    return F.when(as_col(col) == "True", F.lit(True)).when(as_col(col) == "False", F.lit(False))
