"""Date and timestamp expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ordering import as_col

# Timestamp texts accepted besides ISO-8601, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyyMMddHHmm",
    "MMM d, yyyy, hh:mm:ss a",
    "M/d/yyyy h:mm:ss a",
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
)

# Free-form date texts accepted for valuation dates.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd",
    "d/M/yyyy",
    "d-M-yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "yyyyMMdd",
)

# pattern letters -> the texts they can stand for, longest run first
_SHAPES = (
    ("yyyy", r"\d{4}"),
    ("MMMM", "[A-Za-z]+"),
    ("MMM", "[A-Za-z]{3,4}"),
    ("MM", r"\d{2}"),
    ("M", r"\d{1,2}"),
    ("dd", r"\d{2}"),
    ("d", r"\d{1,2}"),
    ("HH", r"\d{2}"),
    ("hh", r"\d{2}"),
    ("h", r"\d{1,2}"),
    ("mm", r"\d{2}"),
    ("ss", r"\d{2}"),
    ("a", "[AaPp][Mm]"),
)


def shape_of(pattern: str) -> str:
    """Regular expression of the texts a date pattern can parse, for the pattern letters used here."""
    out, rest = "^", pattern
    while rest:
        letters, found = next(((p, r) for p, r in _SHAPES if rest.startswith(p)), (rest[0], rest[0]))
        out += found
        rest = rest[len(letters) :]
    return out + "$"


def _parse_shaped(text: Column, formats: Sequence[str]) -> list[Column]:
    # a parser only sees texts of its shape: a failed parse costs far more than the match
    return [F.when(text.rlike(shape_of(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats]


def iso_ts(col: str | Column) -> Column:
    """ISO-8601 text (``yyyy-MM-dd`` with or without time and offset) to timestamp; other texts give null."""
    text = as_col(col)
    # two cheap looks at the dashes keep other shapes away from the parser, whose failures are slow
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(dashes, text).try_cast("timestamp")


def parse_ts_multi(
    col: str | Column, formats: Sequence[str] = TIMESTAMP_FORMATS, on_fail: str = "error"
) -> Column:
    """First format that fits, ISO-8601 first. ``on_fail`` is ``error`` or ``null``."""
    text = as_col(col).cast("string")
    parsed = F.coalesce(iso_ts(text), *_parse_shaped(text, formats))
    if on_fail == "null":
        return parsed
    message = F.concat(F.lit("no timestamp format fits: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message).cast("timestamp")).otherwise(
        parsed
    )


def parse_date_guarded(
    col: str | Column, formats: Sequence[str] = DATE_FORMATS, years: tuple[int, int] = (1900, 2100)
) -> Column:
    """Free-form date text to ``yyyy-MM-dd``; years outside the range and junk give null."""
    text = F.trim(as_col(col))
    parsed = F.coalesce(iso_ts(text), *_parse_shaped(text, formats))
    return F.when(F.year(parsed).between(*years), F.date_format(parsed, "yyyy-MM-dd"))


def fill_millis(col: str | Column) -> Column:
    """Append ``.000000`` to ISO text that stops at seconds."""
    text = as_col(col)
    return F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), F.concat(text, F.lit(".000000"))
    ).otherwise(text)


def epoch_to_ts(col: str | Column, unit: str = "ms") -> Column:
    """Epoch seconds (``s``) or milliseconds (``ms``), number or text, to timestamp."""
    number = as_col(col).cast("bigint")
    return F.timestamp_millis(number) if unit == "ms" else F.timestamp_seconds(number)


def local_to_utc(col: str | Column, tz: str = "Europe/London") -> Column:
    """Wall-clock time to UTC; a repeated hour counts as summer time."""
    return F.to_utc_timestamp(as_col(col), tz)


def compact_to_day(col: str | Column) -> Column:
    """``yyyyMMdd...`` text to ``yyyy-MM-dd``."""
    text = as_col(col)
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))


def report_date(col: str | Column, pattern: str = "dd/MM/yyyy hh:mm:ss a") -> Column:
    return F.date_format(as_col(col), pattern)


def months_between(start: str | Column, end: str | Column) -> Column:
    """Whole months from ``start`` to ``end``."""
    return F.timestamp_diff("MONTH", as_col(start), as_col(end))


def add_days(col: str | Column, days: int) -> Column:
    """Days added with the time of day kept."""
    return as_col(col) + F.expr(f"INTERVAL {int(days)} DAY")


def date_parts(df: DataFrame, col: str) -> DataFrame:
    """Day, month, quarter and year of a date column."""
    return df.withColumns(
        {
            "day": F.dayofmonth(col),
            "month": F.month(col),
            "quarter": F.quarter(col),
            "year": F.year(col),
        }
    )


def with_ymd(df: DataFrame, col: str | Column | dt.date) -> DataFrame:
    """Partition columns ``year``, ``month``, ``day`` from a column or a fixed day."""
    day = F.lit(col) if isinstance(col, dt.date) else as_col(col)
    return df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def with_run_date(df: DataFrame, today: dt.date, pattern: str = "yyyyMMdd") -> DataFrame:
    """Run date of a published dataset as text."""
    return df.withColumn("job_run_date", F.date_format(F.lit(today), pattern))
