"""Schema conforming: declared types, name clean-up, flattening, ingest metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.dates import (
    compact_to_day,
    iso_ts,
    local_to_utc,
    parse_date_guarded,
    parse_ts_multi,
    with_ymd,
)
from ledgerlake.functions.numbers import parse_currency, safe_int, try_number
from ledgerlake.functions.text import ascii_name, clean_null, snake_case, valid_email_or_blank

# Declared type names and their Spark types; anything else is text.
TYPE_NAMES = {
    "string": "string",
    "int": "int",
    "bigint": "bigint",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}


def spark_type(name: str) -> str:
    return TYPE_NAMES.get(name.lower(), "string")


def _to_boolean(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.lower(F.trim(F.col(name)))
        return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)
    return F.col(name).cast("boolean")


def _number_or_cast(df: DataFrame, name: str, target: str) -> Column:
    if target in ("int", "bigint", "double", "float") and isinstance(df.schema[name].dataType, T.StringType):
        return try_number(name, target)
    return F.col(name).try_cast(target)


def _convert(df: DataFrame, name: str, target: str) -> Column:
    source = df.schema[name].dataType
    if target == "boolean":
        return _to_boolean(df, name)
    if target in ("timestamp", "date") and isinstance(source, T.StringType):
        return parse_ts_multi(name, on_fail="null").cast(target)
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target)
    return _number_or_cast(df, name, target)


def select_schema(
    df: DataFrame, schema: Mapping[str, str], add_partition: bool = True, today: dt.date | None = None
) -> DataFrame:
    """Exactly the declared columns, in order and typed; absent ones are null. Optional load-day columns."""
    conformed = df.select(
        *[
            (
                _convert(df, name, spark_type(kind))
                if name in df.columns
                else F.lit(None).cast(spark_type(kind))
            ).alias(name)
            for name, kind in schema.items()
        ]
    )
    return with_ymd(conformed, today or dt.date.today()) if add_partition else conformed


def apply_schema(
    df: DataFrame, schema: Mapping[str, str], numeric_fill: int | None = 0, on_bad_ts: str = "error"
) -> DataFrame:
    """Lower-case names and cast the declared columns; other columns stay as they are.

    A number that does not parse becomes ``numeric_fill``; a column named ``date`` keeps its text.
    """
    lowered = df.toDF(*[c.lower() for c in df.columns])
    types = {k.lower(): spark_type(v) for k, v in schema.items()}

    def typed(name: str) -> Column:
        target = types[name]
        source = lowered.schema[name].dataType
        if target in ("timestamp", "date") and name != "date":
            if isinstance(source, T.StringType):
                return parse_ts_multi(name, on_fail=on_bad_ts).cast(target)
            return F.col(name).cast(target)
        if target in ("int", "bigint", "double", "float"):
            number = _number_or_cast(lowered, name, target)
            return number if numeric_fill is None else F.coalesce(number, F.lit(numeric_fill).cast(target))
        if target == "boolean":
            return _to_boolean(lowered, name)
        return F.col(name).cast("string")

    return lowered.select(
        *[typed(c).alias(c) if c in types else F.col(c) for c in lowered.columns]
    )


def cast_null_columns(df: DataFrame, target: str = "string") -> DataFrame:
    """Columns without a type (all null) become text; decided from the schema, no data pass."""
    return df.select(
        *[
            F.col(f.name).cast(target).alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def infer_schema(df: DataFrame) -> dict[str, str]:
    """Declared type of each text column from its values, in one aggregate over the whole table.

    The table is turned into (column, value) rows that are counted per column before the shuffle, so the
    work per row does not grow into one oversized expression.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("text")) for c in df.columns]
    )
    tall = df.select(F.explode(pairs).alias("p")).select(
        F.col("p.name").alias("name"), clean_null("p.text", markers=("", "None")).alias("text")
    )
    parsed = tall.filter(F.col("text").isNotNull()).select(
        "name",
        try_number("text", "bigint").alias("whole"),
        try_number("text", "double").alias("real"),
        F.lower("text").isin("true", "false").alias("logical"),
        F.when(F.col("text").rlike(r"\d"), parse_ts_multi("text", on_fail="null")).alias("moment"),
    )
    rows = parsed.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("whole").alias("whole"),
        F.max("whole").alias("top"),
        F.count("real").alias("real"),
        F.count_if("logical").alias("logical"),
        F.count("moment").alias("moment"),
        F.count_if(F.col("moment") == F.date_trunc("day", "moment")).alias("midnight"),
    )
    facts = {r["name"]: r for r in rows.collect()}  # one row per column

    def decide(name: str) -> str:
        f = facts.get(name)
        if f is None:
            return "string"
        dated = "date" in name.lower()
        if not dated and f["whole"] == f["n"]:
            return "bigint" if f["top"] > 2**31 - 1 else "int"
        if not dated and f["real"] == f["n"]:
            return "double"
        if not dated and f["logical"] == f["n"]:
            return "boolean"
        if f["moment"] == f["n"] and name != "date":
            return "date" if f["midnight"] == f["n"] else "timestamp"
        return "string"

    return {name: decide(name) for name in df.columns}


def _rename(df: DataFrame, new_names: Sequence[str]) -> DataFrame:
    repeated = {n for n in new_names if list(new_names).count(n) > 1}
    if repeated:
        raise ValueError(f"column names collide after renaming: {sorted(repeated)}")
    return df.toDF(*new_names)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return _rename(df, [snake_case(c) for c in df.columns])


def normalize_columns(df: DataFrame) -> DataFrame:
    return _rename(df, [ascii_name(c) for c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all; one count aggregate decides."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if row[c] > 0])


def drop_if_exists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c in columns])


def generate_catalog(
    df: DataFrame, table: str, comments: Mapping[str, str] | None = None
) -> tuple[dict, dict]:
    """Column comments and declared types of a frame; whole numbers are declared as float."""
    known = dict(comments or {})

    def declared(field: T.StructField) -> str:
        if field.name == "timestamp_extracted":
            return "timestamp"
        if isinstance(field.dataType, (T.LongType, T.DoubleType)):
            return "float"
        return field.dataType.simpleString()

    texts = {
        f.name: known.get(f.name, f"This is the {f.name.replace('_', ' ')} column.") for f in df.schema.fields
    }
    return {table: texts}, {table: {f.name: declared(f) for f in df.schema.fields}}


def cast_by_name(
    df: DataFrame, patterns: Mapping[str, str], exclude: Sequence[str] = ()
) -> DataFrame:
    """Cast every column whose name contains a pattern; the first matching pattern wins."""

    def cast(name: str) -> Column:
        target = next((t for p, t in patterns.items() if p in name.lower()), None)
        if target is None or name in exclude:
            return F.col(name)
        if target == "timestamp" and isinstance(df.schema[name].dataType, T.StringType):
            return iso_ts(name).alias(name)
        return _number_or_cast(df, name, target).alias(name)

    return df.select(*[cast(c) for c in df.columns])


def add_meta(
    df: DataFrame, now: dt.datetime, cdc_field: str | None = None, pattern: str = "yyyyMMdd"
) -> DataFrame:
    """Partition text ``date`` (from the change field, else the load day) and ``timestamp_extracted``."""
    stamp = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if cdc_field:
        name = cdc_field.replace(".", "_").lower()
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.withColumn(name, parse_ts_multi(name))
        day = F.date_format(F.col(name), pattern)
    else:
        day = F.date_format(stamp, pattern)
    return df.withColumn("date", day).withColumn("timestamp_extracted", stamp)


def _walk(
    kind: T.DataType, col: Column, path: str, sep: str
) -> list[tuple[str, Column, T.DataType]]:
    """Fields below a struct as (flat name, expression, type); anything else is itself."""
    if isinstance(kind, T.StructType):
        return [
            leaf for f in kind.fields for leaf in _walk(f.dataType, col[f.name], f"{path}{sep}{f.name}", sep)
        ]
    return [(path, col, kind)]


def flatten(df: DataFrame, sep: str = "_", max_items: int | None = None) -> DataFrame:
    """Nested records as plain columns: struct fields joined by ``sep``, array items by position.

    The number of items per array is the longest array in the table unless ``max_items`` is given.
    """
    while any(isinstance(f.dataType, (T.StructType, T.ArrayType)) for f in df.schema.fields):
        fields = [x for f in df.schema.fields for x in _walk(f.dataType, F.col(f"`{f.name}`"), f.name, sep)]
        lists = [path for path, _, kind in fields if isinstance(kind, T.ArrayType)]
        sizes = dict.fromkeys(lists, max_items or 0)
        if lists and max_items is None:
            longest = df.agg(
                F.array(*[F.max(F.size(c)) for p, c, k in fields if isinstance(k, T.ArrayType)])
            ).first()[0]
            sizes = {path: max(n or 0, 0) for path, n in zip(lists, longest)}
        columns = []
        for path, col, kind in fields:
            if isinstance(kind, T.ArrayType):
                columns += [F.get(col, F.lit(i)).alias(f"{path}{sep}{i}") for i in range(sizes[path])]
            else:
                columns.append(col.alias(path))
        df = df.select(*columns)
    return df


def promote_field(df: DataFrame, source: str, target: str, kind: str = "string") -> DataFrame:
    """Give a flattened lookup column its flat name, or add it as null when absent."""
    if source in df.columns:
        return df.withColumnRenamed(source, target)
    return df.withColumn(target, F.lit(None).cast(kind))


def rows_to_columns(df: DataFrame, dimensions: Sequence[str], metrics: Sequence[str] = ()) -> DataFrame:
    """Header and value arrays of a report response as named columns."""
    has_metrics = "metricValues" in df.columns
    dims = [F.get(F.col("dimensionValues"), F.lit(i))["value"].alias(n) for i, n in enumerate(dimensions)]
    vals = [
        (
            F.get(F.col("metricValues"), F.lit(i))["value"] if has_metrics else F.lit(None).cast("string")
        ).alias(n)
        for i, n in enumerate(metrics)
    ]
    return df.select(*dims, *vals)


def partition_date(df: DataFrame, tz: str = "Europe/London") -> DataFrame:
    """Day partition from ``dateHourMinute`` (also moved to UTC) or from ``date``; one must exist."""
    if "dateHourMinute" in df.columns:
        wall = F.to_timestamp("dateHourMinute", "yyyyMMddHHmm")
        return df.withColumn("date", compact_to_day("dateHourMinute")).withColumn(
            "dateHourMinute", local_to_utc(wall, tz)
        )
    if "date" in df.columns:
        return df.withColumn("date", compact_to_day("date"))
    raise ValueError("day partitioning needs a 'date' or 'dateHourMinute' column")


def stringify_objects(df: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text; scalars unchanged."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Output fields of a valuation record, in order, and how each is parsed.
VALUATION_FIELDS = {
    "Contact_Name__c": "text",
    "Contact_Email__c": "email",
    "Contact_PhoneNumber__c": "text",
    "Property_Age__c": "text",
    "Expected_CompletionDate__c": "text",
    "Property_Type__c": "text",
    "Bedroom_Count__c": "int",
    "Standard_Construction__c": "text",
    "Ownership_Type__c": "text",
    "Remaining_Lease_Years__c": "text",
    "Is_Ex_Local_Authority__c": "text",
    "Located_above_business__c": "text",
    "Business_Nature__c": "text",
    "Case_Number__c": "text",
    "Property_Address__c": "text",
    "Valuation_Date__c": "date",
    "Market_Value__c": "money",
    "Insurance_Reinstatement_Estimate__c": "money",
    "Market_Rent_per_month__c": "money",
    "Essential_Repairs__c": "text",
    "Flooding_risk_sea_or_river__c": "text",
    "Flooding_Risk_surface_water__c": "text",
    "Invasive_Species__c": "text",
    "Overhead_Power_Lines__c": "text",
    "Tenure__c": "text",
    "Terms_Lease_Details__c": "text",
    "Service_Charge_per_annum__c": "money",
    "Is_the_property_fit_for_immediate_occupa__c": "text",
    "Is_a_Reinspection_Required__c": "yes",
    "Original_Building_construction_type__c": "text",
    "External_Condition__c": "text",
    "Internal_Condition__c": "text",
    "Is_the_property_let__c": "text",
    "Case_ID__c": "text",
}


def conform_valuations(df: DataFrame) -> DataFrame:
    """Valuation records ready for the case system; rows without a case id are dropped."""
    parsers = {
        "text": lambda c: F.coalesce(c, F.lit("")),
        "email": valid_email_or_blank,
        "int": safe_int,
        "date": parse_date_guarded,
        "money": parse_currency,
        "yes": lambda c: F.coalesce(c == "Yes", F.lit(False)),
    }

    def source(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    kept = df.filter(F.col("Case_ID__c").isNotNull() & (F.col("Case_ID__c") != ""))
    return kept.select(*[parsers[kind](source(n)).alias(n) for n, kind in VALUATION_FIELDS.items()])
