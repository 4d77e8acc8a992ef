"""Schema conforming and parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import check
from ledgerlake.functions import dates, numbers, text
from ledgerlake.operators import conform

DAY = dt.date(2024, 3, 9)
NOW = dt.datetime(2024, 3, 9, 10, 30, 0)


@check(
    "c1_select_schema",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
              c_acctbal, 2024 AS year, 3 AS month, 9 AS day FROM customer""",
)
def _(t):
    schema = {"c_custkey": "string", "c_name": "string", "c_phone": "string", "c_nationkey": "double", "c_acctbal": "double"}
    return conform.select_schema(t.customer, schema, today=DAY)


RAW_EVENTS = """SELECT event_id, CASE event_type WHEN 'error' THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value,
   CASE event_type WHEN 'click' THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S')
                   WHEN 'view' THEN strftime(ts, '%Y%m%d%H%M')
                   WHEN 'signup' THEN strftime(ts, '%b %-d, %Y, %I:%M:%S %p')
                   WHEN 'purchase' THEN strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p')
                   ELSE strftime(ts, '%d-%m-%Y %H:%M:%S') END AS stamp,
   CASE event_type WHEN 'view' THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END AS moment FROM events"""


def raw_events(t):
    """Events with value and time as text in the shapes the landed files use."""
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.col("value").cast("decimal(18,2)").cast("string")
    )
    shapes = {
        "click": "yyyy-MM-dd'T'HH:mm:ss",
        "view": "yyyyMMddHHmm",
        "signup": "MMM d, yyyy, hh:mm:ss a",
        "purchase": "M/d/yyyy h:mm:ss a",
    }
    stamp = F.date_format("ts", "dd-MM-yyyy HH:mm:ss")
    for kind, pattern in shapes.items():
        stamp = F.when(F.col("event_type") == kind, F.date_format("ts", pattern)).otherwise(stamp)
    return t.events.select("event_id", "event_type", value.alias("Value"), stamp.alias("Stamp"))


@check(
    "c2_apply_schema",
    f"SELECT event_id, coalesce(TRY_CAST(value AS DOUBLE), 0) AS value, moment AS stamp FROM ({RAW_EVENTS})",
)
def _(t):
    raw = raw_events(t).drop("event_type")
    return conform.apply_schema(raw, {"event_id": "bigint", "Value": "double", "Stamp": "timestamp"})


@check("c3_cast_null_columns", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS remark FROM customer")
def _(t):
    return conform.cast_null_columns(t.customer.select("c_custkey", F.lit(None).alias("remark")))


@check(
    "c4_infer_schema",
    """SELECT 'event_id' AS name, 'int' AS kind UNION ALL SELECT 'value', 'double' UNION ALL SELECT 'flag', 'boolean'
       UNION ALL SELECT 'created_date', 'date' UNION ALL SELECT 'stamp', 'timestamp' UNION ALL SELECT 'event_type', 'string'
       UNION ALL SELECT 'big', 'bigint' UNION ALL SELECT 'blank', 'string'""",
)
def _(t):
    """Types found by looking at every value of the events table."""
    raw = t.events.select(
        F.col("event_id").cast("string").alias("event_id"),
        (F.col("event_id") + 3_000_000_000).cast("string").alias("big"),
        F.col("value").cast("string").alias("value"),
        F.when(F.col("value") > 5, "True").otherwise("False").alias("flag"),
        F.date_format("ts", "yyyy-MM-dd").alias("created_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"),
        "event_type",
        F.lit("None").alias("blank"),
    )
    found = conform.infer_schema(raw)
    return t.spark.createDataFrame(list(found.items()), "name string, kind string")


@check("c5_parse_ts_multi", f"SELECT event_id, moment FROM ({RAW_EVENTS})")
def _(t):
    return raw_events(t).select("event_id", dates.parse_ts_multi("Stamp").alias("moment"))


@check(
    "c6_fill_millis",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000'
          ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS stamp FROM events""",
)
def _(t):
    stamp = F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm")
    )
    return t.events.select("event_id", dates.fill_millis(stamp).alias("stamp"))


@check(
    "c7_snake_case_columns",
    "SELECT c_custkey AS customer_key, c_name AS full_name, c_mktsegment AS market_segment FROM customer",
)
def _(t):
    camel = t.customer.select(
        F.col("c_custkey").alias("customerKey"), F.col("c_name").alias("FullName"), F.col("c_mktsegment").alias("marketSegment")
    )
    return conform.snake_case_columns(camel)


@check("c8_normalize_columns", "SELECT p_partkey AS piece_no, p_name AS designation, p_size AS taille_cm FROM part")
def _(t):
    odd = t.part.select(
        F.col("p_partkey").alias("Pièce No."), F.col("p_name").alias(" Désignation "), F.col("p_size").alias("Taille (cm)")
    )
    return conform.normalize_columns(odd)


@check("c9_drop_all_null", "SELECT s_suppkey, s_name, CASE WHEN s_acctbal > 500 THEN s_acctbal END AS large FROM supplier")
def _(t):
    wide = t.supplier.select(
        "s_suppkey",
        "s_name",
        F.when(F.col("s_acctbal") > 500, F.col("s_acctbal")).alias("large"),
        F.lit(None).cast("string").alias("nothing"),
    )
    return conform.drop_all_null(wide)


@check("c10_drop_if_exists", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    return conform.drop_if_exists(t.nation, ["n_regionkey", "n_comment"])


@check(
    "c12_generate_catalog",
    """WITH c AS (SELECT 'c_custkey' AS name, 'float' AS kind, 'Customer number' AS comment UNION ALL
       SELECT 'c_name', 'string', 'This is the c name column.' UNION ALL SELECT 'c_nationkey', 'int', 'This is the c nationkey column.' UNION ALL
       SELECT 'c_acctbal', 'float', 'This is the c acctbal column.' UNION ALL SELECT 'c_mktsegment', 'string', 'This is the c mktsegment column.'),
       v AS (SELECT 'c_custkey' AS name, count(c_custkey) AS filled FROM customer UNION ALL SELECT 'c_name', count(c_name) FROM customer
             UNION ALL SELECT 'c_nationkey', count(c_nationkey) FROM customer UNION ALL SELECT 'c_acctbal', count(c_acctbal) FROM customer
             UNION ALL SELECT 'c_mktsegment', count(c_mktsegment) FROM customer)
       SELECT c.*, v.filled FROM c JOIN v ON v.name = c.name""",
)
def _(t):
    """The catalog of the customer table with the number of values each column holds."""
    comments, schemas = conform.generate_catalog(t.customer, "customer", {"c_custkey": "Customer number"})
    entries = [(n, k, comments["customer"][n]) for n, k in schemas["customer"].items()]
    catalog = t.spark.createDataFrame(entries, "name string, kind string, comment string")
    counts = t.customer.agg(*[F.count(c).alias(c) for c in t.customer.columns])
    return catalog.join(counts.unpivot([], list(t.customer.columns), "name", "filled"), "name")


@check(
    "c13_cast_by_name",
    """SELECT o_orderkey, date_trunc('day', o_orderdate) AS order_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
              'x' AS updated_at FROM orders""",
)
def _(t):
    texts = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total_amount"),
        F.lit("x").alias("updated_at"),
    )
    return conform.cast_by_name(texts, {"date": "timestamp", "amount": "double"}, exclude=["updated_at"])


@check(
    "c14_add_meta",
    """SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y%m%d') AS date, TIMESTAMP '2024-03-09 10:30:00' AS timestamp_extracted FROM orders""",
)
def _(t):
    return conform.add_meta(t.orders.select("o_orderkey", "o_orderdate"), NOW, "o_orderdate")


@check(
    "c15_flatten",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k, event_type AS tags_0, user_id AS nest_user_id,
              value AS nest_parts_0_v, CAST(NULL AS DOUBLE) AS nest_parts_1_v FROM events WHERE event_type <> 'view'
       UNION ALL SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT), event_type, user_id, value, value FROM events WHERE event_type = 'view'""",
)
def _(t):
    part = F.struct(F.col("value").alias("v"))
    parts = F.when(F.col("event_type") == "view", F.array(part, part)).otherwise(F.array(part))
    nested = t.events.select(
        "event_id",
        F.from_json("props", "k bigint").alias("props"),
        F.array("event_type").alias("tags"),
        F.struct("user_id", parts.alias("parts")).alias("nest"),
    )
    return conform.flatten(nested)


@check("c16_promote_field", "SELECT s_suppkey, s_name AS supplier_name, CAST(NULL AS VARCHAR) AS finance_type FROM supplier")
def _(t):
    rows = t.supplier.select("s_suppkey", F.col("s_name").alias("Supplier__r_Name"))
    named = conform.promote_field(rows, "Supplier__r_Name", "supplier_name")
    return conform.promote_field(named, "Case__r_Finance_Type", "finance_type")


@check(
    "c17_rows_to_columns",
    "SELECT n_name AS country, CAST(n_regionkey AS VARCHAR) AS region, CAST(n_nationkey AS VARCHAR) AS sessions, CAST(NULL AS VARCHAR) AS events FROM nation",
)
def _(t):
    value = lambda c: F.struct(F.col(c).cast("string").alias("value"))
    response = t.nation.select(
        F.array(value("n_name"), value("n_regionkey")).alias("dimensionValues"),
        F.array(value("n_nationkey")).alias("metricValues"),
    )
    return conform.rows_to_columns(response, ["country", "region"], ["sessions", "events"])


@check(
    "c18_local_to_utc",
    "SELECT event_id, (ts + INTERVAL 180 DAY) AT TIME ZONE 'Europe/London' AT TIME ZONE 'UTC' AS utc_ts, ts AT TIME ZONE 'Europe/London' AT TIME ZONE 'UTC' AS winter_ts FROM events",
)
def _(t):
    summer = F.col("ts").cast("timestamp") + F.expr("INTERVAL 180 DAY")
    return t.events.select(
        "event_id",
        dates.local_to_utc(summer).alias("utc_ts"),
        dates.local_to_utc(F.col("ts").cast("timestamp")).alias("winter_ts"),
    )


@check(
    "c19_partition_date",
    """SELECT event_id, strftime(ts + INTERVAL 150 DAY, '%Y-%m-%d') AS date,
              date_trunc('minute', ts + INTERVAL 150 DAY) AT TIME ZONE 'Europe/London' AT TIME ZONE 'UTC' AS "dateHourMinute" FROM events""",
)
def _(t):
    wall = F.date_format(F.col("ts") + F.expr("INTERVAL 150 DAY"), "yyyyMMddHHmm")
    return conform.partition_date(t.events.select("event_id", wall.alias("dateHourMinute")))


@check(
    "c20_epoch_to_ts",
    "SELECT event_id, date_trunc('millisecond', ts) AS from_ms, date_trunc('second', ts) AS from_s FROM events",
)
def _(t):
    moment = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        dates.epoch_to_ts(F.unix_millis(moment).cast("string"), "ms").alias("from_ms"),
        dates.epoch_to_ts(F.unix_seconds(moment), "s").alias("from_s"),
    )


@check(
    "c21_clean_text",
    r"SELECT doc_id, replace(replace(replace(replace(text, chr(10), ' '), chr(13), ' '), chr(9), ' '), '  ', ' ') AS text FROM documents",
)
def _(t):
    return text.clean_text(t.documents.select("doc_id", "text"), ["text"])


@check(
    "c22_parse_bool",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS public FROM orders",
)
def _(t):
    raw = F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "False").otherwise("maybe")
    return t.orders.select("o_orderkey", numbers.parse_bool(raw).alias("public"))


@check(
    "c23_stringify_objects",
    """SELECT vec_id, '{"label":' || CAST(label AS VARCHAR) || '}' AS info, '["' || CAST(vec_id AS VARCHAR) || '"]' AS tags FROM embeddings""",
)
def _(t):
    rows = t.embeddings.select(
        "vec_id", F.struct("label").alias("info"), F.array(F.col("vec_id").cast("string")).alias("tags")
    )
    return conform.stringify_objects(rows)


@check(
    "c24_parse_currency",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CAST(value * 1000 AS DECIMAL(18,2)) AS DOUBLE) END AS amount FROM events",
)
def _(t):
    amount = F.concat(F.lit("£"), F.format_number((F.col("value") * 1000).cast("decimal(18,2)"), 2))
    raw = F.when(F.col("event_type") == "error", "n/a").otherwise(amount)
    return t.events.select("event_id", numbers.parse_currency(raw).alias("amount"))


@check(
    "c25_parse_date_guarded",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
)
def _(t):
    shapes = {"1-URGENT": "yyyy-MM-dd", "2-HIGH": "d MMMM yyyy", "3-MEDIUM": "MMM d, yyyy", "5-LOW": "d/M/yyyy"}
    raw = F.date_format("o_orderdate", "yyyy/MM/dd")
    for kind, pattern in shapes.items():
        raw = F.when(F.col("o_orderpriority") == kind, F.date_format("o_orderdate", pattern)).otherwise(raw)
    raw = F.when(F.col("o_orderstatus") == "P", "2190-01-05").otherwise(raw)
    return t.orders.select("o_orderkey", dates.parse_date_guarded(raw).alias("day"))


@check(
    "c26_safe_int",
    "SELECT event_id, CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN NULL WHEN 'view' THEN NULL ELSE CAST(user_id AS INTEGER) END AS rooms FROM events",
)
def _(t):
    raw = (
        F.when(F.col("event_type") == "click", "nan")
        .when(F.col("event_type") == "error", "")
        .when(F.col("event_type") == "view", "3.5")
        .otherwise(F.col("user_id").cast("string"))
    )
    return t.events.select("event_id", numbers.safe_int(raw).alias("rooms"))


@check(
    "c27_valid_email",
    "SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'c' || c_custkey || '@mail.example.com' ELSE '' END AS email FROM customer",
)
def _(t):
    name = F.concat(F.lit("c"), F.col("c_custkey"))
    raw = (
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.concat(name, F.lit("@mail.example.com")))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(name, F.lit("@nodot")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("None"))
    )
    return t.customer.select("c_custkey", text.valid_email_or_blank(raw).alias("email"))


@check(
    "c28_conform_valuations",
    """SELECT 'case' || o_orderkey AS case_id, CASE WHEN o_orderstatus = 'F' THEN 'a' || o_orderkey || '@mail.example.com' ELSE '' END AS email,
              CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS INTEGER) END AS bedrooms, strftime(o_orderdate, '%Y-%m-%d') AS day,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS market, o_orderstatus = 'F' AS reinspect, '' AS age, 34 AS n_columns
       FROM orders WHERE o_orderpriority <> '1-URGENT'""",
)
def _(t):
    filled = F.col("o_orderstatus") == "F"
    raw = t.orders.select(
        F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("case"), "o_orderkey")).otherwise("").alias("Case_ID__c"),
        F.when(filled, F.concat(F.lit("a"), "o_orderkey", F.lit("@mail.example.com"))).otherwise("none").alias("Contact_Email__c"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey").cast("string")).otherwise("nan").alias("Bedroom_Count__c"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Valuation_Date__c"),
        F.concat(F.lit("£"), F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)).alias("Market_Value__c"),
        F.when(filled, "Yes").otherwise("No").alias("Is_a_Reinspection_Required__c"),
    )
    out = conform.conform_valuations(raw)
    return out.select(
        F.col("Case_ID__c").alias("case_id"),
        F.col("Contact_Email__c").alias("email"),
        F.col("Bedroom_Count__c").alias("bedrooms"),
        F.col("Valuation_Date__c").alias("day"),
        F.col("Market_Value__c").alias("market"),
        F.col("Is_a_Reinspection_Required__c").alias("reinspect"),
        F.col("Property_Age__c").alias("age"),
        F.lit(len(out.columns)).alias("n_columns"),
    )


@check(
    "c29_clean_null",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'UNKNOWN' WHEN 'O' THEN 'UNKNOWN' ELSE o_orderpriority END AS brand FROM orders",
)
def _(t):
    raw = (
        F.when(F.col("o_orderstatus") == "F", " <NA> ")
        .when(F.col("o_orderstatus") == "O", "  ")
        .otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")))
    )
    return t.orders.select("o_orderkey", text.clean_null(raw, default="UNKNOWN").alias("brand"))
