"""Scalar, array, map and date functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import check, dec
from ledgerlake.functions import dates, numbers, text

RATE = "CASE o_orderpriority WHEN '1-URGENT' THEN 0.80 WHEN '2-HIGH' THEN 0.86 WHEN '3-MEDIUM' THEN 0.22 WHEN '4-NOT SPECIFIED' THEN 2.65 ELSE 1 END"
CURRENCY = {"1-URGENT": "USD", "2-HIGH": "EUR", "3-MEDIUM": "AED", "4-NOT SPECIFIED": "KWD"}


def by_value(col, table, default=None):
    case = F.lit(default)
    for key, value in table.items():
        case = F.when(F.col(col) == key, F.lit(value)).otherwise(case)
    return case


@check(
    "f1_f2_coalesce_nullif",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS label FROM orders""",
)
def _(t):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.select("o_orderkey", status.alias("status"), F.coalesce(status, "o_orderpriority").alias("label"))


@check(
    "f3_f6_text_basics",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, ltrim('  ' || p_brand) AS l, rtrim(p_brand || '  ') AS r, lower(p_type) AS kind,
              p_brand || '/' || p_type AS joined, substring(p_brand, 1, 3) AS head, concat(p_name, '%') AS pct FROM part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), "p_brand")).alias("l"),
        F.rtrim(F.concat("p_brand", F.lit("  "))).alias("r"),
        F.lower("p_type").alias("kind"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.substring("p_brand", 1, 3).alias("head"),
        F.concat("p_name", F.lit("%")).alias("pct"),
    )


@check(
    "f7_replace_blank",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'Unknown' WHEN 'O' THEN 'Unknown' ELSE o_orderpriority END AS nationality,
              replace(o_orderpriority, ' ', 'T') AS swapped FROM orders""",
)
def _(t):
    raw = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey",
        text.replace_blank(raw).alias("nationality"),
        F.replace("o_orderpriority", F.lit(" "), F.lit("T")).alias("swapped"),
    )


@check("f8_regexp_replace", "SELECT p_partkey, regexp_replace(p_brand || ':default', ':default', '') AS brand, regexp_replace(p_name, '[aeiou]', '', 'g') AS stem FROM part")
def _(t):
    return t.part.select(
        "p_partkey",
        F.regexp_replace(F.concat("p_brand", F.lit(":default")), ":default", "").alias("brand"),
        F.regexp_replace("p_name", "[aeiou]", "").alias("stem"),
    )


@check(
    "f9_split_part",
    """SELECT doc_id, string_split(text, '.')[1] AS first, string_split(text, '.')[3] AS third FROM documents""",
)
def _(t):
    return t.documents.select(
        "doc_id", text.part_of("text", ".", 1).alias("first"), text.part_of("text", ".", 3).alias("third")
    )


@check(
    "f10_try_cast",
    "SELECT event_id, TRY_CAST(event_type AS INTEGER) AS kind_no, TRY_CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS user_no FROM events",
)
def _(t):
    return t.events.select(
        "event_id",
        F.col("event_type").try_cast("int").alias("kind_no"),
        F.col("user_id").cast("string").try_cast("int").alias("user_no"),
    )


@check(
    "f11_casts",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST({dec('l_tax')} AS VARCHAR) AS tax_text, CAST(l_shipdate AS DATE) AS day,
               CAST(l_linenumber AS BIGINT) AS big, CAST(l_linenumber AS DOUBLE) AS real, CAST(l_linenumber - 1 AS BOOLEAN) AS later FROM lineitem""",
)
def _(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_tax").cast("decimal(18,2)").cast("string").alias("tax_text"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_linenumber").cast("bigint").alias("big"),
        F.col("l_linenumber").cast("double").alias("real"),
        (F.col("l_linenumber") - 1).cast("boolean").alias("later"),
    )


@check(
    "f12_to_gbp",
    f"SELECT o_orderkey, CAST({dec('o_totalprice', 3)} * {RATE} AS DOUBLE) AS gbp FROM orders",
)
def _(t):
    gbp = numbers.to_gbp("o_totalprice", by_value("o_orderpriority", CURRENCY, "GBP"))
    return t.orders.select("o_orderkey", gbp.cast("double").alias("gbp"))


@check(
    "f13_midpoint",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(({dec('l_extendedprice', 3)} + {dec('l_quantity', 3)}) * 0.5 AS DECIMAL(18,3)) AS DOUBLE) AS middle FROM lineitem""",
)
def _(t):
    middle = numbers.midpoint(numbers.money("l_extendedprice"), numbers.money("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", middle.cast("double").alias("middle"))


@check("f14_abs", f"SELECT c_custkey, CAST(abs({dec('c_acctbal')}) AS DOUBLE) AS size FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.abs(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("size"))


@check(
    "f15_round",
    f"SELECT l_orderkey, CAST(round(sum({dec('l_extendedprice')} * (1 - {dec('l_discount')})), 2) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1",
)
def _(t):
    price, off = (F.col(c).cast("decimal(18,2)") for c in ("l_extendedprice", "l_discount"))
    return t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum(price * (1 - off)), 2).cast("double").alias("revenue"))


@check(
    "f16_searched_case",
    """SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal > 0 AND c_mktsegment = 'BUILDING' THEN 'Income and Wealth'
              WHEN c_acctbal > 0 THEN 'Income' WHEN c_mktsegment = 'BUILDING' THEN 'Wealth' END AS source FROM customer""",
)
def _(t):
    positive, building = F.col("c_acctbal") > 0, F.col("c_mktsegment") == "BUILDING"
    case = (
        F.when(F.col("c_acctbal").isNull(), None)
        .when(positive & building, "Income and Wealth")
        .when(positive, "Income")
        .when(building, "Wealth")
    )
    return t.customer.select("c_custkey", case.alias("source"))


@check(
    "f17_code_lookup",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 2600 WHEN '2-HIGH' THEN 42000 WHEN '3-MEDIUM' THEN 15900 END AS income FROM orders""",
)
def _(t):
    codes = {"1-URGENT": 2600, "2-HIGH": 42000, "3-MEDIUM": 15900}
    return t.orders.select("o_orderkey", numbers.lookup("o_orderpriority", codes).alias("income"))


@check(
    "f18_bands",
    """SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal <= 1000 THEN 'low' WHEN c_acctbal <= 5000 THEN 'middle' ELSE 'high' END AS class FROM customer""",
)
def _(t):
    return t.customer.select("c_custkey", numbers.band("c_acctbal", [(1000, "low"), (5000, "middle")], "high").alias("class"))


@check("f19_iso_timestamps", "SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS moment FROM events")
def _(t):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = (
        F.when(F.col("event_type") == "error", "not a time")
        .when(F.col("event_type") == "view", F.concat(stamp, F.lit("+0000")))
        .otherwise(F.concat(stamp, F.lit("Z")))
    )
    return t.events.select("event_id", dates.iso_ts(raw).alias("moment"))


@check(
    "f20_f22_date_text",
    """SELECT o_orderkey, o_orderdate AS parsed, strftime(o_orderdate + INTERVAL 13 HOUR, '%d/%m/%Y %I:%M:%S %p') AS shown,
              strftime(o_orderdate, '%d/%m/%Y %H:%M') AS short, CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.to_timestamp(F.substring(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm"), 1, 10), "yyyy-MM-dd").alias("parsed"),
        dates.report_date(F.col("o_orderdate") + F.expr("INTERVAL 13 HOUR")).alias("shown"),
        dates.report_date("o_orderdate", "dd/MM/yyyy HH:mm").alias("short"),
        F.to_date("o_orderdate").alias("day"),
    )


@check(
    "f23_date_parts",
    "SELECT o_orderkey, o_orderdate, day(o_orderdate) AS day, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter, year(o_orderdate) AS year FROM orders",
)
def _(t):
    return dates.date_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


@check(
    "f24_f28_date_arithmetic",
    """SELECT o_orderkey, o_orderdate + INTERVAL 14 DAY AS plus_14, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS age_days,
              date_sub('month', date_trunc('month', o_orderdate), TIMESTAMP '2002-01-01') AS age_months,
              date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS next_month, o_orderdate + INTERVAL 1 HOUR AS later FROM orders""",
)
def _(t):
    end = F.lit("2002-01-01").cast("timestamp_ntz")
    first = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    return t.orders.select(
        "o_orderkey",
        dates.add_days("o_orderdate", 14).alias("plus_14"),
        F.datediff(end, "o_orderdate").alias("age_days"),
        dates.months_between(first, end.cast("timestamp")).alias("age_months"),
        (first + F.expr("INTERVAL 1 MONTH")).alias("next_month"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("later"),
    )


@check("f29_from_unixtime", "SELECT event_id, date_trunc('second', ts) AS moment FROM events")
def _(t):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    return t.events.select("event_id", dates.epoch_to_ts(seconds, "s").alias("moment"))


@check(
    "f30_array_unnest",
    """SELECT l_orderkey, l_linenumber, l_partkey, unnest([l_returnflag, CASE WHEN l_linestatus = 'O' THEN l_linestatus END]) AS mark FROM lineitem""",
)
def _(t):
    marks = F.array("l_returnflag", F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.explode(marks).alias("mark"))


@check(
    "f31_unpivot",
    f"""SELECT l_orderkey, type, CAST(sum(value) AS DOUBLE) AS total FROM (
          SELECT l_orderkey, 'price' AS type, {dec('l_extendedprice')} AS value FROM lineitem
          UNION ALL SELECT l_orderkey, 'tax', {dec('l_tax')} FROM lineitem
          UNION ALL SELECT l_orderkey, 'discount', {dec('l_discount')} FROM lineitem) GROUP BY 1, 2""",
)
def _(t):
    money = t.lineitem.select(
        "l_orderkey",
        *[F.col(c).cast("decimal(18,2)").alias(n) for c, n in (("l_extendedprice", "price"), ("l_tax", "tax"), ("l_discount", "discount"))],
    )
    tall = money.unpivot("l_orderkey", ["price", "tax", "discount"], "type", "value")
    return tall.groupBy("l_orderkey", "type").agg(F.sum("value").cast("double").alias("total"))


@check(
    "f32_f33_map_and_list",
    """SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) AS filled,
              string_agg(DISTINCT o_orderstatus, ', ' ORDER BY o_orderstatus DESC) AS statuses FROM orders GROUP BY 1""",
)
def _(t):
    per = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.max("o_orderdate").alias("d"))
    out = per.groupBy("o_custkey").agg(
        F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "d"))).alias("m"),
        F.array_join(F.sort_array(F.collect_list("o_orderstatus"), asc=False), ", ").alias("statuses"),
    )
    return out.select("o_custkey", F.col("m")["F"].alias("filled"), "statuses")


@check("f34_constants", "SELECT p_partkey, '' AS completion_date, '' AS is_leasehold, 'a' AS gb_col, 1 AS one FROM part")
def _(t):
    return t.part.select(
        "p_partkey", F.lit("").alias("completion_date"), F.lit("").alias("is_leasehold"), F.lit("a").alias("gb_col"), F.lit(1).alias("one")
    )


@check(
    "f35_contains_arabic",
    """SELECT doc_id, (lang = 'en') OR regexp_matches(text, '[\\x{0600}-\\x{06FF}\\x{0750}-\\x{077F}\\x{08A0}-\\x{08FF}\\x{FB50}-\\x{FDFF}\\x{FE70}-\\x{FEFF}]') AS arabic FROM documents""",
)
def _(t):
    marked = F.when(F.col("lang") == "en", F.concat("text", F.lit(" سلام"))).otherwise(F.col("text"))
    return t.documents.select("doc_id", text.contains_arabic(marked).alias("arabic"))


@check("f36_json_text", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@check(
    "s15_year_month_day",
    "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders",
)
def _(t):
    return dates.with_ymd(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@check("s20_run_date", "SELECT c_custkey, c_name, '20240309' AS job_run_date FROM customer")
def _(t):
    return dates.with_run_date(t.customer.select("c_custkey", "c_name"), dt.date(2024, 3, 9))
