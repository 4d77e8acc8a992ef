"""Projections, filters and predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import check, dec
from ledgerlake.operators import joins, predicates
from ledgerlake.operators.conform import keep_columns


@check("p1_project_rename", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment FROM customer")
def _(t):
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
    )


@check(
    "p2_select_except",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem",
)
def _(t):
    return predicates.select_except(t.lineitem, ["l_extendedprice", "l_discount", "l_tax", "l_shipdate"])


@check(
    "p3_replace_columns",
    f"""SELECT CAST({dec('l_extendedprice')} * 2 AS DOUBLE) AS l_extendedprice,
               lower(l_returnflag) AS l_returnflag,
               l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate
        FROM lineitem""",
)
def _(t):
    price = (F.col("l_extendedprice").cast("decimal(18,2)") * 2).cast("double")
    return predicates.replace_columns(
        t.lineitem, {"l_extendedprice": price, "l_returnflag": F.lower("l_returnflag")}
    )


@check("p4_select_existing", "SELECT o_orderkey, o_orderpriority FROM orders")
def _(t):
    return predicates.select_existing(t.orders, ["o_orderkey", "o_clerk", "o_orderpriority", "o_comment"])


@check(
    "p5_star_plus_columns",
    "SELECT *, p_size * 2 AS double_size, 'catalog' AS origin, '' AS remark FROM part",
)
def _(t):
    return t.part.select(
        "*", (F.col("p_size") * 2).alias("double_size"), F.lit("catalog").alias("origin"), F.lit("").alias("remark")
    )


@check(
    "p6_flag_filters",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE o_orderstatus <> 'P' AND (o_totalprice > 400000 OR o_orderpriority = '1-URGENT')
         AND o_totalprice >= 1000""",
)
def _(t):
    wide = (F.col("o_totalprice") > 400000) | (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.filter(
        (F.col("o_orderstatus") != "P") & wide & (F.col("o_totalprice") >= 1000)
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@check(
    "p7_in_lists",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('F')""",
)
def _(t):
    return t.orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("F")
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@check(
    "p8_like_patterns",
    """SELECT p_partkey, p_name, p_brand FROM part
       WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt' OR p_brand LIKE '%#2%'""",
)
def _(t):
    return t.part.filter(
        F.col("p_name").like("red%") | F.col("p_name").like("%bolt") | F.col("p_brand").like("%#2%")
    ).select("p_partkey", "p_name", "p_brand")


@check(
    "p9_matches_any",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE contains(o_orderpriority, 'HIGH') OR contains(o_orderpriority, '4-NOT') OR contains(o_orderpriority, '5.LOW')""",
)
def _(t):
    return t.orders.filter(predicates.matches_any("o_orderpriority", ["HIGH", "4-NOT", "5.LOW"])).select(
        "o_orderkey", "o_orderpriority"
    )


@check(
    "p10_between_dates",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""",
)
def _(t):
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1996-01-01", "1996-12-31"))
    return t.orders.filter(F.col("o_orderdate").between(low, high)).select("o_orderkey", "o_orderdate")


@check(
    "p11_not_blank",
    "SELECT event_id, tag FROM (SELECT event_id, CASE event_type WHEN 'view' THEN '' WHEN 'error' THEN NULL ELSE event_type END AS tag FROM events) WHERE tag IS NOT NULL AND tag <> ''",
)
def _(t):
    tag = F.when(F.col("event_type") == "view", "").when(F.col("event_type") != "error", F.col("event_type"))
    return t.events.select("event_id", tag.alias("tag")).filter(predicates.not_blank("tag"))


@check(
    "p12_last_n_days",
    "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - 3",
)
def _(t):
    return predicates.last_n_days(t.events, "ts", 3, dt.date(2024, 1, 20)).select("event_id", "user_id")


@check("p13_since_date", "SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2000-06-16'")
def _(t):
    return predicates.since(t.orders, "o_orderdate", dt.date(2000, 6, 16)).select("o_orderkey", "o_custkey")


@check(
    "p14_cast_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE TRY_CAST(CAST(l_linenumber AS VARCHAR) AS DECIMAL(18,3)) IN (1, 3)
         AND TRY_CAST(l_returnflag AS DECIMAL(18,3)) IS NULL""",
)
def _(t):
    number = F.col("l_linenumber").cast("string").try_cast("decimal(18,3)")
    return t.lineitem.filter(
        number.isin(1, 3) & F.col("l_returnflag").try_cast("decimal(18,3)").isNull()
    ).select("l_orderkey", "l_linenumber", "l_partkey")


@check("p15_name_set", "SELECT n_nationkey, n_name FROM nation WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_24')")
def _(t):
    return t.nation.filter(F.col("n_name").isin("NATION_1", "NATION_7", "NATION_24")).select("n_nationkey", "n_name")


@check(
    "p16_latest_snapshot",
    """SELECT event_id, day FROM (SELECT event_id, CAST(ts AS DATE) AS day FROM events)
       WHERE day = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def _(t):
    return predicates.latest_snapshot(t.events.select("event_id", F.to_date("ts").alias("day")), "day")


@check(
    "p17_not_in_subquery",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(t):
    rich = t.customer.filter("c_acctbal > 0")
    return joins.exclude_keys(t.orders.select("o_orderkey", "o_custkey"), rich, "o_custkey", "c_custkey")


@check(
    "p17_not_in_with_null",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey END FROM customer)""",
)
def _(t):
    keys = t.customer.select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("o_custkey"))
    return joins.exclude_keys(t.orders.select("o_orderkey", "o_custkey"), keys, "o_custkey")


@check(
    "p18_drop_null_rows",
    """SELECT event_id, user_id, score FROM (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS score FROM events)
       WHERE score IS NOT NULL""",
)
def _(t):
    scored = t.events.withColumn("score", F.when(F.col("event_type") != "error", F.col("value")))
    return predicates.drop_null_rows(scored, ["event_id", "user_id", "score"])


@check("c11_keep_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def _(t):
    return keep_columns(t.part, ["p_size", "p_partkey", "p_brand", "p_container"])
