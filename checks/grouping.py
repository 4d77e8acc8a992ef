"""Aggregations and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, dec, dsum
from ledgerlake.functions.numbers import greatest_case, null_safe_sum
from ledgerlake.operators import aggregate, latest, windows

PRIORITIES = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "unspecified",
    "5-LOW": "low",
}


def money(col: str):
    return F.col(col).cast("decimal(18,2)")


@check(
    "g1_group_aggregates",
    f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {dsum('l_extendedprice')} AS total, min(l_shipdate) AS first_day,
               max(l_shipdate) AS last_day FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.sum(money("l_extendedprice")).cast("double").alias("total"),
        F.min("l_shipdate").alias("first_day"),
        F.max("l_shipdate").alias("last_day"),
    )


@check(
    "g2_group_by_ordinal",
    "SELECT l_returnflag, l_linestatus, max(l_shipdate) AS last_day FROM lineitem GROUP BY 1, 2",
)
def _(t):
    return t.spark.sql(
        "SELECT l_returnflag, l_linestatus, max(l_shipdate) AS last_day FROM {lines} GROUP BY 1, 2", lines=t.lineitem
    )


@check(
    "g3_conditional_aggregates",
    f"""SELECT o_custkey,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {dec('o_totalprice')} ELSE 0 END) AS DOUBLE) AS filled,
               max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS last_open
        FROM orders GROUP BY o_custkey""",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        aggregate.agg_if(F.sum, F.col("o_orderstatus") == "F", money("o_totalprice"), 0).cast("double").alias("filled"),
        aggregate.agg_if(F.max, F.col("o_orderstatus") == "O", "o_orderdate").alias("last_open"),
    )


@check(
    "g4_pivot_fixed",
    """SELECT o_custkey,
         max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS urgent_last,
         max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent_top,
         max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate END) AS high_last,
         max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END) AS high_top,
         max(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderdate END) AS other_last,
         max(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_totalprice END) AS other_top
       FROM orders GROUP BY o_custkey""",
)
def _(t):
    return aggregate.pivot_fixed(
        t.orders,
        "o_custkey",
        "o_orderpriority",
        {"1-URGENT": "urgent", "2-HIGH": "high"},
        {"last": F.col("o_orderdate"), "top": F.col("o_totalprice")},
        other="other",
    )


@check(
    "g5_pivot_to_row",
    """SELECT max(CASE WHEN p_type = 'ECONOMY' THEN p_size END) AS economy_size,
              max(CASE WHEN p_type = 'PROMO' THEN concat(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '%') END) AS promo_rate,
              max(CASE WHEN p_brand = 'Brand#3' THEN p_name END) AS brand_3_name FROM part""",
)
def _(t):
    return aggregate.pivot_to_row(
        t.part,
        {
            "economy_size": (F.col("p_type") == "ECONOMY", F.col("p_size")),
            "promo_rate": (F.col("p_type") == "PROMO", F.concat(money("p_retailprice").cast("string"), F.lit("%"))),
            "brand_3_name": (F.col("p_brand") == "Brand#3", F.col("p_name")),
        },
    )


@check(
    "g6_pivot_sum",
    "SELECT c.c_custkey, "
    + ", ".join(
        f"CAST(sum(CASE WHEN o_orderpriority = '{v}' THEN {dec('o_totalprice')} END) AS DOUBLE) AS total_{n}"
        for v, n in PRIORITIES.items()
    )
    + " FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey",
)
def _(t):
    conditions = {f"total_{n}": F.col("o_orderpriority") == v for v, n in PRIORITIES.items()}
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    sums = aggregate.pivot_sum(joined, "c_custkey", conditions, money("o_totalprice"))
    return sums.select("c_custkey", *[F.col(c).cast("double").alias(c) for c in conditions])


@check(
    "g7_pivot_max_date",
    "SELECT o_custkey, "
    + ", ".join(f"max(CASE WHEN o_orderpriority = '{v}' THEN CAST(o_orderdate AS DATE) END) AS {n}_date" for v, n in PRIORITIES.items())
    + " FROM orders GROUP BY o_custkey",
)
def _(t):
    conditions = {f"{n}_date": F.col("o_orderpriority") == v for v, n in PRIORITIES.items()}
    return aggregate.pivot_max_date(t.orders, "o_custkey", conditions, F.to_date("o_orderdate"))


@check("g8_group_count", "SELECT o_custkey, count(o_orderkey) AS id_count FROM orders GROUP BY o_custkey")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("id_count"))


@check("g9_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@check(
    "g10_drop_duplicates_by",
    """SELECT o_custkey, o_orderdate, o_orderkey FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return latest.drop_duplicates_by(rows, ["o_custkey", "o_orderdate"], ["o_orderkey"])


@check(
    "g11_string_agg_ordered",
    "SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority DESC) AS kinds FROM orders GROUP BY o_custkey",
)
def _(t):
    return aggregate.string_agg_ordered(t.orders, "o_custkey", "o_orderpriority", "kinds")


@check(
    "g12_map_agg",
    f"""SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN {dec('o_totalprice')} END) AS DOUBLE) AS filled,
               CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {dec('o_totalprice')} END) AS DOUBLE) AS open,
               CAST(NULL AS DOUBLE) AS absent
        FROM orders GROUP BY o_custkey""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderstatus", money("o_totalprice").alias("amount"))
    mapped = aggregate.map_agg(rows, "o_custkey", "o_orderstatus", "amount", "kv", F.sum)
    wide = aggregate.wide_from_map(mapped, "kv", {"F": "filled", "O": "open", "X": "absent"})
    return wide.select("o_custkey", *[F.col(c).cast("double").alias(c) for c in ("filled", "open", "absent")])


@check(
    "g13_last_with_attr",
    """SELECT o_custkey, o_orderpriority, o_orderdate AS last_order FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    return latest.last_with_attr(t.orders, "o_custkey", "o_orderdate", "o_orderpriority", "last_order", ["o_orderkey"])


@check(
    "g14_collapse_max",
    """SELECT o_custkey, max(o_orderstatus) AS o_orderstatus, max(o_totalprice) AS o_totalprice, min(o_orderdate) AS o_orderdate
       FROM orders GROUP BY o_custkey""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return aggregate.collapse_max(rows, "o_custkey", minimum=["o_orderdate"])


@check(
    "g15_null_safe_sum",
    f"""SELECT l_orderkey, CAST(sum(coalesce(CASE WHEN l_returnflag <> 'A' THEN {dec('l_extendedprice')} END, 0)
               + coalesce({dec('l_tax')}, 0)) AS DOUBLE) AS due FROM lineitem GROUP BY l_orderkey""",
)
def _(t):
    part = F.when(F.col("l_returnflag") != "A", money("l_extendedprice"))
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(null_safe_sum(part, money("l_tax"))).cast("double").alias("due"))


@check(
    "g16_latest_group",
    """SELECT o_orderpriority, o_orderstatus, o_custkey, last_day FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY last_day DESC, o_orderstatus DESC, o_custkey DESC) AS rn FROM (
           SELECT o_orderpriority, o_orderstatus, o_custkey, max(o_orderdate) AS last_day FROM orders GROUP BY 1, 2, 3)) WHERE rn = 1""",
)
def _(t):
    return latest.latest_group(
        t.orders, "o_orderpriority", ["o_orderstatus", "o_custkey"], "o_orderdate", "last_day", ["o_orderstatus", "o_custkey"]
    )


@check(
    "g17_group_max_on_latest",
    """SELECT a.o_custkey, a.o_orderkey, b.top_price, b.top_status FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) a
       LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top_price, max(o_orderstatus) AS top_status FROM orders GROUP BY 1) b
       ON a.o_custkey = b.o_custkey WHERE a.rn = 1""",
)
def _(t):
    marked = windows.with_group_max(t.orders, "o_custkey", {"o_totalprice": "top_price", "o_orderstatus": "top_status"})
    return latest.latest_per_key(marked, "o_custkey", ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "top_price", "top_status"
    )


@check(
    "g18_greatest_case",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN a >= b AND a >= c THEN a WHEN b >= a AND b >= c THEN b ELSE c END AS top FROM
       (SELECT *, l_quantity AS a, l_linenumber * 10.0::DOUBLE AS b, CASE WHEN l_returnflag <> 'R' THEN 25.0::DOUBLE END AS c FROM lineitem)""",
)
def _(t):
    third = F.when(F.col("l_returnflag") != "R", F.lit(25.0))
    top = greatest_case(F.col("l_quantity"), F.col("l_linenumber") * F.lit(10.0), third)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", top.alias("top"))


@check(
    "g19_hourly_sum",
    f"""SELECT event_type, user_id, date_trunc('hour', ts) AS hour, {dsum('value')} AS total FROM events
        WHERE event_type IN ('click', 'view') GROUP BY ALL""",
)
def _(t):
    rows = t.events.filter(F.col("event_type").isin("click", "view")).withColumn("value", money("value"))
    out = aggregate.hourly_sum(rows, "ts", ["event_type", "user_id"], "value", "total")
    return out.withColumn("total", F.col("total").cast("double"))


@check(
    "g20_activity_report",
    """SELECT CAST(ts AS DATE) AS day, event_type AS event_name, count(*) AS event_count, count(DISTINCT user_id) AS total_users,
              count(DISTINCT (user_id, date_trunc('hour', ts))) AS sessions
       FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1, 2""",
)
def _(t):
    return aggregate.activity_report(
        t.events,
        {"day": F.to_date("ts"), "event_name": F.col("event_type")},
        "user_id",
        F.struct("user_id", F.date_trunc("hour", "ts")),
        "ts",
        "2024-01-05",
        "2024-01-20",
    )


@check(
    "g21_nest_children",
    """SELECT o.o_orderkey, 0 AS page, l.items FROM orders o LEFT JOIN
       (SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR), ','
               ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey""",
)
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    nested = aggregate.nest_children(
        t.orders.select("o_orderkey"),
        lines,
        "o_orderkey",
        ["l_linenumber", "l_partkey"],
        ["l_linenumber", "l_partkey", "l_suppkey"],
    )
    text = F.transform("records", lambda r: F.concat_ws(":", r["l_linenumber"], r["l_partkey"]))
    return nested.select("o_orderkey", "page", F.array_join(text, ",").alias("items"))
