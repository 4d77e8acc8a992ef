"""Latest rows and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, dec, dsum
from ledgerlake.operators import aggregate, joins, latest, predicates, windows

LAST = "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)"


def money(col: str):
    return F.col(col).cast("decimal(18,2)")


#: Rows of a chunk where a window is cut at quantiles; the hottest key decides how many chunks there are.
PER_CHUNK = 100_000

@check("w1_latest_per_key", f"SELECT * EXCLUDE (rn) FROM (SELECT *, {LAST} AS rn FROM orders) WHERE rn = 1")
def _(t):
    return latest.latest_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"])


@check(
    "w2_first_per_key",
    """SELECT o_custkey, o_orderstatus, o_orderkey, o_orderdate FROM
       (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderdate")
    return latest.first_per_key(rows, ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])


@check(
    "w3_rank_both",
    f"""SELECT o_orderkey, o_custkey, {LAST} AS rn,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn_first FROM orders""",
)
def _(t):
    ranked = windows.rank_both(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], grain="year")
    return ranked.select("o_orderkey", "o_custkey", "rn", "rn_first")


@check(
    "w4_latest_with_date_floor",
    """SELECT o_custkey, o_orderkey, stamp FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey
            ORDER BY coalesce(nullif(trim(stamp), ''), '1900-01-01 00:00:00') DESC, o_orderkey DESC) AS rn FROM (
           SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN NULL
                  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS stamp FROM orders)) WHERE rn = 1""",
)
def _(t):
    stamp = F.when(F.col("o_orderstatus") == "P", "").when(
        F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    rows = t.orders.select("o_custkey", "o_orderkey", stamp.alias("stamp"))
    return latest.latest_per_key(rows, "o_custkey", ["stamp", "o_orderkey"], floored=["stamp"])


@check(
    "w5_latest_not_blank",
    """SELECT user_id, event_id, tag FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM
           (SELECT *, CASE event_type WHEN 'view' THEN '' WHEN 'error' THEN NULL ELSE event_type END AS tag FROM events)
         WHERE tag IS NOT NULL AND tag <> '') WHERE rn = 1""",
)
def _(t):
    tag = F.when(F.col("event_type") == "view", "").when(F.col("event_type") != "error", F.col("event_type"))
    rows = t.events.withColumn("tag", tag).filter(predicates.not_blank("tag"))
    return latest.latest_per_key(rows, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "tag")


@check(
    "w6_first_of_first",
    """WITH f AS (SELECT o.o_custkey, l.l_orderkey, l.l_shipdate, l.l_linenumber, l.l_partkey,
                  row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_partkey) AS rn
                  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
       SELECT o_custkey, l_orderkey, l_shipdate FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS r2
         FROM f WHERE rn = 1) WHERE r2 = 1""",
)
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey"
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    return latest.first_of_first(joined, "l_orderkey", "o_custkey", order).select("o_custkey", "l_orderkey", "l_shipdate")


@check(
    "w7_group_totals",
    f"""SELECT o_orderkey, o_custkey, CAST(sum({dec('o_totalprice')}) OVER (PARTITION BY o_custkey) AS DOUBLE) AS spent,
               count(*) OVER (PARTITION BY o_custkey) AS n, max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_day FROM orders""",
)
def _(t):
    totals = windows.with_group_totals(
        t.orders,
        "o_custkey",
        {
            "spent": F.sum(money("o_totalprice")).cast("double"),
            "n": F.count("*"),
            "last_day": F.max("o_orderdate"),
        },
    )
    return totals.select("o_orderkey", "o_custkey", "spent", "n", "last_day")


@check(
    "w8_conditional_totals",
    f"""SELECT o_orderkey,
          count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS n_urgent,
          CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN {dec('o_totalprice')} END) OVER (PARTITION BY o_custkey) AS DOUBLE) AS high_total,
          max(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END) OVER (PARTITION BY o_custkey) AS last_filled FROM orders""",
)
def _(t):
    out = windows.window_agg_if(
        t.orders,
        "o_custkey",
        {
            "n_urgent": ("count", F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey")),
            "high_total": ("sum", F.col("o_orderpriority") == "2-HIGH", money("o_totalprice")),
            "last_filled": ("max", F.col("o_orderstatus") == "F", F.col("o_orderdate")),
        },
    )
    return out.select("o_orderkey", "n_urgent", F.col("high_total").cast("double").alias("high_total"), "last_filled")


@check(
    "w9_global_window",
    "SELECT p_partkey, max(p_size) OVER () AS top_size, max(p_retailprice) OVER () AS top_price FROM part",
)
def _(t):
    return windows.with_global(
        t.part.select("p_partkey", "p_size", "p_retailprice"),
        {"top_size": F.max("p_size"), "top_price": F.max("p_retailprice")},
    ).select("p_partkey", "top_size", "top_price")


@check(
    "w10_running_sum",
    f"""SELECT o_orderkey, o_custkey, CAST(sum({dec('o_totalprice')}) OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", money("o_totalprice").alias("amount"))
    out = windows.running_sum(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "amount", "running", grain="year")
    return out.select("o_orderkey", "o_custkey", F.col("running").cast("double").alias("running"))


@check(
    "w11_latest_running_sum",
    f"""SELECT o_custkey, o_orderdate, o_orderkey, running FROM (
          SELECT *, CAST(sum({dec('o_totalprice')}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS running,
                 {LAST} AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    rows = t.orders.withColumn("amount", money("o_totalprice"))
    out = windows.latest_running_sum(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "amount", "running")
    return out.withColumn("running", F.col("running").cast("double"))


@check(
    "w12_with_next",
    """SELECT o_orderkey, lead(o_orderdate) OVER w AS next_day, lead(o_orderkey) OVER w AS next_key FROM orders
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t):
    out = windows.with_next(
        t.orders,
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        {"o_orderdate": "next_day", "o_orderkey": "next_key"},
        grain="year",
    )
    return out.select("o_orderkey", "next_day", "next_key")


@check("w3_rank_both_quantiles", """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY CASE WHEN value < 90 THEN props END DESC NULLS LAST, event_id DESC) AS rn,
               row_number() OVER (PARTITION BY event_type ORDER BY CASE WHEN value < 90 THEN props END NULLS LAST, event_id) AS rn_first FROM events""")
def _(t):
    """Few keys, an order column of many nulls and ties: chunks are cut at quantiles."""
    rows = t.events.select("event_id", "event_type", F.when(F.col("value") < 90, F.col("props")).alias("tag"))
    ranked = windows.rank_both(rows, "event_type", ["tag", "event_id"], rows_per_chunk=PER_CHUNK)
    return ranked.select("event_id", "rn", "rn_first")


@check(
    "w10_running_sum_quantiles",
    f"""SELECT o_orderkey, CAST(sum({dec('o_totalprice')}) OVER (PARTITION BY o_orderpriority
          ORDER BY CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END NULLS LAST, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM orders""",
)
def _(t):
    day = F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")).alias("day")
    rows = t.orders.select("o_orderkey", "o_orderpriority", day, money("o_totalprice").alias("amount"))
    out = windows.running_sum(rows, "o_orderpriority", ["day", "o_orderkey"], "amount", "running", rows_per_chunk=PER_CHUNK)
    return out.select("o_orderkey", F.col("running").cast("double").alias("running"))


@check(
    "w12_with_next_quantiles",
    """SELECT event_id, lead(event_id) OVER (PARTITION BY event_type ORDER BY CASE WHEN value < 90 THEN props END NULLS LAST, event_id) AS next_id FROM events""",
)
def _(t):
    rows = t.events.select("event_id", "event_type", F.when(F.col("value") < 90, F.col("props")).alias("tag"))
    return windows.with_next(rows, "event_type", ["tag", "event_id"], {"event_id": "next_id"}, rows_per_chunk=PER_CHUNK).select("event_id", "next_id")


@check(
    "w13_first_last_value",
    """SELECT o_orderkey, first_value(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS first_status,
              first_value(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS last_price FROM orders""",
)
def _(t):
    order = F.struct("o_orderdate", "o_orderkey")
    first = windows.first_value_by(t.orders, "o_custkey", order, {"o_orderstatus": "first_status"})
    both = windows.first_value_by(first, "o_custkey", order, {"o_totalprice": "last_price"}, last=True)
    return both.select("o_orderkey", "first_status", "last_price")


@check(
    "w14_count_after_distinct",
    """SELECT user_id, event_type, count(event_type) OVER (PARTITION BY user_id) AS kinds FROM (SELECT DISTINCT user_id, event_type FROM events)""",
)
def _(t):
    pairs = t.events.select("user_id", "event_type").distinct()
    return windows.with_group_totals(pairs, "user_id", {"kinds": F.count("event_type")})


@check(
    "w15_any_over",
    """SELECT o_orderkey, max(o_orderstatus = 'F' AND o_totalprice > 300000) OVER (PARTITION BY o_custkey) AS has_large,
              max(o_orderpriority = '1-URGENT') OVER (PARTITION BY o_custkey) AS has_urgent FROM orders""",
)
def _(t):
    out = windows.any_over(
        t.orders,
        "o_custkey",
        {
            "has_large": (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000),
            "has_urgent": F.col("o_orderpriority") == "1-URGENT",
        },
    )
    return out.select("o_orderkey", "has_large", "has_urgent")


@check(
    "w16_dedupe_events",
    """SELECT user_id, event_type, hour, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, hour ORDER BY ts DESC, event_id DESC) AS rn
       FROM (SELECT *, date_trunc('hour', ts) AS hour FROM events)) WHERE rn = 1""",
)
def _(t):
    rows = t.events.withColumn("hour", F.date_trunc("hour", "ts"))
    out = latest.dedupe_events(rows, ["user_id", "event_type", "hour"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "hour", "event_id")


@check(
    "w17_latest_extract",
    "SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def _(t):
    return latest.latest_extract(t.events, "user_id", "ts", ["event_id"]).select("user_id", "event_id", "ts")


@check(
    "w18_latest_per_name",
    """SELECT o_orderpriority, o_custkey, last_day FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY last_day DESC, o_custkey DESC) AS rn
       FROM (SELECT o_orderpriority, o_custkey, max(o_orderdate) AS last_day FROM orders GROUP BY 1, 2)) WHERE rn = 1""",
)
def _(t):
    return latest.latest_group(t.orders, "o_orderpriority", "o_custkey", "o_orderdate", "last_day", ["o_custkey"])


@check(
    "customer_activity_report",
    f"""WITH f AS (SELECT o_custkey, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY 1),
             s AS (SELECT o_custkey,
                     CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN {dec('o_totalprice')} END) AS DOUBLE) AS urgent_total,
                     CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN {dec('o_totalprice')} END) AS DOUBLE) AS low_total
                   FROM orders GROUP BY 1),
             d AS (SELECT o_custkey, max(l_shipdate) AS last_return FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                   WHERE l_returnflag = 'R' GROUP BY 1),
             r AS (SELECT o_custkey, o_orderstatus AS last_status FROM (SELECT *, {LAST} AS rn FROM orders) WHERE rn = 1)
        SELECT c.c_custkey, strftime(first_day, '%d/%m/%Y %H:%M') AS first_order, strftime(last_day, '%d/%m/%Y %H:%M') AS last_order,
               strftime(last_return, '%d/%m/%Y %H:%M') AS last_return, last_status, urgent_total, low_total
        FROM customer c LEFT JOIN f ON f.o_custkey = c.c_custkey LEFT JOIN s ON s.o_custkey = c.c_custkey
        LEFT JOIN d ON d.o_custkey = c.c_custkey LEFT JOIN r ON r.o_custkey = c.c_custkey""",
)
def _(t):
    """Per customer: first and last order, last return, last status and sums per priority."""
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    span = orders.groupBy("c_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    sums = aggregate.pivot_sum(
        orders,
        "c_custkey",
        {
            "urgent_total": F.col("o_orderpriority") == "1-URGENT",
            "low_total": F.col("o_orderpriority") == "5-LOW",
        },
        money("o_totalprice"),
    )
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    returns = (
        orders.select("c_custkey", "o_orderkey")
        .join(returned, "o_orderkey")
        .groupBy("c_custkey")
        .agg(F.max("l_shipdate").alias("last_return"))
    )
    status = latest.latest_per_key(orders, "c_custkey", ["o_orderdate", "o_orderkey"]).select(
        "c_custkey", F.col("o_orderstatus").alias("last_status")
    )
    report = joins.left_join_all(t.customer.select("c_custkey"), [span, sums, returns, status], "c_custkey")
    dates = ("first_order", "last_order", "last_return")
    return report.withColumns(
        {
            **{c: F.date_format(c, "dd/MM/yyyy HH:mm") for c in dates},
            **{c: F.col(c).cast("double") for c in ("urgent_total", "low_total")},
        }
    )
