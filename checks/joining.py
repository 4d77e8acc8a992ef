"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, dec, dsum
from ledgerlake.operators import aggregate, joins, setops

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")


@check(
    "j1_inner_join",
    "SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey",
)
def _(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "inner")
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@check(
    "j2_left_join",
    """SELECT c.c_custkey, c.c_name, o.o_orderkey FROM customer c
       LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o ON o.o_custkey = c.c_custkey""",
)
def _(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.left_join_many(t.customer.select("c_custkey", "c_name"), urgent, "c_custkey")


@check(
    "j3_join_required",
    """SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c LEFT JOIN
       (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c.c_nationkey = n.n_nationkey WHERE n.n_name IS NOT NULL""",
)
def _(t):
    nations = t.nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.join_required(t.customer.select("c_custkey", "c_nationkey"), nations, "c_nationkey")


@check(
    "j4_right_join",
    """SELECT n.n_nationkey, n.n_name, c.c_custkey FROM
       (SELECT * FROM customer WHERE c_acctbal > 9900) c RIGHT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def _(t):
    rich = t.customer.filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    return joins.right_join_many(rich, t.nation.select("n_nationkey", "n_name"), "n_nationkey")


@check(
    "j5_full_compare",
    """WITH a AS (SELECT o_orderkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
            b AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT coalesce(a.k, b.k) AS k, a.n AS n_left, b.n AS n_right FROM a FULL JOIN b ON a.k = b.k""",
)
def _(t):
    a = t.orders.filter("o_orderstatus <> 'P'").groupBy(F.col("o_orderkey").alias("k")).agg(F.count("*").alias("n"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    return joins.full_compare(a, b, "k")


@check(
    "j6_multi_key_join",
    """SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey FROM orders o JOIN lineitem l
       ON o.o_orderkey = l.l_orderkey AND o.o_orderdate = l.l_shipdate""",
)
def _(t):
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("day"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("day"), "l_linenumber", "l_partkey"
    )
    return orders.join(lines, ["o_orderkey", "day"]).drop("day")


@check(
    "j7_join_latest",
    """SELECT c.c_custkey, o.o_orderkey, o.o_orderdate FROM customer c LEFT JOIN
       (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) o
       ON o.o_custkey = c.c_custkey AND o.rn = 1""",
)
def _(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    return joins.join_latest(t.customer.select("c_custkey"), orders, "c_custkey", ["o_orderdate", "o_orderkey"])


@check(
    "j8_attach_row",
    """SELECT o.o_orderkey, s.n_orders, s.last_day FROM orders o
       CROSS JOIN (SELECT count(*) AS n_orders, max(o_orderdate) AS last_day FROM orders) s""",
)
def _(t):
    facts = t.orders.agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_day"))
    return joins.attach_row(t.orders.select("o_orderkey"), facts)


@check("j9_attach_scalar", "SELECT o_orderkey, (SELECT max(c_custkey) FROM customer) AS top_customer FROM orders")
def _(t):
    top = t.customer.agg(F.max("c_custkey"))
    return joins.attach_scalar(t.orders.select("o_orderkey"), top, "top_customer")


@check(
    "j10_report_assembly",
    f"""SELECT c.c_custkey, o.n_orders, o.spent, e.n_events FROM customer c
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, {dsum('o_totalprice')} AS spent FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey
        LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1) e ON e.user_id = c.c_custkey""",
)
def _(t):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spent"),
    )
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n_events"))
    return joins.left_join_all(t.customer.select("c_custkey"), [orders, events], "c_custkey")


@check(
    "j11_join_distinct",
    """SELECT o.o_orderkey, o.o_orderstatus, d.l_returnflag FROM orders o JOIN
       (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) d ON d.l_orderkey = o.o_orderkey""",
)
def _(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.join_distinct(
        t.orders.select("o_orderkey", "o_orderstatus"), lines, ["o_orderkey", "l_returnflag"], "o_orderkey"
    )


@check(
    "j12_bridge_join",
    f"""SELECT c.c_custkey, n.n_name, o.o_orderkey, l.l_linenumber, CAST({dec('l.l_extendedprice')} AS DOUBLE) AS price
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
)
def _(t):
    customers = t.customer.withColumnRenamed("c_custkey", "customer_id")
    clients = t.customer.select(F.col("c_custkey").alias("client_id"), F.col("c_nationkey").alias("client_nation"))
    links = {
        "client": ("customer_id", "client_id"),
        "account": ("client_id", "o_custkey"),
        "transaction": ("o_orderkey", "l_orderkey"),
    }
    joined = joins.bridge(customers, clients, t.orders, t.lineitem, links)
    named = joined.join(t.nation, F.col("client_nation") == F.col("n_nationkey"), "left")
    return named.select(
        F.col("customer_id").alias("c_custkey"),
        "n_name",
        "o_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(18,2)").cast("double").alias("price"),
    )


@check(
    "j13_explode_columns",
    "SELECT l_orderkey, l_linenumber, unnest([l_partkey, l_suppkey]) AS reference FROM lineitem",
)
def _(t):
    return joins.explode_columns(t.lineitem, ["l_partkey", "l_suppkey"], "reference", ["l_orderkey", "l_linenumber"])


@check(
    "j14_keep_matching",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def _(t):
    keys = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return joins.keep_matching(t.orders.select("o_orderkey", "o_custkey"), keys, "o_custkey")


@check(
    "u1_union_all",
    "SELECT c_custkey AS id, c_name AS name, 'customer' AS side FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier",
)
def _(t):
    return setops.union_all(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("side")),
            t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("side")),
        ]
    )


@check(
    "u2_stack_tiers",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, '0' AS tier, CAST({dec('l_discount')} AS DOUBLE) AS rate FROM lineitem
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, '1', CAST({dec('l_tax')} AS DOUBLE) FROM lineitem""",
)
def _(t):
    rate = lambda c: F.col(c).cast("decimal(18,2)").cast("double")
    return setops.stack_rows(
        t.lineitem,
        ["l_orderkey", "l_linenumber", "l_partkey"],
        [{"tier": F.lit("0"), "rate": rate("l_discount")}, {"tier": F.lit("1"), "rate": rate("l_tax")}],
    )


@check(
    "u3_union_evolving",
    """SELECT c_custkey AS id, c_mktsegment AS segment, NULL AS balance FROM customer
       UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def _(t):
    return setops.union_evolving(
        [
            t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")),
            t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
        ]
    )


@check("t1_report_order", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return aggregate.report_order(
        rows, [F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last()], ["o_orderkey"]
    )


@check("t2_order_by_ordinal", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.spark.sql(
        "SELECT o_orderstatus, count(*) AS n FROM {orders} GROUP BY 1 ORDER BY 1", orders=t.orders
    )
