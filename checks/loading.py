"""Incremental loading, quality checks, reconciliation and streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import check
from ledgerlake.operators import incremental, quality
from ledgerlake.session import fresh_path
from ledgerlake.sources import sinks
from ledgerlake.streaming import landing

NOW = dt.datetime(2024, 3, 9, 10, 30, 0)


@check("n1_high_watermark", "SELECT max(ts) AS high_watermark, max(date_trunc('second', ts)) AS from_text FROM events")
def _(t):
    text = t.events.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    from_text = incremental.high_watermark(text, "ts").scalar()
    return incremental.high_watermark(t.events, "ts").withColumn("from_text", from_text)


@check("n1_watermark_of_table", "SELECT max(ts) AS by_day, max(event_id) AS by_statistics FROM events")
def _(t):
    """The newest day only, and the files' statistics only."""
    path = fresh_path(t.spark, "history")
    sinks.land(t.events.select("event_id", "ts", F.date_format("ts", "yyyyMMdd").alias("date")), path)
    marks = incremental.high_watermark_of(t.spark, path, "ts", "date"), incremental.high_watermark_of(t.spark, path, "event_id")
    return t.spark.createDataFrame([marks], "by_day timestamp_ntz, by_statistics bigint")


@check(
    "n2_delta",
    """SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15' AND event_type <> 'error'""",
)
def _(t):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10", "2024-01-15"))
    return incremental.delta(t.events, "ts", start, end, F.col("event_type") != "error").select("event_id", "user_id")


@check(
    "n3_append_delta",
    """SELECT event_id, strftime(ts, '%Y%m%d') AS date FROM events WHERE ts < TIMESTAMP '2024-01-15'
       UNION ALL SELECT event_id, strftime(ts, '%Y%m%d') FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-14'""",
)
def _(t):
    """Two loads whose boundary day overlaps: the overlap is stored twice, as in any ``>=`` load."""
    path = fresh_path(t.spark, "history")
    rows = t.events.select("event_id", "ts")
    bound = lambda x: F.lit(x).cast("timestamp_ntz")
    incremental.append_delta(incremental.delta(rows, "ts", None, bound("2024-01-15")), path, "ts", NOW)
    incremental.append_delta(incremental.delta(rows, "ts", bound("2024-01-14")), path, "ts", NOW)
    return t.spark.read.schema("event_id bigint, date string").parquet(path)


@check(
    "n4_current_state",
    "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def _(t):
    state = incremental.current_state(t.events, "user_id", "ts", ["event_id"])
    return state.select("user_id", "event_id", "event_type", "value")


@check(
    "n5_plan_days",
    """WITH stored AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click' AND value > 20),
            span AS (SELECT CAST(unnest(generate_series(DATE '2024-02-05' - 29, DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS day)
       SELECT day FROM span WHERE day NOT IN (SELECT day FROM stored) UNION SELECT max(day) FROM stored""",
)
def _(t):
    stored = t.events.filter("event_type = 'click' AND value > 20").select(F.to_date("ts").alias("day"))
    return incremental.plan_days(stored, dt.date(2024, 2, 5))


@check(
    "n6_balanced_slices",
    """WITH b AS (SELECT (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) AS m FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-02'),
            lv AS (SELECT unnest(range(0, 13)) AS level),
            tree AS (SELECT level, CAST(floor(CAST(m AS HUGEINT) * (1 << level) // CAST(2764800000000 AS HUGEINT)) AS BIGINT) AS slice, count(*) AS n FROM b, lv GROUP BY 1, 2)
       SELECT make_timestamp(epoch_us(TIMESTAMP '2024-01-01') + t.slice * (2764800000000 // (1 << t.level))) AS slice_start,
              make_timestamp(epoch_us(TIMESTAMP '2024-01-01') + (t.slice + 1) * (2764800000000 // (1 << t.level))) AS slice_end, t.n AS rows
       FROM tree t LEFT JOIN tree p ON p.level = t.level - 1 AND p.slice = t.slice // 2
       WHERE (t.level = 0 OR p.n >= 40) AND (t.n < 40 OR t.level = 12)""",
)
def _(t):
    return incremental.balanced_slices(
        t.events, "ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2), max_rows=40, depth=12
    )


@check(
    "n8_upsert",
    """SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def _(t):
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    state = incremental.current_state(t.events.filter(F.col("ts") < middle), "user_id", "ts", ["event_id"])
    merged = incremental.upsert(state, t.events.filter(F.col("ts") >= middle), "user_id", "ts", ["event_id"])
    return merged.select("user_id", "event_id")


SIDES = """a AS (SELECT CAST(o_orderdate AS DATE) AS createddate, count(o_orderkey) AS n FROM orders GROUP BY 1),
           b AS (SELECT CAST(o_orderdate AS DATE) AS createddate, count(o_orderkey) AS n FROM orders
                 WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)"""


def lake_orders(t):
    keys = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.join(keys, "o_orderkey", "left_semi")


@check(
    "q1_reconcile_by_date",
    f"""WITH {SIDES}, j AS (SELECT coalesce(a.createddate, b.createddate) AS createddate, a.n AS id_count_source, b.n AS id_count_lake,
            coalesce(a.n = b.n, false) AS match FROM a FULL JOIN b ON a.createddate = b.createddate)
        SELECT *, (SELECT bool_and(match) FROM j) AS all_match FROM j""",
)
def _(t):
    dated = lambda df: df.withColumn("createddate", F.to_date("o_orderdate"))
    return quality.reconcile_counts(dated(t.orders), dated(lake_orders(t)), "createddate", "o_orderkey")


@check(
    "q2_reconcile_by_type",
    """WITH s AS (SELECT CAST(o_orderdate AS DATE) AS createddate, CASE o_orderpriority WHEN '5-LOW' THEN 'Unknown' ELSE o_orderpriority END AS type,
                    CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS open_closed, o_orderkey FROM orders),
            a AS (SELECT createddate, type, open_closed, count(*) AS n FROM s GROUP BY ALL),
            b AS (SELECT createddate, type, open_closed, count(*) AS n FROM s WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL),
            j AS (SELECT coalesce(a.createddate, b.createddate) AS createddate, coalesce(a.type, b.type) AS type,
                    coalesce(a.open_closed, b.open_closed) AS open_closed, a.n AS id_count_source, b.n AS id_count_lake, coalesce(a.n = b.n, false) AS match
                  FROM a FULL JOIN b ON a.createddate = b.createddate AND a.type = b.type AND a.open_closed = b.open_closed)
       SELECT *, (SELECT bool_and(match) FROM j) AS all_match FROM j""",
)
def _(t):
    def typed(df):
        kind = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("")
        closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
        return df.select(
            F.to_date("o_orderdate").alias("createddate"),
            F.coalesce(F.nullif(kind, F.lit("")), F.lit("Unknown")).alias("type"),
            F.when(closed.isNull(), "OPEN").otherwise("CLOSED").alias("open_closed"),
            F.col("o_orderkey").alias("id"),
        )

    return quality.reconcile_counts(typed(t.orders), typed(lake_orders(t)), ["createddate", "type", "open_closed"])


@check(
    "q3_reconcile_renamed",
    f"""WITH {SIDES.replace('FROM orders GROUP', "FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP")},
        j AS (SELECT coalesce(a.createddate, b.createddate) AS createddate, a.n AS id_count_source, b.n AS id_count_lake,
            coalesce(a.n = b.n, false) AS match FROM a FULL JOIN b ON a.createddate = b.createddate)
        SELECT *, (SELECT bool_and(match) FROM j) AS all_match FROM j""",
)
def _(t):
    """Both sides hold the same orders, the source under another id name: every group matches."""
    lake = lake_orders(t).select(F.to_date("o_orderdate").alias("createddate"), F.col("o_orderkey").alias("id"))
    source = lake.withColumnRenamed("id", "AccountId")
    return quality.reconcile_counts(source, lake, "createddate", rename={"AccountId": "id"})


@check(
    "q4_date_profile",
    """SELECT o_orderkey, o_orderdate, day(o_orderdate) AS day, month(o_orderdate) AS month, quarter(o_orderdate) AS quarter, year(o_orderdate) AS year FROM orders""",
)
def _(t):
    return quality.date_profile(t.orders, "o_orderdate", ["o_orderkey"])


@check("q5_validate_copy", "SELECT true AS same, false AS shorter, count(*) AS rows FROM customer")
def _(t):
    path = fresh_path(t.spark, "copy")
    sinks.land(t.customer, path, "overwrite", ())
    copy = t.spark.read.parquet(path)
    same = quality.validate_copy(t.customer, copy)
    shorter = quality.validate_copy(t.customer, copy.filter("c_acctbal > 0"))
    return t.spark.createDataFrame(
        [(same["ok"], shorter["ok"], same["rows"][1])], "same boolean, shorter boolean, rows bigint"
    )


@check(
    "q5_validate_contents",
    "SELECT true AS shuffled, false AS one_cell, false AS twice, count(*) AS rows FROM customer",
)
def _(t):
    """A copy in another order of rows and columns passes; one changed cell, or one row in place of another, does not."""
    rows = t.customer
    last = rows.agg(F.max("c_custkey")).scalar()
    shuffled = rows.repartition(7, "c_name").select(*reversed(rows.columns))
    one_cell = rows.withColumn("c_acctbal", F.when(F.col("c_custkey") == last, F.col("c_acctbal") + 0.01).otherwise(F.col("c_acctbal")))
    twice = rows.filter(F.col("c_custkey") != last).unionByName(rows.filter(F.col("c_custkey") == last - 1))
    verdicts = [quality.validate_copy(rows, copy) for copy in (shuffled, one_cell, twice)]
    found = (*(v["ok"] for v in verdicts), verdicts[2]["rows"][1])
    return t.spark.createDataFrame([found], "shuffled boolean, one_cell boolean, twice boolean, rows bigint")


@check("q6_check_partitions", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    quality.check_partitions(t.orders, ["o_orderstatus", "o_orderdate"])
    try:
        quality.check_partitions(t.orders.withColumn("d", F.nullif("o_orderstatus", F.lit("P"))), ["d"])
    except ValueError:
        return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    raise AssertionError("nulls in a partition column must be refused")


@check(
    "q8_global_match",
    "SELECT o_orderkey, o_totalprice > 0 AS positive, (SELECT bool_and(o_totalprice > 0) FROM orders) AS all_match FROM orders",
)
def _(t):
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") > 0).alias("positive"))
    return quality.with_global_match(rows, "positive")


@check("q8_equal_contents", "SELECT c_custkey, true AS copied, false AS changed FROM customer")
def _(t):
    """The verdict over whole tables, as a column on every row."""
    path = fresh_path(t.spark, "copy")
    sinks.land(t.customer, path, "overwrite", ())
    copy = t.spark.read.parquet(path)
    changed = copy.withColumn("c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")))
    rows = quality.with_equal_contents(t.customer, copy, "copied")
    return rows.withColumn("changed", F.lit(quality.same_contents(t.customer, changed)[0])).select("c_custkey", "copied", "changed")


def event_stream(t):
    return landing.stream_files(t.spark, t.folder, t.events.schema, glob="events.parquet")


@check("st1_stream_land", "SELECT event_id, user_id, ts, event_type FROM events")
def _(t):
    """Two runs over the same folder: the second finds nothing new."""
    dst, checkpoint = fresh_path(t.spark, "landed"), fresh_path(t.spark, "progress")
    rows = event_stream(t).select("event_id", "user_id", "ts", "event_type")
    for _ in range(2):
        landing.stream_land(rows, dst, checkpoint, ["event_type"])
    return t.spark.read.schema(rows.schema).parquet(dst)


@check("st2_stream_dedupe", "SELECT event_id, user_id, ts FROM events")
def _(t):
    """Every event arrives twice; one copy is kept."""
    dst, checkpoint = fresh_path(t.spark, "deduped"), fresh_path(t.spark, "progress")
    twice = event_stream(t).select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")
    )
    landing.stream_land(landing.stream_dedupe(twice, "event_id", "ts", "40 days").drop("copy"), dst, checkpoint)
    return t.spark.read.schema("event_id bigint, user_id bigint, ts timestamp").parquet(dst)


@check(
    "st3_stream_upsert",
    "SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def _(t):
    """Early and late events arrive in two batches of many files; the state is the latest event per user."""
    src, target, checkpoint = (fresh_path(t.spark, n) for n in ("changes", "state", "progress"))
    rows = t.events.select("user_id", "event_id", "ts")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for part in (early, ~early):
        rows.filter(part).write.mode("append").parquet(src)
        # the second run finds the files of the second write only
        stream = landing.stream_files(t.spark, src, rows.schema)
        landing.stream_upsert(stream, "user_id", "ts", target, checkpoint, ["event_id"], buckets=8)
    return landing.read_state(t.spark, target, rows.schema)
