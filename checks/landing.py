"""Sources, sinks and jobs, checked by writing a driver table to the shared folder and reading it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import check
from ledgerlake.operators import incremental
from ledgerlake.plans import jobs
from ledgerlake.session import fresh_path
from ledgerlake.sources import readers, sinks

DAY = dt.date(2024, 3, 9)


@check(
    "s1_parameterised_sql",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice >= 200000 AND o_orderstatus = 'F' GROUP BY 1",
)
def _(t):
    return readers.read_sql(
        t.spark,
        "SELECT o_orderpriority, count(*) AS n FROM {orders} WHERE o_totalprice >= :floor AND o_orderstatus = :status GROUP BY 1",
        {"floor": 200000, "status": "F"},
        orders=t.orders,
    )


@check("s2_sql_file", "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY 1")
def _(t):
    path = fresh_path(t.spark, "sql")
    query = "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS top FROM {customer} GROUP BY 1;"
    t.spark.createDataFrame([(query,)], "value string").coalesce(1).write.text(path)
    return readers.read_sql_file(t.spark, path, customer=t.customer)


@check(
    "s3_parquet_schema_merge",
    """SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer""",
)
def _(t):
    path = fresh_path(t.spark, "merge")
    sinks.land(t.customer.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_acctbal"), path, partition_by=())
    sinks.land(t.customer.filter("c_acctbal < 0").select("c_custkey", "c_name"), path, partition_by=())
    return readers.read_parquet(t.spark, path)


@check("s4_tolerant_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'")
def _(t):
    path = fresh_path(t.spark, "csv")
    broken = F.when(F.col("c_mktsegment") == "BUILDING", "broken").otherwise(F.col("c_acctbal").cast("string"))
    t.customer.select("c_custkey", "c_name", broken.alias("c_acctbal")).write.option("header", True).csv(path)
    return readers.read_csv_tolerant(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@check("s5_mixed_encodings", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || 'é' AS p_name FROM part")
def _(t):
    folders = []
    parts = {"UTF-8": "p_size < 20", "ISO-8859-1": "p_size BETWEEN 20 AND 35", "UTF-16": "p_size > 35"}
    for encoding, rows in parts.items():
        folders.append(fresh_path(t.spark, "enc"))
        named = t.part.filter(rows).select("p_partkey", F.concat("p_name", F.lit("é")).alias("p_name"))
        named.write.option("header", True).option("encoding", encoding).csv(folders[-1])
    return readers.read_csv_any_encoding(t.spark, folders)


@check("s6_csv_archive", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def _(t):
    path = fresh_path(t.spark, "gz")
    t.orders.select("o_orderkey", "o_orderpriority").write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_csv_archive(t.spark, path, ["o_orderkey", "o_orderpriority"]).drop("path", "member")


@check(
    "s7_file_backlog",
    """SELECT 'Visits_' || o_orderkey || '_' || strftime(o_orderdate, '%d_%m_%Y') || '.zip' AS file_name, CAST(o_orderdate AS DATE) AS file_date
       FROM orders WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) >= DATE '2001-07-20' - 30""",
)
def _(t):
    head = F.when(F.col("o_orderstatus") == "P", "Other_").otherwise("Visits_")
    listing = t.orders.select(
        F.concat(head, "o_orderkey", F.lit("_"), F.date_format("o_orderdate", "dd_MM_yyyy"), F.lit(".zip")).alias("file_name")
    )
    return readers.backlog_of(listing, "file_name", "Visits_", 30, dt.date(2001, 7, 20))


@check(
    "s8_csv_tree",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority FROM orders",
)
def _(t):
    base = fresh_path(t.spark, "tree")
    for status, columns in (("F", ["o_orderkey", "o_orderpriority"]), ("O", ["o_orderkey"]), ("P", ["o_orderkey"])):
        rows = t.orders.filter(F.col("o_orderstatus") == status).select(*columns)
        rows.write.option("header", True).csv(f"{base}/date=2024010{len(columns)}/{status}")
    return readers.read_csv_tree(t.spark, base).drop("source_path")


@check("s9_json_lines", "SELECT event_id, ts, event_type FROM events")
def _(t):
    path = fresh_path(t.spark, "jsonl")
    sinks.write_jsonl(t.events.select("event_id", "ts", "event_type"), path)
    return readers.read_jsonl(t.spark, path, "event_id bigint, ts timestamp_ntz, event_type string")


@check("s10_json_array", "SELECT n_regionkey, n_nationkey, n_name FROM nation")
def _(t):
    """One JSON array file per region (five regions, a fixed dimension)."""
    path = fresh_path(t.spark, "array")
    arrays = t.nation.groupBy("n_regionkey").agg(F.collect_list(F.struct("n_regionkey", "n_nationkey", "n_name")).alias("rows"))
    arrays.select(F.to_json("rows").alias("value"), F.col("n_regionkey").alias("r")).write.partitionBy("r").text(path)
    return readers.read_json_array(t.spark, path, "n_regionkey int, n_nationkey int, n_name string").drop("r")


@check(
    "s11_partitioned_sink",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS load, o_orderstatus FROM orders""",
)
def _(t):
    """Dynamic overwrite replaces one partition and leaves the others."""
    path = fresh_path(t.spark, "sink")
    rows = t.orders.select("o_orderkey", F.lit("old").alias("load"), "o_orderstatus")
    sinks.land(rows, path, "overwrite", ["o_orderstatus"])
    sinks.land(rows.filter("o_orderstatus = 'F'").withColumn("load", F.lit("new")), path, "overwrite_partitions", ["o_orderstatus"])
    return t.spark.read.parquet(path)


@check("s12_csv_sink", "SELECT s_suppkey, s_name || ', \"' || 'Ltd' AS s_name, s_acctbal FROM supplier")
def _(t):
    path = fresh_path(t.spark, "csvsink")
    rows = t.supplier.select("s_suppkey", F.concat("s_name", F.lit(', "Ltd')).alias("s_name"), "s_acctbal")
    sinks.land(rows, path, "overwrite", (), fmt="csv")
    reader = t.spark.read.option("header", True).option("escape", "\\")
    return reader.schema("s_suppkey bigint, s_name string, s_acctbal double").csv(path)


@check(
    "s13_report_csv",
    "SELECT c_mktsegment, count(*) AS n, max(c_name) AS last_name FROM customer GROUP BY 1",
)
def _(t):
    path = fresh_path(t.spark, "report")
    report = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.max("c_name").alias("last_name"))
    sinks.write_report_csv(report, path, order_by=["c_mktsegment"])
    return t.spark.read.option("header", True).schema("c_mktsegment string, n bigint, last_name string").csv(path)


@check("s14_fallback_sink", "SELECT c_custkey, c_name FROM customer")
def _(t):
    """A write that fails (append to a file where a folder should be) ends up under ``_fallback``."""
    path = fresh_path(t.spark, "fallback")
    rows = t.customer.select("c_custkey", "c_name")
    try:
        sinks.land(rows, path, "append", ["absent_column"], fallback=True)
    except Exception:
        return t.spark.read.schema(rows.schema).json(f"{path}_fallback")
    raise AssertionError("the write should have failed")


@check("s16_day_files", "SELECT event_id, strftime(ts, '%d-%m-%Y') AS day FROM events")
def _(t):
    path = fresh_path(t.spark, "day")
    sinks.land_by_day(t.events.select("event_id", "ts"), "ts", path)
    return t.spark.read.parquet(path).select("event_id", "day")


@check("s17_batches", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    path = fresh_path(t.spark, "batches")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.land(rows, path, "overwrite", ["o_orderstatus"])
    large = t.orders.filter("o_totalprice >= 200000").select(*rows.columns)
    small = t.orders.filter("o_totalprice < 200000").select(*rows.columns)
    sinks.land_batches([large, small], path, ["o_orderstatus"], overwrite_first=True)
    return t.spark.read.parquet(path)


@check(
    "s18_csv_to_parquet",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderdate AS order_date, o_totalprice, o_orderpriority FROM orders",
)
def _(t):
    base, out = fresh_path(t.spark, "src"), fresh_path(t.spark, "dst")
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_date"), "o_totalprice", "o_orderpriority")
    rows.write.option("header", True).csv(f"{base}/date=20240101")
    jobs.csv_to_parquet(t.spark, base, out)
    return t.spark.read.parquet(out)


@check(
    "s19_publish_datasets",
    "SELECT c_custkey, c_mktsegment, '2024-03-09' AS date FROM customer",
)
def _(t):
    """Two datasets are configured; the broken one is skipped and the other is published."""
    base = fresh_path(t.spark, "curated")
    catalog = {"c_custkey": {"type": "bigint", "comment": "Customer"}, "c_mktsegment": {"type": "string", "comment": "Segment"}}
    config = {
        "broken": {"query": "SELECT no_such_column FROM {customer}", "catalog": catalog},
        "segments": {"query": "SELECT c_custkey, c_mktsegment FROM {customer}", "catalog": catalog},
    }
    jobs.publish(t.spark, config, base, DAY, customer=t.customer)
    return t.spark.read.schema("c_custkey bigint, c_mktsegment string, date string").parquet(f"{base}/segments")


@check("s21_skip_empty", "SELECT 0 AS empty_rows, false AS empty_written, count(*) AS rows, true AS written FROM customer")
def _(t):
    path = fresh_path(t.spark, "empty")
    none = sinks.land(t.customer.filter("c_name IS NULL"), path, "append", (), skip_empty=True)
    some = sinks.land(t.customer, path, "append", (), skip_empty=True)
    return t.spark.createDataFrame(
        [(none["rows"], none["written"], some["rows"], some["written"])],
        "empty_rows int, empty_written boolean, rows bigint, written boolean",
    )


@check("s22_column_comments", "SELECT 'c_custkey' AS name, 'Customer number' AS comment, count(*) AS rows FROM customer")
def _(t):
    path = fresh_path(t.spark, "comments")
    sinks.land(t.customer, path, "overwrite", (), comments={"c_custkey": "Customer number"})
    back = t.spark.read.parquet(path)
    found = [(f.name, f.metadata["comment"]) for f in back.schema.fields if "comment" in f.metadata]
    notes = t.spark.createDataFrame(found, "name string, comment string")
    return notes.withColumn("rows", back.agg(F.count(F.lit(1))).scalar())


@check(
    "s23_manifest_delta",
    """SELECT DISTINCT source || '_' || d.doc_id || '.pdf' AS file_name FROM documents d WHERE lang <> 'en' AND d.doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(t):
    name = F.concat_ws("_", "source", F.concat("doc_id", F.lit(".pdf")))
    wanted = t.documents.filter("lang <> 'en'").select(name.alias("file_name"))
    present = t.labels.join(t.documents, "doc_id").select(name.alias("file_name"))
    return incremental.manifest_delta(wanted, present)


@check(
    "n7_backfill",
    "SELECT event_id, strftime(ts, '%Y%m%d') AS date FROM events",
)
def _(t):
    path = fresh_path(t.spark, "backfill")
    rows = t.events.select("event_id", F.date_format("ts", "yyyyMMdd").alias("date"))
    incremental.backfill(t.events.filter("event_type <> 'view'").select("event_id", F.date_format("ts", "yyyyMMdd").alias("date")), path)
    incremental.backfill(rows, path)
    return t.spark.read.schema("event_id bigint, date string").parquet(path)
