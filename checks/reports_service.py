"""Loan, service, valuation, reconciliation and landing reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.bank import plain
from checks.registry import check
from ledgerlake.operators import conform, incremental
from ledgerlake.plans import jobs, loans, service
from ledgerlake.session import fresh_path
from ledgerlake.sources import readers, sinks

NOW = dt.datetime(2024, 3, 9, 10, 30, 0)
TODAY = dt.date(2000, 6, 15)


def loan_tables(t):
    return {
        "psd_form": t.customer.selectExpr(
            "concat('F', c_custkey) AS id", "concat('case', c_custkey) AS case__c", "c_mktsegment AS purpose__c",
            "1.0D AS current_expected_monthly_payment__c", "2.0D AS current_payment_shortfall__c", "3 AS remaining_term_months__c",
            "4 AS months_past_maturity__c", "5.0D AS current_balance_outstanding__c",
        ),
        "mortgage_applications": t.orders.selectExpr(
            "CASE WHEN o_orderstatus <> 'P' THEN concat('case', o_custkey) END AS salesforce_case_id", "concat('app', o_orderkey) AS id",
            "CASE WHEN o_orderpriority <> '5-LOW' THEN concat('L', o_orderkey) END AS loan_account_mambu_id", "o_orderdate AS updated_at",
        ),
        "loan_accounts": t.orders.selectExpr(
            "concat('K', o_orderkey) AS encoded_key", "concat('app', o_orderkey) AS mortgage_app_mortgage_application_id",
            "concat('L', o_orderkey) AS id", "CAST(o_totalprice AS decimal(18,2)) AS balances_principal_balance", "o_orderdate AS last_modified_date",
        ),
        "loan_installments": t.lineitem.selectExpr(
            "concat('K', l_orderkey) AS parent_account_key", "CAST(date_trunc('MONTH', CAST(l_shipdate AS timestamp)) AS date) AS due_date",
            "CASE l_returnflag WHEN 'R' THEN 'PAID' ELSE 'PENDING' END AS state", "CAST(l_extendedprice AS decimal(18,2)) AS principal_amount_due",
            "CASE WHEN l_discount > 0.02 THEN CAST(l_quantity AS decimal(18,2)) END AS interest_amount_due",
            "CASE l_linestatus WHEN 'O' THEN timestamp'2002-01-02' ELSE timestamp'2002-01-01' END AS timestamp_extracted",
        ),
    }


@check(
    "r11_loan_return",
    """WITH app AS (SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, 'app' || o_orderkey DESC) AS rn
            FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW') WHERE rn = 1),
         inst AS (SELECT l_orderkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS due, l_returnflag <> 'R' AS pending, CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
            CASE WHEN l_discount > 0.02 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS i FROM lineitem WHERE l_linestatus = 'O'),
         short AS (SELECT l_orderkey, sum(CASE WHEN pending AND due < DATE '2000-06-15' THEN p + coalesce(i, 0) ELSE 0 END) AS s FROM inst GROUP BY 1),
         last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY due DESC, p DESC, i DESC NULLS LAST, pending DESC) AS rn FROM inst) WHERE rn = 1)
       SELECT CAST(l.p + l.i AS DOUBLE) AS current_expected_monthly_payment__c, CAST(s.s AS DOUBLE) AS current_payment_shortfall__c,
            date_sub('month', DATE '2000-06-15', l.due) AS remaining_term_months__c,
            CASE WHEN l.pending AND l.due < DATE '2000-06-15' THEN date_sub('month', l.due, DATE '2000-06-15') ELSE 0 END AS months_past_maturity__c,
            CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS current_balance_outstanding__c,
            'F' || c_custkey AS id, 'case' || c_custkey AS case__c, c_mktsegment AS purpose__c
       FROM customer c LEFT JOIN app a ON a.o_custkey = c.c_custkey LEFT JOIN orders o ON o.o_orderkey = a.o_orderkey
       LEFT JOIN short s ON s.l_orderkey = o.o_orderkey LEFT JOIN last l ON l.l_orderkey = o.o_orderkey""",
)
def _(t):
    return plain(loans.loan_return(loan_tables(t), TODAY))


def case_tables(t):
    """Orders are cases, nations own them, customers are the contacts, line items are milestones."""
    cases = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey AS id", "CASE WHEN o_orderstatus = 'P' THEN 'Enquiry' ELSE 'Complaint' END AS case_rt_dev_name__c",
        "concat('N', o_orderkey) AS case_number", "concat('N', o_orderkey) AS casenumber", "o_orderpriority AS type", "o_orderstatus AS status", "c_mktsegment AS origin",
        "o_orderpriority AS priority", "c_nationkey AS owner_id", "o_custkey AS contact_id", "concat('About ', o_orderkey) AS subject",
        "'open' AS complaint_status__c", "'none' AS response_status__c", "'no' AS redress_paid__c",
        "CAST(CAST(o_totalprice AS decimal(18,2)) AS string) AS redress_amount__c", "'fees' AS complaint_root_cause__c", "o_orderdate AS createddate",
    )
    return {
        "cases": cases,
        "users": t.nation.selectExpr("n_nationkey AS id", "n_name AS name"),
        "contacts": t.customer.selectExpr("c_custkey AS id", "c_name AS name"),
        "case_milestones": t.lineitem.selectExpr(
            "l_orderkey AS case_id", "l_partkey AS milestone_type_id", "l_shipdate AS target_date",
            "CASE l_linestatus WHEN 'F' THEN l_shipdate END AS completion_date",
        ),
        "milestone_types": t.part.selectExpr("p_partkey AS id", "p_name AS name"),
    }


@check(
    "r12_complaint_cases",
    """SELECT 'Complaint' AS case_record_type, 'N' || o_orderkey AS case_number, o_orderpriority AS type, o_orderstatus AS status, 'open' AS complaint_status,
          'none' AS response_status, 'no' AS redress_paid, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS redress_amount, 'fees' AS complaint_root_cause,
          c_mktsegment AS case_origin, n_name AS case_owner, c_name AS name, 'About ' || o_orderkey AS subject, o_orderdate AS date_time_opened
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus <> 'P'""",
)
def _(t):
    return service.complaint_cases(case_tables(t))


@check(
    "r13_complaint_milestones",
    """SELECT 'N' || o_orderkey AS case_number, o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS case_origin, o_orderdate AS date_time_opened,
          p_name AS milestone, l_shipdate AS target_date, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS completion_date, 'Complaint' AS case_record_type
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus <> 'P'""",
)
def _(t):
    return service.complaint_milestones(case_tables(t))


def survey_tables(t):
    """Line items are answers, orders the takers, regions the surveys and parts the questions."""
    return {
        "survey_responses": t.lineitem.selectExpr(
            "l_orderkey AS survey_taker__c", "l_returnflag AS question_type__c", "concat('R', l_orderkey, '-', l_linenumber) AS name",
            "l_linestatus AS response__c", "lower(l_linestatus) AS response_english_text", "l_partkey AS survey_question__c",
            "l_quantity AS response_numeric__c", "l_shipdate AS createddate",
        ),
        "survey_takers": t.orders.selectExpr(
            "o_orderkey AS id", "concat('T', o_orderkey) AS name", "CAST(substr(o_orderpriority, 1, 1) AS int) - 1 AS survey__c"
        ),
        "surveys": t.region.selectExpr(
            "r_regionkey AS id",
            "CASE r_regionkey WHEN 0 THEN 'Onboarding Survey' WHEN 1 THEN 'SurveyForce Sample Survey' WHEN 2 THEN 'How was your recent experience?' ELSE r_name END AS name",
        ),
        "survey_questions": t.part.selectExpr("p_partkey AS id", "p_name AS name"),
    }


def survey_sql(priority: str, english: bool = False) -> str:
    return f"""SELECT 'T' || o_orderkey AS survey_response, 'R' || l_orderkey || '-' || l_linenumber AS response_id, l_returnflag AS question_type, p_name AS name,
        l_linestatus AS response, {"lower(l_linestatus) AS response_en," if english else ""} l_quantity AS response_numeric, l_shipdate AS created_date
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE o_orderpriority = '{priority}'"""


@check("r14_onboarding_survey", survey_sql("1-URGENT", True))
def _(t):
    return service.onboarding_survey(survey_tables(t))


@check("r15_general_enquiry_survey", survey_sql("2-HIGH"))
def _(t):
    return service.general_enquiry_survey(survey_tables(t))


@check("r16_recent_experience_survey", survey_sql("3-MEDIUM"))
def _(t):
    return service.recent_experience_survey(survey_tables(t))


def account_tables(t):
    field = (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Vulnerability_Comments__pc' WHEN '2-HIGH' THEN 'Vulnerable_Customer__pc' "
        "WHEN '3-MEDIUM' THEN 'Vulnerable_Customer_Subcategory__pc' ELSE 'Phone' END AS field"
    )
    return {
        "account_history": t.orders.selectExpr(
            field, "o_orderstatus AS old_value", "lower(o_orderstatus) AS new_value", "o_custkey AS account_id", "o_orderdate AS createddate"
        ),
        "accounts": t.customer.selectExpr("c_custkey AS id", "c_name AS name"),
    }


@check(
    "r17_vulnerable_customers",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Vulnerability_Comments__pc' WHEN '2-HIGH' THEN 'Vulnerable_Customer__pc' ELSE 'Vulnerable_Customer_Subcategory__pc' END AS field,
          o_orderstatus AS old_value, lower(o_orderstatus) AS new_value, o_custkey AS account_id, c_name AS account_name, o_orderdate AS created_date
       FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def _(t):
    return service.vulnerable_customers(account_tables(t))


@check(
    "r18_outbound_calls",
    """SELECT 'P' || o_orderkey AS id, o_orderpriority AS customer_cohort__c, o_orderstatus AS ocp_call_1_result__c, CAST(o_custkey AS VARCHAR) AS final_call__c
       FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-16'""",
)
def _(t):
    made = {"id": "concat('P', o_orderkey)", "customer_cohort__c": "o_orderpriority", "ocp_call_1_result__c": "o_orderstatus", "final_call__c": "CAST(o_custkey AS string)"}
    contacts = t.orders.selectExpr(
        *[f"{made.get(c, 'CAST(NULL AS string)')} AS {c}" for c in service.CALL_COLUMNS],
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss.SSS') AS createddate",
    )
    return service.outbound_calls({"contacts": contacts}, "1999-06-16 00:00:00").select(*made)


def valuation_tables(t):
    made = {
        "case_number": "concat('N', o_orderkey)", "applicantname": "concat('Applicant ', o_custkey)", "rooms_bedrooms": "CAST(o_custkey AS string)",
        "valuationDate": "date_format(o_orderdate, 'dd/MM/yyyy')", "valuations_marketValue": "concat('£', format_number(CAST(o_totalprice AS decimal(18,2)), 2))",
        "tenure_type": "o_orderpriority", "isReinspectionRequired": "CASE o_orderstatus WHEN 'F' THEN 'Yes' ELSE 'No' END",
    }
    sources = sorted(set(service.VALUATION_SOURCES.values()))
    cases = t.orders.filter("o_orderstatus <> 'P'").selectExpr("concat('I', o_orderkey) AS id", "concat('N', o_orderkey) AS casenumber")
    return {"valuations": t.orders.selectExpr(*[f"{made.get(c, 'CAST(NULL AS string)')} AS {c}" for c in sources]), "cases": cases}


VALUATION_SQL = """SELECT 'N' || o_orderkey AS "Case_Number__c", 'I' || o_orderkey AS "Case_ID__c", 'Applicant ' || o_custkey AS "Contact_Name__c",
   {} AS "Bedroom_Count__c", {} AS "Valuation_Date__c", {} AS "Market_Value__c", o_orderpriority AS "Ownership_Type__c", o_orderpriority AS "Tenure__c",
   '' AS "Business_Nature__c", {} AS "Is_a_Reinspection_Required__c" FROM orders WHERE o_orderstatus <> 'P'"""
VALUATION_COLUMNS = (
    "Case_Number__c", "Case_ID__c", "Contact_Name__c", "Bedroom_Count__c", "Valuation_Date__c", "Market_Value__c", "Ownership_Type__c",
    "Tenure__c", "Business_Nature__c", "Is_a_Reinspection_Required__c",
)


@check(
    "r19_property_valuations",
    VALUATION_SQL.format(
        "CAST(o_custkey AS VARCHAR)", "strftime(o_orderdate, '%d/%m/%Y')", "'£' || format('{:,.2f}', o_totalprice)",
        "CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END",
    ),
)
def _(t):
    return service.property_valuations(valuation_tables(t)).select(*VALUATION_COLUMNS)


@check(
    "r20_conformed_valuations",
    VALUATION_SQL.format(
        "CAST(o_custkey AS INTEGER)", "strftime(o_orderdate, '%Y-%m-%d')", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)", "o_orderstatus = 'F'"
    ),
)
def _(t):
    return conform.conform_valuations(service.property_valuations(valuation_tables(t))).select(*VALUATION_COLUMNS)


@check(
    "r21_q7_reconciliation_run",
    """WITH a AS (SELECT CAST(o_orderdate AS DATE) AS createddate, count(*) AS n FROM orders GROUP BY 1),
            b AS (SELECT CAST(o_orderdate AS DATE) AS createddate, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
            j AS (SELECT coalesce(a.createddate, b.createddate) AS createddate, a.n AS l, b.n AS r FROM a FULL JOIN b ON a.createddate = b.createddate)
       SELECT 'orders' AS source, createddate, l AS id_count_source, r AS id_count_lake, (SELECT coalesce(bool_and(coalesce(l = r, false)), true) FROM j) AS all_match FROM j
       UNION ALL SELECT 'events', CAST(ts AS DATE), count(*), count(*), true FROM events GROUP BY 2""",
)
def _(t):
    """Two tables from one configuration; verdicts are landed as CSV and read back."""
    base = fresh_path(t.spark, "recon")
    orders = t.orders.select(F.to_date("o_orderdate").alias("createddate"), F.col("o_orderkey").alias("id"))
    keys = t.lineitem.select(F.col("l_orderkey").alias("id")).distinct()
    events = t.events.select(F.to_date("ts").alias("createddate"), F.col("event_id").alias("id"))
    config = {"orders": {"keys": ["createddate"]}, "events": {"keys": ["createddate"], "rename": {"event_id": "id"}}}
    sources = {"orders": orders, "events": events.withColumnRenamed("id", "event_id")}
    lake = {"orders": orders.join(keys, "id", "left_semi"), "events": events}
    jobs.run_reconciliation(config, sources, lake, base)
    schema = "createddate date, id_count_source bigint, id_count_lake bigint, all_match boolean"
    parts = [
        t.spark.read.option("header", True).schema(schema).csv(f"{base}/{n}").withColumn("source", F.lit(n)) for n in config
    ]
    return parts[0].unionByName(parts[1])


@check(
    "r22_analytics_landing",
    """SELECT date_trunc('minute', ts + INTERVAL 150 DAY) AT TIME ZONE 'Europe/London' AT TIME ZONE 'UTC' AS datehourminute, event_type AS eventname,
          CAST(user_id AS INTEGER) AS sessions, strftime(ts + INTERVAL 150 DAY, '%Y-%m-%d') AS date, TIMESTAMP '2024-03-09 10:30:00' AS timestamp_extracted FROM events""",
)
def _(t):
    value = lambda c: F.struct(c.cast("string").alias("value"))
    wall = F.date_format(F.col("ts") + F.expr("INTERVAL 150 DAY"), "yyyyMMddHHmm")
    response = t.events.select(
        F.array(value(wall), value(F.col("event_type"))).alias("dimensionValues"), F.array(value(F.col("user_id"))).alias("metricValues")
    )
    schema = {"dateHourMinute": "timestamp", "eventName": "string", "sessions": "int", "timestamp_extracted": "timestamp", "date": "string"}
    return jobs.land_analytics_report(response, ["dateHourMinute", "eventName"], ["sessions"], NOW, schema)


@check(
    "r23_response_time_landing",
    """SELECT event_id AS message_id, event_type AS message_kind, CAST(user_id AS INTEGER) AS message_user_id, date_trunc('second', ts) AS created_time,
          strftime(ts, '%Y-%m-%d') AS date, TIMESTAMP '2024-03-09 10:30:00' AS timestamp_extracted FROM events""",
)
def _(t):
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    messages = t.events.select(
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("id")).alias("user")).alias("MESSAGE"),
        millis.alias("CREATED_TIME"),
    )
    schema = {"message_id": "bigint", "message_kind": "string", "message_user_id": "int", "created_time": "timestamp", "date": "string"}
    return jobs.conform_response_times(messages, "CREATED_TIME", schema, NOW)


@check(
    "r24_skill_summary_landing",
    """SELECT event_id, event_type AS skill_name, '20240309' AS date FROM events WHERE ts < TIMESTAMP '2024-01-15'
       UNION ALL SELECT event_id, event_type, '20240309' FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
)
def _(t):
    """First load, then what is newer than the last extract; the boundary row is read again."""
    path = fresh_path(t.spark, "skills")
    rows = t.events.select("event_id", F.col("event_type").alias("skill_name"), F.col("ts").cast("timestamp").alias("timestamp_extracted"))
    first = rows.filter("timestamp_extracted < timestamp'2024-01-15'")
    schema = {"event_id": "bigint", "skill_name": "string"}
    jobs.land_skill_summary(first, None, path, schema, NOW)
    jobs.land_skill_summary(rows, first, path, schema, NOW)
    return t.spark.read.schema("event_id bigint, skill_name string, date string").parquet(path)


@check(
    "r25_crm_object_landing",
    """WITH e AS (SELECT *, date_trunc('millisecond', ts) AS m FROM events)
       SELECT event_id AS id, event_type AS owner_name, m AS lastmodifieddate, strftime(m, '%Y%m%d') AS date FROM e WHERE m < TIMESTAMP '2024-01-15'
       UNION ALL SELECT event_id, event_type, m, strftime(m, '%Y%m%d') FROM e WHERE m >= (SELECT max(m) FROM e WHERE m < TIMESTAMP '2024-01-15')""",
)
def _(t):
    """First load, then a load from the watermark on; the boundary row is read again."""
    path = fresh_path(t.spark, "crm")
    records = t.events.select(
        F.struct(F.lit("Case").alias("type"), F.lit("/x").alias("url")).alias("attributes"),
        F.col("event_id").alias("Id"),
        F.struct(F.concat(F.col("event_type"), F.lit("\n")).alias("Name")).alias("Owner"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'").alias("LastModifiedDate"),
        F.lit(None).cast("string").alias("Description"),
    )
    schema = {"id": "bigint", "owner_name": "string", "lastmodifieddate": "timestamp"}
    before = F.col("LastModifiedDate") < "2024-01-15"
    jobs.land_crm_object(records.filter(before), None, path, "LastModifiedDate", schema, NOW)
    target = t.spark.read.parquet(path)
    jobs.land_crm_object(records, target, path, "LastModifiedDate", schema, NOW)
    landed = t.spark.read.schema("id bigint, owner_name string, lastmodifieddate timestamp, date string").parquet(path)
    return landed.withColumn("owner_name", F.trim("owner_name"))


@check("r26_regulatory_form_landing", "SELECT s_suppkey AS id, s_name AS property_finance_type__c, '20240309' AS date FROM supplier")
def _(t):
    path = fresh_path(t.spark, "form")
    records = t.supplier.select(
        F.col("s_suppkey").alias("Id"),
        F.struct(F.struct(F.lit("Case").alias("type")).alias("attributes"), F.col("s_name").alias("Property_Finance_Type__c")).alias("Case__r"),
    )
    schema = {"id": "bigint", "property_finance_type__c": "string"}
    jobs.land_regulatory_form(records, path, schema, NOW, {"Case__r_Property_Finance_Type__c": "property_finance_type__c"})
    return t.spark.read.schema("id bigint, property_finance_type__c string, date string").parquet(path)


@check(
    "r27_campaign_landing",
    """SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, p_size > 25 AS favorite, TIMESTAMP '2024-01-02 03:04:05' AS createddate,
          '{"brand":"' || p_brand || '"}' AS tags FROM part""",
)
def _(t):
    path = fresh_path(t.spark, "campaigns")
    records = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "True").otherwise("False").alias("favorite"),
        F.lit("2024-01-02T03:04:05").alias("createdDate"),
        F.struct(F.col("p_brand").alias("brand")).alias("tags"),
        F.lit("x").alias("schema"),
    )
    types = {"id": "int", "name": "string", "favorite": "boolean", "createdDate": "timestamp"}
    jobs.land_campaign_objects(records, path, types, NOW, remove=["schema", "iconUrl"], booleans=["favorite"])
    return t.spark.read.parquet(path).select("id", "name", "favorite", "createddate", "tags")


@check(
    "r28_tracking_landing",
    """SELECT event_id, strftime(ts, '%d-%m-%Y') AS day FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 29
         AND (CAST(ts AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE event_type = 'click' AND value > 20)
              OR CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type = 'click' AND value > 20))""",
)
def _(t):
    path = fresh_path(t.spark, "tracking")
    stored = t.events.filter("event_type = 'click' AND value > 20").select(F.to_date("ts").alias("day"))
    events = t.events.select("event_id", "ts", F.lit("ok").alias("result"))
    jobs.land_tracking_events(events, "ts", stored, path, dt.date(2024, 1, 31))
    return t.spark.read.schema("event_id bigint, day string").parquet(path)


@check(
    "r29_screen_visit_landing",
    """SELECT event_id::VARCHAR AS event_id, event_type AS screen_name, 2024 AS year, 1 AS month, 29 AS day, '2024-01-29' AS date FROM events""",
)
def _(t):
    """The whole events table as gzip archives whose folder date is two days old."""
    folder, path = fresh_path(t.spark, "inbox"), fresh_path(t.spark, "visits")
    rows = t.events.select("event_id", F.col("event_type").alias("Screen Name"))
    rows.repartition(8).write.option("header", True).option("compression", "gzip").csv(folder)
    for i, written in enumerate(readers.list_files(t.spark, folder, "part-*.csv.gz").toLocalIterator()):
        sinks.move_file(t.spark, written["path"], f"{folder}-in/Visits_{i}_29_01_2024.csv.gz")
    jobs.land_screen_visits(t.spark, f"{folder}-in", path, "Visits", dt.date(2024, 1, 31), overwrite=True, suffix=".csv.gz")
    return t.spark.read.schema("event_id string, screen_name string, date string, year int, month int, day int").parquet(path)


@check(
    "r30_csv_table_conversion",
    """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_mktsegment, CAST(CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS DOUBLE) AS c_acctbal,
          0 AS left_behind FROM customer""",
)
def _(t):
    """A CSV table of files with two headers becomes Parquet; the sources move to the archive."""
    src, dst = fresh_path(t.spark, "csvtable"), fresh_path(t.spark, "parquettable")
    money = F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal")
    parts = {"1": t.customer.filter("c_acctbal >= 0").select("c_custkey", "c_mktsegment", money), "2": t.customer.filter("c_acctbal < 0").select("c_custkey", "c_mktsegment")}
    for name, part in parts.items():
        part.write.option("header", True).csv(f"{src}/date=2024010{name}")
    jobs.csv_to_parquet(t.spark, src, dst, f"{src}_archive")
    left = readers.list_files(t.spark, src, "*.csv").agg(F.count(F.lit(1)).cast("int")).scalar()
    return t.spark.read.parquet(dst).withColumn("left_behind", left)


@check(
    "r31_consumer_duty_publishing",
    """SELECT 'complaints_cases' AS dataset, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' UNION ALL
       SELECT 'complaint_cases_with_milestones', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' UNION ALL
       SELECT 'onboarding_survey', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority = '1-URGENT' UNION ALL
       SELECT 'general_enquiry_survey', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority = '2-HIGH' UNION ALL
       SELECT 'recent_experience_survey', count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority = '3-MEDIUM' UNION ALL
       SELECT 'vulnerable_customers', count(*) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def _(t):
    base = fresh_path(t.spark, "duty")
    tables = {**case_tables(t), **survey_tables(t), **account_tables(t)}
    results = jobs.publish(t.spark, service.consumer_duty_config(tables), base, NOW.date(), **tables)
    counts = [
        t.spark.read.parquet(f"{base}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n") for name in results
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


@check(
    "r32_valuation_manifest",
    """SELECT 'failed' AS status, source || '_' || doc_id || '.pdf' AS file_name, 'not found' AS error_message FROM documents
       WHERE lang = 'fr' AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(t):
    """Missing documents, the failed ones appended to the log table."""
    path = fresh_path(t.spark, "failures")
    name = F.concat_ws("_", "source", F.concat("doc_id", F.lit(".pdf")))
    wanted = t.documents.select(name.alias("file_name"), "lang")
    present = t.documents.join(t.labels, "doc_id", "left_semi").select(name.alias("file_name"))
    missing = incremental.manifest_delta(wanted, present)
    handled = missing.select(
        F.when(F.col("lang") == "fr", "failed").otherwise("success").alias("status"),
        "file_name",
        F.when(F.col("lang") == "fr", "not found").alias("error_message"),
    )
    incremental.append_failures(handled, path, NOW)
    return t.spark.read.parquet(path).drop("timestamp")
