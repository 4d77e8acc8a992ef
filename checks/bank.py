"""Bank-shaped tables derived from the driver tables, for Spark and as SQL text.

Every order is one change of its customer and one change of an account (customer x priority); every line
item is one extract of a deposit transaction; every event is a card message or an app event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import Tables

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ORDER_STAMP = "timestamp_micros(unix_micros(CAST(o_orderdate AS timestamp)) + o_orderkey)"
LINE_STAMP = "timestamp_micros(unix_micros(CAST(l_shipdate AS timestamp)) + l_partkey * 10000 + l_suppkey)"

ACCOUNT_NAMES = {
    "1-URGENT": ("GBP Fixed Deposit Account Exclusive", "GBP"),
    "2-HIGH": ("USD Fixed Deposit Account", "USD"),
    "3-MEDIUM": ("GBP Instant Access Saver", "GBP"),
    "4-NOT SPECIFIED": ("EUR Current Account", "EUR"),
    "5-LOW": ("USD Instant Access Saver", "USD"),
}


def case(column: str, values: dict[str, str], default: str = "NULL") -> str:
    """SQL text that maps values of a column; valid in both dialects."""
    body = " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items())
    return f"CASE {column} {body} ELSE {default} END"


NAME = case("o_orderpriority", {k: f"'{v[0]}'" for k, v in ACCOUNT_NAMES.items()})
CURRENCY = case("o_orderpriority", {k: f"'{v[1]}'" for k, v in ACCOUNT_NAMES.items()})
STATUS = case("o_orderpriority", {"2-HIGH": "'AWAITING_MANUAL_REVIEW'", "3-MEDIUM": "'AWAITING_APPROVAL'"}, "'APPROVED'")
BRAND = case("o_orderpriority", {"1-URGENT": "''", "2-HIGH": "'<NA>'", "3-MEDIUM": "NULL"}, "c_mktsegment")
COUNTRY = "CASE WHEN c_nationkey < 8 THEN 'ARE' WHEN c_nationkey < 10 THEN '' ELSE 'GBR' END"
INCOME = "CASE WHEN o_orderstatus = 'P' THEN '<NA>' ELSE " + case(
    "c_mktsegment",
    {"AUTOMOBILE": "'GBP_6000_TO_12000'", "BUILDING": "'KWD_LESS_THAN_1000'", "FURNITURE": "''", "HOUSEHOLD": "'0_9999_AED_MONTH'"},
) + " END"
ASSETS = "CASE WHEN o_orderstatus = 'O' THEN '' ELSE " + case(
    "o_orderpriority",
    {"1-URGENT": "'GBP_85K_TO_199K'", "2-HIGH": "'KWD_30K_TO_80K'", "4-NOT SPECIFIED": "'MORE_THAN_1000000_SAR'", "5-LOW": "'GBP_LESS_THAN_20K'"},
) + " END"
INCOME_VALUE = "CASE income_code WHEN 'GBP_6000_TO_12000' THEN 108000 WHEN 'KWD_LESS_THAN_1000' THEN 15900 WHEN '0_9999_AED_MONTH' THEN 13100 END"
ASSETS_VALUE = "CASE assets_code WHEN 'GBP_85K_TO_199K' THEN 142000 WHEN 'KWD_30K_TO_80K' THEN 140000 WHEN 'MORE_THAN_1000000_SAR' THEN 220000 WHEN 'GBP_LESS_THAN_20K' THEN 10000 END"
MONTHS = case("o_orderstatus", {"F": "3", "O": "6"})
STATE = case("o_orderstatus", {"P": "'MATURED'"}, "'ACTIVE'")
RATE = case("o_orderstatus", {"F": "'4.50'", "O": "'3.25'"})
TIERS = [case("o_orderstatus", v, d) for v, d in (({"F": "'1.00'"}, "'2.75'"), ({"F": "'2.50'"}, "'2.25'"), ({"F": "'2.00'"}, "'1.25'"))]
TYPE = case("l_returnflag", {"N": "'DEPOSIT'", "A": "'INTEREST_APPLIED'"}, "'WITHDRAWAL'")
CHANNEL = "CASE WHEN l_linestatus = 'O' THEN 'CB_Deposit_BACS' WHEN l_discount >= 0.05 THEN 'CC_Deposit_GBP' WHEN l_discount >= 0.02 THEN 'Internal' ELSE '' END"

HISTORY_COLUMNS = {
    "dynamodb_keys_id_s": "CASE WHEN o_orderstatus = 'F' THEN concat('C', o_custkey) END",
    "dynamodb_key_id_s": "CASE WHEN o_orderstatus = 'O' THEN concat('C', o_custkey) END",
    "dynamodb_new_image_id_s": "concat('C', o_custkey)",
    "dynamodb_new_image_status_s": STATUS,
    "dynamodb_new_image_brand_id_s": BRAND,
    "dynamodb_new_image_individual_m_address_m_country_code_s": COUNTRY,
    "dynamodb_new_image_individual_m_financial_details_m_monthly_income_s": INCOME,
    "dynamodb_new_image_individual_m_financial_details_m_estimated_assets_value_s": ASSETS,
    "dynamodb_new_image_card_ordered_bool": "o_totalprice > 250000",
}
ITEM_0 = case("c_mktsegment", {"AUTOMOBILE": "'INCOME_FROM_PERSONAL_SAVINGS'", "BUILDING": "'PROPERTY_SALES'", "FURNITURE": "'OTHER'", "HOUSEHOLD": "'UNLISTED'"})
ITEM_1 = "CASE WHEN c_nationkey < 12 THEN 'SAVINGS_FROM_SALARY_OR_EARNINGS' ELSE 'VIRTUAL_ASSETS' END"
RANGE_0 = "concat('GBP_', c_custkey * 10, '_', c_custkey * 30 + 1)"
RANGE_1 = "CASE WHEN c_nationkey < 18 THEN 'GBP_100000_200001.5' ELSE 'n/a' END"
WORTH_CODE = case("c_mktsegment", {"AUTOMOBILE": "'USD'", "BUILDING": "'EUR'", "FURNITURE": "'AED'", "HOUSEHOLD": "'KWD'"}, "'GBP'")
AGE = "CASE WHEN c_nationkey < 3 THEN '' WHEN c_nationkey < 6 THEN NULL ELSE '25-34' END"
WALLET = case("event_type", {"click": "'103'", "view": "'216'", "signup": "'217'", "purchase": "'103'"}, "''")
KIND = "CASE WHEN value > 60 THEN 'TC' END"
STEP = "CASE WHEN value < 15 THEN '01' WHEN value < 30 THEN '7' ELSE '03' END"
APPROVAL = case("event_type", {"click": "'1'", "view": "'2'"}, "'3'")
REPLY = "CASE WHEN value < 50 THEN '000' ELSE '005' END"
MESSAGE_TYPE = "CASE WHEN value < 20 THEN '0100' WHEN value < 40 THEN '0120' ELSE '0400' END"
SPEND = case("event_type", {"click": "'POS - Purchase'", "view": "'ECOM - NA'", "signup": "'POS - Purchase with Cash Back'"}, "'ECOM - Purchase'")
SCREEN = case("event_type", {"click": "'Screen_Prop_Fin_Type'", "view": "'screen_legal_agreement'", "signup": "'screen_home'"}, "'screen_BTLdashboard'")


def customers(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(
        *[f"{sql} AS {name}" for name, sql in HISTORY_COLUMNS.items()],
        f"{ORDER_STAMP} AS dynamodb_new_image_updated_at_n",
        f"{ORDER_STAMP} AS dynamodb_approximate_creation_date_time",
        f"{ORDER_STAMP} AS timestamp_extracted",
    )


def clients(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "concat('C', c_custkey) AS id",
        "concat('K', c_custkey) AS encoded_key",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'ar' ELSE 'en' END AS preferred_language",
        "'2020-01-01T00:00:00Z' AS last_modified_date",
    )


def deposit_accounts(t: Tables) -> DataFrame:
    month = "date_trunc('MONTH', CAST(o_orderdate AS timestamp))"
    iso = lambda ts: f"date_format({ts}, \"{ISO}\")"
    suffix = "concat(o_custkey, '-', substr(o_orderpriority, 1, 1))"
    prefix = "interest_settings_interest_rate_settings_interest_rate"
    return t.orders.selectExpr(
        f"concat('A', {suffix}) AS id",
        f"concat('E', {suffix}) AS encoded_key",
        "concat('K', o_custkey) AS account_holder_key",
        f"{NAME} AS name",
        f"CASE WHEN {NAME} LIKE '%Fixed%' THEN 'FIXED_DEPOSIT' ELSE 'SAVINGS' END AS account_type",
        f"{STATE} AS account_state",
        f"{CURRENCY} AS currency_code",
        "CAST(CAST(o_totalprice AS decimal(18,2)) AS string) AS balances_total_balance",
        "concat(o_custkey, '.50') AS accrued_amounts_interest_accrued",
        f"{iso(ORDER_STAMP)} AS last_modified_date",
        f"{iso(ORDER_STAMP)} AS approved_date",
        f"{iso(month)} AS activation_date",
        f"date_format(add_months(CAST({month} AS date), {MONTHS}), \"yyyy-MM-dd'T'00:00:00'Z'\") AS maturity_date",
        f"CASE WHEN o_orderstatus = 'O' AND o_totalprice > 450000 THEN {iso(month)} END AS closed_date",
        f"{RATE} AS {prefix}",
        *[f"{tier} AS {prefix}_tiers_{i}_interest_rate" for i, tier in enumerate(TIERS, start=1)],
    )


def deposit_transactions(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    shipped = f"date_format(CAST(l_shipdate AS timestamp), \"{ISO}\")"
    amount = "CAST(CAST(l_extendedprice AS decimal(18,2)) AS string)"
    return joined.selectExpr(
        "concat('T', l_orderkey, '-', l_linenumber) AS id",
        "concat('E', o_custkey, '-', substr(o_orderpriority, 1, 1)) AS parent_account_key",
        f"{TYPE} AS type",
        f"{CURRENCY} AS currency_code",
        f"{CHANNEL} AS transaction_details_transaction_channel_id",
        f"{amount} AS amount",
        f"{amount} AS affected_amounts_funds_amount",
        f"{shipped} AS booking_date",
        f"{shipped} AS creation_date",
        f"{shipped} AS value_date",
        f"{LINE_STAMP} AS timestamp_extracted",
    )


def riskscore(t: Tables) -> DataFrame:
    once = t.customer.selectExpr(
        "concat('C', c_custkey) AS dynamodb_keys_customer_id_s",
        f"{ITEM_0} AS items_new_0_type",
        f"{RANGE_0} AS items_new_0_converted_currency",
        f"{ITEM_1} AS items_new_1_type",
        f"{RANGE_1} AS items_new_1_converted_currency",
        *[f"CAST(NULL AS string) AS items_new_{i}_{part}" for i in range(2, 30) for part in ("type", "converted_currency")],
        f"{WORTH_CODE} AS estimated_net_worth_currency_code",
        "CASE WHEN c_nationkey <= 20 THEN CAST(CAST(c_acctbal AS decimal(18,2)) AS string) END AS estimated_net_worth_min_local",
        "CASE WHEN c_nationkey <= 20 THEN CAST(CAST(c_acctbal + 1000 AS decimal(18,2)) AS string) END AS estimated_net_worth_max_local",
    )
    return once.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


def timeline(t: Tables) -> DataFrame:
    return t.customer.filter("c_nationkey < 23").selectExpr(
        "concat('C', c_custkey) AS dynamo_user_key",
        "c_acctbal > 2000 AS email_notifications_m_marketing",
        "c_acctbal > 5000 AS push_notifications_m_marketing",
        "c_mktsegment = 'BUILDING' AS sms_notifications_m_marketing",
        f"{AGE} AS age_range",
        "CASE WHEN c_nationkey < 5 THEN ' ' ELSE c_mktsegment END AS brand_id",
        f"{COUNTRY} AS dynamodb_individual_m_nationality_country_code_s",
        "CASE WHEN c_acctbal > 0 THEN '1' ELSE '0' END AS dynamodb_new_gid",
    )


def risk_form(t: Tables) -> DataFrame:
    form = "dynamodb_new_image_form_data_m_customer"
    occupations = ("concat(' ', o_orderpriority)", "o_orderstatus", "'nan'", "' '", "CAST(NULL AS string)")
    circumstances = ("CASE WHEN o_orderstatus = 'P' THEN 'nan' ELSE o_orderstatus END", "o_orderpriority", "''")
    return t.orders.selectExpr(
        "concat('C', o_custkey) AS dynamodb_new_image_customer_id_s",
        *[f"{sql} AS {form}_occupations_l_{i}_s" for i, sql in enumerate(occupations)],
        *[f"{sql} AS {form}_circumstances_l_{i}_s" for i, sql in enumerate(circumstances)],
        f"{ORDER_STAMP} AS dynamodb_new_image_updated_at_n",
    )


PRODUCT_CURRENCY = case("p_type", {"ECONOMY": "'gbp'", "SMALL": "'gbp'", "MEDIUM": "'usd'", "LARGE": "'usd'"}, "'eur'")
PRODUCT_OFFER = case("p_type", {k: "'post_maturity_reinvestment'" for k in ("SMALL", "LARGE", "PROMO")}, "'default'")
PRODUCT_TERM = "CASE WHEN p_size <= 16 THEN '3m' WHEN p_size <= 33 THEN '6m' ELSE '12m' END"
PRODUCT_COLUMNS = {
    "dynamodb_new_image_product_encoded_key_s": f"concat({PRODUCT_CURRENCY}, {PRODUCT_TERM})",
    "dynamodb_new_image_sk_s": f"concat({PRODUCT_CURRENCY}, ':ftd_', {PRODUCT_TERM}, ':', {PRODUCT_OFFER})",
    "dynamodb_new_image_interest_rate_n": "CASE WHEN p_size <= 40 THEN concat(p_size, '.50') END",
    "dynamodb_new_image_min_amount_n": "'1000'",
    "dynamodb_new_image_rates_l_0_m_rate_n": "'3.00'",
    "dynamodb_new_image_rates_l_0_m_profit_margin_n": "'0.25'",
    "dynamodb_new_image_rates_l_0_m_bonus_rate_n": "'0.15'",
    "dynamodb_new_image_rates_l_1_m_rate_n": "'3.50'",
    "dynamodb_new_image_rates_l_1_m_profit_margin_n": "'0.10'",
    "dynamodb_new_image_rates_l_1_m_bonus_rate_n": "'0.20'",
    "dynamodb_new_image_rates_l_1_m_min_amount_n": "'50000'",
    "dynamodb_new_image_updated_at_n": "concat('', 1700000000 + p_partkey)",
}


def payment_products(t: Tables) -> DataFrame:
    products = t.part.selectExpr(*[f"{sql} AS {name}" for name, sql in PRODUCT_COLUMNS.items()])
    rule = t.part.selectExpr(
        "'rule' AS dynamodb_new_image_product_encoded_key_s",
        "'ftd:rule:post_maturity_reinvestment' AS dynamodb_new_image_sk_s",
        "p_size AS dynamodb_new_image_available_days_after_maturity_n",
        "concat('', 1700000000 + p_partkey) AS dynamodb_new_image_updated_at_n",
    )
    return products.unionByName(rule, allowMissingColumns=True)


def recurring_transfers(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus <> 'P'").selectExpr(
        "concat('A', o_custkey, '-', substr(o_orderpriority, 1, 1)) AS dynamodb_new_image_target_account_id_s",
        "o_totalprice > 200000 AS dynamodb_new_image_is_active_bool",
        "unix_millis(CAST(o_orderdate AS timestamp)) + o_orderkey AS dynamodb_new_image_updated_at_n",
    )


def card_messages(t: Tables) -> DataFrame:
    m = "dynamodb_new_image_message_m"
    return t.events.selectExpr(
        "user_id AS dynamodb_new_image_token_n",
        "CAST(ts AS timestamp) AS dynamodb_new_image_updated_at_n",
        f"{WALLET} AS {m}_iso_msg_m_de48_m_26_s",
        f"{KIND} AS {m}_iso_msg_m_de124_m_1_s",
        f"{STEP} AS {m}_iso_msg_m_de124_m_3_s",
        f"{APPROVAL} AS {m}_iso_msg_m_de124_m_7_s",
        f"{REPLY} AS {m}_iso_msg_m_de39_s",
        f"{MESSAGE_TYPE} AS {m}_message_type_m_message_type_s",
        f"value - 3 AS {m}_summary_m_billing_amount_s",
        f"CASE WHEN value < 45 THEN 'Approve' ELSE 'Decline' END AS {m}_summary_m_processor_decision_desc_s",
        f"'Authorisation Request' AS {m}_message_type_m_message_desc_s",
        f"{SPEND} AS {m}_summary_m_spend_type_s",
    )


def cards(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "concat('D', c_custkey) AS dynamodb_keys_id_s",
        "c_custkey AS dynamodb_new_image_token_n",
        "concat('C', c_custkey) AS dynamodb_new_image_user_id_s",
        "CASE WHEN c_acctbal > 0 THEN 'ACTIVE' ELSE 'CLOSED' END AS dynamodb_new_image_state_s",
        "timestamp_seconds(1600000000 + c_custkey) AS dynamodb_new_image_updated_at_n",
        "timestamp_seconds(1600000000 + c_custkey) AS timestamp_extracted",
        "timestamp_seconds(1500000000) AS date",
    )


def card_orders(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "concat('C', o_custkey) AS dynamodb_new_image_user_id_s",
        "concat('C', o_custkey) AS dynamodb_keys_user_id_s",
        f"{ORDER_STAMP} AS dynamodb_new_image_created_at_n",
        f"CASE WHEN o_orderstatus <> 'P' THEN {ORDER_STAMP} END AS dynamodb_new_image_updated_at_n",
        f"{ORDER_STAMP} AS timestamp_extracted",
        "CAST(o_orderdate AS timestamp) AS date",
    )


def app_events(t: Tables) -> DataFrame:
    once = t.events.selectExpr(
        "user_id AS amplitude_id",
        "event_id",
        "CAST(ts AS timestamp) AS event_time",
        f"{SCREEN} AS event_type",
        "concat('C', user_id) AS user_id",
        "CASE WHEN value < 15 THEN 'iOS' ELSE 'Android' END AS platform",
    )
    return once.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


BUILDERS = {
    f.__name__: f
    for f in (
        customers, clients, deposit_accounts, deposit_transactions, riskscore, timeline, risk_form, payment_products,
        recurring_transfers, card_messages, cards, card_orders, app_events,
    )
}


def bank(t: Tables, *names: str) -> dict[str, DataFrame]:
    return {n: BUILDERS[n](t) for n in names}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the way the SQL side returns them."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- the same tables as DuckDB CTEs ------------------------------------------------------------------

_ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
_SUFFIX = "concat(o_custkey, '-', substr(o_orderpriority, 1, 1))"

CTES = {
    "b_cust": "SELECT "
    + ", ".join(
        f"{sql} AS {name}"
        for name, sql in {
            "keys_id": HISTORY_COLUMNS["dynamodb_keys_id_s"],
            "user_id": "concat('C', o_custkey)",
            "status": STATUS,
            "brand": BRAND,
            "country": COUNTRY,
            "income_code": INCOME,
            "assets_code": ASSETS,
            "card_ordered": "o_totalprice > 250000",
            "upd": "o_orderdate + to_microseconds(o_orderkey)",
        }.items()
    )
    + " FROM orders JOIN customer ON o_custkey = c_custkey",
    "b_client": "SELECT concat('C', c_custkey) AS id, concat('K', c_custkey) AS ckey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'ar' ELSE 'en' END AS lang FROM customer",
    "b_acct": f"""SELECT concat('A', {_SUFFIX}) AS id, concat('E', {_SUFFIX}) AS ekey, concat('K', o_custkey) AS holder, {NAME} AS name,
        CASE WHEN {NAME} LIKE '%Fixed%' THEN 'FIXED_DEPOSIT' ELSE 'SAVINGS' END AS kind, {STATE} AS state, {CURRENCY} AS ccy,
        CAST(o_totalprice AS DECIMAL(18,2)) AS balance, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS balance_text,
        CAST(concat(o_custkey, '.50') AS DECIMAL(18,3)) AS accrued, o_orderdate + to_microseconds(o_orderkey) AS modified,
        date_trunc('month', o_orderdate) AS activated, date_trunc('month', o_orderdate) + to_months({MONTHS}) AS matures,
        CASE WHEN o_orderstatus = 'O' AND o_totalprice > 450000 THEN date_trunc('month', o_orderdate) END AS closed,
        {RATE} AS rate, {TIERS[0]} AS t1, {TIERS[1]} AS t2, {TIERS[2]} AS t3 FROM orders""",
    "b_txn": f"""SELECT concat('T', l_orderkey, '-', l_linenumber) AS id, concat('E', {_SUFFIX}) AS ekey, {TYPE} AS type, {CURRENCY} AS ccy,
        {CHANNEL} AS channel, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS booked,
        l_shipdate + to_microseconds(l_partkey * 10000 + l_suppkey) AS extracted
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "b_risk": f"""SELECT concat('C', c_custkey) AS user_id, {ITEM_0} AS i0, {RANGE_0} AS r0, {ITEM_1} AS i1, {RANGE_1} AS r1, {WORTH_CODE} AS code,
        CASE WHEN c_nationkey <= 20 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS low,
        CASE WHEN c_nationkey <= 20 THEN CAST(c_acctbal + 1000 AS DECIMAL(18,2)) END AS high FROM customer""",
    "b_time": f"""SELECT concat('C', c_custkey) AS user_id, c_acctbal > 2000 AS email, c_acctbal > 5000 AS push, c_mktsegment = 'BUILDING' AS sms,
        {AGE} AS age_range, CASE WHEN c_nationkey < 5 THEN ' ' ELSE c_mktsegment END AS brand_id, {COUNTRY} AS nationality,
        CASE WHEN c_acctbal > 0 THEN 'Female' ELSE 'Male' END AS gender FROM customer WHERE c_nationkey < 23""",
    "b_form": """SELECT concat('C', o_custkey) AS user_id, o_orderpriority AS p, o_orderstatus AS s FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate + to_microseconds(o_orderkey) DESC) AS rn FROM orders) WHERE rn = 1""",
    "b_msg": f"""SELECT user_id AS token, ts, {WALLET} AS wallet, {KIND} AS kind, {STEP} AS step, {APPROVAL} AS approval, {REPLY} AS reply,
        {MESSAGE_TYPE} AS mtype, value - 3 AS billed, value < 45 AS approved, {SPEND} AS spend FROM events""",
    "b_card": """SELECT c_custkey AS token, concat('C', c_custkey) AS user_id, c_acctbal > 0 AS active,
        to_timestamp(1600000000 + c_custkey) AT TIME ZONE 'UTC' AS upd FROM customer""",
}
_RATES = "CASE {} WHEN 'USD' THEN 0.80 WHEN 'EUR' THEN 0.86 WHEN 'AED' THEN 0.22 WHEN 'KWD' THEN 2.65 WHEN 'SAR' THEN 0.22 ELSE 1.00 END"


def gbp(amount: str, ccy: str) -> str:
    return f"(CAST({amount} AS DECIMAL(18,3)) * CAST({_RATES.format(ccy)} AS DECIMAL(3,2)))"


def _mid(text: str) -> str:
    part = lambda i: f"TRY_CAST(string_split({text}, '_')[{i}] AS DECIMAL(18,3))"
    return f"CAST(({part(2)} + {part(3)}) * 0.5 AS DECIMAL(18,3))"


_INCOME = "('INCOME_FROM_PERSONAL_SAVINGS', 'SAVINGS_FROM_SALARY_OR_EARNINGS')"
_WEALTH = "('PROPERTY_SALES', 'OTHER', 'VIRTUAL_ASSETS')"


def means_ctes(fallback: bool) -> dict[str, str]:
    """Declared means and the income / assets values per customer, as CTEs ending in ``m_value``."""
    if fallback:
        income = "WHEN iv > 0 THEN iv WHEN ib > 0 THEN ib ELSE income"
        assets = "WHEN av > 0 THEN av WHEN ab > 0 THEN ab ELSE wealth"
    else:
        income, assets = "ELSE iv", "ELSE av"
    return {
        "m_items": f"""SELECT user_id, i0 AS item, {_mid('r0')} AS amount FROM b_risk UNION ALL SELECT user_id, i1, {_mid('r1')} FROM b_risk""",
        "m_sum": f"""SELECT user_id, sum(CASE WHEN item IN {_INCOME} THEN amount END) AS income, sum(CASE WHEN item IN {_WEALTH} THEN amount END) AS wealth
            FROM m_items GROUP BY 1""",
        "m_worth": f"SELECT user_id, CAST(({gbp('low', 'code')} + {gbp('high', 'code')}) * 0.5 AS DECIMAL(18,3)) AS worth FROM b_risk",
        "m_coded": f"""SELECT user_id, country, status, card_ordered, upd, {INCOME_VALUE} AS iv, {ASSETS_VALUE} AS av FROM b_cust""",
        "m_last": """SELECT c.*, max(iv) OVER (PARTITION BY user_id) AS ib, max(av) OVER (PARTITION BY user_id) AS ab,
            row_number() OVER (PARTITION BY user_id ORDER BY upd DESC) AS rn FROM m_coded c""",
        "m_pick": f"""SELECT l.user_id, country, status, card_ordered, worth, income, wealth,
            CASE WHEN country = 'ARE' AND income <> 0 THEN income {income} END AS ig,
            CASE WHEN country = 'ARE' AND wealth > 0 THEN wealth WHEN coalesce(wealth, 0) = 0 AND worth > 0 THEN worth {assets} END AS ag
            FROM m_last l LEFT JOIN m_sum s ON s.user_id = l.user_id LEFT JOIN m_worth w ON w.user_id = l.user_id WHERE rn = 1""",
        "m_value": """SELECT *, CASE WHEN i >= 100000 OR a >= 200000 THEN 'Affluent' WHEN i >= 50000 OR a >= 60000 THEN 'Mass Affluent'
            WHEN i < 50000 OR a < 60000 THEN 'Mass' END AS affluency FROM (SELECT *,
            CASE WHEN ig IS NULL AND ag IS NOT NULL THEN 0 ELSE ig END AS i, CASE WHEN ag IS NULL AND ig IS NOT NULL THEN 0 ELSE ag END AS a FROM m_pick)""",
    }


def with_ctes(names: str, query: str, extra: dict[str, str] | None = None) -> str:
    parts = {n: CTES[n] for n in names.split()} | (extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in parts.items()) + "\n" + query
