"""Account, deposit, affluency and card reports over bank-shaped tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.bank import PRODUCT_CURRENCY, PRODUCT_OFFER, PRODUCT_TERM, bank, gbp, means_ctes, plain, with_ctes
from checks.registry import check
from ledgerlake.plans import affluency, engagement, incentive, lifecycle, savings, term_deposits
from ledgerlake.plans.names import TERM_ACCOUNTS

BRAND = "HOUSE"
STAMP = "'%d/%m/%Y %H:%M'"
LONG = "'%d/%m/%Y %I:%M:%S %p'"


def dbl(sql: str, name: str) -> str:
    return f"CAST({sql} AS DOUBLE) AS {name}"


CCY = ("gbp", "eur", "usd", "aed", "sar", "kwd")
_R1_MATURE = ", ".join(
    f"max(CASE WHEN name = '{n}' THEN matures END) AS {c}_maturity_date, max(CASE WHEN name = '{n}' THEN CAST(approved AS DATE) END) AS {c}_last_in_date"
    for n, c in TERM_ACCOUNTS.items()
)
_R1_OUT = []
for _c in incentive.REPORT_COLUMNS:
    if _c == "customer_id":
        _R1_OUT.append("e.customer_id")
    elif "date" in _c:
        _R1_OUT.append(f"strftime({_c}, {STAMP}) AS {_c}")
    else:
        _R1_OUT.append(f"CAST(round({_c}, 2) AS DOUBLE) AS {_c}")


@check(
    "r1_partner_incentives",
    with_ctes(
        "b_cust b_client b_acct b_txn",
        f"""SELECT {', '.join(_R1_OUT)} FROM (SELECT DISTINCT customer_id FROM cust) e
        LEFT JOIN totals t ON t.customer_id = e.customer_id LEFT JOIN sub s ON s.customer_id = e.customer_id
        LEFT JOIN per_customer p ON p.customer_id = e.customer_id LEFT JOIN bal b ON b.holder = t.holder""",
        {
            "cust": "SELECT user_id AS customer_id, status, upd FROM b_cust",
            "sub": "SELECT customer_id, max(upd) AS submit_application_datetime FROM cust WHERE status = 'AWAITING_MANUAL_REVIEW' GROUP BY 1",
            "acct": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ekey, holder, name ORDER BY modified DESC) AS rn FROM b_acct) WHERE rn = 1",
            "txn": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ekey, id, type, channel ORDER BY booked DESC, amount DESC, ccy DESC) AS rn
                FROM b_txn WHERE channel <> '') WHERE rn = 1""",
            "merged": """SELECT c.id AS customer_id, a.holder, a.name, a.modified AS approved, t.* EXCLUDE (rn),
                regexp_matches(t.channel, 'CB_Deposit_BACS|CC_Deposit_GBP') AS inbound
                FROM b_client c JOIN acct a ON a.holder = c.ckey JOIN txn t ON t.ekey = a.ekey
                WHERE c.id IN (SELECT customer_id FROM cust)""",
            "totals": "SELECT customer_id, holder, "
            + ", ".join(f"sum(CASE WHEN ccy = '{c.upper()}' THEN amount END) AS total_inbound_payment_{c}" for c in CCY)
            + " FROM merged WHERE type = 'DEPOSIT' AND inbound GROUP BY 1, 2",
            "mat": "SELECT holder, name, max(CAST(matures AS DATE)) AS matures FROM b_acct WHERE matures IS NOT NULL GROUP BY 1, 2",
            "per_name": """SELECT customer_id, holder, name, min(approved) AS approved, min(CASE WHEN inbound THEN booked END) AS f,
                max(CASE WHEN type = 'WITHDRAWAL' THEN booked END) AS d FROM merged GROUP BY 1, 2, 3""",
            "per_customer": f"""SELECT customer_id, min(f) AS first_deposit_transaction_date, max(d) AS last_transaction_date,
                min(approved) AS approved_date, {_R1_MATURE} FROM per_name p LEFT JOIN mat m USING (holder, name) GROUP BY 1""",
            "last_bal": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY holder, name ORDER BY modified DESC) AS rn FROM b_acct) WHERE rn = 1",
            "bal": "SELECT holder, "
            + ", ".join(f"sum(CASE WHEN contains(name, '{c.upper()}') THEN balance END) AS last_balance_{c}" for c in CCY)
            + ", "
            + ", ".join(f"sum(CASE WHEN name = '{n}' THEN balance END) AS {c}_balance" for n, c in TERM_ACCOUNTS.items())
            + " FROM last_bal GROUP BY 1",
        },
    ),
)
def _(t):
    return plain(incentive.partner_incentives(bank(t, "customers", "clients", "deposit_accounts", "deposit_transactions")))


@check(
    "r2_affluency",
    with_ctes(
        "b_cust b_risk b_time",
        """SELECT DISTINCT v.user_id, coalesce(affluency, 'Unknown') AS affluency, CASE WHEN age_range = '' THEN 'Unknown' ELSE age_range END AS age_range
        FROM m_value v LEFT JOIN b_time t ON t.user_id = v.user_id""",
        means_ctes(False),
    ),
)
def _(t):
    return affluency.affluency(bank(t, "customers", "riskscore", "timeline"))


@check(
    "r2_taxonomy",
    with_ctes(
        "b_cust b_risk b_time",
        f"""SELECT v.user_id, CASE WHEN coalesce(country, '') = '' THEN 'Unknown' ELSE country END AS country_code, status AS current_status,
            CAST(coalesce(card_ordered, false) AS INTEGER) AS card_ordered, {dbl('worth', 'average_net_worth')}, {dbl('i', 'income_gbp_value')},
            {dbl('a', 'assets_gbp_value')}, affluency, CASE WHEN age_range = '' THEN 'Unknown' ELSE age_range END AS age_range,
            CASE WHEN nationality = '' THEN 'Unknown' ELSE nationality END AS nationality, gender,
            CASE WHEN t.user_id IS NULL THEN NULL WHEN trim(brand_id) = '' THEN '{BRAND}' ELSE brand_id END AS brand_id,
            CASE WHEN card_ordered THEN 20.7 ELSE 0.0 END::DOUBLE AS card_cost, CAST(status = 'APPROVED' AS INTEGER) AS approved_customer,
            CASE WHEN i > 0 AND a > 0 THEN 'Income and Wealth' WHEN i > 0 THEN 'Income' WHEN a > 0 THEN 'Wealth' END AS income_wealth_type,
            CAST(coalesce(country = 'ARE' AND income > 0 AND coalesce(wealth, 0) = 0, false) AS INTEGER) AS uae_cust_zero_wealth
        FROM m_value v LEFT JOIN b_time t ON t.user_id = v.user_id""",
        means_ctes(False),
    ),
)
def _(t):
    rows = affluency.taxonomy(bank(t, "customers", "riskscore", "timeline"), BRAND)
    known = F.col("age_range").isNotNull() | F.col("nationality").isNotNull()
    out = plain(rows).drop("uae_cust_no_income_wealth_riskscore")
    return out.withColumn("brand_id", F.when(F.col("gender").isNotNull() | known, F.col("brand_id")))


_BRACKET = lambda c, bounds, top: (
    f"CASE WHEN {c} IS NULL THEN NULL " + " ".join(f"WHEN {c} <= {b} THEN '{n}'" for b, n in bounds) + f" ELSE '{top}' END"
)


@check(
    "r4_customer_profile",
    with_ctes(
        "b_cust b_risk b_time b_form",
        f"""SELECT t.user_id, t.nationality, t.age_range, CASE WHEN trim(t.brand_id) = '' THEN '{BRAND}' ELSE t.brand_id END AS brand_id, t.gender,
            v.country AS country_code, v.status AS current_status, v.card_ordered, {dbl('worth', 'average_net_worth')},
            {dbl('i', 'income_gbp_value')}, {dbl('a', 'assets_gbp_value')}, v.affluency,
            CASE WHEN v.user_id IS NOT NULL THEN CAST(coalesce(country = 'ARE' AND coalesce(income, 0) = 0 AND coalesce(wealth, 0) = 0, false) AS INTEGER) END AS uae_cust_no_income_wealth_riskscore,
            CASE WHEN v.user_id IS NOT NULL THEN CAST(coalesce(country = 'ARE' AND income > 0 AND coalesce(wealth, 0) = 0, false) AS INTEGER) END AS uae_cust_zero_wealth,
            {_BRACKET('i', affluency.INCOME_BRACKETS, 'Over £500,000pa')} AS income_bracket,
            {_BRACKET('a', affluency.WEALTH_BRACKETS, 'Over £1,000,000')} AS wealth_bracket,
            CASE WHEN i > 0 AND a > 0 THEN 'Income and Wealth' WHEN i > 0 THEN 'Income' WHEN a > 0 THEN 'Wealth' END AS income_wealth_type,
            s.item AS income_wealth_value, s.n AS income_wealth_source_count, o.v AS occupation, o.n AS occupation_count, c.v AS circumstance, c.n AS circumstance_count
        FROM b_time t LEFT JOIN m_value v ON v.user_id = t.user_id LEFT JOIN src s ON s.user_id = v.user_id
        LEFT JOIN occ o ON o.user_id = t.user_id LEFT JOIN cir c ON c.user_id = t.user_id""",
        means_ctes(True)
        | {
            "src": """SELECT user_id, item, count(*) OVER (PARTITION BY user_id, item IN ('INCOME_FROM_PERSONAL_SAVINGS', 'SAVINGS_FROM_SALARY_OR_EARNINGS')) AS n
                FROM (SELECT DISTINCT user_id, item FROM m_items WHERE item IS NOT NULL)""",
            "occ": "SELECT user_id, v, count(v) OVER (PARTITION BY user_id) AS n FROM (SELECT user_id, p AS v FROM b_form UNION SELECT user_id, s FROM b_form)",
            "cir": """SELECT user_id, v, count(v) OVER (PARTITION BY user_id) AS n FROM
                (SELECT user_id, p AS v FROM b_form UNION SELECT user_id, s FROM b_form WHERE s <> 'P')""",
        },
    ),
)
def _(t):
    return plain(affluency.customer_profile(bank(t, "customers", "riskscore", "timeline", "risk_form"), BRAND))


TODAY = dt.date(2001, 3, 15)
_TIER_NAME = "CASE " + " ".join(
    f"WHEN state = 'ACTIVE' AND ccy = '{c}' AND balance >= {low} THEN '{c} Tier {i}'"
    for c, bounds in savings.TIER_BOUNDS.items()
    for i, low in reversed(list(enumerate(bounds, start=1)))
) + " ELSE 'Not Active' END"


def _r3_currency(c: str) -> str:
    last = "last_deposit_date" if c == "EUR" else "last_transaction_date"
    low = c.lower()
    mine = f"starts_with(a.name, '{c}')"
    rates = ", ".join(
        f"CASE WHEN {mine} THEN r.{p} END AS ias_dynamic_rate_{low}_{p}" for p in ("tier_1", "tier_2", "tier_3", "top_rate")
    )
    return f"""CAST({mine} AND state = 'ACTIVE' AS INTEGER) AS ias_{low}_is_open, CASE WHEN {mine} THEN first_d END AS ias_{low}_first_deposit_date,
        CASE WHEN {mine} THEN last_d END AS ias_{low}_{last}, CASE WHEN {mine} THEN balance_text END AS ias_{low}_current_balance, {rates}"""


@check(
    "r3_savings_accounts",
    with_ctes(
        "b_client b_acct b_txn",
        f"""SELECT a.user_id AS ias_customer_id, a.ekey AS ias_encoded_key, a.id AS ias_account_id, a.name AS ias_account_name, a.ccy AS ias_currency_code,
            CASE right(tier, 1) WHEN '1' THEN r.tier_1 WHEN '2' THEN r.tier_2 WHEN '3' THEN r.tier_3 ELSE 'Not Active' END AS customer_active_currency_tier_rate,
            tier AS customer_active_currency_tier_name, CAST(opened AS DATE) AS ias_open_date, state AS ias_account_state,
            {', '.join(_r3_currency(c) for c in savings.TIER_BOUNDS)},
            count(*) FILTER (state = 'ACTIVE') OVER (PARTITION BY a.user_id) AS ias_no_active_accounts,
            CAST(count(*) FILTER (state = 'ACTIVE') OVER (PARTITION BY a.user_id) < count(*) OVER (PARTITION BY a.user_id) AS INTEGER) AS ias_has_opened_prev,
            {dbl('interest', 'ias_interest_accrued_amount')}, rec.active AS ias_recurring_transfer
        FROM (SELECT *, {_TIER_NAME} AS tier FROM acct) a LEFT JOIN rates r ON r.name = a.name LEFT JOIN intr i ON i.ekey = a.ekey LEFT JOIN rec ON rec.id = a.id""",
        {
            "tx": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, type ORDER BY extracted DESC) AS rn FROM b_txn WHERE booked >= '1997-07-01') WHERE rn = 1""",
            "dep": "SELECT ekey, CAST(min(booked) AS DATE) AS first_d, CAST(max(booked) AS DATE) AS last_d FROM tx WHERE type = 'DEPOSIT' GROUP BY 1",
            "intr": "SELECT ekey, sum(amount) AS interest FROM tx WHERE type = 'INTEREST_APPLIED' AND booked < '2001-04-01' GROUP BY 1",
            "hist": """SELECT *, first_value(activated) OVER (PARTITION BY ekey ORDER BY modified) AS opened,
                row_number() OVER (PARTITION BY ekey ORDER BY modified DESC) AS rn FROM b_acct WHERE name LIKE '%Instant%'""",
            "acct": "SELECT h.*, c.id AS user_id, first_d, last_d FROM hist h JOIN b_client c ON c.ckey = h.holder JOIN dep d ON d.ekey = h.ekey WHERE rn = 1",
            "seen": """SELECT name, CAST(t1 AS DECIMAL(18,2)) AS t1, CAST(t2 AS DECIMAL(18,2)) AS t2, CAST(t3 AS DECIMAL(18,2)) AS t3,
                max(CAST(modified AS DATE)) AS m FROM b_acct WHERE name LIKE '%Instant%' GROUP BY ALL""",
            "rates": """SELECT name, t1 || '%' AS tier_1, t2 || '%' AS tier_2, t3 || '%' AS tier_3, greatest(t1, t2, t3) || '%' AS top_rate FROM
                (SELECT *, row_number() OVER (PARTITION BY name ORDER BY m DESC, t1 DESC, t2 DESC, t3 DESC) AS rn FROM seen) WHERE rn = 1""",
            "rec": """SELECT id, active FROM (SELECT concat('A', o_custkey, '-', substr(o_orderpriority, 1, 1)) AS id, o_totalprice > 200000 AS active,
                row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY epoch_ms(o_orderdate) + o_orderkey DESC, o_totalprice > 200000 DESC) AS rn
                FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1""",
        },
    ),
)
def _(t):
    tables = bank(t, "clients", "deposit_accounts", "deposit_transactions", "recurring_transfers")
    return plain(savings.savings_accounts(tables, TODAY, since=dt.date(1997, 7, 1)))


_SK = f"concat({PRODUCT_CURRENCY}, ':ftd_', {PRODUCT_TERM}, ':', {PRODUCT_OFFER})"
_R5_RATES = []
for _ccy in term_deposits.RATE_CURRENCIES:
    for _i in (0, 1):
        _R5_RATES.append(f"max(CASE WHEN sk = '{_ccy}:ftd_3m:default' THEN min_{_i} END) AS ftd_{_ccy}_rate_{_i}_min_amount")
    for _offer, _label in term_deposits.OFFERS.items():
        for _i in (0, 1):
            for _term in term_deposits.TERMS:
                _R5_RATES.append(
                    f"max(CASE WHEN sk = '{_ccy}:ftd_{_term}:{_offer}' THEN r{_i} || '%' END) AS ftd_{_ccy}_{_term}_rate_{_i}_{_label}"
                )
_R5_TOTALS = []
for _ccy in ("GBP", "EUR", "USD"):
    _l = _ccy.lower()
    _R5_TOTALS += [
        f"count(*) FILTER (ccy = '{_ccy}') AS ftd_number_{_l}_ftds",
        f"CAST(sum(balance) FILTER (ccy = '{_ccy}') AS DOUBLE) AS ftd_{_l}_total_balance",
        f"CAST(sum(balance) FILTER (ccy = '{_ccy}' AND last_state = 'ACTIVE') AS DOUBLE) AS ftd_{_l}_cur_balance",
        f"coalesce(bool_or(ccy = '{_ccy}' AND last_state = 'ACTIVE'), false) AS ftd_{_l}_is_currently_open",
        f"bool_or(ccy = '{_ccy}') AS ftd_{_l}_has_open",
        f"min(modified) FILTER (ccy = '{_ccy}') AS ftd_{_l}_first_inbound_date",
        f"max(modified) FILTER (ccy = '{_ccy}') AS ftd_{_l}_last_inbound_date",
    ]


@check(
    "r5_term_deposits",
    with_ctes(
        "b_cust b_client b_acct b_txn b_risk b_time",
        f"""SELECT d.user_id AS ftd_customer_id, d.holder AS ftd_account_holder_key, coalesce(v.affluency, '') AS ftd_affluency,
            CASE WHEN c.user_id IS NOT NULL THEN coalesce(nullif(nullif(c.brand, ''), '<NA>'), '{BRAND}') END AS ftd_brand_id,
            c.country AS ftd_residence_country_code, c.status AS ftd_customer_status, d.id AS ftd_account_id, d.kind AS ftd_account_type, d.name AS ftd_name,
            d.last_state AS ftd_account_state, CASE WHEN n_months + 1 = 4 THEN '3-months' ELSE (n_months + 1) || '-months' END AS ftd_term,
            {dbl('CAST(d.rate AS DECIMAL(18,2))', 'ftd_interest_rate')}, d.ccy AS ftd_currency_code, {dbl('d.balance', 'ftd_balance')},
            {dbl(gbp('d.balance', 'd.ccy'), 'ftd_balance_in_gbp')}, {dbl('CAST(coalesce(mi.amount, d.accrued) AS DECIMAL(18,2))', 'ftd_interest_accrued_amount')},
            d.modified AS ftd_open_date, d.matures AS ftd_maturity_date, CAST(d.matures + INTERVAL 1 HOUR AS DATE) AS ftd_maturity_date_plus_1hr,
            {dbl('mp.amount', 'ftd_balance_at_maturity')}, {dbl('CAST(' + gbp('mp.amount', 'd.ccy') + ' AS DECIMAL(18,2))', 'ftd_balance_at_maturity_in_gbp')},
            d.next_id AS ftd_next_account_id, d.next_approved AS ftd_next_approved_date,
            {', '.join(f"CAST(coalesce(CAST(next_approved AS DATE) BETWEEN CAST(matures AS DATE) AND CAST(matures AS DATE) + {n}, false) AS INTEGER) AS ftd_opened_within_{n}_days_maturity" for n in (1, 3, 7, 14))},
            tot.* EXCLUDE (user_id), rr.*, top.*, rule.days AS ftd_offer_days,
            CASE WHEN rule.days <> -1 THEN CAST(CAST(d.matures + INTERVAL 1 HOUR AS DATE) + rule.days AS DATE) END AS ftd_offer_expired_date
        FROM dep d LEFT JOIN cur c ON c.user_id = d.user_id LEFT JOIN m_value v ON v.user_id = d.user_id AND v.user_id IN (SELECT user_id FROM b_time)
        LEFT JOIN tot ON tot.user_id = d.user_id
        LEFT JOIN mat mi ON mi.ekey = d.ekey AND mi.type = 'INTEREST_APPLIED' AND c.user_id IS NOT NULL
        LEFT JOIN mat mp ON mp.ekey = d.ekey AND mp.type = 'WITHDRAWAL' AND c.user_id IS NOT NULL
        CROSS JOIN rr CROSS JOIN top CROSS JOIN rule""",
        means_ctes(True)
        | {
            "cur": "SELECT user_id, status, brand, country FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY upd DESC) AS rn FROM b_cust) WHERE rn = 1",
            "fixed": "SELECT *, row_number() OVER (PARTITION BY id ORDER BY modified DESC) AS rl FROM b_acct WHERE name LIKE '%Fixed%'",
            "early": "SELECT DISTINCT id FROM b_acct WHERE closed < matures",
            "act": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY holder, id ORDER BY modified DESC) AS rn FROM fixed
                WHERE state = 'ACTIVE' AND id NOT IN (SELECT id FROM early)) WHERE rn = 1 AND matures IS NOT NULL""",
            "dep": """SELECT a.*, cl.id AS user_id, f.state AS last_state, date_sub('month', a.activated, a.matures) AS n_months,
                lead(a.modified) OVER w AS next_approved, lead(a.id) OVER w AS next_id FROM act a LEFT JOIN b_client cl ON cl.ckey = a.holder
                JOIN fixed f ON f.id = a.id AND f.rl = 1 WINDOW w AS (PARTITION BY a.holder ORDER BY a.modified, a.id)""",
            "tx": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, type IN ('INTEREST_APPLIED', 'WITHDRAWAL') ORDER BY extracted DESC) AS rn FROM b_txn) WHERE rn = 1",
            "mat": """SELECT ekey, type, amount FROM (SELECT *, row_number() OVER (PARTITION BY ekey, type ORDER BY booked DESC, id DESC) AS r2 FROM tx
                WHERE type IN ('INTEREST_APPLIED', 'WITHDRAWAL')) WHERE r2 = 1""",
            "tot": f"SELECT user_id, {', '.join(_R5_TOTALS)} FROM dep GROUP BY 1",
            "prod": f"""SELECT * FROM (SELECT {_SK} AS sk, '1000' AS min_0, '50000' AS min_1,
                coalesce(CASE WHEN p_size <= 40 THEN p_size + CAST(0.5 AS DECIMAL(18,2)) END - CAST(0.25 AS DECIMAL(18,2)), CAST(3.00 AS DECIMAL(18,2))) AS r0,
                coalesce(CASE WHEN p_size <= 40 THEN p_size + CAST(0.5 AS DECIMAL(18,2)) END - CAST(0.10 AS DECIMAL(18,2)), CAST(3.50 AS DECIMAL(18,2))) AS r1,
                row_number() OVER (PARTITION BY {_SK} ORDER BY p_partkey DESC) AS rn FROM part) WHERE rn = 1""",
            "pref": """SELECT a.sk, a.min_0, a.min_1, left(a.sk, 3) AS ccy, b.r0 + CAST(0.15 AS DECIMAL(18,2)) AS r0, b.r1 + CAST(0.20 AS DECIMAL(18,2)) AS r1
                FROM prod a JOIN prod b ON replace(a.sk, ':post_maturity_reinvestment', '') = replace(b.sk, ':default', '') AND b.sk LIKE '%default'
                WHERE a.sk LIKE '%reinvestment'""",
            "both_rates": "SELECT sk, min_0, min_1, r0, r1 FROM pref UNION ALL SELECT sk, min_0, min_1, r0, r1 FROM prod WHERE sk LIKE '%default'",
            "rr": f"SELECT {', '.join(_R5_RATES)} FROM both_rates",
            "top": """SELECT max(greatest(r0, r1)) FILTER (ccy = 'eur') || '%' AS ftd_top_pref_rate_euro, max(greatest(r0, r1)) FILTER (ccy = 'gbp') || '%' AS ftd_top_pref_rate_gbp,
                max(greatest(r0, r1)) FILTER (ccy = 'usd') || '%' AS ftd_top_pref_rate_usd, max(greatest(r0, r1)) || '%' AS ftd_top_pref_rate_overall FROM pref""",
            "rule": "SELECT p_size AS days FROM part ORDER BY p_partkey DESC LIMIT 1",
        },
    ),
)
def _(t):
    names = ("customers", "clients", "deposit_accounts", "deposit_transactions", "payment_products", "riskscore", "timeline", "risk_form")
    return plain(term_deposits.term_deposits(bank(t, *names), BRAND))


_R6_OUT = []
for _n in lifecycle.ACCOUNT_NAMES:
    _l = _n.replace(" ", "_")
    _R6_OUT += [
        f"strftime(max(CASE WHEN h.name = '{_n}' THEN last_in END), {LONG}) AS {_l}_Last_Inbound_Payment_Date",
        f"CAST(max(CASE WHEN h.name = '{_n}' THEN balance END) AS DOUBLE) AS {_l}_Total_Balance",
        f"strftime(max(CASE WHEN h.name = '{_n}' THEN first_in END), {LONG}) AS {_l}_First_Inbound_Payment_Date",
    ]
_LISTED = ", ".join(f"'{n}'" for n in lifecycle.ACCOUNT_NAMES)


@check(
    "r6_lifecycle_extract",
    with_ctes(
        "b_cust b_client b_acct b_txn b_msg b_card",
        f"""SELECT p.user_id AS "Reference_ID", p.co AS "Card_Ordered", max(lang) AS preferred_language,
            strftime(max(first_app), {LONG}) AS "First_APP_Trans_Date", strftime(max(last_app), {LONG}) AS "Last_APP_Trans_Date",
            strftime(max(first_card), {LONG}) AS "First_Card_Trans_Date", strftime(max(last_card), {LONG}) AS "Last_Card_Trans_Date",
            strftime(max(k.upd), {LONG}) AS "Card_Activation_Date", strftime(max(co.ordered), {LONG}) AS "Card_Ordered_Date",
            CASE WHEN max(first_app) IS NOT NULL THEN 'YES' ELSE 'NO' END AS "Cus_Has_Apple_Pay",
            coalesce(string_agg(h.name, ', ' ORDER BY h.name DESC), '') AS "Account_Types", {', '.join(_R6_OUT)},
            strftime(max(CASE WHEN h.name NOT IN ({_LISTED}) THEN last_in END), {LONG}) AS "Other_Inbound_Payment_Date",
            CAST(max(CASE WHEN h.name NOT IN ({_LISTED}) THEN balance END) AS DOUBLE) AS "Other_Balances_Total_Balance",
            strftime(max(CASE WHEN h.name NOT IN ({_LISTED}) THEN first_in END), {LONG}) AS "Other_First_Inbound_Payment_Date"
        FROM people p LEFT JOIN b_client c ON c.id = p.user_id LEFT JOIN held h ON h.holder = c.ckey
        LEFT JOIN (SELECT * FROM b_card WHERE active) k ON k.user_id = p.user_id LEFT JOIN msg m ON m.token = k.token
        LEFT JOIN co ON co.user_id = p.user_id GROUP BY p.user_id, p.co""",
        {
            "people": """SELECT keys_id AS user_id, CASE WHEN card_ordered THEN 'YES' ELSE 'NO' END AS co FROM
                (SELECT *, row_number() OVER (PARTITION BY keys_id ORDER BY upd DESC) AS rn FROM b_cust WHERE keys_id IS NOT NULL) WHERE rn = 1 AND status = 'APPROVED'""",
            "acct": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY modified DESC) AS rn FROM b_acct) WHERE rn = 1",
            "tx": """SELECT *, row_number() OVER (PARTITION BY id ORDER BY extracted DESC) AS rl, row_number() OVER (PARTITION BY id ORDER BY extracted) AS rf
                FROM b_txn WHERE type = 'DEPOSIT'""",
            "inb": "SELECT ekey, max(CASE WHEN rl = 1 THEN booked END) AS last_in, min(CASE WHEN rf = 1 THEN booked END) AS first_in FROM tx GROUP BY 1",
            "held": "SELECT a.holder, a.name, a.balance, last_in, first_in FROM acct a LEFT JOIN inb i ON i.ekey = a.ekey",
            "msg": """SELECT token, min(ts) FILTER (wallet = '103' AND spend <> 'POS - Purchase with Cash Back') AS first_app,
                max(ts) FILTER (wallet = '103' AND spend <> 'POS - Purchase with Cash Back') AS last_app, min(ts) FILTER (wallet <> '103') AS first_card,
                max(ts) FILTER (wallet <> '103') AS last_card FROM b_msg WHERE billed >= 0 AND approved GROUP BY 1""",
            "co": """SELECT concat('C', o_custkey) AS user_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_microseconds(o_orderkey) ELSE o_orderdate END AS ordered
                FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
        },
    ),
)
def _(t):
    names = ("customers", "clients", "deposit_accounts", "deposit_transactions", "cards", "card_messages", "card_orders")
    return plain(lifecycle.lifecycle_extract(bank(t, *names)))


@check(
    "r7_first_funded_accounts",
    with_ctes(
        "b_cust b_client b_acct b_txn b_time",
        f"""SELECT a.ekey AS encoded_key, a.id, a.name, a.holder AS account_holder_key, a.state AS account_state, a.kind AS account_type,
            a.balance_text AS balances_total_balance, strftime(a.modified, '%Y-%m-%dT%H:%M:%S.%fZ') AS last_modified_date, f.type AS type_funding,
            CAST(f.amount AS VARCHAR) AS funded_amount, {dbl(gbp('f.amount', 'f.ccy'), 'gbp_amount')}, f.channel AS channel_id, f.channel AS type_transaction,
            f.ccy AS currency_code, t.push AS has_opted_out_of_push, c.id AS customer_id, f.booked AS first_date_funded
        FROM acct a JOIN b_client c ON c.ckey = a.holder JOIN cur ON cur.user_id = c.id JOIN fund f ON f.ekey = a.ekey LEFT JOIN b_time t ON t.user_id = c.id
        WHERE f.booked >= '1998-03-01'""",
        {
            "cur": """SELECT user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY upd DESC) AS rn FROM b_cust)
                WHERE rn = 1 AND status = 'APPROVED'""",
            "acct": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY holder ORDER BY modified, ekey) AS rn FROM b_acct WHERE balance > 0) WHERE rn = 1",
            "tx": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY extracted) AS rn FROM b_txn WHERE type = 'DEPOSIT') WHERE rn = 1",
            "fund": "SELECT * FROM (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY ekey ORDER BY booked, id) AS r2 FROM tx) WHERE r2 = 1",
        },
    ),
)
def _(t):
    tables = bank(t, "customers", "clients", "deposit_accounts", "deposit_transactions", "timeline")
    return plain(engagement.first_funded_accounts(tables, dt.date(1998, 3, 4), BRAND, since="1990-01-01"))


@check(
    "r8_wallet_activations",
    with_ctes(
        "b_msg b_card b_time",
        """SELECT k.user_id AS dynamodb_new_image_user_id_s, m.token AS dynamodb_new_image_token_n, m.ts AS dynamodb_new_image_updated_at_n,
            m.kind AS dynamodb_new_image_message_m_iso_msg_m_de124_m_1_s, 1 AS rn, m.rn_first, m.step AS dynamodb_new_image_message_m_iso_msg_m_de124_m_3_s,
            m.approval AS dynamodb_new_image_message_m_iso_msg_m_de124_m_7_s, m.wallet AS dynamodb_new_image_message_m_iso_msg_m_de48_m_26_s,
            CASE WHEN m.wallet = '103' THEN 'Apple Pay' ELSE 'Google Pay' END AS "Wallet_Ind", 'Approve' AS "Approved_Ind",
            t.email AS email_notifications_m_marketing, t.push AS push_notifications_m_marketing, t.sms AS sms_notifications_m_marketing,
            CASE WHEN rn_first = 1 THEN 'Yes' ELSE 'NO' END AS first_activation
        FROM m JOIN b_card k ON k.token = m.token LEFT JOIN b_time t ON t.user_id = k.user_id WHERE m.rn = 1 AND (t.email OR t.push OR t.sms)""",
        {
            "m": """SELECT *, row_number() OVER (PARTITION BY token ORDER BY ts DESC) AS rn, row_number() OVER (PARTITION BY token ORDER BY ts) AS rn_first
                FROM b_msg WHERE wallet IN ('103', '216') AND step IN ('01', '7') AND approval IN ('1', '2')"""
        },
    ),
)
def _(t):
    return engagement.wallet_activations(bank(t, "card_messages", "cards", "timeline"))


@check(
    "r9_wallet_usage",
    with_ctes(
        "b_msg b_card",
        """SELECT k.user_id AS customer_id, CASE m.wallet WHEN '103' THEN 'Apple_Pay' ELSE 'Google_Pay' END AS wallet_indicator,
            max(CAST(ts AS DATE)) AS latest_transaction_wallet_date FROM b_msg m LEFT JOIN b_card k ON k.token = m.token
        WHERE wallet IN ('103', '216') AND coalesce(kind, 'XX') NOT IN ('AC', 'TC', 'TV', 'TA', 'TE') AND CAST(reply AS DECIMAL(18,3)) = 0
          AND CAST(mtype AS DECIMAL(18,3)) IN (100, 120) GROUP BY 1, 2""",
    ),
)
def _(t):
    return engagement.wallet_usage(bank(t, "card_messages", "cards"))


@check(
    "r10_screen_visits",
    with_ctes(
        "b_time",
        """SELECT e.user_id AS amplitude_id, e.event_id, e.ts AS event_time, sc AS event_type, t.user_id, CASE WHEN value < 15 THEN 'iOS' ELSE 'Android' END AS platform,
            t.email AS email_notifications_m_marketing, t.push AS push_notifications_m_marketing, t.sms AS sms_notifications_m_marketing, t.brand_id
        FROM (SELECT *, CASE event_type WHEN 'click' THEN 'Screen_Prop_Fin_Type' WHEN 'view' THEN 'screen_legal_agreement' WHEN 'signup' THEN 'screen_home'
              ELSE 'screen_BTLdashboard' END AS sc FROM events) e JOIN b_time t ON t.user_id = concat('C', e.user_id)
        WHERE sc <> 'screen_home' AND CAST(ts AS DATE) >= DATE '2024-01-17' AND (t.email OR t.push OR t.sms)""",
    ),
)
def _(t):
    return engagement.screen_visits(bank(t, "app_events", "timeline"), dt.date(2024, 1, 20))
