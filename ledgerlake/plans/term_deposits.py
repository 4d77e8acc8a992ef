"""Fixed-term deposits: product rates, accounts, renewals and customer totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import add_days, epoch_to_ts, iso_ts, months_between
from ledgerlake.functions.numbers import money, to_gbp
from ledgerlake.functions.text import clean_null
from ledgerlake.operators.aggregate import pivot_to_row
from ledgerlake.operators.joins import attach_row, attach_scalar, exclude_keys
from ledgerlake.operators.latest import latest_extract, latest_per_key
from ledgerlake.operators.setops import stack_rows, union_all
from ledgerlake.operators.windows import with_global, with_next
from ledgerlake.plans.affluency import customer_affluency
from ledgerlake.plans.customers import BRAND, COUNTRY, STATUS, Tables, change_order, customer_id
from ledgerlake.session import materialize

SK = "dynamodb_new_image_sk_s"
PRODUCT = "dynamodb_new_image_product_encoded_key_s"
CHANGED = "dynamodb_new_image_updated_at_n"
OFFER_RULE = "ftd:rule:post_maturity_reinvestment"

# Currencies, terms and offers of the rate table.
RATE_CURRENCIES = ("gbp", "usd", "eur")
TERMS = ("3m", "6m", "12m")
OFFERS = {"default": "default_rate", "post_maturity_reinvestment": "preferential_rate"}
REPORT_CURRENCIES = ("GBP", "EUR", "USD")
WINDOWS = (1, 3, 7, 14)


def _percent(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("%"))


def product_rates(products: DataFrame) -> DataFrame:
    """Latest row of every term-deposit product with its tier rates."""
    tiers = []
    for i in (0, 1):
        margin = money(f"dynamodb_new_image_rates_l_{i}_m_profit_margin_n", 2)
        listed = money(f"dynamodb_new_image_rates_l_{i}_m_rate_n", 2)
        tiers += [
            F.coalesce(money("dynamodb_new_image_interest_rate_n", 2) - margin, listed).alias(f"rate_{i}"),
            money(f"dynamodb_new_image_rates_l_{i}_m_bonus_rate_n", 2).alias(f"bonus_{i}"),
        ]
    rows = products.filter(F.col(SK).like("%:ftd_%")).select(
        F.col(SK).alias("sk"),
        F.col(PRODUCT).alias("product_key"),
        F.col("dynamodb_new_image_min_amount_n").alias("min_0"),
        F.col("dynamodb_new_image_rates_l_1_m_min_amount_n").alias("min_1"),
        *tiers,
        epoch_to_ts(CHANGED, "s").alias("changed"),
    )
    return latest_per_key(rows, ["product_key", "sk"], ["changed", "rate_0", "rate_1"])


def preferential_rates(latest: DataFrame) -> DataFrame:
    """Reinvestment products with the default rate of the same account type and their bonus on top."""
    standard = latest.filter(F.col("sk").like("%default")).select(
        F.regexp_replace("sk", ":default", "").alias("account_type"),
        "min_1",
        F.col("rate_0").alias("default_0"),
        F.col("rate_1").alias("default_1"),
    )
    reinvest = latest.filter(F.col("sk").like("%reinvestment")).select(
        F.regexp_replace("sk", ":post_maturity_reinvestment", "").alias("account_type"),
        "sk",
        "product_key",
        "min_0",
        "min_1",
        "bonus_0",
        "bonus_1",
    )
    joined = reinvest.join(standard, ["account_type", "min_1"])
    return joined.select(
        "account_type",
        "sk",
        F.substring("account_type", 1, 3).alias("currency"),
        "min_0",
        "min_1",
        "default_0",
        "default_1",
        (F.col("bonus_0") + F.col("default_0")).alias("pref_0"),
        (F.col("bonus_1") + F.col("default_1")).alias("pref_1"),
    )


def tiers(pref: DataFrame) -> DataFrame:
    """One row per account type and tier."""
    return stack_rows(
        pref,
        ["account_type", "currency"],
        [
            {
                "tier": F.lit(str(i)),
                "min_amount": F.col(f"min_{i}"),
                "default_rate": F.col(f"default_{i}"),
                "pref_rate": F.col(f"pref_{i}"),
            }
            for i in (0, 1)
        ],
    )


def top_rates(pref: DataFrame) -> DataFrame:
    """Best preferential rate per currency and overall, as one row of texts."""
    per_currency = tiers(pref).groupBy("currency").agg(F.max("pref_rate").alias("top"))
    marked = with_global(per_currency, {"overall": F.max("top")})
    labels = {"eur": "ftd_top_pref_rate_euro", "gbp": "ftd_top_pref_rate_gbp", "usd": "ftd_top_pref_rate_usd"}
    return marked.agg(
        *[_percent(F.max(F.when(F.col("currency") == c, F.col("top")))).alias(n) for c, n in labels.items()],
        _percent(F.max("overall")).alias("ftd_top_pref_rate_overall"),
    )


def rate_row(latest: DataFrame, pref: DataFrame) -> DataFrame:
    """All default and preferential rates as one wide row."""
    standard = latest.filter(F.col("sk").like("%default")).select("sk", "min_0", "min_1", "rate_0", "rate_1")
    reinvest = pref.select("sk", "min_0", "min_1", F.col("pref_0").alias("rate_0"), F.col("pref_1").alias("rate_1"))
    spec = {}
    for ccy in RATE_CURRENCIES:
        for i in (0, 1):
            spec[f"ftd_{ccy}_rate_{i}_min_amount"] = (F.col("sk") == f"{ccy}:ftd_3m:default", F.col(f"min_{i}"))
        for offer, label in OFFERS.items():
            for i in (0, 1):
                for term in TERMS:
                    spec[f"ftd_{ccy}_{term}_rate_{i}_{label}"] = (
                        F.col("sk") == f"{ccy}:ftd_{term}:{offer}",
                        _percent(F.col(f"rate_{i}")),
                    )
    return pivot_to_row(union_all([reinvest, standard]), spec)


def current_customers(history: DataFrame, default_brand: str) -> DataFrame:
    keyed = history.withColumn("user_id", customer_id(history))
    return latest_per_key(keyed, "user_id", change_order(history)).select(
        "user_id",
        F.col(STATUS).alias("customer_status"),
        clean_null(BRAND, ("", "<NA>"), default_brand).alias("brand_id"),
        clean_null(COUNTRY, ("",), "").alias("residence_country_code"),
    )


def deposit_accounts(tables: Tables) -> DataFrame:
    """Account history with parsed dates and money, and the owner."""
    owners = tables["clients"].select(
        F.col("id").alias("user_id"), F.col("encoded_key").alias("account_holder_key")
    ).distinct()
    stamps = ("last_modified_date", "approved_date", "maturity_date", "activation_date", "closed_date")
    rows = tables["deposit_accounts"].select(
        "account_holder_key",
        "encoded_key",
        F.col("id").alias("account_id"),
        "name",
        "account_type",
        "account_state",
        "currency_code",
        *[iso_ts(c).alias(c) for c in stamps],
        money("balances_total_balance").alias("balance"),
        to_gbp("balances_total_balance", "currency_code").alias("gbp_balance"),
        F.col("interest_settings_interest_rate_settings_interest_rate").alias("interest_rate"),
        money("accrued_amounts_interest_accrued").alias("interest_accrued"),
    )
    return rows.join(owners, "account_holder_key", "left")


def fixed_deposits(accounts: DataFrame) -> DataFrame:
    """One row per holder and fixed deposit: its latest active row, its latest state, and whether any row of
    the account was closed before maturity. One pass over the account history.
    """
    fixed = F.col("name").like("%Fixed%")
    order = F.struct("last_modified_date", "balance")
    kept = [c for c in accounts.columns if c not in ("account_holder_key", "account_id")]
    active = fixed & (F.col("account_state") == "ACTIVE")
    reduced = accounts.groupBy("account_holder_key", "account_id").agg(
        F.max_by(F.struct(*kept), F.when(active, order)).alias("_now"),
        F.max_by("account_state", F.when(fixed, order)).alias("ftd_account_state"),
        F.max(F.coalesce(F.col("closed_date") < F.col("maturity_date"), F.lit(False))).alias("closed_early"),
    )
    return reduced.select("account_holder_key", "account_id", "_now.*", "ftd_account_state", "closed_early")


def deposit_terms(accounts: DataFrame) -> DataFrame:
    """Fixed deposits that were not closed early, with their term and the holder's next deposit."""
    deposits = materialize(fixed_deposits(accounts), "deposits")
    early = deposits.filter("closed_early").select("account_id")
    wanted = deposits.filter(F.col("maturity_date").isNotNull()).drop("closed_early")
    latest = exclude_keys(wanted, early, "account_id")
    months = months_between("activation_date", "maturity_date") + 1
    term = F.when(months == 4, F.lit("3-months")).otherwise(F.concat(months.cast("string"), F.lit("-months")))
    following = with_next(
        latest,
        "account_holder_key",
        ["approved_date", "account_id"],
        {"approved_date": "next_approved_date", "account_id": "next_account_id"},
        grain="year",
    )
    renewed = F.to_date("next_approved_date")
    flags = {
        f"opened_within_{n}": F.coalesce(
            renewed.between(F.to_date("maturity_date"), F.to_date(add_days("maturity_date", n))).cast("int"), F.lit(0)
        )
        for n in WINDOWS
    }
    state = F.coalesce((F.col("ftd_account_state") == "ACTIVE").cast("int"), F.lit(0))
    return following.withColumns(
        {"term": term, "maturity_plus_1hr": F.col("maturity_date") + F.expr("INTERVAL 1 HOUR"), "active_flag": state, **flags}
    )


def matured_amounts(transactions: DataFrame) -> DataFrame:
    """Interest applied and amount paid out per account; the latest posting when there are several."""
    moves = transactions.filter(F.col("type").isin("INTEREST_APPLIED", "WITHDRAWAL")).select(
        "parent_account_key", "id", "type", "currency_code", "amount", "value_date", "timestamp_extracted"
    )
    latest = latest_extract(moves, "id", ties=["value_date", "amount"])
    # value_date is ISO text of one shape, so text order is time order; the id settles ties
    order = F.struct("value_date", "id")
    interest, payout = F.col("type") == "INTEREST_APPLIED", F.col("type") == "WITHDRAWAL"
    return latest.groupBy(F.col("parent_account_key").alias("encoded_key")).agg(
        F.max_by(money("amount"), F.when(interest, order)).alias("matured_interest"),
        F.max_by(F.abs(money("amount")), F.when(payout, order)).alias("balance_at_maturity"),
        F.max_by(F.abs(to_gbp("amount", "currency_code")), F.when(payout, order)).alias("balance_at_maturity_gbp"),
    )


def customer_totals(per_account: DataFrame) -> DataFrame:
    """Counts, balances, open flags and first / last dates per customer and currency, in one aggregate."""
    exprs = []
    for ccy in REPORT_CURRENCIES:
        mine = F.col("currency_code") == ccy
        active = mine & (F.col("active_flag") == 1)
        c = ccy.lower()
        exprs += [
            F.count(F.when(mine, F.col("account_id"))).alias(f"ftd_number_{c}_ftds"),
            F.sum(F.when(mine, F.col("balance"))).cast("decimal(18,2)").alias(f"ftd_{c}_total_balance"),
            F.sum(F.when(active, F.col("balance"))).alias(f"ftd_{c}_cur_balance"),
            F.max(F.coalesce(active, F.lit(False))).alias(f"ftd_{c}_is_currently_open"),
            F.max(F.coalesce(mine, F.lit(False))).alias(f"ftd_{c}_has_open"),
            F.min(F.when(mine, F.col("approved_date"))).alias(f"ftd_{c}_first_inbound_date"),
            F.max(F.when(mine, F.col("approved_date"))).alias(f"ftd_{c}_last_inbound_date"),
        ]
    return per_account.groupBy("user_id").agg(*exprs)


def term_deposits(
    tables: Tables, default_brand: str, today: dt.date | None = None, maturity_window_days: int | None = None
) -> DataFrame:
    """One row per fixed deposit with rates, renewal flags and customer totals.

    Needs ``customers``, ``clients``, ``deposit_accounts``, ``deposit_transactions``, ``payment_products``,
    ``riskscore``, ``timeline`` and ``risk_form``. ``maturity_window_days`` keeps deposits that mature within
    that many days of ``today``.
    """
    accounts = deposit_accounts(tables)
    per_account = deposit_terms(accounts)
    customers = current_customers(tables["customers"], default_brand)
    per_customer = customer_totals(per_account)
    totals = [c for c in per_customer.columns if c != "user_id"]
    report = (
        per_account.join(matured_amounts(tables["deposit_transactions"]), "encoded_key", "left")
        .join(customers.withColumn("known", F.lit(True)), "user_id", "left")
        .join(customer_affluency(tables), "user_id", "left")
        .join(per_customer, "user_id", "left")
    )
    # postings count only for owners the customer history knows
    matured = {
        c: F.when(F.col("known"), F.col(c))
        for c in ("matured_interest", "balance_at_maturity", "balance_at_maturity_gbp")
    }
    report = report.withColumns(matured)
    named = report.select(
        F.col("user_id").alias("ftd_customer_id"),
        F.col("account_holder_key").alias("ftd_account_holder_key"),
        F.coalesce("affluency", F.lit("")).alias("ftd_affluency"),
        F.col("brand_id").alias("ftd_brand_id"),
        F.col("residence_country_code").alias("ftd_residence_country_code"),
        F.col("customer_status").alias("ftd_customer_status"),
        F.col("account_id").alias("ftd_account_id"),
        F.col("account_type").alias("ftd_account_type"),
        F.col("name").alias("ftd_name"),
        "ftd_account_state",
        F.col("term").alias("ftd_term"),
        money("interest_rate", 2).alias("ftd_interest_rate"),
        F.col("currency_code").alias("ftd_currency_code"),
        F.col("balance").alias("ftd_balance"),
        F.col("gbp_balance").alias("ftd_balance_in_gbp"),
        money(F.coalesce("matured_interest", "interest_accrued"), 2).alias("ftd_interest_accrued_amount"),
        F.col("approved_date").alias("ftd_open_date"),
        F.col("maturity_date").alias("ftd_maturity_date"),
        F.to_date("maturity_plus_1hr").alias("ftd_maturity_date_plus_1hr"),
        money("balance_at_maturity", 2).alias("ftd_balance_at_maturity"),
        money("balance_at_maturity_gbp", 2).alias("ftd_balance_at_maturity_in_gbp"),
        F.col("next_account_id").alias("ftd_next_account_id"),
        F.col("next_approved_date").alias("ftd_next_approved_date"),
        *[F.col(f"opened_within_{n}").alias(f"ftd_opened_within_{n}_days_maturity") for n in WINDOWS],
        *totals,
    )
    if maturity_window_days is not None:
        gap = F.abs(F.datediff(F.lit(today), F.to_date("ftd_maturity_date")))
        named = named.filter(gap <= maturity_window_days)

    products = tables["payment_products"]
    latest = product_rates(products)
    pref = preferential_rates(latest)
    rated = attach_row(attach_row(named, rate_row(latest, pref)), top_rates(pref))
    rule = products.filter((F.col(SK) == OFFER_RULE) & clean_null(CHANGED, ("",)).isNotNull())
    offer = latest_per_key(rule.withColumn("changed", epoch_to_ts(CHANGED, "s")), [PRODUCT, SK], ["changed"]).select(
        F.col("dynamodb_new_image_available_days_after_maturity_n").cast("int")
    )
    offered = attach_scalar(rated, offer, "ftd_offer_days")
    expiry = F.when(
        F.col("ftd_offer_days") != -1, F.date_add("ftd_maturity_date_plus_1hr", F.col("ftd_offer_days"))
    )
    return offered.withColumn("ftd_offer_expired_date", expiry)
