"""Instant-access savings accounts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import epoch_to_ts, iso_ts
from ledgerlake.functions.numbers import greatest_case, money
from ledgerlake.operators.latest import latest_extract, latest_per_key
from ledgerlake.operators.windows import with_group_totals
from ledgerlake.plans.customers import Tables
from ledgerlake.session import materialize

# Lower balance bounds of tiers 1 to 3 per currency.
TIER_BOUNDS = {"GBP": (3000, 10000, 25000), "USD": (3000, 10000, 30000), "EUR": (3000, 10000, 30000)}
SINCE = dt.date(2021, 7, 1)
RATE = "interest_settings_interest_rate_settings_interest_rate_tiers_{}_interest_rate"


def account_postings(transactions: DataFrame, before: dt.date, since: dt.date = SINCE) -> DataFrame:
    """First and last deposit day and interest paid per account, from the latest extract of each posting."""
    wanted = transactions.filter(
        F.col("creation_date").isNotNull() & F.col("type").isin("DEPOSIT", "INTEREST_APPLIED")
    ).select(
        "id",
        "type",
        "parent_account_key",
        F.to_date(iso_ts("value_date")).alias("posted"),
        money("amount", 2).alias("amount"),
        "timestamp_extracted",
    )
    latest = latest_extract(wanted.filter(F.col("posted") >= F.lit(since)), ["id", "type"], ties=["posted", "amount"])
    deposit, interest = F.col("type") == "DEPOSIT", F.col("type") == "INTEREST_APPLIED"
    return latest.groupBy(F.col("parent_account_key").alias("ias_encoded_key")).agg(
        F.min(F.when(deposit, F.col("posted"))).alias("first_deposit"),
        F.max(F.when(deposit, F.col("posted"))).alias("last_deposit"),
        F.sum(F.when(interest & (F.col("posted") < F.lit(before)), F.col("amount"))).alias("ias_interest_accrued_amount"),
    )


def tier_rates(accounts: DataFrame, clients: DataFrame) -> DataFrame:
    """Latest tier rates per account name and the best of the three."""
    owned = accounts.join(
        clients.select(F.col("encoded_key").alias("account_holder_key")).distinct(), "account_holder_key", "left_semi"
    )
    tiers = [money(RATE.format(i), 2).alias(f"tier_{i}") for i in (1, 2, 3)]
    seen = (
        owned.select("name", iso_ts("last_modified_date").cast("date").alias("modified"), *tiers)
        .groupBy("name", "tier_1", "tier_2", "tier_3")
        .agg(F.max("modified").alias("modified"))
    )
    rows = latest_per_key(seen, "name", ["modified", "tier_1", "tier_2", "tier_3"])
    best = greatest_case(F.col("tier_1"), F.col("tier_2"), F.col("tier_3"))
    texts = {f"tier_{i}": F.col(f"tier_{i}") for i in (1, 2, 3)} | {"top_rate": best}
    return rows.select(
        "name", *[F.concat(v.cast("string"), F.lit("%")).alias(n) for n, v in texts.items()]
    )


def _in_currency(ccy: str, value: Column) -> Column:
    return F.when(F.col("ias_account_name").startswith(ccy), value)


def savings_accounts(tables: Tables, today: dt.date, since: dt.date = SINCE) -> DataFrame:
    """One row per instant-access account with at least one deposit.

    Needs ``clients``, ``deposit_accounts``, ``deposit_transactions`` and ``recurring_transfers``.
    """
    clients = tables["clients"].select(
        F.col("id").alias("ias_customer_id"), F.col("encoded_key").alias("account_holder_key")
    ).distinct()
    history = tables["deposit_accounts"].filter(F.col("name").like("%Instant%"))
    month_end = (today.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    postings = account_postings(tables["deposit_transactions"], month_end, since)

    modified = iso_ts("last_modified_date")
    # rows of one time are told apart by their values, so state and balance come from one of them
    newest = F.when(modified.isNotNull(), F.struct(modified, "account_state", "balances_total_balance"))
    oldest = F.when(modified.isNotNull(), F.struct(modified, iso_ts("activation_date")))
    accounts = history.groupBy(
        "account_holder_key",
        F.col("encoded_key").alias("ias_encoded_key"),
        F.col("id").alias("ias_account_id"),
        F.col("name").alias("ias_account_name"),
        F.col("currency_code").alias("ias_currency_code"),
    ).agg(
        F.min_by(iso_ts("activation_date"), oldest).cast("date").alias("ias_open_date"),
        F.max_by("account_state", newest).alias("ias_account_state"),
        F.max_by("balances_total_balance", newest).alias("balance"),
    )
    owned = materialize(
        accounts.join(clients, "account_holder_key")
        .drop("account_holder_key")
        .join(postings.filter(F.col("first_deposit").isNotNull()), "ias_encoded_key"),
        "savings",
    )
    active = F.col("ias_account_state") == "ACTIVE"
    counted = with_group_totals(
        owned, "ias_customer_id", {"ias_no_active_accounts": F.count_if(active), "_all": F.count("ias_encoded_key")}
    ).withColumn("ias_has_opened_prev", (F.col("ias_no_active_accounts") < F.col("_all")).cast("int"))

    rates = tier_rates(history, tables["clients"]).withColumnRenamed("name", "ias_account_name")
    recurring = latest_per_key(
        tables["recurring_transfers"].select(
            F.col("dynamodb_new_image_target_account_id_s").cast("string").alias("ias_account_id"),
            F.col("dynamodb_new_image_is_active_bool").alias("ias_recurring_transfer"),
            epoch_to_ts("dynamodb_new_image_updated_at_n", "ms").alias("updated"),
        ),
        "ias_account_id",
        ["updated", "ias_recurring_transfer"],
    ).drop("updated")
    joined = (
        counted.join(rates, "ias_account_name", "left")
        .join(recurring, "ias_account_id", "left")
    )

    amount = F.col("balance").cast("double")
    rate = F.lit(None).cast("string")
    label = F.lit("Not Active")
    for ccy, bounds in TIER_BOUNDS.items():
        mine = (F.col("ias_currency_code") == ccy) & F.col("ias_account_name").startswith(ccy) & active
        for tier, low in enumerate(bounds, start=1):
            # later tiers have higher bounds, so the last match wins
            hit = mine & (amount >= low)
            label = F.when(hit, F.lit(f"{ccy} Tier {tier}")).otherwise(label)
            rate = F.when(hit, F.col(f"tier_{tier}")).otherwise(rate)
    last_names = {"GBP": "last_transaction_date", "USD": "last_transaction_date", "EUR": "last_deposit_date"}
    per_currency = [
        column
        for ccy in TIER_BOUNDS
        for column in (
            F.coalesce((F.col("ias_account_name").startswith(ccy) & active).cast("int"), F.lit(0)).alias(
                f"ias_{ccy.lower()}_is_open"
            ),
            _in_currency(ccy, F.col("first_deposit")).alias(f"ias_{ccy.lower()}_first_deposit_date"),
            _in_currency(ccy, F.col("last_deposit")).alias(f"ias_{ccy.lower()}_{last_names[ccy]}"),
            _in_currency(ccy, F.col("balance")).alias(f"ias_{ccy.lower()}_current_balance"),
        )
    ]
    rate_columns = [
        _in_currency(ccy, F.col(part)).alias(f"ias_dynamic_rate_{ccy.lower()}_{part}")
        for ccy in TIER_BOUNDS
        for part in ("tier_1", "tier_2", "tier_3", "top_rate")
    ]
    return joined.select(
        "ias_customer_id",
        "ias_encoded_key",
        "ias_account_id",
        "ias_account_name",
        "ias_currency_code",
        F.when(label == "Not Active", "Not Active").otherwise(rate).alias("customer_active_currency_tier_rate"),
        label.alias("customer_active_currency_tier_name"),
        "ias_open_date",
        "ias_account_state",
        *per_currency,
        *rate_columns,
        "ias_no_active_accounts",
        "ias_has_opened_prev",
        "ias_interest_accrued_amount",
        "ias_recurring_transfer",
    )
