"""Partnership incentive report.

Transactions are reduced to one row per account before anything is joined, so the joins carry accounts
and customers only, never the transaction history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.functions.dates import iso_ts
from ledgerlake.functions.numbers import money
from ledgerlake.operators.joins import left_join_all
from ledgerlake.operators.latest import latest_per_key
from ledgerlake.operators.predicates import matches_any, not_blank, select_existing
from ledgerlake.plans.customers import STATUS, UPDATED, Tables, change_order, customer_id
from ledgerlake.plans.names import CURRENCIES, INBOUND_CHANNELS, TERM_ACCOUNTS
from ledgerlake.session import materialize

CHANNEL = "transaction_details_transaction_channel_id"

# Report columns in order.
REPORT_COLUMNS = (
    "customer_id",
    "total_inbound_payment_gbp",
    "last_balance_gbp",
    "gbp_ftd_maturity_date",
    "gbp_standard_ftd_maturity_date",
    "gbp_exclusive_ftd_maturity_date",
    "total_inbound_payment_eur",
    "last_balance_eur",
    "eur_ftd_maturity_date",
    "eur_ftd_last_in_date",
    "eur_standard_ftd_balance",
    "eur_standard_ftd_maturity_date",
    "eur_standard_ftd_last_in_date",
    "eur_exclusive_ftd_balance",
    "eur_exclusive_ftd_maturity_date",
    "eur_exclusive_ftd_last_in_date",
    "total_inbound_payment_usd",
    "last_balance_usd",
    "usd_ftd_maturity_date",
    "usd_standard_ftd_maturity_date",
    "usd_exclusive_ftd_maturity_date",
    "total_inbound_payment_aed",
    "last_balance_aed",
    "total_inbound_payment_sar",
    "last_balance_sar",
    "total_inbound_payment_kwd",
    "last_balance_kwd",
    "last_transaction_date",
    "approved_date",
    "first_deposit_transaction_date",
    "submit_application_datetime",
)


def _currency_in(column: str) -> Column:
    """The first listed currency found in the text."""
    case = F.lit(None).cast("string")
    for ccy in reversed(CURRENCIES):
        case = F.when(F.col(column).contains(ccy), F.lit(ccy)).otherwise(case)
    return case


def account_activity(transactions: DataFrame, channels: Sequence[str], deposits_only_first: bool) -> DataFrame:
    """One row per account: first qualifying deposit, last debit and inbound sums per currency."""
    named = transactions.filter(not_blank(CHANNEL)).select(
        "parent_account_key",
        "id",
        "type",
        CHANNEL,
        _currency_in("currency_code").alias("ccy"),
        matches_any(CHANNEL, channels).alias("inbound"),
        money("amount").alias("amount"),
        iso_ts("booking_date").alias("booked"),
    )
    latest = latest_per_key(named, ["parent_account_key", "id", "type", CHANNEL], ["booked", "amount", "ccy"])
    inbound = F.col("inbound")
    deposit = F.col("type") == "DEPOSIT"
    first = inbound & deposit if deposits_only_first else inbound
    return latest.groupBy("parent_account_key").agg(
        F.min(F.when(first, F.col("booked"))).alias("first_deposit"),
        F.max(F.when(F.col("type").isin("WITHDRAWAL", "WITHDRAWAL_ADJUSTMENT"), F.col("booked"))).alias("last_debit"),
        F.count_if(deposit & inbound).alias("n_inbound"),
        *[
            F.sum(F.when(deposit & inbound & (F.col("ccy") == c), F.col("amount"))).alias(
                f"total_inbound_payment_{c.lower()}"
            )
            for c in CURRENCIES
        ],
    )


def current_accounts(accounts: DataFrame) -> DataFrame:
    """One row per account, holder and name: the newest values and the last maturity date of the history."""
    rows = accounts.select(
        "encoded_key",
        "account_holder_key",
        "name",
        money("balances_total_balance").alias("balance"),
        iso_ts("maturity_date").cast("date").alias("matures"),
        iso_ts("approved_date").alias("approved"),
        iso_ts("last_modified_date").alias("modified"),
    )
    newest = F.max_by(F.struct("modified", "approved", "balance"), F.struct("modified", "approved", "balance"))
    return (
        rows.groupBy("encoded_key", "account_holder_key", "name")
        .agg(newest.alias("_now"), F.max("matures").alias("last_maturity"))
        .select("encoded_key", "account_holder_key", "name", "last_maturity", "_now.*")
    )


def last_balances(current: DataFrame, per_name_only: bool) -> DataFrame:
    """Balances per holder from the last row of each account name.

    ``per_name_only`` keeps one row per name for the whole bank instead of one per holder and name.
    """
    keys = ["name"] if per_name_only else ["account_holder_key", "name"]
    last = latest_per_key(current, keys, ["modified", "balance", "account_holder_key"]).withColumn(
        "ccy", _currency_in("name")
    )
    exact = {f"{label}_balance": F.col("name") == name for name, label in TERM_ACCOUNTS.items()}
    by_currency = {f"last_balance_{c.lower()}": F.col("ccy") == c for c in CURRENCIES}
    return last.groupBy("account_holder_key").agg(
        *[F.sum(F.when(cond, F.col("balance"))).alias(out) for out, cond in {**by_currency, **exact}.items()]
    )


def partner_incentives(
    tables: Tables,
    channels: Sequence[str] = INBOUND_CHANNELS,
    legacy_balances: bool = False,
    deposits_only_first: bool = False,
    as_text: bool = True,
) -> DataFrame:
    """One row per customer and account holder key.

    Needs ``customers``, ``clients``, ``deposit_accounts`` and ``deposit_transactions``. Missing dates rank
    lowest when the latest row is chosen but never appear as a value.
    """
    history = tables["customers"]
    customers = history.withColumn(
        "customer_id", customer_id(history, ("dynamodb_keys_id_s", "dynamodb_new_image_id_s"))
    )
    submitted = latest_per_key(
        customers.filter(F.col(STATUS) == "AWAITING_MANUAL_REVIEW"), "customer_id", change_order(customers)
    ).select("customer_id", F.col(UPDATED).cast("timestamp").alias("submit_application_datetime"))
    everyone = customers.select("customer_id").distinct()

    clients = tables["clients"].select("id", F.col("encoded_key").alias("client_key")).distinct()
    current = materialize(current_accounts(tables["deposit_accounts"]), "accounts")
    activity = account_activity(tables["deposit_transactions"], channels, deposits_only_first)
    active = current.join(activity, F.col("encoded_key") == F.col("parent_account_key"))
    owned = (
        everyone.join(clients, F.col("customer_id") == F.col("id"))
        .join(active, F.col("client_key") == F.col("account_holder_key"))
    )
    # opening and maturity dates are taken per account name, over all accounts of that name
    maturities = current.groupBy("account_holder_key", "name").agg(F.max("last_maturity").alias("last_maturity"))
    inbound = [f"total_inbound_payment_{c.lower()}" for c in CURRENCIES]
    per_name = (
        owned.groupBy("customer_id", "account_holder_key", "name")
        .agg(
            F.min("first_deposit").alias("first_deposit"),
            F.max("last_debit").alias("last_debit"),
            F.min("approved").alias("approved"),
            F.sum("n_inbound").alias("n_inbound"),
            *[F.sum(c).alias(c) for c in inbound],
        )
        .join(maturities, ["account_holder_key", "name"], "left")
    )
    named = {label: F.col("name") == name for name, label in TERM_ACCOUNTS.items()}
    highest = {
        "last_transaction_date": F.col("last_debit"),
        **{f"{n}_maturity_date": F.when(c, F.col("last_maturity")) for n, c in named.items()},
        **{f"{n}_last_in_date": F.when(c, F.to_date("approved")) for n, c in named.items()},
    }
    lowest = {"first_deposit_transaction_date": F.col("first_deposit"), "approved_date": F.col("approved")}
    per_holder = per_name.groupBy("customer_id", "account_holder_key").agg(
        F.sum("n_inbound").alias("n_inbound"),
        *[F.sum(c).alias(c) for c in inbound],
        *[F.max(c).alias(n) for n, c in highest.items()],
        *[F.min(c).alias(n) for n, c in lowest.items()],
    )
    # one row per holder key is left here, so the customer-wide values can come from a window
    customer = W.partitionBy("customer_id")
    wide = per_holder.withColumns(
        {
            **{n: F.max(n).over(customer) for n in highest},
            **{n: F.min(n).over(customer) for n in lowest},
            "_inbound": F.sum("n_inbound").over(customer),
            "_rn": F.row_number().over(customer.orderBy("account_holder_key")),
        }
    )
    # holders with inbound payments; a customer without any keeps one row and no holder
    paid = F.col("n_inbound") > 0
    holders = wide.filter(paid | ((F.col("_inbound") == 0) & (F.col("_rn") == 1))).withColumn(
        "account_holder_key", F.when(paid, F.col("account_holder_key"))
    )
    report = left_join_all(everyone, [holders, submitted], "customer_id")
    report = report.join(last_balances(current, legacy_balances), "account_holder_key", "left")
    report = select_existing(report, REPORT_COLUMNS)
    amounts = [c for c in report.columns if "balance" in c or "payment" in c]
    report = report.withColumns({c: F.round(c, 2) for c in amounts})
    if not as_text:
        return report
    dates = [c for c in report.columns if "date" in c]
    return report.withColumns({c: F.date_format(c, "dd/MM/yyyy HH:mm") for c in dates})
