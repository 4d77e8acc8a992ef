"""First funding, card wallets and app screens."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import iso_ts
from ledgerlake.functions.numbers import money, to_gbp, try_number
from ledgerlake.functions.text import clean_null
from ledgerlake.operators.latest import dedupe_events, first_per_key, latest_per_key
from ledgerlake.operators.predicates import last_n_days
from ledgerlake.plans.customers import BRAND, COUNTRY, STATUS, UPDATED, Tables, change_order, customer_id
from ledgerlake.plans.lifecycle import MESSAGE, TOKEN, USER, WALLET

CONSENTS = ("email_notifications_m_marketing", "push_notifications_m_marketing", "sms_notifications_m_marketing")
SINCE = "2021-07-01"

# Wallet codes.
WALLETS = {"103": "Apple_Pay", "216": "Google_Pay", "217": "Samsung_Pay", "327": "Merchant_tokenization_program"}
MARKETED_WALLETS = ("103", "216")

# Codes of wallet activations, and message codes that are not purchases.
ACTIVATION_STEPS = ("01", "7")
APPROVALS = ("1", "2")
NOT_PURCHASES = ("AC", "TC", "TV", "TA", "TE")

# App screens of the savings and finance journeys (brand-free ones).
SCREENS = (
    "screen_prop_fin_type",
    "screen_fixed_term_deposit_calculator",
    "screen_rent_or_residential",
    "screen_btldashboard",
    "screen_legal_agreement",
    "screen_add_new_savings_account_choices",
    "screen_instant_access_saver_benefits",
    "screen_instant_access_saver_calculator",
    "screen_pay_and_transfer_overlay",
    "screen_select_currency_account_variant_b",
)


def consents(timeline: DataFrame, *more: str) -> DataFrame:
    """One row per customer with the marketing consents."""
    return timeline.groupBy(F.col("dynamo_user_key").alias("user_id")).agg(
        *[F.max(c).alias(c) for c in (*CONSENTS, *more)]
    )


def any_consent() -> Column:
    return F.coalesce(F.greatest(*[F.col(c) for c in CONSENTS]), F.lit(False))


def first_funded_accounts(
    tables: Tables, today: dt.date, default_brand: str, days: int = 3, since: str = SINCE
) -> DataFrame:
    """Approved customers whose first funded account got its first deposit in the last days.

    Needs ``customers``, ``clients``, ``deposit_accounts``, ``deposit_transactions`` and ``timeline``.
    """
    history = tables["customers"].filter(F.col(UPDATED) >= F.lit(since).cast("timestamp"))
    keyed = history.withColumn("user_id", customer_id(history))
    approved = latest_per_key(keyed, "user_id", change_order(history)).filter(F.col(STATUS) == "APPROVED")
    customers = approved.select(
        "user_id",
        clean_null(BRAND, ("", "<NA>"), default_brand).alias("brand_id"),
        clean_null(COUNTRY, ("", "<NA>"), "").alias("country"),
    )
    clients = tables["clients"].select(
        F.col("id").alias("user_id"), F.col("encoded_key").alias("account_holder_key")
    ).distinct()
    accounts = first_per_key(
        tables["deposit_accounts"]
        .filter(money("balances_total_balance") > 0)
        .withColumn("last_modified", iso_ts("last_modified_date")),
        "account_holder_key",
        ["last_modified", "encoded_key"],
    )
    deposits = first_per_key(tables["deposit_transactions"].filter("type = 'DEPOSIT'"), "id", ["timestamp_extracted", "value_date"])
    funded = first_per_key(
        deposits.select(
            F.col("parent_account_key").alias("encoded_key"),
            F.col("type").alias("type_funding"),
            F.col("amount").alias("funded_amount"),
            to_gbp("amount", "currency_code").alias("gbp_amount"),
            F.col("transaction_details_transaction_channel_id").alias("channel_id"),
            F.coalesce("transaction_details_transaction_channel_id", F.lit("Unknown")).alias("type_transaction"),
            F.col("currency_code").alias("funded_currency_code"),
            iso_ts("value_date").alias("first_date_funded"),
            F.col("id").alias("transaction_id"),
        ),
        "encoded_key",
        ["first_date_funded", "transaction_id"],
    )
    recent = last_n_days(funded, "first_date_funded", days, today)
    push = tables["timeline"].groupBy(F.col("dynamo_user_key").alias("user_id")).agg(
        F.max("push_notifications_m_marketing").alias("has_opted_out_of_push")
    )
    joined = (
        accounts.join(recent, "encoded_key")
        .join(clients, "account_holder_key")
        .join(customers.select("user_id"), "user_id", "left_semi")
        .join(push, "user_id", "left")
    )
    return joined.select(
        "encoded_key",
        "id",
        "name",
        "account_holder_key",
        "account_state",
        "account_type",
        "balances_total_balance",
        "last_modified_date",
        "type_funding",
        "funded_amount",
        "gbp_amount",
        "channel_id",
        "type_transaction",
        F.col("funded_currency_code").alias("currency_code"),
        "has_opted_out_of_push",
        F.col("user_id").alias("customer_id"),
        "first_date_funded",
    ).orderBy("account_holder_key", "last_modified_date")


def wallet_activations(tables: Tables) -> DataFrame:
    """Latest wallet activation per card token for customers with a marketing consent.

    ``first_activation`` is ``Yes`` only when the token has a single activation row. Needs
    ``card_messages``, ``cards`` and ``timeline``.
    """
    step, approval = f"{MESSAGE}_iso_msg_m_de124_m_3_s", f"{MESSAGE}_iso_msg_m_de124_m_7_s"
    kind = f"{MESSAGE}_iso_msg_m_de124_m_1_s"
    messages = (
        tables["card_messages"]
        .filter(
            F.col(WALLET).isin(*MARKETED_WALLETS)
            & F.col(step).isin(*ACTIVATION_STEPS)
            & F.col(approval).isin(*APPROVALS)
        )
        .select(TOKEN, UPDATED, kind, step, approval, WALLET)
        .distinct()
    )
    counts = messages.groupBy(TOKEN).agg(F.count(F.lit(1)).alias("n_messages"))
    last = latest_per_key(messages, TOKEN, [UPDATED, kind, step, approval, WALLET])
    holders = tables["cards"].select(TOKEN, USER).distinct().groupBy(TOKEN).agg(
        F.max(USER).alias(USER), F.count(F.lit(1)).alias("n_holders")
    )
    joined = (
        last.join(counts, TOKEN)
        .join(holders, TOKEN)
        .join(consents(tables["timeline"]), F.col(USER) == F.col("user_id"))
        .filter(any_consent())
        .withColumn("rn_first", F.col("n_messages") * F.col("n_holders"))
    )
    return joined.select(
        USER,
        TOKEN,
        UPDATED,
        kind,
        F.lit(1).alias("rn"),
        "rn_first",
        step,
        approval,
        WALLET,
        F.when(F.col(WALLET) == "103", "Apple Pay").otherwise("Google Pay").alias("Wallet_Ind"),
        F.when(F.col(approval).isin(*APPROVALS), "Approve").alias("Approved_Ind"),
        *CONSENTS,
        F.when(F.col("rn_first") == 1, "Yes").otherwise("NO").alias("first_activation"),
    )


def wallet_usage(tables: Tables) -> DataFrame:
    """Day of the latest approved wallet transaction per customer and wallet.

    A card token belongs to the customer whose latest card it is; older cards count under no customer.
    Needs ``card_messages`` and ``cards``.
    """
    code = lambda c: try_number(c, "decimal(18,3)")
    approved = tables["card_messages"].filter(
        F.col(WALLET).isin(*MARKETED_WALLETS)
        & ~F.coalesce(f"{MESSAGE}_iso_msg_m_de124_m_1_s", F.lit("XX")).isin(*NOT_PURCHASES)
        & (code(f"{MESSAGE}_iso_msg_m_de39_s") == 0)
        & code(f"{MESSAGE}_message_type_m_message_type_s").isin(100, 120)
    )
    name = F.lit(None).cast("string")
    for key, label in WALLETS.items():
        name = F.when(F.col(WALLET) == key, F.lit(label)).otherwise(name)
    # reduced per token first, so the join sees one row per token and wallet
    per_token = approved.groupBy(F.col(TOKEN).alias("token"), name.alias("wallet_indicator")).agg(
        F.max(F.to_date(UPDATED)).alias("last_day")
    )
    cards = latest_per_key(tables["cards"], USER, [UPDATED, "timestamp_extracted"]).select(
        F.col(TOKEN).alias("token"), F.col(USER).alias("customer_id")
    )
    return (
        per_token.join(cards, "token", "left")
        .groupBy("customer_id", "wallet_indicator")
        .agg(F.max("last_day").alias("latest_transaction_wallet_date"))
    )


def screen_visits(
    tables: Tables, today: dt.date, days: int = 3, screens: Sequence[str] = SCREENS
) -> DataFrame:
    """Visits of the listed screens in the last days by customers with a marketing consent.

    Needs ``app_events`` and ``timeline``; add the brand's own screens to ``screens``.
    """
    events = last_n_days(tables["app_events"], "event_time", days, today).filter(F.lower("event_type").isin(*screens))
    people = consents(tables["timeline"], "brand_id").filter(any_consent())
    identity = ["user_id", "amplitude_id", "event_time", "event_type"]
    rest = [c for c in events.columns if c not in identity]
    single = dedupe_events(events, identity, ["event_time", *rest])
    return single.join(people, "user_id").orderBy(F.col("event_time").desc_nulls_last(), *identity)


