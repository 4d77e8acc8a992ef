"""Lifecycle master extract: card, wallet and account activity per approved customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import iso_ts, report_date
from ledgerlake.functions.numbers import money
from ledgerlake.operators.aggregate import pivot_fixed
from ledgerlake.operators.joins import left_join_all
from ledgerlake.operators.latest import first_per_key, latest_per_key
from ledgerlake.plans.customers import STATUS, UPDATED, Tables, change_order

TOKEN = "dynamodb_new_image_token_n"
USER = "dynamodb_new_image_user_id_s"
MESSAGE = "dynamodb_new_image_message_m"
WALLET = f"{MESSAGE}_iso_msg_m_de48_m_26_s"

# Account names with columns of their own; any other name goes to "Other".
ACCOUNT_NAMES = (
    "AED Current Account",
    "EUR Current Account",
    "GBP Current Account",
    "GBP Fixed Deposit Account Exclusive",
    "GBP Fixed Deposit Account Standard",
    "KWD Current Account",
    "SAR Current Account",
    "USD Current Account",
    "USD Fixed Deposit Account Exclusive",
    "USD Fixed Deposit Account Standard",
)

# What counts as an approved card purchase.
DECISIONS = ("Approve", "Approve - NO CVV,NOT Chip,NOT off premesis=> DE39=00")
MESSAGE_KINDS = ("Authorisation Request", "Authorisation Advice")
SPEND_TYPES = ("POS - Purchase", "ECOM - Purchase", "ECOM - NA", "POS - NA")
CASH_BACK = "POS - Purchase with Cash Back"
APPLE_PAY = "103"


def label_of(name: str) -> str:
    return name.replace(" ", "_")


def token_activity(messages: DataFrame) -> DataFrame:
    """First and last approved purchase per card token, by wallet and by card."""
    approved = messages.filter(
        (F.col(f"{MESSAGE}_summary_m_billing_amount_s") >= 0)
        & F.col(f"{MESSAGE}_summary_m_processor_decision_desc_s").isin(*DECISIONS)
        & F.col(f"{MESSAGE}_message_type_m_message_desc_s").isin(*MESSAGE_KINDS)
        & F.col(f"{MESSAGE}_summary_m_spend_type_s").isin(*SPEND_TYPES, CASH_BACK)
    )
    wallet = (F.col(WALLET) == APPLE_PAY) & (F.col(f"{MESSAGE}_summary_m_spend_type_s") != CASH_BACK)
    card = F.col(WALLET) != APPLE_PAY
    at = F.col(UPDATED)
    return approved.groupBy(F.col(TOKEN).alias("token")).agg(
        F.min(F.when(wallet, at)).alias("first_app"),
        F.max(F.when(wallet, at)).alias("last_app"),
        F.min(F.when(card, at)).alias("first_card"),
        F.max(F.when(card, at)).alias("last_card"),
    )


def card_facts(cards: DataFrame, messages: DataFrame) -> DataFrame:
    """Per customer: activation of the active cards and purchases made with them."""
    active = first_per_key(
        cards.filter("dynamodb_new_image_state_s = 'ACTIVE'"),
        "dynamodb_keys_id_s",
        [UPDATED, "timestamp_extracted", TOKEN],
    ).select(F.col(USER).alias("customer_id"), F.col(TOKEN).alias("token"), F.coalesce(UPDATED, "date").alias("activated"))
    joined = active.join(token_activity(messages), "token", "left")
    return joined.groupBy("customer_id").agg(
        F.max("activated").alias("activated"),
        F.min("first_app").alias("first_app"),
        F.max("last_app").alias("last_app"),
        F.min("first_card").alias("first_card"),
        F.max("last_card").alias("last_card"),
    )


def card_orders(orders: DataFrame) -> DataFrame:
    """First card order per customer."""
    keys = [USER, "dynamodb_keys_user_id_s"]
    first = first_per_key(orders, keys, ["dynamodb_new_image_created_at_n", "timestamp_extracted"])
    return first.groupBy(F.coalesce(*keys).alias("customer_id")).agg(
        F.max(F.coalesce(UPDATED, "date")).alias("ordered")
    )


def inbound_per_account(transactions: DataFrame) -> DataFrame:
    """Last and first inbound payment per account.

    The last uses the newest extract of each deposit and the first its oldest extract, so both are taken
    from one row per deposit before the account is reduced.
    """
    booked = iso_ts("booking_date")
    seen = F.struct("timestamp_extracted", booked.alias("b"))
    per_id = (
        transactions.filter("type = 'DEPOSIT'")
        .groupBy("id")
        .agg(
            F.max_by(F.struct("parent_account_key", booked.alias("booked")), seen).alias("newest"),
            F.min_by(F.struct("parent_account_key", booked.alias("booked")), seen).alias("oldest"),
        )
    )
    nothing = F.lit(None).cast("timestamp")
    moves = F.array(
        F.struct(F.col("newest.parent_account_key").alias("account_key"), F.col("newest.booked").alias("l"), nothing.alias("f")),
        F.struct(F.col("oldest.parent_account_key").alias("account_key"), nothing.alias("l"), F.col("oldest.booked").alias("f")),
    )
    return (
        per_id.select(F.inline(moves))
        .groupBy("account_key")
        .agg(F.max("l").alias("last_in"), F.min("f").alias("first_in"))
    )


def lifecycle_extract(tables: Tables, names: Sequence[str] = ACCOUNT_NAMES) -> DataFrame:
    """One row per approved customer.

    Needs ``customers``, ``clients``, ``deposit_accounts``, ``deposit_transactions``, ``cards``,
    ``card_messages`` and ``card_orders``. Dates are compared as timestamps and formatted last.
    """
    history = tables["customers"]
    people = latest_per_key(history, "dynamodb_keys_id_s", change_order(history)).filter(F.col(STATUS) == "APPROVED")
    customers = people.select(
        F.col("dynamodb_keys_id_s").alias("customer_id"),
        F.when(F.col("dynamodb_new_image_card_ordered_bool"), "YES").otherwise("NO").alias("Card_Ordered"),
    ).filter(F.col("customer_id").isNotNull())
    clients = latest_per_key(tables["clients"], ["id", "encoded_key"], ["last_modified_date", "preferred_language"]).select(
        F.col("id").alias("customer_id"), F.col("encoded_key").alias("account_holder_key"), "preferred_language"
    )
    accounts = latest_per_key(
        tables["deposit_accounts"].withColumn("modified", iso_ts("last_modified_date")),
        "id",
        ["modified", "balances_total_balance"],
    ).select(
        F.col("encoded_key").alias("account_key"),
        "account_holder_key",
        "name",
        F.coalesce(money("balances_total_balance", 2), F.lit(0)).alias("balance"),
    )
    held = (
        customers.select("customer_id")
        .join(clients, "customer_id")
        .join(accounts, "account_holder_key")
        .join(inbound_per_account(tables["deposit_transactions"]), "account_key", "left")
    )
    newest = F.struct("last_in", "balance")
    per_name = held.groupBy("customer_id", "name").agg(
        F.max_by(newest, newest).alias("_now"), F.min("first_in").alias("first_in")
    )
    listed = {n: label_of(n) for n in names}
    wide = pivot_fixed(
        per_name,
        "customer_id",
        "name",
        listed,
        {
            "Last_Inbound_Payment_Date": F.col("_now.last_in"),
            "Total_Balance": F.col("_now.balance"),
            "First_Inbound_Payment_Date": F.col("first_in"),
        },
        other="Other",
        more={"Account_Types": F.array_join(F.sort_array(F.collect_set("name"), asc=False), ", ")},
    )
    languages = clients.groupBy("customer_id").agg(F.max("preferred_language").alias("preferred_language"))
    cards = card_facts(tables["cards"], tables["card_messages"])
    report = left_join_all(
        customers, [languages, cards, card_orders(tables["card_orders"]), wide], "customer_id"
    )

    def shown(column: str) -> Column:
        return report_date(column).alias(column)

    last_columns = []
    for label in listed.values():
        last_columns += [
            shown(f"{label}_Last_Inbound_Payment_Date"),
            F.col(f"{label}_Total_Balance"),
        ]
    return report.select(
        F.col("customer_id").alias("Reference_ID"),
        "Card_Ordered",
        "preferred_language",
        report_date("first_app").alias("First_APP_Trans_Date"),
        report_date("last_app").alias("Last_APP_Trans_Date"),
        report_date("first_card").alias("First_Card_Trans_Date"),
        report_date("last_card").alias("Last_Card_Trans_Date"),
        report_date("activated").alias("Card_Activation_Date"),
        report_date("ordered").alias("Card_Ordered_Date"),
        F.when(F.col("first_app").isNotNull(), "YES").otherwise("NO").alias("Cus_Has_Apple_Pay"),
        F.coalesce("Account_Types", F.lit("")).alias("Account_Types"),
        *last_columns,
        report_date("Other_Last_Inbound_Payment_Date").alias("Other_Inbound_Payment_Date"),
        F.col("Other_Total_Balance").alias("Other_Balances_Total_Balance"),
        *[shown(f"{label}_First_Inbound_Payment_Date") for label in listed.values()],
        report_date("Other_First_Inbound_Payment_Date").alias("Other_First_Inbound_Payment_Date"),
    )
