"""Reports on a few hand-made banking rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest

from ledgerlake.plans import affluency, engagement, incentive, lifecycle, loans, savings, service, term_deposits
from tests.conftest import rows

T = dt.datetime


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


CUSTOMER = (
    "dynamodb_keys_id_s string, dynamodb_key_id_s string, dynamodb_new_image_id_s string, dynamodb_new_image_status_s string, "
    "dynamodb_new_image_brand_id_s string, dynamodb_new_image_individual_m_address_m_country_code_s string, "
    "dynamodb_new_image_individual_m_financial_details_m_monthly_income_s string, "
    "dynamodb_new_image_individual_m_financial_details_m_estimated_assets_value_s string, dynamodb_new_image_card_ordered_bool boolean, "
    "dynamodb_new_image_updated_at_n timestamp, dynamodb_approximate_creation_date_time timestamp, timestamp_extracted timestamp"
)


def customer(user, status, day, country="GBR", brand="", income="<NA>", assets="<NA>", key="keys"):
    ids = {"keys": (user, None, user), "key": (None, user, user), "image": (None, None, user)}[key]
    at = T(2024, 1, day)
    return (*ids, status, brand, country, income, assets, True, at, at, at)


ACCOUNT = (
    "id string, encoded_key string, account_holder_key string, name string, account_type string, account_state string, currency_code string, "
    "balances_total_balance string, accrued_amounts_interest_accrued string, last_modified_date string, approved_date string, "
    "activation_date string, maturity_date string, closed_date string, interest_settings_interest_rate_settings_interest_rate string, "
    "interest_settings_interest_rate_settings_interest_rate_tiers_1_interest_rate string, "
    "interest_settings_interest_rate_settings_interest_rate_tiers_2_interest_rate string, "
    "interest_settings_interest_rate_settings_interest_rate_tiers_3_interest_rate string"
)


def account(n, holder, name, balance, modified, ccy="GBP", state="ACTIVE", approved="2024-01-01", activation="2024-01-01", maturity=None, closed=None, tiers=("1.00", "2.00", "3.00")):
    iso = lambda d: d if not d else f"{d}T00:00:00Z"
    return (f"A{n}", f"E{n}", holder, name, "X", state, ccy, balance, "1.50", iso(modified), iso(approved), iso(activation), iso(maturity), iso(closed), "4.50", *tiers)


MOVE = (
    "id string, parent_account_key string, type string, currency_code string, transaction_details_transaction_channel_id string, "
    "amount string, booking_date string, creation_date string, value_date string, timestamp_extracted timestamp"
)


def move(n, account_no, kind, amount, day, ccy="GBP", channel="CB_Deposit_BACS", extracted=1):
    iso = f"{day}T10:00:00Z"
    return (f"T{n}", f"E{account_no}", kind, ccy, channel, amount, iso, iso, iso, T(2024, 6, extracted))


CLIENT = "id string, encoded_key string, preferred_language string, last_modified_date string"


@pytest.fixture(scope="module")
def clients(spark):
    return frame(spark, CLIENT, *[(f"C{i}", f"K{i}", "en", "2024-01-01T00:00:00Z") for i in (1, 2, 3)])


def test_incentives(spark, clients):
    tables = {
        "customers": frame(
            spark, CUSTOMER,
            customer("C1", "AWAITING_MANUAL_REVIEW", 1), customer("C1", "APPROVED", 5, key="image"), customer("C2", "APPROVED", 2), customer("C3", "APPROVED", 3),
        ),
        "clients": clients,
        "deposit_accounts": frame(
            spark, ACCOUNT,
            account(1, "K1", "GBP Fixed Deposit Account", "100.004", "2024-02-01", approved="", maturity="2024-08-01"),
            account(1, "K1", "GBP Fixed Deposit Account", "90", "2024-01-01", approved="2023-12-01", maturity="2024-09-01"),
            account(2, "K1", "USD Fixed Deposit Account", "7", "2024-02-01", ccy="USD"),
            account(3, "K2", "USD Fixed Deposit Account", "9", "2024-03-01", ccy="USD"),
        ),
        "deposit_transactions": frame(
            spark, MOVE,
            move(1, 1, "DEPOSIT", "10.50", "2024-02-02"), move(1, 1, "DEPOSIT", "10.50", "2024-02-02"),
            move(2, 1, "WITHDRAWAL", "3", "2024-02-09", channel="x"), move(3, 2, "DEPOSIT", "5", "2024-02-01", ccy="USD"),
            move(4, 2, "DEPOSIT", "99", "2024-01-09", channel=""), move(5, 3, "DEPOSIT", "8", "2024-02-03", channel="unlisted"),
        ),
    }
    got = {r["customer_id"]: r for r in incentive.partner_incentives(tables).collect()}
    assert set(got) == {"C1", "C2", "C3"}
    one = got["C1"]
    assert (one["total_inbound_payment_gbp"], one["total_inbound_payment_usd"], one["total_inbound_payment_eur"]) == (D("10.50"), D("5.00"), None)
    assert (one["last_balance_gbp"], one["last_balance_usd"]) == (D("100.00"), D("7.00"))
    assert one["gbp_ftd_maturity_date"] == "01/09/2024 00:00"
    assert one["first_deposit_transaction_date"] == "01/02/2024 10:00"
    assert one["last_transaction_date"] == "09/02/2024 10:00"
    assert one["submit_application_datetime"] == "01/01/2024 00:00"
    # the blank approval date of account 1 ranks lowest but is not a date
    assert one["approved_date"] == "01/01/2024 00:00"
    two = got["C2"]
    # an unlisted channel is no inbound payment: no holder, hence no balances
    assert two["last_balance_usd"] is None and two["approved_date"] == "01/01/2024 00:00"
    assert all(got["C3"][c] is None for c in incentive.REPORT_COLUMNS if c != "customer_id")
    legacy = {r["customer_id"]: r for r in incentive.partner_incentives(tables, legacy_balances=True).collect()}
    assert legacy["C1"]["last_balance_usd"] is None and legacy["C1"]["last_balance_gbp"] == D("100.00")


def risk(spark, *data):
    schema = (
        "dynamodb_keys_customer_id_s string, items_new_0_type string, items_new_0_converted_currency string, items_new_1_type string, "
        "items_new_1_converted_currency string, estimated_net_worth_currency_code string, estimated_net_worth_min_local string, estimated_net_worth_max_local string"
    )
    return frame(spark, schema, *data)


def timeline(spark, *users):
    schema = (
        "dynamo_user_key string, email_notifications_m_marketing boolean, push_notifications_m_marketing boolean, "
        "sms_notifications_m_marketing boolean, age_range string, brand_id string, dynamodb_individual_m_nationality_country_code_s string, dynamodb_new_gid string"
    )
    return frame(spark, schema, *[(u, False, True, False, "", " ", "", "1") for u in users])


def test_affluency(spark):
    income = "INCOME_FROM_PERSONAL_SAVINGS"
    tables = {
        "customers": frame(
            spark, CUSTOMER,
            customer("C1", "APPROVED", 1, country="ARE", income="GBP_6000_TO_12000", assets="AED_LESS_THAN_35K"),
            customer("C2", "APPROVED", 1, income="GBP_3000_TO_4000", assets="GBP_LESS_THAN_20K"),
            customer("C3", "APPROVED", 1, income="GBP_6000_TO_12000"),
            customer("C3", "APPROVED", 2, income=""),
            customer("C4", "APPROVED", 1),
        ),
        "riskscore": risk(
            spark,
            ("C1", income, "GBP_40000_50001", "OTHER", "n/a", None, None, None), ("C1", income, "GBP_40000_50001", "OTHER", "n/a", None, None, None),
            ("C4", None, None, None, None, "USD", "100000", "50001"),
        ),
        "timeline": timeline(spark, "C1", "C2", "C3"),
    }
    assert rows(affluency.affluency(tables), "user_id", "affluency", "age_range") == [
        ("C1", "Mass", "Unknown"), ("C2", "Mass", "Unknown"), ("C3", "Unknown", "Unknown"), ("C4", "Mass Affluent", None),
    ]
    means = {r["user_id"]: r for r in affluency.means_per_customer(tables, True).collect()}
    # repeated declarations count once; the history fills in what the latest row lacks
    assert means["C1"]["income_gbp_value"] == D("45000.500") and means["C1"]["assets_gbp_value"] == D("3800.000")
    assert means["C3"]["income_gbp_value"] == D("108000.000") and means["C3"]["affluency"] == "Affluent"
    assert means["C4"]["assets_gbp_value"] == D("60000.400") and means["C4"]["income_gbp_value"] == 0


def test_savings(spark, clients):
    name = "GBP Instant Access Saver"
    tables = {
        "clients": clients,
        "deposit_accounts": frame(
            spark, ACCOUNT,
            account(1, "K1", name, "9999.99", "2024-01-02", activation="2023-05-01"), account(1, "K1", name, "25000", "2024-02-01", tiers=("1.10", "2.50", "2.20")),
            account(2, "K1", "USD Instant Access Saver", "5000", "2024-01-01", ccy="USD", state="CLOSED"),
            account(3, "K2", name, "50", "2024-01-01"), account(4, "K2", "GBP Current Account", "50", "2024-01-01"),
        ),
        "deposit_transactions": frame(
            spark, MOVE,
            move(1, 1, "DEPOSIT", "1", "2024-01-05"), move(1, 1, "DEPOSIT", "1", "2024-01-07", extracted=2), move(2, 1, "DEPOSIT", "1", "2024-02-05"),
            move(3, 1, "INTEREST_APPLIED", "1.25", "2024-02-01"), move(4, 1, "INTEREST_APPLIED", "2.25", "2024-03-31"),
            move(5, 1, "INTEREST_APPLIED", "9", "2024-04-01"), move(6, 2, "DEPOSIT", "1", "2024-01-05"),
        ),
        "recurring_transfers": frame(
            spark, "dynamodb_new_image_target_account_id_s string, dynamodb_new_image_is_active_bool boolean, dynamodb_new_image_updated_at_n bigint",
            ("A1", True, 1), ("A1", False, 2),
        ),
    }
    got = {r["ias_account_id"]: r for r in savings.savings_accounts(tables, dt.date(2024, 3, 15)).collect()}
    assert set(got) == {"A1", "A2"}
    one, two = got["A1"], got["A2"]
    assert (one["customer_active_currency_tier_name"], one["customer_active_currency_tier_rate"]) == ("GBP Tier 3", "2.20%")
    assert one["ias_dynamic_rate_gbp_top_rate"] == "2.50%" and one["ias_open_date"] == dt.date(2023, 5, 1)
    assert one["ias_gbp_first_deposit_date"] == dt.date(2024, 1, 7) and one["ias_gbp_last_transaction_date"] == dt.date(2024, 2, 5)
    assert one["ias_interest_accrued_amount"] == D("3.50") and one["ias_recurring_transfer"] is False
    assert (one["ias_no_active_accounts"], one["ias_has_opened_prev"]) == (1, 1)
    assert (two["customer_active_currency_tier_name"], two["ias_usd_is_open"]) == ("Not Active", 0)


def test_savings_of_tied_rows(spark, clients):
    """Two versions of one time: state and balance come from one of them, whatever the order of the rows."""
    name = "GBP Instant Access Saver"
    versions = [
        account(1, "K1", name, "10", "2024-02-01", state="ACTIVE", activation="2023-05-01"),
        account(1, "K1", name, "9", "2024-02-01", state="CLOSED", activation="2023-04-01"),
        account(1, "K1", name, "8", "2024-02-01", state="CLOSED", activation="2023-06-01"),
    ]
    found = []
    for rows_in_order in (versions, versions[::-1]):
        tables = {
            "clients": clients,
            "deposit_accounts": frame(spark, ACCOUNT, *rows_in_order).coalesce(1),
            "deposit_transactions": frame(spark, MOVE, move(1, 1, "DEPOSIT", "1", "2024-01-05")),
            "recurring_transfers": frame(
                spark, "dynamodb_new_image_target_account_id_s string, dynamodb_new_image_is_active_bool boolean, dynamodb_new_image_updated_at_n bigint"
            ),
        }
        (row,) = savings.savings_accounts(tables, dt.date(2024, 3, 15)).collect()
        found.append(row.asDict())
    assert found[0] == found[1]
    assert found[0]["ias_account_state"] == "CLOSED" and found[0]["ias_open_date"] == dt.date(2023, 4, 1)


def test_term_deposits(spark, clients):
    exclusive = "GBP Fixed Deposit Account Exclusive"
    product = {
        "dynamodb_new_image_product_encoded_key_s": "p", "dynamodb_new_image_sk_s": "", "dynamodb_new_image_interest_rate_n": "5.00",
        "dynamodb_new_image_min_amount_n": "1000", "dynamodb_new_image_rates_l_0_m_rate_n": "1", "dynamodb_new_image_rates_l_0_m_profit_margin_n": "0.25",
        "dynamodb_new_image_rates_l_0_m_bonus_rate_n": "0.15", "dynamodb_new_image_rates_l_1_m_rate_n": "1", "dynamodb_new_image_rates_l_1_m_profit_margin_n": "0.10",
        "dynamodb_new_image_rates_l_1_m_bonus_rate_n": "0.20", "dynamodb_new_image_rates_l_1_m_min_amount_n": "50000", "dynamodb_new_image_updated_at_n": "1700000000",
        "dynamodb_new_image_available_days_after_maturity_n": "14",
    }
    kinds = ("gbp:ftd_3m:default", "gbp:ftd_3m:post_maturity_reinvestment", "ftd:rule:post_maturity_reinvestment")
    products = [{**product, "dynamodb_new_image_sk_s": k} for k in kinds]
    products.append({**product, "dynamodb_new_image_sk_s": kinds[0], "dynamodb_new_image_updated_at_n": "1600000000", "dynamodb_new_image_interest_rate_n": "9"})
    form = "dynamodb_new_image_form_data_m_customer"
    form_schema = "dynamodb_new_image_customer_id_s string, dynamodb_new_image_updated_at_n timestamp, " + ", ".join(
        [f"{form}_occupations_l_{i}_s string" for i in range(5)] + [f"{form}_circumstances_l_{i}_s string" for i in range(3)]
    )
    tables = {
        "customers": frame(spark, CUSTOMER, customer("C1", "APPROVED", 1, income="GBP_6000_TO_12000")),
        "clients": clients,
        "deposit_accounts": frame(
            spark, ACCOUNT,
            account(1, "K1", exclusive, "100", "2024-01-10", approved="2024-01-05", activation="2024-01-05", maturity="2024-04-05"),
            account(1, "K1", exclusive, "100", "2024-04-06", state="MATURED", approved="2024-01-05", activation="2024-01-05", maturity="2024-04-05"),
            account(2, "K1", exclusive, "200", "2024-04-08", approved="2024-04-08", activation="2024-04-08", maturity="2024-10-08"),
            account(3, "K1", exclusive, "300", "2024-05-01", approved="2024-05-01", activation="2024-05-01", maturity="2024-08-01"),
            account(3, "K1", exclusive, "300", "2024-05-09", state="CLOSED", approved="2024-05-01", activation="2024-05-01", maturity="2024-08-01", closed="2024-05-09"),
            account(4, "K2", exclusive, "10", "2024-01-01", state="CLOSED", maturity="2024-08-01"),
        ),
        "deposit_transactions": frame(
            spark, MOVE, move(1, 1, "INTEREST_APPLIED", "2.555", "2024-04-05"), move(2, 1, "WITHDRAWAL", "-102.55", "2024-04-06"),
        ),
        "payment_products": spark.createDataFrame(products),
        "riskscore": risk(spark, ("C9", None, None, None, None, None, None, None)),
        "timeline": timeline(spark, "C1"),
        "risk_form": frame(spark, form_schema, ("C1", T(2024, 1, 1), *["x"] * 8)),
    }
    got = {r["ftd_account_id"]: r for r in term_deposits.term_deposits(tables, "HOUSE").collect()}
    # account 3 was closed early, account 4 was never active
    assert set(got) == {"A1", "A2"}
    one, two = got["A1"], got["A2"]
    assert (one["ftd_term"], two["ftd_term"]) == ("3-months", "7-months")
    assert (one["ftd_account_state"], two["ftd_account_state"]) == ("MATURED", "ACTIVE")
    assert (one["ftd_next_account_id"], two["ftd_next_account_id"]) == ("A2", None)
    assert [one[f"ftd_opened_within_{n}_days_maturity"] for n in (1, 3, 7, 14)] == [0, 1, 1, 1]
    assert one["ftd_interest_accrued_amount"] == D("2.56") and two["ftd_interest_accrued_amount"] == D("1.50")
    assert one["ftd_balance_at_maturity"] == D("102.55") and two["ftd_balance_at_maturity"] is None
    assert (one["ftd_number_gbp_ftds"], one["ftd_gbp_total_balance"], one["ftd_gbp_cur_balance"]) == (2, D("300.00"), D("200.000"))
    assert one["ftd_usd_has_open"] is False and one["ftd_gbp_is_currently_open"] is True
    assert (one["ftd_affluency"], one["ftd_brand_id"]) == ("Affluent", "HOUSE")
    assert one["ftd_gbp_3m_rate_0_default_rate"] == "4.75%" and one["ftd_gbp_3m_rate_1_preferential_rate"] == "5.10%"
    assert one["ftd_top_pref_rate_gbp"] == "5.10%" and one["ftd_top_pref_rate_euro"] is None
    assert one["ftd_offer_days"] == 14 and one["ftd_offer_expired_date"] == dt.date(2024, 4, 19)
    near = term_deposits.term_deposits(tables, "HOUSE", dt.date(2024, 4, 20), 21)
    assert rows(near, "ftd_account_id") == [("A1",)]


def test_first_funded(spark, clients):
    tables = {
        "customers": frame(spark, CUSTOMER, customer("C1", "APPROVED", 1), customer("C2", "AWAITING_APPROVAL", 2), customer("C2", "APPROVED", 1)),
        "clients": clients,
        "deposit_accounts": frame(
            spark, ACCOUNT, account(1, "K1", "GBP Current Account", "0", "2024-01-01"), account(2, "K1", "USD Current Account", "5", "2024-01-02", ccy="USD"), account(3, "K2", "GBP Current Account", "5", "2024-01-02"),
        ),
        "deposit_transactions": frame(
            spark, MOVE,
            move(1, 2, "DEPOSIT", "10", "2024-03-08", ccy="USD", channel=None), move(2, 2, "DEPOSIT", "99", "2024-03-09", ccy="USD"),
            move(3, 1, "DEPOSIT", "1", "2024-03-09"), move(4, 3, "DEPOSIT", "1", "2024-03-09"),
        ),
        "timeline": timeline(spark, "C1"),
    }
    got = engagement.first_funded_accounts(tables, dt.date(2024, 3, 10), "HOUSE").collect()
    assert [(r["customer_id"], r["funded_amount"], r["gbp_amount"], r["type_transaction"], r["has_opted_out_of_push"]) for r in got] == [
        ("C1", "10", D("8.00000"), "Unknown", True)
    ]
    assert engagement.first_funded_accounts(tables, dt.date(2024, 3, 20), "HOUSE").count() == 0


def test_wallet_activation_is_first_only_when_single(spark):
    m = "dynamodb_new_image_message_m_iso_msg_m"
    schema = f"dynamodb_new_image_token_n bigint, dynamodb_new_image_updated_at_n timestamp, {m}_de48_m_26_s string, {m}_de124_m_1_s string, {m}_de124_m_3_s string, {m}_de124_m_7_s string"
    tables = {
        "card_messages": frame(
            spark, schema,
            (1, T(2024, 1, 1), "103", None, "01", "1"), (1, T(2024, 1, 1), "103", None, "01", "1"), (2, T(2024, 1, 1), "216", None, "7", "2"),
            (2, T(2024, 1, 2), "103", None, "01", "1"), (3, T(2024, 1, 2), "103", None, "01", "1"), (1, T(2024, 1, 5), "103", None, "03", "1"), (1, T(2024, 1, 6), "", None, "01", "1"),
        ),
        "cards": frame(spark, "dynamodb_new_image_token_n bigint, dynamodb_new_image_user_id_s string", (1, "C1"), (2, "C2"), (3, "C3")),
        "timeline": timeline(spark, "C1", "C2"),
    }
    got = engagement.wallet_activations(tables)
    assert rows(got, "dynamodb_new_image_user_id_s", "Wallet_Ind", "rn_first", "first_activation") == [("C1", "Apple Pay", 1, "Yes"), ("C2", "Apple Pay", 2, "NO")]


def test_loan_return(spark):
    day = dt.date
    tables = {
        "psd_form": frame(spark, "id string, case__c string, remaining_term_months__c int, current_expected_monthly_payment__c double, current_payment_shortfall__c double, months_past_maturity__c int, current_balance_outstanding__c double", ("F1", "c1", 9, 9.0, 9.0, 9, 9.0), ("F2", "c2", 9, 9.0, 9.0, 9, 9.0)),
        "mortgage_applications": frame(spark, "salesforce_case_id string, id string, loan_account_mambu_id string, updated_at timestamp", ("c1", "a0", "L0", T(2024, 1, 1)), ("c1", "a1", "L1", T(2024, 1, 2)), ("c1", "a2", None, T(2024, 1, 3))),
        "loan_accounts": frame(spark, "encoded_key string, mortgage_app_mortgage_application_id string, id string, balances_principal_balance double, last_modified_date string", ("k1", "a1", "L1", 50.0, "2024-01-01"), ("k1", "a1", "L1", 40.0, "2024-02-01")),
        "loan_installments": frame(
            spark, "parent_account_key string, due_date date, state string, principal_amount_due double, interest_amount_due double, timestamp_extracted timestamp",
            ("k1", day(2024, 1, 15), "PENDING", 10.0, None, T(2024, 3, 2)), ("k1", day(2024, 2, 15), "PENDING", 5.0, 1.0, T(2024, 3, 2)),
            ("k1", day(2023, 12, 15), "PAID", 7.0, 1.0, T(2024, 3, 2)), ("k1", day(2030, 1, 1), "PENDING", 99.0, 99.0, T(2024, 3, 1)),
        ),
    }
    got = {r["id"]: r for r in loans.loan_return(tables, day(2024, 4, 20)).collect()}
    one = got["F1"]
    assert (one["current_expected_monthly_payment__c"], one["current_payment_shortfall__c"], one["current_balance_outstanding__c"]) == (6.0, 16.0, 40.0)
    assert (one["remaining_term_months__c"], one["months_past_maturity__c"]) == (-2, 2)
    assert (got["F2"]["current_payment_shortfall__c"], got["F2"]["months_past_maturity__c"]) == (None, 0)


def test_lifecycle_other_accounts_and_cash_back(spark, clients):
    m = "dynamodb_new_image_message_m"
    at = T(2024, 1, 1, 13, 5, 6)
    message = f"dynamodb_new_image_token_n bigint, dynamodb_new_image_updated_at_n timestamp, {m}_iso_msg_m_de48_m_26_s string, {m}_summary_m_billing_amount_s double, {m}_summary_m_processor_decision_desc_s string, {m}_message_type_m_message_desc_s string, {m}_summary_m_spend_type_s string"
    tables = {
        "customers": frame(spark, CUSTOMER, customer("C1", "APPROVED", 1), customer("C2", "AWAITING_APPROVAL", 1)),
        "clients": clients,
        "deposit_accounts": frame(spark, ACCOUNT, account(1, "K1", "GBP Current Account", "5", "2024-01-01"), account(2, "K1", "Pot", "6", "2024-01-01"), account(3, "K1", "GBP Current Account", "7", "2024-01-01")),
        "deposit_transactions": frame(spark, MOVE, move(1, 1, "DEPOSIT", "1", "2024-02-01"), move(1, 1, "DEPOSIT", "1", "2024-02-09", extracted=2), move(2, 2, "DEPOSIT", "1", "2024-02-03")),
        "cards": frame(spark, "dynamodb_keys_id_s string, dynamodb_new_image_token_n bigint, dynamodb_new_image_user_id_s string, dynamodb_new_image_state_s string, dynamodb_new_image_updated_at_n timestamp, timestamp_extracted timestamp, date timestamp", ("d", 1, "C1", "ACTIVE", None, at, at)),
        "card_messages": frame(spark, message, (1, at, "103", 1.0, "Approve", "Authorisation Request", "POS - Purchase with Cash Back"), (1, at, "217", 1.0, "Approve", "Authorisation Advice", "POS - Purchase with Cash Back"), (1, at, "103", -1.0, "Approve", "Authorisation Request", "POS - Purchase")),
        "card_orders": frame(spark, "dynamodb_new_image_user_id_s string, dynamodb_keys_user_id_s string, dynamodb_new_image_created_at_n timestamp, dynamodb_new_image_updated_at_n timestamp, timestamp_extracted timestamp, date timestamp", (None, "C1", at, at, at, at)),
    }
    got = lifecycle.lifecycle_extract(tables).collect()
    assert len(got) == 1
    row = got[0]
    assert row["Account_Types"] == "Pot, GBP Current Account" and row["Other_Balances_Total_Balance"] == D("6.00")
    assert row["GBP_Current_Account_Total_Balance"] == D("5.00")
    assert row["GBP_Current_Account_Last_Inbound_Payment_Date"] == "09/02/2024 10:00:00 AM"
    assert row["GBP_Current_Account_First_Inbound_Payment_Date"] == "01/02/2024 10:00:00 AM"
    # cash back counts for cards but not for the wallet; a negative amount counts for neither
    assert row["Cus_Has_Apple_Pay"] == "NO" and row["First_Card_Trans_Date"] == "01/01/2024 01:05:06 PM"
    assert row["Card_Activation_Date"] == row["Card_Ordered_Date"] == "01/01/2024 01:05:06 PM"


def test_calls_need_a_parsable_creation_time(spark):
    schema = ", ".join(f"{c} string" for c in (*service.CALL_COLUMNS, "createddate"))
    blank = [None] * (len(service.CALL_COLUMNS) - 1)
    contacts = frame(spark, schema, ("p1", *blank, "2023-06-16 00:00:00.001"), ("p2", *blank, "2023-06-16 00:00:00.000"), ("p3", *blank, "soon"))
    assert rows(service.outbound_calls({"contacts": contacts}), "id") == [("p1",)]


def test_survey_reports_share_one_join_of_the_answers(spark, tmp_path, monkeypatch):
    """Repeated and null keys, a survey id with two names; each report as when it stands alone."""
    from ledgerlake.plans import jobs

    tables = {
        "cases": frame(
            spark,
            "id long, case_rt_dev_name__c string, case_number string, casenumber string, type string, status string, origin string, priority string, "
            "owner_id long, contact_id long, subject string, complaint_status__c string, response_status__c string, redress_paid__c string, "
            "redress_amount__c string, complaint_root_cause__c string, createddate timestamp",
        ),
        "users": frame(spark, "id long, name string"),
        "contacts": frame(spark, "id long, name string"),
        "case_milestones": frame(spark, "case_id long, milestone_type_id long, target_date timestamp, completion_date timestamp"),
        "milestone_types": frame(spark, "id long, name string"),
        "account_history": frame(spark, "field string, old_value string, new_value string, account_id long, createddate timestamp"),
        "accounts": frame(spark, "id long, name string"),
        "surveys": frame(
            spark, "id long, name string", *enumerate(service.SURVEYS.values()), (0, "Onboarding Survey"), (1, "Onboarding Survey"),
            (None, "Onboarding Survey"), (3, "Other"),
        ),
        "survey_takers": frame(spark, "id long, name string, survey__c long", *((i % 9, f"T{i}", i % 5 if i % 7 else None) for i in range(30)), (None, "n", 0)),
        "survey_questions": frame(spark, "id long, name string", (1, "one"), (2, "two"), (2, "two again"), (None, "none")),
        "survey_responses": frame(
            spark,
            "survey_taker__c long, question_type__c string, name string, response__c string, response_english_text string, "
            "survey_question__c long, response_numeric__c double, createddate timestamp",
            *((i % 11 if i % 6 else None, "q", f"R{i // 2}", "x", "y", i % 4, float(i), T(2024, 1, 1)) for i in range(60)),
        ),
    }
    written, materialize = [], service.materialize
    monkeypatch.setattr(service, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    config = service.consumer_duty_config(tables)
    for turn in (1, 2):
        found = jobs.publish(spark, config, str(tmp_path / str(turn)), dt.date(2024, 3, 9), **tables)
        assert all(x["written"] for x in found.values()) and len(written) == turn  # one join a run
        for name in ("onboarding_survey", "general_enquiry_survey", "recent_experience_survey"):
            alone = service.CONSUMER_DUTY[name][0](tables)
            assert alone.count() > 0
            back = spark.read.schema(alone.schema).parquet(str(tmp_path / str(turn) / name))
            assert rows(back, *alone.columns) == rows(alone)
