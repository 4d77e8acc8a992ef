"""Loan part of the regulatory return."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import months_between
from ledgerlake.functions.numbers import null_safe_sum
from ledgerlake.operators.latest import latest_per_key
from ledgerlake.operators.predicates import latest_snapshot
from ledgerlake.plans.customers import Tables

# Form columns that the report computes.
COMPUTED = (
    "current_expected_monthly_payment__c",
    "current_payment_shortfall__c",
    "remaining_term_months__c",
    "months_past_maturity__c",
    "current_balance_outstanding__c",
)


def loan_return(tables: Tables, today: dt.date) -> DataFrame:
    """The form with its loan columns replaced by current figures.

    Needs ``psd_form``, ``mortgage_applications``, ``loan_accounts`` and ``loan_installments``.
    """
    day = F.lit(today)
    applications = latest_per_key(
        tables["mortgage_applications"].filter(
            F.col("loan_account_mambu_id").isNotNull() & F.col("salesforce_case_id").isNotNull()
        ),
        "salesforce_case_id",
        ["updated_at", "id"],
    ).select(F.col("salesforce_case_id").alias("case__c"), F.col("id").alias("application_id"), F.col("loan_account_mambu_id").alias("loan_id"))
    loans = latest_per_key(tables["loan_accounts"], "encoded_key", ["last_modified_date", "id"]).select(
        "encoded_key",
        F.col("mortgage_app_mortgage_application_id").alias("application_id"),
        F.col("id").alias("loan_id"),
        F.col("balances_principal_balance").alias("current_balance_outstanding__c"),
    )
    due = latest_snapshot(tables["loan_installments"], "timestamp_extracted")
    pending = F.col("state") == "PENDING"
    owed = null_safe_sum("principal_amount_due", "interest_amount_due")
    newest = F.struct("due_date", "principal_amount_due", "interest_amount_due", "state")
    # one aggregate per loan: the shortfall and the installment that falls due last
    summary = due.groupBy(F.col("parent_account_key").alias("encoded_key")).agg(
        F.sum(F.when(pending & (F.col("due_date") < day), owed).otherwise(F.lit(0))).alias("current_payment_shortfall__c"),
        F.max_by(F.struct("due_date", "state", "principal_amount_due", "interest_amount_due"), newest).alias("last"),
    )
    per_loan = loans.join(summary, "encoded_key", "left").drop("encoded_key")
    form = tables["psd_form"].drop(*COMPUTED)
    joined = form.join(applications, "case__c", "left").join(per_loan, ["application_id", "loan_id"], "left")
    last_due = F.col("last.due_date")
    overdue = (F.col("last.state") == "PENDING") & (last_due < day)
    return joined.select(
        (F.col("last.principal_amount_due") + F.col("last.interest_amount_due")).alias("current_expected_monthly_payment__c"),
        "current_payment_shortfall__c",
        months_between(day, last_due).alias("remaining_term_months__c"),
        F.when(overdue, months_between(last_due, day)).otherwise(F.lit(0)).alias("months_past_maturity__c"),
        "current_balance_outstanding__c",
        *form.columns,
    )
