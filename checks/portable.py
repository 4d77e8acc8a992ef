"""Columns that the two engines hand to pandas in different types.

Spark gives dates as objects and whole numbers with gaps as floats; DuckDB gives timestamps and nullable
integers. Both sides of the check return these dates and flags as text and these numbers as doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# query -> (columns compared as text, columns compared as doubles)
COLUMNS: dict[str, tuple[list[str], list[str]]] = {
    "c22_parse_bool": (["public"], []),
    "c26_safe_int": ([], ["rooms"]),
    "c28_conform_valuations": ([], ["bedrooms"]),
    "p16_latest_snapshot": (["day"], []),
    "g7_pivot_max_date": (["urgent_date", "high_date", "medium_date", "unspecified_date", "low_date"], []),
    "g20_activity_report": (["day"], []),
    "j2_left_join": ([], ["o_orderkey"]),
    "j4_right_join": ([], ["c_custkey"]),
    "j5_full_compare": ([], ["n_left", "n_right"]),
    "j10_report_assembly": ([], ["n_events"]),
    "s7_file_backlog": (["file_date"], []),
    "n5_plan_days": (["day"], []),
    "q1_reconcile_by_date": (["createddate"], []),
    "q2_reconcile_by_type": (["createddate"], ["id_count_lake"]),
    "q3_reconcile_renamed": (["createddate"], []),
    "r3_savings_accounts": (["ias_open_date", "ias_gbp_first_deposit_date", "ias_gbp_last_transaction_date", "ias_usd_first_deposit_date", "ias_usd_last_transaction_date", "ias_eur_first_deposit_date", "ias_eur_last_deposit_date", "ias_recurring_transfer"], []),
    "r5_term_deposits": (["ftd_maturity_date_plus_1hr", "ftd_offer_expired_date"], []),
    "r7_first_funded_accounts": (["has_opted_out_of_push"], []),
    "r9_wallet_usage": (["latest_transaction_wallet_date"], []),
    "r11_loan_return": ([], ["remaining_term_months__c"]),
    "r21_q7_reconciliation_run": (["createddate"], []),
    "f10_try_cast": ([], ["kind_no"]),
    "f11_casts": (["day"], []),
    "f17_code_lookup": ([], ["income"]),
    "f20_f22_date_text": (["day"], []),
    "w12_with_next": ([], ["next_key"]),
    "w12_with_next_quantiles": ([], ["next_id"]),
}


def frame(name: str, df: DataFrame) -> DataFrame:
    text, number = COLUMNS.get(name, ([], []))
    casts = {**{c: F.col(c).cast("string") for c in text}, **{c: F.col(c).cast("double") for c in number}}
    return df.withColumns(casts) if casts else df


def sql(name: str, query: str) -> str:
    text, number = COLUMNS.get(name, ([], []))
    casts = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in text] + [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in number]
    return f"SELECT * REPLACE ({', '.join(casts)}) FROM ({query}) AS checked" if casts else query
