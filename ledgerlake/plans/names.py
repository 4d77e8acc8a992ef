"""Fixed names and values the reports share."""

from __future__ import annotations

# Account currencies.
CURRENCIES = ("GBP", "USD", "EUR", "AED", "SAR", "KWD")

# Currencies and grades of term deposits; the account name is built from them.
TERM_CURRENCIES = ("GBP", "EUR", "USD")
TERM_GRADES = {"": "ftd", " Standard": "standard_ftd", " Exclusive": "exclusive_ftd"}

# account name -> column prefix, e.g. "GBP Fixed Deposit Account Standard" -> "gbp_standard_ftd"
TERM_ACCOUNTS = {
    f"{ccy} Fixed Deposit Account{grade}": f"{ccy.lower()}_{label}"
    for ccy in TERM_CURRENCIES
    for grade, label in TERM_GRADES.items()
}

# Channels that count as an inbound payment.
INBOUND_CHANNELS = (
    "BLME_USD_Deposit",
    "CB_Deposit_BACS",
    "CB_Deposit_CHAPS",
    "CB_Deposit_FPS",
    "CB_Transfer",
    "CC_Deposit_AED",
    "CC_Deposit_EUR",
    "CC_Deposit_GBP",
    "CC_Deposit_KWD",
    "CC_Deposit_SAR",
    "CC_Deposit_USD",
    "CC_ManualDeposit_AED",
    "CC_ManualDeposit_EUR",
    "CC_ManualDeposit_GBP",
    "CC_ManualDeposit_KWD",
    "CC_ManualDeposit_SAR",
    "CC_ManualDeposit_USD",
    "ClearBank_Nostro_GBP",
)
