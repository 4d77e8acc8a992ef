"""Affluency classes and the extended customer profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import band, lookup, midpoint, to_gbp, try_number
from ledgerlake.functions.text import blank_to, clean_null, part_of, replace_blank
from ledgerlake.operators.latest import latest_per_key
from ledgerlake.operators.windows import with_group_totals
from ledgerlake.plans.customers import COUNTRY, STATUS, Tables, change_order, customer_id

# Yearly income in GBP per monthly income code.
INCOME_GBP = {
    "0_2000_SAR_MONTH": 2600,
    "AED_LESS_THAN_2000": 2600,
    "GBP_3000_TO_4000": 42000,
    "KWD_LESS_THAN_1000": 15900,
    "GBP_LESS_THAN_1000": 6000,
    "6000_12000_GBP_MONTH": 108000,
    "0_1000_GBP_MONTH": 6000,
    "3000_4000_GBP_MONTH": 42000,
    "KWD_1000_TO_3999": 79400,
    "1000_3000_GBP_MONTH": 24000,
    "GBP_6000_TO_12000": 108000,
    "GBP_4000_TO_6000": 60000,
    "MORE_THAN_7000_KWD_MONTH": 222600,
    "KWD_4000_TO_7000": 174900,
    "KWD_MORE_THAN_7000": 222600,
    "GBP_MORE_THAN_12000": 144000,
    "1000_3999_KWD_MONTH": 79400,
    "4000_6000_GBP_MONTH": 60000,
    "MORE_THAN_12000_GBP_MONTH": 144000,
    "0_1000_KWD_MONTH": 15900,
    "4000_7000_KWD_MONTH": 174900,
    "0_20000_AED_MONTH": 26400,
    "GBP_1000_TO_3000": 24000,
    "55000_85000_AED_MONTH": 184800,
    "3000_4999_SAR_MONTH": 10500,
    "MORE_THAN_125000_AED_MONTH": 330000,
    "MORE_THAN_15000_SAR_MONTH": 39600,
    "AED_MORE_THAN_10000": 26400,
    "AED_5000_TO_7000": 15800,
    "AED_3000_TO_5000": 10500,
    "AED_7000_TO_10000": 22400,
    "20000_35000_AED_MONTH": 72600,
    "35000_55000_AED_MONTH": 118800,
    "8000_14999_SAR_MONTH": 30300,
    "5000_7999_SAR_MONTH": 17100,
    "AED_2000_TO_3000": 6600,
    "85000_125000_AED_MONTH": 277000,
    "2000_2999_SAR_MONTH": 6500,
    "MORE_THAN_100000_AED_MONTH": 264000,
    "10000_14999_AED_MONTH": 32900,
    "40000_99999_AED_MONTH": 184700,
    "15000_19999_AED_MONTH": 46100,
    "20000_39999_AED_MONTH": 79100,
    "0_9999_AED_MONTH": 13100,
}

# Assets in GBP per asset code.
ASSETS_GBP = {
    "0_30000_KWD": 39700,
    "85000_199000_GBP": 142000,
    "30000_80000_KWD": 145700,
    "0_50000_SAR": 5500,
    "KWD_150K_TO_300K": 596200,
    "KWD_80K_TO_150K": 304700,
    "20000_84000_GBP": 52000,
    "GBP_LESS_THAN_20K": 10000,
    "GBP_20K_TO_84K": 52000,
    "MORE_THAN_300000_KWD": 795000,
    "150000_300000_KWD": 596200,
    "GBP_200K_TO_299K": 249500,
    "GBP_85K_TO_199K": 142000,
    "MORE_THAN_1000000_GBP": 1000000,
    "KWD_MORE_THAN_300K": 795000,
    "0_20000_GBP": 10000,
    "KWD_LESS_THAN_30K": 39700,
    "AED_LESS_THAN_35K": 3800,
    "200000_299000_GBP": 249500,
    "0_35000_AED": 3800,
    "GBP_MORE_THAN_1M": 1000000,
    "500000_1000000_GBP": 750000,
    "KWD_30K_TO_80K": 140000,
    "GBP_500K_TO_1M": 750000,
    "80000_150000_KWD": 304700,
    "AED_500K_TO_1_5M": 220000,
    "AED_35K_TO_49K": 9200,
    "AED_50K_TO_99K": 16300,
    "AED_100K_TO_499K": 65800,
    "AED_MORE_THAN_1_5M": 330000,
    "35000_49000_AED": 9240,
    "500000_1500000_AED": 220000,
    "50000_99000_AED": 16300,
    "750000_1000000_SAR": 192500,
    "100000_499000_AED": 65800,
    "MORE_THAN_1500000_AED": 330000,
    "250000_750000_SAR": 110000,
    "MORE_THAN_1000000_SAR": 220000,
    "100000_250000_SAR": 38500,
    "50000_100000_SAR": 16500,
}

# Item types that count as income, and those that count as wealth.
INCOME_TYPES = (
    "INCOME_FROM_SALARY_BONUS_BENEFITS_COMMISSIONS",
    "INCOME_FROM_PERSONAL_SAVINGS",
    "SAVINGS_FROM_SALARY_OR_EARNINGS",
)
WEALTH_TYPES = (
    "BUSINESS_PROFITS_DIVIDENDS_OR_SALES",
    "STOCKS_SHARES_AND_FUNDS",
    "OTHER",
    "INHERITANCE_OR_GIFTS",
    "PREMIUM_ASSETS",
    "PROPERTY_SALES",
    "VIRTUAL_ASSETS",
)
SLOTS = 30

# Upper bounds of the income and wealth brackets.
INCOME_BRACKETS = (
    (5000, "Less than £5000 pa"),
    (10000, "£5000 to £10,000 pa"),
    (50000, "£10,000 to £50,000 pa"),
    (100000, "£50,000 to £100,000 pa"),
    (500000, "£100,000 to £500,000 pa"),
)
WEALTH_BRACKETS = (
    (5000, "Less than £5000"),
    (10000, "£5000 to £10,000"),
    (50000, "£10,000 to £50,000"),
    (100000, "£50,000 to £100,000"),
    (500000, "£100,000 to £500,000"),
    (1000000, "£500,000 to £1,000,000"),
)

RISK_KEY = "dynamodb_keys_customer_id_s"
INCOME_CODE = "dynamodb_new_image_individual_m_financial_details_m_monthly_income_s"
ASSETS_CODE = "dynamodb_new_image_individual_m_financial_details_m_estimated_assets_value_s"
CARD_ORDERED = "dynamodb_new_image_card_ordered_bool"


def declared_means(risk: DataFrame) -> DataFrame:
    """Income, wealth and net worth per customer from the repeated risk-score items.

    An item is worth the middle of the two numbers in ``CODE_<min>_<max>``, if both parse.
    """
    slots = [i for i in range(SLOTS) if f"items_new_{i}_type" in risk.columns]
    raw = F.array(
        *[
            F.struct(
                F.col(f"items_new_{i}_type").alias("type"),
                F.col(f"items_new_{i}_converted_currency").alias("range"),
            )
            for i in slots
        ]
    )

    def item(x: Column) -> Column:
        low, high = (try_number(part_of(x["range"], "_", i), "decimal(18,3)") for i in (2, 3))
        kind = F.when(x["type"].isin(*INCOME_TYPES), "income").when(x["type"].isin(*WEALTH_TYPES), "wealth")
        return F.struct(kind.alias("kind"), midpoint(low, high).alias("amount"))

    items = F.filter(F.transform(raw, item), lambda x: x["kind"].isNotNull() & x["amount"].isNotNull())
    low, high = (
        to_gbp(f"estimated_net_worth_{side}_local", "estimated_net_worth_currency_code") for side in ("min", "max")
    )
    # repeated extracts of the same declaration count once
    declared = (
        risk.filter(F.col(RISK_KEY).isNotNull())
        .select(RISK_KEY, items.alias("items"), midpoint(low, high).alias("net_worth"))
        .distinct()
    )

    def total(kind: str) -> Column:
        known = F.filter("items", lambda x: x["kind"] == kind)
        zero = F.lit(0).cast("decimal(28,3)")
        added = F.aggregate(known, zero, lambda acc, x: (acc + x["amount"]).cast("decimal(28,3)"))
        return F.when(F.size(known) > 0, added)

    return (
        declared.select(
            F.col(RISK_KEY).alias("user_id"), total("income").alias("income"), total("wealth").alias("wealth"), "net_worth"
        )
        .groupBy("user_id")
        .agg(
            F.sum("income").alias("income"),
            F.sum("wealth").alias("wealth"),
            F.sum("net_worth").alias("average_net_worth"),
        )
    )


def means_per_customer(tables: Tables, history_fallback: bool) -> DataFrame:
    """Income and assets per customer with the source-precedence rules, and the affluency class.

    With ``history_fallback`` a value missing from the latest row is taken from the customer's history.
    """
    history = tables["customers"]
    order = change_order(history)
    facts = {
        "country_code": F.col(COUNTRY),
        "current_status": F.col(STATUS),
        "card_ordered": F.col(CARD_ORDERED),
        "income_coded": lookup(INCOME_CODE, INCOME_GBP),
        "assets_coded": lookup(ASSETS_CODE, ASSETS_GBP),
    }
    coded = history.select(
        customer_id(history).alias("user_id"), *order, *[c.alias(n) for n, c in facts.items()]
    )
    if history_fallback:
        # the latest row and the best values of the history in one pass
        current = (
            coded.groupBy("user_id")
            .agg(
                F.max_by(F.struct(*facts), F.struct(*order)).alias("_now"),
                F.max("income_coded").alias("income_best"),
                F.max("assets_coded").alias("assets_best"),
            )
            .select("user_id", "_now.*", "income_best", "assets_best")
        )
    else:
        current = latest_per_key(coded, "user_id", order)
    joined = current.join(declared_means(tables["riskscore"]), "user_id", "left")

    uae = F.col("country_code") == "ARE"
    income, wealth, worth = F.col("income"), F.col("wealth"), F.col("average_net_worth")
    income_gbp = F.when(uae & (income != 0), income)
    assets_gbp = F.when(uae & (wealth > 0), wealth).when(
        (wealth.isNull() | (wealth == 0)) & (worth > 0), worth
    )
    if history_fallback:
        for coded_col in ("income_coded", "income_best"):
            income_gbp = income_gbp.when(F.col(coded_col) > 0, F.col(coded_col))
        for coded_col in ("assets_coded", "assets_best"):
            assets_gbp = assets_gbp.when(F.col(coded_col) > 0, F.col(coded_col))
        income_gbp, assets_gbp = income_gbp.otherwise(income), assets_gbp.otherwise(wealth)
    else:
        income_gbp, assets_gbp = income_gbp.otherwise(F.col("income_coded")), assets_gbp.otherwise(F.col("assets_coded"))
    valued = joined.withColumn("_i", income_gbp.cast("decimal(28,3)")).withColumn("_a", assets_gbp.cast("decimal(28,3)"))
    both_missing = F.col("_i").isNull() & F.col("_a").isNull()
    value = lambda c: F.when(~both_missing, F.coalesce(c, F.lit(0))).cast("decimal(28,3)")
    no_wealth = wealth.isNull() | (wealth == 0)
    no_income = income.isNull() | (income == 0)
    return valued.select(
        "user_id",
        "country_code",
        "current_status",
        "card_ordered",
        "average_net_worth",
        value(F.col("_i")).alias("income_gbp_value"),
        value(F.col("_a")).alias("assets_gbp_value"),
        F.coalesce((uae & no_income & no_wealth).cast("int"), F.lit(0)).alias("uae_cust_no_income_wealth_riskscore"),
        F.coalesce((uae & (income > 0) & no_wealth).cast("int"), F.lit(0)).alias("uae_cust_zero_wealth"),
    ).withColumn("affluency", affluency_class(F.col("income_gbp_value"), F.col("assets_gbp_value")))


def affluency_class(income: Column, assets: Column) -> Column:
    return (
        F.when((income >= 100000) | (assets >= 200000), "Affluent")
        .when((income >= 50000) | (assets >= 60000), "Mass Affluent")
        .when((income < 50000) | (assets < 60000), "Mass")
    )


def means_type(income: Column, assets: Column) -> Column:
    """Which of income and wealth a customer declared."""
    none = lambda c: c.isNull() | (c == 0)
    return (
        F.when((income > 0) & (assets > 0), "Income and Wealth")
        .when((income > 0) & none(assets), "Income")
        .when(none(income) & (assets > 0), "Wealth")
    )


def affluency(tables: Tables) -> DataFrame:
    """``user_id, affluency, age_range`` for every customer.

    Needs ``customers``, ``riskscore`` and ``timeline``.
    """
    ages = tables["timeline"].select(
        F.col("dynamo_user_key").alias("user_id"), blank_to("age_range", "Unknown").alias("age_range")
    ).distinct()
    means = means_per_customer(tables, history_fallback=False)
    return (
        means.select("user_id", F.coalesce("affluency", F.lit("Unknown")).alias("affluency"))
        .join(ages, "user_id", "left")
        .distinct()
    )


def taxonomy(tables: Tables, default_brand: str) -> DataFrame:
    """The full customer taxonomy the affluency report is cut from."""
    labels = tables["timeline"].select(
        F.col("dynamo_user_key").alias("user_id"),
        blank_to("age_range", "Unknown").alias("age_range"),
        blank_to("dynamodb_individual_m_nationality_country_code_s", "Unknown").alias("nationality"),
        clean_null("brand_id", ("", "<NA>"), default_brand).alias("brand_id"),
        gender().alias("gender"),
    )
    means = means_per_customer(tables, history_fallback=False)
    return (
        means.join(labels, "user_id", "left")
        .withColumn("country_code", replace_blank("country_code"))
        .withColumn("card_ordered", F.coalesce(F.col("card_ordered").cast("int"), F.lit(0)))
        .withColumn("card_cost", F.when(F.col("card_ordered") == 1, F.lit("20.70").cast("decimal(5,2)")).otherwise(0))
        .withColumn("approved_customer", F.coalesce((F.col("current_status") == "APPROVED").cast("int"), F.lit(0)))
        .withColumn("income_wealth_type", means_type(F.col("income_gbp_value"), F.col("assets_gbp_value")))
        .distinct()
    )


def gender() -> Column:
    code = F.col("dynamodb_new_gid")
    return F.when(code == "1", "Female").when(code == "0", "Male")


FORM_KEY = "dynamodb_new_image_customer_id_s"
FORM = "dynamodb_new_image_form_data_m_customer"


def form_answers(form: DataFrame, kind: str, slots: int, out: str, count: str) -> DataFrame:
    """Distinct answers of the latest risk form, one per row, with their number per customer."""
    current = latest_per_key(form, FORM_KEY, "dynamodb_new_image_updated_at_n")
    answers = current.select(
        F.col(FORM_KEY).alias("user_id"),
        F.explode(F.array(*[F.col(f"{FORM}_{kind}_l_{i}_s") for i in range(slots)])).alias("raw"),
    )
    cleaned = answers.select("user_id", clean_null("raw", ("", "nan")).alias(out)).filter(F.col(out).isNotNull())
    return with_group_totals(cleaned.distinct(), "user_id", {count: F.count(out)})


def wealth_sources(risk: DataFrame) -> DataFrame:
    """Distinct declared item types per customer with the number of sources per kind."""
    types = F.array(*[F.col(c) for c in risk.columns if c.startswith("items_new_") and c.endswith("_type")])
    named = (
        risk.filter(F.col(RISK_KEY).isNotNull())
        .select(F.col(RISK_KEY).alias("user_id"), F.explode(types).alias("income_wealth_value"))
        .filter(F.col("income_wealth_value").isNotNull())
        .distinct()
        .withColumn("kind", F.when(F.col("income_wealth_value").isin(*INCOME_TYPES), "income").otherwise("wealth"))
    )
    return with_group_totals(
        named, ["user_id", "kind"], {"income_wealth_source_count": F.count("income_wealth_value")}
    ).drop("kind")


def customer_profile(tables: Tables, default_brand: str) -> DataFrame:
    """Every customer of the timeline with means, brackets, occupations, circumstances and sources.

    One row per combination of occupation, circumstance and source. Needs ``customers``, ``riskscore``,
    ``timeline`` and ``risk_form``.
    """
    means = means_per_customer(tables, history_fallback=True)
    income, assets = F.col("income_gbp_value"), F.col("assets_gbp_value")
    people = tables["timeline"].select(
        F.col("dynamo_user_key").alias("user_id"),
        F.col("dynamodb_individual_m_nationality_country_code_s").alias("nationality"),
        "age_range",
        clean_null("brand_id", ("",), default_brand).alias("brand_id"),
        gender().alias("gender"),
    )
    form = tables["risk_form"]
    return (
        people.join(means.withColumn("known", F.lit(True)), "user_id", "left")
        .withColumns(
            {
                "income_bracket": band(income, INCOME_BRACKETS, "Over £500,000pa"),
                "wealth_bracket": band(assets, WEALTH_BRACKETS, "Over £1,000,000"),
                "income_wealth_type": means_type(income, assets),
            }
        )
        .join(wealth_sources(tables["riskscore"]).withColumn("known", F.lit(True)), ["user_id", "known"], "left")
        .drop("known")
        .join(form_answers(form, "occupations", 5, "occupation", "occupation_count"), "user_id", "left")
        .join(form_answers(form, "circumstances", 3, "circumstance", "circumstance_count"), "user_id", "left")
    )


def customer_affluency(tables: Tables) -> DataFrame:
    """``user_id, affluency`` with the history fallback, one row per customer of the timeline."""
    means = means_per_customer(tables, history_fallback=True).select("user_id", "affluency")
    return means.join(
        tables["timeline"].select(F.col("dynamo_user_key").alias("user_id")).distinct(), "user_id", "left_semi"
    )
