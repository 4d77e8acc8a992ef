"""Complaint, survey, vulnerability, call and valuation reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.dates import iso_ts
from ledgerlake.operators.conform import VALUATION_FIELDS, cast_null_columns
from ledgerlake.plans.customers import Tables
from ledgerlake.session import materialize

# Names the reports select by.
COMPLAINT = "Complaint"
SURVEYS = {
    "onboarding": "Onboarding Survey",
    "general_enquiry": "SurveyForce Sample Survey",
    "recent_experience": "How was your recent experience?",
}
VULNERABILITY_FIELDS = (
    "Vulnerability_Comments__pc",
    "Vulnerable_Customer__pc",
    "Vulnerable_Customer_Subcategory__pc",
)
CALLS_SINCE = "2023-06-16 00:00:00"

# Contact columns of the call report.
CALL_COLUMNS = (
    "id",
    "customer_cohort__c",
    "prior_customer_cohort__c",
    "latest_cohort_change__c",
    "customer_intent__c",
    "intent_reason__c",
    "last_call_date__c",
    "ocp_call_1__c",
    "ocp_call_1_result__c",
    "ocp_call_1_date__c",
    "ocp_call_2__c",
    "ocp_call_2_result__c",
    "ocp_call_2_date__c",
    "ocp_call_3__c",
    "ocp_call_3_result__c",
    "ocp_call_3_date__c",
    "final_call__c",
    "final_call_attempt_date__c",
    "final_call_projected_date__c",
    "final_call_result__c",
    "pending_final_call__c",
)

# Valuation column -> source column; fields left out are blank.
VALUATION_SOURCES = {
    "Contact_Name__c": "applicantname",
    "Contact_Email__c": "valuationContactEmail",
    "Contact_PhoneNumber__c": "valuationTelNumber",
    "Property_Age__c": "ageMain",
    "Property_Type__c": "flatsType",
    "Bedroom_Count__c": "rooms_bedrooms",
    "Ownership_Type__c": "tenure_type",
    "Remaining_Lease_Years__c": "tenure_terms",
    "Located_above_business__c": "overNonResidential",
    "Case_Number__c": "case_number",
    "Property_Address__c": "propertyAddress",
    "Valuation_Date__c": "valuationDate",
    "Market_Value__c": "valuations_marketValue",
    "Insurance_Reinstatement_Estimate__c": "valuations_insuranceReinstatementEstimate",
    "Market_Rent_per_month__c": "valuations_marketRentPerMonth",
    "Essential_Repairs__c": "essentialRecommendedRepairs",
    "Flooding_risk_sea_or_river__c": "floodingRisk_seaOrRiver",
    "Flooding_Risk_surface_water__c": "floodingRisk_surfaceWater",
    "Invasive_Species__c": "invasiveSpecies",
    "Overhead_Power_Lines__c": "overheadPowerLines",
    "Tenure__c": "tenure_type",
    "Terms_Lease_Details__c": "tenure_terms",
    "Service_Charge_per_annum__c": "serviceCharge",
    "Is_the_property_fit_for_immediate_occupa__c": "fitForImmediateOccupation",
    "Is_a_Reinspection_Required__c": "isReinspectionRequired",
    "Original_Building_construction_type__c": "originalBuilding",
    "External_Condition__c": "condition_external",
    "Internal_Condition__c": "condition_internal",
    "Is_the_property_let__c": "isPropertyLet",
}


def _pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(out) for out, source in columns.items()])


def complaint_cases(tables: Tables) -> DataFrame:
    """Complaints with the names of owner and contact. Needs ``cases``, ``users`` and ``contacts``."""
    cases = tables["cases"].filter(F.col("case_rt_dev_name__c") == COMPLAINT)
    owners = _pick(tables["users"], {"owner_id": "id", "case_owner": "name"})
    contacts = _pick(tables["contacts"], {"contact_id": "id", "contact_name": "name"})
    joined = cases.join(owners, "owner_id").join(contacts, "contact_id")
    return _pick(
        joined,
        {
            "case_record_type": "case_rt_dev_name__c",
            "case_number": "case_number",
            "type": "type",
            "status": "status",
            "complaint_status": "complaint_status__c",
            "response_status": "response_status__c",
            "redress_paid": "redress_paid__c",
            "redress_amount": "redress_amount__c",
            "complaint_root_cause": "complaint_root_cause__c",
            "case_origin": "origin",
            "case_owner": "case_owner",
            "name": "contact_name",
            "subject": "subject",
            "date_time_opened": "createddate",
        },
    )


def complaint_milestones(tables: Tables) -> DataFrame:
    """Complaints with their service-level milestones. Needs ``cases``, ``case_milestones``, ``milestone_types``."""
    cases = tables["cases"].filter(F.col("case_rt_dev_name__c") == COMPLAINT).withColumnRenamed("id", "case_id")
    kinds = _pick(tables["milestone_types"], {"milestone_type_id": "id", "milestone": "name"})
    steps = tables["case_milestones"].select("case_id", "milestone_type_id", "target_date", "completion_date")
    joined = steps.join(cases, "case_id").join(kinds, "milestone_type_id")
    return _pick(
        joined,
        {
            "case_number": "case_number",
            "status": "status",
            "priority": "priority",
            "case_origin": "origin",
            "date_time_opened": "createddate",
            "milestone": "milestone",
            "target_date": "target_date",
            "completion_date": "completion_date",
            "case_record_type": "case_rt_dev_name__c",
        },
    )


def survey_answers(tables: Tables, surveys: Iterable[str]) -> DataFrame:
    """Responses to the surveys with the name of their survey (``answered_survey``), for all of them in one pass.

    Needs ``survey_responses``, ``survey_takers``, ``surveys``, ``survey_questions``.
    """
    wanted = tables["surveys"].filter(F.col("name").isin(*surveys))
    takers = _pick(tables["survey_takers"], {"survey__c": "survey__c", "survey_taker__c": "id", "survey_response": "name"})
    # surveys may repeat; a taker counts once for each name that its survey has
    takers = takers.join(_pick(wanted, {"survey__c": "id", "answered_survey": "name"}).distinct(), "survey__c").drop("survey__c")
    questions = _pick(tables["survey_questions"], {"survey_question__c": "id", "question": "name"})
    return tables["survey_responses"].join(takers, "survey_taker__c").join(questions, "survey_question__c")


def survey_responses(tables: Tables, survey: str, english: bool = False) -> DataFrame:
    """Responses to one survey. Needs ``survey_answers``, or the tables that it is made of."""
    given = tables.get("survey_answers")
    joined = survey_answers(tables, [survey]) if given is None else given.filter(F.col("answered_survey") == survey)
    columns = {
        "survey_response": "survey_response",
        "response_id": "name",
        "question_type": "question_type__c",
        "name": "question",
        "response": "response__c",
        **({"response_en": "response_english_text"} if english else {}),
        "response_numeric": "response_numeric__c",
        "created_date": "createddate",
    }
    return _pick(joined, columns)


def onboarding_survey(tables: Tables) -> DataFrame:
    return survey_responses(tables, SURVEYS["onboarding"], english=True)


def general_enquiry_survey(tables: Tables) -> DataFrame:
    return survey_responses(tables, SURVEYS["general_enquiry"])


def recent_experience_survey(tables: Tables) -> DataFrame:
    return survey_responses(tables, SURVEYS["recent_experience"])


def vulnerable_customers(tables: Tables) -> DataFrame:
    """Changes of the vulnerability fields with the account name. Needs ``account_history`` and ``accounts``."""
    changes = tables["account_history"].filter(F.col("field").isin(*VULNERABILITY_FIELDS))
    accounts = _pick(tables["accounts"], {"account_id": "id", "account_name": "name"})
    joined = changes.join(accounts, "account_id")
    return joined.select(
        "field", "old_value", "new_value", "account_id", "account_name", F.col("createddate").alias("created_date")
    )


def outbound_calls(tables: Tables, since: str = CALLS_SINCE) -> DataFrame:
    """Contacts created after the start of the call programme. Needs ``contacts``."""
    created = iso_ts(F.replace("createddate", F.lit(" "), F.lit("T")))
    return tables["contacts"].filter(created > F.lit(since).cast("timestamp")).select(*CALL_COLUMNS)


def property_valuations(tables: Tables) -> DataFrame:
    """Valuations with the id of their case; valuations without a case are dropped. Needs ``valuations``, ``cases``."""
    cases = _pick(tables["cases"], {"Case_Number__c": "casenumber", "Case_ID__c": "id"}).filter(
        F.col("Case_ID__c").isNotNull()
    )
    records = tables["valuations"].select(
        *[
            (F.col(VALUATION_SOURCES[n]) if n in VALUATION_SOURCES else F.lit("")).alias(n)
            for n in VALUATION_FIELDS
            if n != "Case_ID__c"
        ]
    )
    return records.join(cases, "Case_Number__c").select(*VALUATION_FIELDS)


# Published datasets and their declared types.
CONSUMER_DUTY = {
    "complaints_cases": (complaint_cases, {"date_time_opened": "timestamp"}),
    "complaint_cases_with_milestones": (
        complaint_milestones,
        {"date_time_opened": "timestamp", "target_date": "timestamp", "completion_date": "timestamp"},
    ),
    "onboarding_survey": (onboarding_survey, {"created_date": "timestamp", "response_numeric": "double"}),
    "general_enquiry_survey": (general_enquiry_survey, {"created_date": "timestamp", "response_numeric": "double"}),
    "recent_experience_survey": (recent_experience_survey, {"created_date": "timestamp", "response_numeric": "double"}),
    "vulnerable_customers": (vulnerable_customers, {"created_date": "timestamp"}),
}


# What the survey reports read of the answers.
ANSWER_COLUMNS = (
    "answered_survey",
    "survey_response",
    "name",
    "question_type__c",
    "question",
    "response__c",
    "response_english_text",
    "response_numeric__c",
    "createddate",
)


def consumer_duty_config(tables: Tables) -> dict[str, dict[str, object]]:
    """Publishing configuration of the consumer-duty reports; see ``jobs.publish``.

    The three survey reports share one join of the answers, written by the first of them that is asked for. A report
    that is asked for again, or over other tables, has it written anew.
    """
    shared: dict[str, object] = {}

    def given_answers(report, given: Tables) -> Tables:
        sources = [given[n] for n in ("survey_responses", "survey_takers", "surveys", "survey_questions")]
        if not shared or report in shared["served"] or any(a is not b for a, b in zip(sources, shared["sources"])):
            answers = survey_answers(given, SURVEYS.values()).select(*ANSWER_COLUMNS)
            shared.update(sources=sources, served=set(), answers=materialize(cast_null_columns(answers), "answers"))
        shared["served"].add(report)
        return {**given, "survey_answers": shared["answers"]}

    surveys = (onboarding_survey, general_enquiry_survey, recent_experience_survey)
    config = {}
    for name, (report, types) in CONSUMER_DUTY.items():
        columns = report(tables).columns
        config[name] = {
            "query": lambda spark, given, report=report: report(given_answers(report, given) if report in surveys else given),
            "catalog": {
                c: {"type": types.get(c, "string"), "comment": f"{c.replace('_', ' ').capitalize()}"} for c in columns
            },
        }
    return config
