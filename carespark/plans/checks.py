"""The declared data-quality suite over staged, core and mart models."""

from __future__ import annotations

from ..operators.quality import Check

W = "warn"


def _nn(model, *cols, severity="error"):
    return [Check(model, "not_null", c, severity) for c in cols]


def _uq(model, *cols):
    return [Check(model, "unique", c) for c in cols]


def _ge0(model, *cols):
    return [Check(model, "between", c, min_value=0) for c in cols]


# The rules declared for the models.
SUITE: list[Check] = [
    # --- staging: members
    *_nn("stg_member", "member_id"), *_uq("stg_member", "member_id"),
    Check("stg_member", "type", "date_of_birth", type_name="date"),
    Check("stg_member", "accepted_values", "gender_code", values=("M", "F", "U")),
    Check("stg_mbrelig", "pair_ge", "termination_date", W, column_b="effective_date",
          row_condition="effective_date is not null and termination_date is not null"),
    *_nn("stg_mbrelig", "member_id", "eligibility_id", "effective_date"),
    Check("stg_mbrelig", "relationships", "member_id", W, to_model="stg_member", to_field="member_id"),
    *_uq("stg_mbrelig", "eligibility_id"),
    # --- staging: claims
    Check("stg_clclaim", "pair_ge", "service_to_date", W, column_b="service_from_date",
          row_condition="service_from_date is not null and service_to_date is not null"),
    *_nn("stg_clclaim", "claim_id", "member_id", "claim_status_code"), *_uq("stg_clclaim", "claim_id"),
    Check("stg_clclaim", "relationships", "member_id", W, to_model="stg_member", to_field="member_id"),
    Check("stg_clclaim", "relationships", "billing_provider_id", W, to_model="stg_provider", to_field="provider_id"),
    Check("stg_clclaim", "accepted_values", "claim_type_code", values=("I", "P", "D", "R")),
    *[Check("stg_clclaim", "between", c, min_value=0, max_value=10000000)
      for c in ("billed_amount", "allowed_amount", "paid_amount")],
    Check("stg_clline", "pair_ge", "service_to_date", W, column_b="service_from_date",
          row_condition="service_from_date is not null and service_to_date is not null"),
    *_nn("stg_clline", "claim_line_id", "claim_id", "line_number"), *_uq("stg_clline", "claim_line_id"),
    Check("stg_clline", "relationships", "claim_id", to_model="stg_clclaim", to_field="claim_id"),
    *[Check("stg_clline", "between", c, min_value=0, max_value=10000000) for c in ("billed_amount", "paid_amount")],
    *_nn("stg_cldiag", "claim_diagnosis_id", "claim_id", "diagnosis_sequence", "diagnosis_code"),
    *_uq("stg_cldiag", "claim_diagnosis_id"),
    Check("stg_cldiag", "relationships", "claim_id", W, to_model="stg_clclaim", to_field="claim_id"),
    Check("stg_cldiag", "accepted_values", "diagnosis_code_type", W, values=("ICD9", "ICD10", "9", "10")),
    *_nn("stg_clproc", "claim_procedure_id", "claim_id", "procedure_sequence", "procedure_code"),
    *_uq("stg_clproc", "claim_procedure_id"),
    Check("stg_clproc", "relationships", "claim_id", W, to_model="stg_clclaim", to_field="claim_id"),
    *_nn("stg_cladjust", "claim_adjustment_id", "claim_id", "adjustment_sequence"),
    *_uq("stg_cladjust", "claim_adjustment_id"),
    Check("stg_cladjust", "relationships", "claim_id", W, to_model="stg_clclaim", to_field="claim_id"),
    # --- staging: providers, reference, identity
    *_nn("stg_provider", "provider_id"), *_uq("stg_provider", "provider_id"),
    Check("stg_provider", "accepted_values", "entity_type_code", values=("I", "O")),
    *_nn("stg_diagcode", "diagnosis_code"), *_uq("stg_diagcode", "diagnosis_code"),
    Check("stg_diagcode", "accepted_values", "diagnosis_code_type", values=("ICD9", "ICD10")),
    *_nn("stg_golden_member", "golden_member_id"), *_uq("stg_golden_member", "golden_member_id"),
    *_nn("stg_golden_provider", "golden_provider_id"), *_uq("stg_golden_provider", "golden_provider_id"),
    *_nn("stg_member_crosswalk", "crosswalk_id", "golden_member_id", "source_system", "source_member_id"),
    *_uq("stg_member_crosswalk", "crosswalk_id"),
    *_nn("stg_provider_crosswalk", "crosswalk_id", "golden_provider_id", "source_system", "source_provider_id"),
    *_uq("stg_provider_crosswalk", "crosswalk_id"),
    # Declared in prose only upstream; added here: crosswalk -> golden record.
    Check("stg_member_crosswalk", "relationships", "golden_member_id", W, to_model="stg_golden_member",
          to_field="golden_member_id"),
    Check("stg_provider_crosswalk", "relationships", "golden_provider_id", W, to_model="stg_golden_provider",
          to_field="golden_provider_id"),
    # --- core
    *_nn("dim_date", "date_key", "date_day"), *_uq("dim_date", "date_key"),
    *_nn("dim_member", "member_key", "member_id", "is_currently_eligible"), *_uq("dim_member", "member_key", "member_id"),
    Check("dim_member", "between", "current_age", min_value=0, max_value=120),
    *_nn("dim_provider", "provider_key", "provider_id", "is_active"), *_uq("dim_provider", "provider_key", "provider_id"),
    *_nn("dim_diagnosis", "diagnosis_key", "diagnosis_code"), *_uq("dim_diagnosis", "diagnosis_key"),
    *_nn("fct_claim", "claim_key", "claim_id", "member_id", "claim_status", "billed_amount", "paid_amount"),
    *_uq("fct_claim", "claim_key", "claim_id"),
    Check("fct_claim", "relationships", "member_id", to_model="dim_member", to_field="member_id"),
    *_ge0("fct_claim", "billed_amount"),
    Check("fct_claim", "between", "days_to_process", min_value=0, max_value=365,
          row_condition="days_to_process is not null"),
    # --- marts
    *_nn("mart_claims_summary", "summary_key", "service_month", "year_month", "claim_count", "total_paid"),
    *_uq("mart_claims_summary", "summary_key"),
    *_ge0("mart_claims_summary", "claim_count", "unique_members", "total_paid"),
    Check("mart_claims_summary", "between", "approval_rate", min_value=0, max_value=100),
    *_nn("mart_member_months", "member_month_key", "calendar_month", "year_month", "member_months",
         "enrolled_members"),
    *_uq("mart_member_months", "member_month_key"),
    *_ge0("mart_member_months", "member_months", "enrolled_members", "subscriber_count", "dependent_count"),
    # --- raw tables
    *_nn("raw_member", "memid"), *_nn("raw_mbrelig", "memid", "eligid"),
    *_nn("raw_clclaim", "claimid"), *_uq("raw_clclaim", "claimid"),
    *_nn("raw_clline", "claimid", "lineseq"),
    *_nn("raw_provider", "provid"), *_uq("raw_provider", "provid"),
    *_nn("raw_diagcode", "diagcode"), *_nn("raw_proccode", "proccode"),
    *_nn("raw_golden_member", "golden_member_id"), *_uq("raw_golden_member", "golden_member_id"),
    *_nn("raw_golden_provider", "golden_provider_id"), *_uq("raw_golden_provider", "golden_provider_id"),
    *_nn("raw_member_crosswalk", "crosswalk_id", "golden_member_id", "source_system", "source_member_id"),
    *_uq("raw_member_crosswalk", "crosswalk_id"),
    *_nn("raw_provider_crosswalk", "crosswalk_id", "golden_provider_id", "source_system", "source_provider_id"),
    *_uq("raw_provider_crosswalk", "crosswalk_id"),
]
DECLARED = len(SUITE) - 2  # all but the two crosswalk rules above

# Rules of our own: keys of several columns, and the models that have no declared rule.
SUITE += [
    # Surrogate keys hash raw ids, so spelling variants of one claim could repeat a line, diagnosis or procedure.
    Check("stg_clline", "unique", "claim_id+line_number", W), Check("stg_cldiag", "unique", "claim_id+diagnosis_sequence", W),
    Check("stg_clproc", "unique", "claim_id+procedure_sequence", W),
    # The key leaves plan_name out, which is a group key.
    Check("mart_member_months", "unique", "calendar_month+line_of_business+plan_id+group_id+coverage_type", W),
    # Several active links of one source id fan facts out.
    Check("stg_member_crosswalk", "unique", "source_system+source_member_id", W, row_condition="is_active"),
    Check("stg_provider_crosswalk", "unique", "source_system+source_provider_id", W, row_condition="is_active"),
    *_nn("dim_golden_member", "golden_member_key", "golden_member_id"),
    Check("dim_golden_member", "unique", "golden_member_key", W),
    *_nn("dim_golden_provider", "golden_provider_key", "golden_provider_id"),
    Check("dim_golden_provider", "unique", "golden_provider_key", W),
    *_nn("fct_claim_conformed", "claim_key", "claim_id", "claim_status"),
    Check("fct_claim_conformed", "relationships", "member_golden_id", W, to_model="dim_golden_member", to_field="golden_member_id"),
    Check("fct_claim_conformed", "relationships", "billing_provider_golden_id", W, to_model="dim_golden_provider", to_field="golden_provider_id"),
    *_ge0("fct_claim_conformed", "billed_amount"),
    *_nn("mart_medical_expense", "expense_key", "report_month"), *_uq("mart_medical_expense", "expense_key"),
    *_ge0("mart_medical_expense", "claim_count", "total_paid", "member_months"),
]

SUITE_MODELS = sorted({c.model for c in SUITE} | {c.to_model for c in SUITE if c.to_model})

# One query per rule kind, on rules that some rows break.
EXAMPLES = {
    "dq_not_null": Check("stg_member", "not_null", "date_of_birth"),
    "dq_unique": Check("stg_mbrelig", "unique", "member_id"),
    "dq_accepted_values": Check("stg_clclaim", "accepted_values", "claim_type_code", values=("I", "P", "D", "R")),
    "dq_relationships": Check("stg_clclaim", "relationships", "servicing_provider_id", W, to_model="stg_provider", to_field="provider_id"),
    "dq_between": Check("fct_claim", "between", "days_to_process", min_value=0, max_value=10, row_condition="days_to_process is not null"),
    "dq_pair_order": Check("stg_clclaim", "pair_ge", "received_date", column_b="service_to_date", or_equal=False),
}
TYPE_CHECK = Check("stg_member", "type", "date_of_birth", type_name="date")

# Every raw extract and the source group whose freshness objective it falls under.
SOURCE_GROUPS = {t: "extracts" for t in ("member", "mbrelig", "provider", "clclaim", "clline", "cldiag", "clproc", "cladjust", "diagcode")} | {
    t: "identity" for t in ("golden_member", "golden_provider", "member_crosswalk", "provider_crosswalk")}
FRESHNESS_AS_OF = "2001-06-30 00:00:00"
ROW_COUNT_TABLES = tuple(t for t, g in SOURCE_GROUPS.items() if g == "extracts")
