"""Bronze layer: one projection per raw extract (scan -> typed, renamed columns).

Each function is a pure ``DataFrame -> DataFrame`` projection; Catalyst
pushes any later filter and column pruning straight into the parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx


def stg_member(src: DataFrame) -> DataFrame:
    return src.select(
        fx.format_member_id("memid").alias("member_id"),
        fx.clean_string("fname").alias("first_name"),
        fx.clean_string("mname").alias("middle_name"),
        fx.clean_string("lname").alias("last_name"),
        fx.parse_date("dob").alias("date_of_birth"),
        fx.normalize_code("sex").alias("gender_code"),
        fx.gender("sex").alias("gender"),
        fx.clean_string("ssn").alias("ssn"),
        fx.clean_string("medid").alias("medicaid_id"),
        fx.clean_string("mcrid").alias("medicare_id"),
        fx.clean_string("altid").alias("alternate_id"),
        fx.clean_string("email").alias("email"),
        fx.clean_string("language").alias("preferred_language"),
        fx.normalize_code("status").alias("status_code"),
        fx.member_status("status").alias("member_status"),
        fx.parse_datetime("createdate").alias("created_at"),
        fx.parse_datetime("modifydate").alias("updated_at"),
        F.col("_loaded_at"),
    )


def stg_mbrelig(src: DataFrame) -> DataFrame:
    return src.select(
        fx.format_member_id("memid").alias("member_id"),
        fx.clean_string("eligid").alias("eligibility_id"),
        fx.parse_date("effdate").alias("effective_date"),
        fx.parse_date("termdate").alias("termination_date"),
        fx.clean_string("lobid").alias("lob_id"),
        fx.line_of_business("lobid").alias("line_of_business"),
        fx.clean_string("planid").alias("plan_id"),
        fx.clean_string("planname").alias("plan_name"),
        fx.clean_string("productid").alias("product_id"),
        fx.clean_string("groupid").alias("group_id"),
        fx.clean_string("subgroupid").alias("subgroup_id"),
        fx.clean_string("covtype").alias("coverage_type"),
        fx.clean_string("relation").alias("relationship_code"),
        fx.clean_string("subscriberid").alias("subscriber_id"),
        fx.format_provider_id("pcpid").alias("pcp_provider_id"),
        fx.parse_date("pcpassigndate").alias("pcp_assignment_date"),
        fx.normalize_code("eligstatus").alias("eligibility_status_code"),
        fx.parse_datetime("createdate").alias("created_at"),
        fx.parse_datetime("modifydate").alias("updated_at"),
        F.col("_loaded_at"),
    )


AMOUNT_COLUMNS = [
    ("billedamt", "billed_amount"),
    ("allowedamt", "allowed_amount"),
    ("paidamt", "paid_amount"),
    ("copayamt", "copay_amount"),
    ("coinsamt", "coinsurance_amount"),
    ("deductamt", "deductible_amount"),
    ("cobamt", "cob_amount"),
    ("withholdamt", "withhold_amount"),
]


def stg_clclaim(src: DataFrame) -> DataFrame:
    return src.select(
        fx.format_claim_id("claimid").alias("claim_id"),
        fx.format_member_id("memid").alias("member_id"),
        fx.format_provider_id("provid").alias("billing_provider_id"),
        fx.format_provider_id("servprovid").alias("servicing_provider_id"),
        fx.format_provider_id("refprovid").alias("referring_provider_id"),
        fx.clean_string("facilityid").alias("facility_id"),
        fx.normalize_code("claimtype").alias("claim_type_code"),
        fx.claim_type("claimtype").alias("claim_type"),
        fx.clean_string("formtype").alias("form_type"),
        fx.clean_string("billtype").alias("bill_type"),
        fx.parse_date("svcfromdate").alias("service_from_date"),
        fx.parse_date("svctodate").alias("service_to_date"),
        fx.parse_date("admitdate").alias("admit_date"),
        fx.parse_date("dischargedate").alias("discharge_date"),
        fx.parse_date("recvddate").alias("received_date"),
        fx.parse_date("processdate").alias("processed_date"),
        fx.parse_date("paiddate").alias("paid_date"),
        fx.parse_date("adjuddate").alias("adjudicated_date"),
        fx.normalize_code("claimstatus").alias("claim_status_code"),
        fx.claim_status("claimstatus").alias("claim_status"),
        *[fx.amount(raw).alias(name) for raw, name in AMOUNT_COLUMNS],
        fx.clean_string("drg").alias("drg_code"),
        fx.clean_string("admittype").alias("admit_type"),
        fx.clean_string("admitsource").alias("admit_source"),
        fx.clean_string("dischargestatus").alias("discharge_status"),
        fx.int_default("los").alias("length_of_stay"),
        fx.clean_string("authid").alias("authorization_id"),
        fx.clean_string("refnum").alias("reference_number"),
        fx.clean_string("icn").alias("internal_control_number"),
        fx.clean_string("dcn").alias("document_control_number"),
        fx.parse_datetime("createdate").alias("created_at"),
        fx.parse_datetime("modifydate").alias("updated_at"),
        F.col("_loaded_at"),
    )


def stg_clline(src: DataFrame) -> DataFrame:
    return src.select(
        fx.format_claim_id("claimid").alias("claim_id"),
        fx.int_or_null("lineseq").alias("line_number"),
        # Keys hash the *raw* claim id on purpose: existing keys were built so.
        fx.surrogate_key("claimid", "lineseq").alias("claim_line_id"),
        fx.clean_string("proccode").alias("procedure_code"),
        fx.clean_string("modifier1").alias("modifier_1"),
        fx.clean_string("modifier2").alias("modifier_2"),
        fx.clean_string("modifier3").alias("modifier_3"),
        fx.clean_string("modifier4").alias("modifier_4"),
        fx.clean_string("revcode").alias("revenue_code"),
        fx.clean_string("ndc").alias("ndc_code"),
        fx.parse_date("svcfromdate").alias("service_from_date"),
        fx.parse_date("svctodate").alias("service_to_date"),
        fx.clean_string("pos").alias("place_of_service_code"),
        fx.amount("svcunits").alias("service_units"),
        *[fx.amount(raw).alias(name) for raw, name in AMOUNT_COLUMNS],
        fx.normalize_code("linestatus").alias("line_status_code"),
        fx.claim_status("linestatus").alias("line_status"),
        fx.clean_string("diagptr1").alias("diagnosis_pointer_1"),
        fx.clean_string("diagptr2").alias("diagnosis_pointer_2"),
        fx.clean_string("diagptr3").alias("diagnosis_pointer_3"),
        fx.clean_string("diagptr4").alias("diagnosis_pointer_4"),
        fx.format_provider_id("servprovid").alias("servicing_provider_id"),
        fx.parse_datetime("createdate").alias("created_at"),
        fx.parse_datetime("modifydate").alias("updated_at"),
        F.col("_loaded_at"),
    )


def _primary_flag(seq: str):
    # The flag casts the raw sequence without the blank guard, as the source did.
    return F.coalesce(F.col(seq).cast("int"), F.lit(0)) == 1


def stg_cldiag(src: DataFrame) -> DataFrame:
    return src.select(
        fx.surrogate_key("claimid", "diagseq").alias("claim_diagnosis_id"),
        fx.format_claim_id("claimid").alias("claim_id"),
        fx.int_default("diagseq").alias("diagnosis_sequence"),
        _primary_flag("diagseq").alias("is_primary_diagnosis"),
        fx.clean_string("diagcode").alias("diagnosis_code"),
        fx.normalize_code("diagtype").alias("diagnosis_code_type"),
        fx.diagnosis_type("diagtype").alias("diagnosis_code_type_description"),
        fx.clean_string("poa").alias("poa_indicator"),
        fx.poa_description("poa").alias("poa_description"),
        F.col("_loaded_at"),
    )


def stg_clproc(src: DataFrame) -> DataFrame:
    return src.select(
        fx.surrogate_key("claimid", "procseq").alias("claim_procedure_id"),
        fx.format_claim_id("claimid").alias("claim_id"),
        fx.int_default("procseq").alias("procedure_sequence"),
        _primary_flag("procseq").alias("is_principal_procedure"),
        fx.clean_string("proccode").alias("procedure_code"),
        fx.normalize_code("proctype").alias("procedure_code_type"),
        fx.procedure_type("proctype").alias("procedure_code_type_description"),
        fx.parse_date("procdate").alias("procedure_date"),
        F.col("_loaded_at"),
    )


def stg_cladjust(src: DataFrame) -> DataFrame:
    return src.select(
        fx.surrogate_key("claimid", "adjustseq").alias("claim_adjustment_id"),
        fx.format_claim_id("claimid").alias("claim_id"),
        fx.int_default("adjustseq").alias("adjustment_sequence"),
        fx.clean_string("adjustcode").alias("adjustment_reason_code"),
        fx.clean_string("adjustdesc").alias("adjustment_reason_description"),
        fx.clean_string("adjustgroup").alias("adjustment_group_code"),
        fx.amount("adjustamt").alias("adjustment_amount"),
        fx.parse_date("adjustdate").alias("adjustment_date"),
        F.col("_loaded_at"),
    )


def stg_provider(src: DataFrame) -> DataFrame:
    return src.select(
        fx.format_provider_id("provid").alias("provider_id"),
        fx.clean_string("npi").alias("npi"),
        fx.clean_string("taxid").alias("tax_id"),
        fx.clean_string("license").alias("license_number"),
        fx.clean_string("dea").alias("dea_number"),
        fx.clean_string("upin").alias("upin"),
        fx.clean_string("provname").alias("provider_name"),
        fx.clean_string("provlname").alias("provider_last_name"),
        fx.clean_string("provfname").alias("provider_first_name"),
        fx.clean_string("provmname").alias("provider_middle_name"),
        fx.clean_string("suffix").alias("suffix"),
        fx.clean_string("credential").alias("credential"),
        fx.clean_string("provtype").alias("provider_type_code"),
        fx.clean_string("provtypedesc").alias("provider_type"),
        fx.clean_string("entitytype").alias("entity_type_code"),
        fx.entity_type("entitytype").alias("entity_type"),
        fx.clean_string("taxonomy").alias("taxonomy_code"),
        fx.normalize_code("provstatus").alias("provider_status_code"),
        fx.provider_status("provstatus").alias("provider_status"),
        fx.parse_date("effdate").alias("effective_date"),
        fx.parse_date("termdate").alias("termination_date"),
        fx.is_valid_npi("npi").alias("is_valid_npi"),
        fx.parse_datetime("createdate").alias("created_at"),
        fx.parse_datetime("modifydate").alias("updated_at"),
        F.col("_loaded_at"),
    )


def stg_diagcode(src: DataFrame) -> DataFrame:
    return src.select(
        fx.clean_string("diagcode").alias("diagnosis_code"),
        fx.clean_string("diagdesc").alias("diagnosis_description"),
        fx.clean_string("diagshortdesc").alias("diagnosis_short_description"),
        fx.normalize_code("diagtype").alias("diagnosis_code_type"),
        fx.diagnosis_code_system("diagtype").alias("diagnosis_code_system"),
        fx.clean_string("category").alias("category_code"),
        fx.clean_string("categorydesc").alias("category_description"),
        fx.clean_string("chapter").alias("chapter_code"),
        fx.clean_string("chapterdesc").alias("chapter_description"),
        fx.parse_date("effdate").alias("effective_date"),
        fx.parse_date("termdate").alias("termination_date"),
        fx.yes_flag("billable").alias("is_billable"),
        fx.yes_flag("header").alias("is_header"),
        F.col("_loaded_at"),
    )


def stg_golden_member(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("golden_member_id"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.col("date_of_birth"),
        fx.normalize_code("gender").alias("gender_code"),
        fx.gender("gender").alias("gender"),
        F.col("ssn"),
        F.col("match_confidence"),
        F.col("merge_history"),
        F.col("is_active"),
        F.col("created_at"),
        F.col("updated_at"),
        F.col("_loaded_at"),
    )


def stg_golden_provider(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("golden_provider_id"),
        F.trim("provider_name").alias("provider_name"),
        F.trim("npi").alias("npi"),
        F.trim("tax_id").alias("tax_id"),
        fx.normalize_code("provider_type").alias("provider_type_code"),
        F.trim("primary_specialty").alias("primary_specialty_code"),
        F.col("match_confidence"),
        F.col("is_active"),
        F.col("created_at"),
        F.col("updated_at"),
        F.col("_loaded_at"),
    )


def _crosswalk(src: DataFrame, golden: str, source_id: str, as_of: dt.date) -> DataFrame:
    term = F.col("termination_date")
    return src.select(
        F.col("crosswalk_id"),
        F.col(golden),
        fx.normalize_code("source_system").alias("source_system"),
        # Source ids are trimmed but deliberately not upper-cased.
        F.trim(source_id).alias(source_id),
        F.col("match_confidence"),
        F.trim("match_rule").alias("match_rule"),
        F.coalesce(F.col("is_primary"), F.lit(False)).alias("is_primary"),
        F.col("effective_date"),
        term,
        (term.isNull() | (term >= fx.as_date(as_of))).alias("is_active"),
        F.col("created_at"),
        F.col("_loaded_at"),
    )


def stg_member_crosswalk(src: DataFrame, as_of: dt.date) -> DataFrame:
    return _crosswalk(src, "golden_member_id", "source_member_id", as_of)


def stg_provider_crosswalk(src: DataFrame, as_of: dt.date) -> DataFrame:
    return _crosswalk(src, "golden_provider_id", "source_provider_id", as_of)


STAGING = {
    "stg_member": ("member", stg_member),
    "stg_mbrelig": ("mbrelig", stg_mbrelig),
    "stg_clclaim": ("clclaim", stg_clclaim),
    "stg_clline": ("clline", stg_clline),
    "stg_cldiag": ("cldiag", stg_cldiag),
    "stg_clproc": ("clproc", stg_clproc),
    "stg_cladjust": ("cladjust", stg_cladjust),
    "stg_provider": ("provider", stg_provider),
    "stg_diagcode": ("diagcode", stg_diagcode),
    "stg_golden_member": ("golden_member", stg_golden_member),
    "stg_golden_provider": ("golden_provider", stg_golden_provider),
    "stg_member_crosswalk": ("member_crosswalk", stg_member_crosswalk),
    "stg_provider_crosswalk": ("provider_crosswalk", stg_provider_crosswalk),
}
AS_OF_MODELS = {"stg_member_crosswalk", "stg_provider_crosswalk"}


def stage(name: str, raw: DataFrame, as_of: dt.date) -> DataFrame:
    table, fn = STAGING[name]
    return fn(raw, as_of) if name in AS_OF_MODELS else fn(raw)
