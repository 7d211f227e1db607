"""Column helpers exercised over whole raw / staged extracts (one query each)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fx
from ..sources.adapter import AS_OF

# name -> (source, kind, () -> [(output column, expression)])  kind: raw | stg
FUNCTION_QUERIES = {
    "fn_clean_string": ("member", "raw", lambda: [
        ("memid", F.col("memid")), ("fname_clean", fx.clean_string("fname")),
        ("mname_clean", fx.clean_string("mname")), ("language_clean", fx.clean_string("language"))]),
    "fn_parse_date": ("member", "raw", lambda: [("memid", F.col("memid")), ("dob", F.col("dob")),
                                        ("dob_parsed", fx.parse_date("dob"))]),
    "fn_parse_datetime": ("member", "raw", lambda: [("memid", F.col("memid")), ("modifydate", F.col("modifydate")),
                                            ("modified_at", fx.parse_datetime("modifydate"))]),
    "fn_amount": ("clclaim", "raw", lambda: [("claimid", F.col("claimid")), ("deduct", fx.amount("deductamt")),
                                     ("cob", fx.amount("cobamt")), ("coins", fx.amount("coinsamt"))]),
    "fn_format_ids": ("clclaim", "raw", lambda: [("claimid", F.col("claimid")), ("claim_id", fx.format_claim_id("claimid")),
                                         ("member_id", fx.format_member_id("memid")),
                                         ("provider_id", fx.format_provider_id("provid"))]),
    "fn_claim_status": ("clclaim", "raw", lambda: [("claimid", F.col("claimid")), ("status_raw", F.col("claimstatus")),
                                           ("status_code", fx.normalize_code("claimstatus")),
                                           ("status_label", fx.claim_status("claimstatus"))]),
    "fn_gender": ("member", "raw", lambda: [("memid", F.col("memid")), ("gender", fx.gender("sex"))]),
    "fn_member_status": ("member", "raw", lambda: [("memid", F.col("memid")), ("member_status", fx.member_status("status"))]),
    "fn_line_of_business": ("mbrelig", "raw", lambda: [("eligid", F.col("eligid")), ("lob", fx.line_of_business("lobid"))]),
    "fn_age": ("stg_member", "stg", lambda: [("member_id", F.col("member_id")),
                                     ("age", fx.age_years("date_of_birth", AS_OF))]),
    "fn_member_months": ("stg_mbrelig", "stg", lambda: [
        ("eligibility_id", F.col("eligibility_id")),
        ("months", fx.member_months("effective_date", "termination_date")),
        ("months_to_as_of", fx.member_months("effective_date", fx.as_date(AS_OF)))]),
    "fn_valid_npi": ("provider", "raw", lambda: [("provid", F.col("provid")), ("npi", F.col("npi")),
                                         ("is_valid_npi", fx.is_valid_npi("npi"))]),
    "fn_phone": ("member", "raw", lambda: [("memid", F.col("memid")), ("digits", fx.standardize_phone("email"))]),
    "fn_zip": ("provider", "raw", lambda: [("provid", F.col("provid")), ("zip5", fx.standardize_zip("taxonomy"))]),
    "fn_surrogate_key": ("clline", "raw", lambda: [("claimid", F.col("claimid")), ("lineseq", F.col("lineseq")),
                                           ("line_key", fx.surrogate_key("claimid", "lineseq"))]),
    "fn_code_maps": ("cldiag", "raw", lambda: [
        ("claimid", F.col("claimid")), ("diagseq", F.col("diagseq")),
        ("diag_type", fx.diagnosis_type("diagtype")), ("proc_type", fx.procedure_type("diagtype")),
        ("poa", fx.poa_description("poa"))]),
    "fn_int_defaults": ("clclaim", "raw", lambda: [("claimid", F.col("claimid")), ("los", fx.int_default("los")),
                                           ("los_or_null", fx.int_or_null("los"))]),
    "fn_boundary_diffs": ("stg_clclaim", "stg", lambda: [
        ("claim_id", F.col("claim_id")),
        ("days", fx.days_between("service_from_date", "paid_date")),
        ("weeks", fx.weeks_between_boundaries("service_from_date", "paid_date")),
        ("months", fx.months_between_boundaries("service_from_date", "paid_date")),
        ("years", fx.years_between_boundaries("service_from_date", "paid_date"))]),
}


def run(wh, name: str):
    source, kind, cols = FUNCTION_QUERIES[name]
    df = wh.raw[source] if kind == "raw" else wh.stg(source)
    return df.select(*[expr.alias(alias) for alias, expr in cols()])
