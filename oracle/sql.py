"""Independent DuckDB SQL for every compared query.

Each model is a SQL body plus the names of the CTEs it reads.  ``query(name)``
assembles a single ``WITH`` statement: the raw extracts (derived from the
driver tables by the shared adapter rules), then every model the target needs,
in dependency order.
"""

from __future__ import annotations

import re

from carespark.sources.adapter import AS_OF, DUCKDB, RAW_TABLES, raw_sql

AS_OF_SQL = f"date '{AS_OF.isoformat()}'"
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

MODELS: dict[str, str] = {}


def model(name: str, sql: str) -> None:
    MODELS[name] = sql


# ----------------------------------------------------------------- helpers
def clean(c):
    return f"nullif(trim(cast({c} as varchar)), '')"


def code(c):
    return f"upper(trim(cast({c} as varchar)))"


def pdate(c):
    t = f"trim(cast({c} as varchar))"
    return (
        f"(case when {c} is null then null when {t} = '' then null when {t} = '0' then null "
        f"when length({t}) = 8 then cast(try_strptime({t}, '%Y%m%d') as date) "
        f"else cast(coalesce(try_strptime({t}, '%Y-%m-%d'), try_strptime({t}, '%d-%b-%Y'), "
        f"try_strptime({t}, '%m/%d/%Y')) as date) end)"
    )


def pts(c):
    t = f"trim(cast({c} as varchar))"
    return f"(case when {c} is null then null when {t} = '' then null else try_cast({t} as timestamp) end)"


def amt(c, default="0"):
    return (
        f"coalesce(case when {c} is null then null when cast({c} as varchar) = '' then null "
        f"else cast({c} as decimal(18,2)) end, cast({default} as decimal(18,2)))"
    )


def int_or_null(c):
    return f"(case when {c} is null or cast({c} as varchar) = '' then null else cast({c} as integer) end)"


def int_default(c):
    return f"coalesce({int_or_null(c)}, 0)"


def skey(*cols):
    parts = ", ".join(f"coalesce(cast({c} as varchar), '{NULL_TOKEN}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def case_map(key, mapping, default="null"):
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"(case {key} {whens} else {default} end)"


CLAIM_STATUS = dict(A="Approved", D="Denied", P="Pending", V="Void", S="Suspended", I="In Process", R="Rejected")
GENDER = dict(M="Male", F="Female", U="Unknown")
MEMBER_STATUS = dict(A="Active", T="Terminated", P="Pending", C="Cancelled")
LOB = dict(COM="Commercial", MCD="Medicaid", MCR="Medicare", MKT="Marketplace", SNP="Special Needs Plan")
CLAIM_TYPE = dict(I="Institutional", P="Professional", D="Dental", R="Pharmacy")
DIAG_TYPE = {"ICD9": "ICD-9-CM", "ICD10": "ICD-10-CM", "9": "ICD-9-CM", "10": "ICD-10-CM"}
PROC_TYPE = {"ICD9": "ICD-9-PCS", "ICD10": "ICD-10-PCS", "9": "ICD-9-PCS", "10": "ICD-10-PCS"}
POA = {"Y": "Yes - Present on Admission", "N": "No - Not Present on Admission", "U": "Unknown",
       "W": "Clinically Undetermined", "1": "Unreported/Not Used"}
ENTITY = dict(I="Individual", O="Organization")
PROV_STATUS = dict(A="Active", T="Terminated", P="Pending", S="Suspended")


def age(dob):
    return f"cast(floor(datediff('day', {dob}, {AS_OF_SQL}) / 365.25) as integer)"


def month_idx(d):
    return f"(year({d}) * 12 + month({d}))"


def member_months(s, e):
    return f"(case when {s} is null or {e} is null then 0 else greatest({month_idx(e)} - {month_idx(s)} + 1, 0) end)"


def ratio(num, den, digits):
    """round(num/den, digits) half away from zero from exact integers; NULL when den = 0."""
    scale = 10**digits
    n = f"abs(cast({num} as hugeint))"
    d = f"abs(cast({den} as hugeint))"
    return (
        f"(case when {den} is null or {den} = 0 then null else "
        f"cast((({n} * {2 * scale} + {d}) // ({d} * 2)) * sign({num}) * sign({den}) as bigint) / {scale} end)"
    )


def gratio(num, den, digits):
    return f"(case when {den} > 0 then {ratio(num, den, digits)} else 0.0 end)"


def cents(x):
    return f"cast({x} * 100 as bigint)"


# ----------------------------------------------------------------- staging
model("stg_member", f"""
select {code('memid')} as member_id, {clean('fname')} as first_name, {clean('mname')} as middle_name,
  {clean('lname')} as last_name, {pdate('dob')} as date_of_birth, {code('sex')} as gender_code,
  {case_map(code('sex'), GENDER, "'Unknown'")} as gender, {clean('ssn')} as ssn, {clean('medid')} as medicaid_id,
  {clean('mcrid')} as medicare_id, {clean('altid')} as alternate_id, {clean('email')} as email,
  {clean('language')} as preferred_language, {code('status')} as status_code,
  {case_map(code('status'), MEMBER_STATUS, "'Unknown'")} as member_status,
  {pts('createdate')} as created_at, {pts('modifydate')} as updated_at, _loaded_at
from raw_member""")

model("stg_mbrelig", f"""
select {code('memid')} as member_id, {clean('eligid')} as eligibility_id, {pdate('effdate')} as effective_date,
  {pdate('termdate')} as termination_date, {clean('lobid')} as lob_id,
  {case_map(code('lobid'), LOB, 'lobid')} as line_of_business, {clean('planid')} as plan_id,
  {clean('planname')} as plan_name, {clean('productid')} as product_id, {clean('groupid')} as group_id,
  {clean('subgroupid')} as subgroup_id, {clean('covtype')} as coverage_type, {clean('relation')} as relationship_code,
  {clean('subscriberid')} as subscriber_id, {code('pcpid')} as pcp_provider_id,
  {pdate('pcpassigndate')} as pcp_assignment_date, {code('eligstatus')} as eligibility_status_code,
  {pts('createdate')} as created_at, {pts('modifydate')} as updated_at, _loaded_at
from raw_mbrelig""")

AMOUNTS = [("billedamt", "billed_amount"), ("allowedamt", "allowed_amount"), ("paidamt", "paid_amount"),
           ("copayamt", "copay_amount"), ("coinsamt", "coinsurance_amount"), ("deductamt", "deductible_amount"),
           ("cobamt", "cob_amount"), ("withholdamt", "withhold_amount")]
AMOUNT_SQL = ", ".join(f"{amt(r)} as {n}" for r, n in AMOUNTS)

model("stg_clclaim", f"""
select {code('claimid')} as claim_id, {code('memid')} as member_id, {code('provid')} as billing_provider_id,
  {code('servprovid')} as servicing_provider_id, {code('refprovid')} as referring_provider_id,
  {clean('facilityid')} as facility_id, {code('claimtype')} as claim_type_code,
  {case_map(code('claimtype'), CLAIM_TYPE, "'Unknown'")} as claim_type, {clean('formtype')} as form_type,
  {clean('billtype')} as bill_type, {pdate('svcfromdate')} as service_from_date, {pdate('svctodate')} as service_to_date,
  {pdate('admitdate')} as admit_date, {pdate('dischargedate')} as discharge_date, {pdate('recvddate')} as received_date,
  {pdate('processdate')} as processed_date, {pdate('paiddate')} as paid_date, {pdate('adjuddate')} as adjudicated_date,
  {code('claimstatus')} as claim_status_code, {case_map('claimstatus', CLAIM_STATUS, "'Unknown'")} as claim_status,
  {AMOUNT_SQL}, {clean('drg')} as drg_code, {clean('admittype')} as admit_type, {clean('admitsource')} as admit_source,
  {clean('dischargestatus')} as discharge_status, {int_default('los')} as length_of_stay,
  {clean('authid')} as authorization_id, {clean('refnum')} as reference_number,
  {clean('icn')} as internal_control_number, {clean('dcn')} as document_control_number,
  {pts('createdate')} as created_at, {pts('modifydate')} as updated_at, _loaded_at
from raw_clclaim""")

model("stg_clline", f"""
select {code('claimid')} as claim_id, {int_or_null('lineseq')} as line_number, {skey('claimid', 'lineseq')} as claim_line_id,
  {clean('proccode')} as procedure_code, {clean('modifier1')} as modifier_1, {clean('modifier2')} as modifier_2,
  {clean('modifier3')} as modifier_3, {clean('modifier4')} as modifier_4, {clean('revcode')} as revenue_code,
  {clean('ndc')} as ndc_code, {pdate('svcfromdate')} as service_from_date, {pdate('svctodate')} as service_to_date,
  {clean('pos')} as place_of_service_code, {amt('svcunits')} as service_units, {AMOUNT_SQL},
  {code('linestatus')} as line_status_code, {case_map('linestatus', CLAIM_STATUS, "'Unknown'")} as line_status,
  {clean('diagptr1')} as diagnosis_pointer_1, {clean('diagptr2')} as diagnosis_pointer_2,
  {clean('diagptr3')} as diagnosis_pointer_3, {clean('diagptr4')} as diagnosis_pointer_4,
  {code('servprovid')} as servicing_provider_id, {pts('createdate')} as created_at, {pts('modifydate')} as updated_at,
  _loaded_at
from raw_clline""")

model("stg_cldiag", f"""
select {skey('claimid', 'diagseq')} as claim_diagnosis_id, {code('claimid')} as claim_id,
  {int_default('diagseq')} as diagnosis_sequence,
  (case when coalesce(cast(diagseq as integer), 0) = 1 then true else false end) as is_primary_diagnosis,
  {clean('diagcode')} as diagnosis_code, {code('diagtype')} as diagnosis_code_type,
  {case_map(code('diagtype'), DIAG_TYPE, "'Unknown'")} as diagnosis_code_type_description,
  {clean('poa')} as poa_indicator, {case_map(code('poa'), POA)} as poa_description, _loaded_at
from raw_cldiag""")

model("stg_clproc", f"""
select {skey('claimid', 'procseq')} as claim_procedure_id, {code('claimid')} as claim_id,
  {int_default('procseq')} as procedure_sequence,
  (case when coalesce(cast(procseq as integer), 0) = 1 then true else false end) as is_principal_procedure,
  {clean('proccode')} as procedure_code, {code('proctype')} as procedure_code_type,
  {case_map(code('proctype'), PROC_TYPE, "'Unknown'")} as procedure_code_type_description,
  {pdate('procdate')} as procedure_date, _loaded_at
from raw_clproc""")

model("stg_cladjust", f"""
select {skey('claimid', 'adjustseq')} as claim_adjustment_id, {code('claimid')} as claim_id,
  {int_default('adjustseq')} as adjustment_sequence, {clean('adjustcode')} as adjustment_reason_code,
  {clean('adjustdesc')} as adjustment_reason_description, {clean('adjustgroup')} as adjustment_group_code,
  {amt('adjustamt')} as adjustment_amount, {pdate('adjustdate')} as adjustment_date, _loaded_at
from raw_cladjust""")

model("stg_provider", f"""
select {code('provid')} as provider_id, {clean('npi')} as npi, {clean('taxid')} as tax_id,
  {clean('license')} as license_number, {clean('dea')} as dea_number, {clean('upin')} as upin,
  {clean('provname')} as provider_name, {clean('provlname')} as provider_last_name,
  {clean('provfname')} as provider_first_name, {clean('provmname')} as provider_middle_name,
  {clean('suffix')} as suffix, {clean('credential')} as credential, {clean('provtype')} as provider_type_code,
  {clean('provtypedesc')} as provider_type, {clean('entitytype')} as entity_type_code,
  {case_map(code('entitytype'), ENTITY, "'Unknown'")} as entity_type, {clean('taxonomy')} as taxonomy_code,
  {code('provstatus')} as provider_status_code,
  {case_map(code('provstatus'), PROV_STATUS, "'Unknown'")} as provider_status,
  {pdate('effdate')} as effective_date, {pdate('termdate')} as termination_date,
  (length(trim(npi)) = 10 and regexp_full_match(trim(npi), '[0-9]+')) as is_valid_npi,
  {pts('createdate')} as created_at, {pts('modifydate')} as updated_at, _loaded_at
from raw_provider""")

model("stg_diagcode", f"""
select {clean('diagcode')} as diagnosis_code, {clean('diagdesc')} as diagnosis_description,
  {clean('diagshortdesc')} as diagnosis_short_description, {code('diagtype')} as diagnosis_code_type,
  (case {code('diagtype')} when 'ICD9' then 'ICD-9-CM' when 'ICD10' then 'ICD-10-CM' else {code('diagtype')} end)
    as diagnosis_code_system,
  {clean('category')} as category_code, {clean('categorydesc')} as category_description,
  {clean('chapter')} as chapter_code, {clean('chapterdesc')} as chapter_description,
  {pdate('effdate')} as effective_date, {pdate('termdate')} as termination_date,
  coalesce({code('billable')} = 'Y', false) as is_billable, coalesce({code('header')} = 'Y', false) as is_header,
  _loaded_at
from raw_diagcode""")

model("stg_golden_member", f"""
select golden_member_id, trim(first_name) as first_name, trim(last_name) as last_name, date_of_birth,
  {code('gender')} as gender_code, {case_map(code('gender'), GENDER, "'Unknown'")} as gender, ssn,
  match_confidence, merge_history, is_active, created_at, updated_at, _loaded_at
from raw_golden_member""")

model("stg_golden_provider", """
select golden_provider_id, trim(provider_name) as provider_name, trim(npi) as npi, trim(tax_id) as tax_id,
  upper(trim(provider_type)) as provider_type_code, trim(primary_specialty) as primary_specialty_code,
  match_confidence, is_active, created_at, updated_at, _loaded_at
from raw_golden_provider""")

for _kind in ("member", "provider"):
    model(f"stg_{_kind}_crosswalk", f"""
select crosswalk_id, golden_{_kind}_id, upper(trim(source_system)) as source_system,
  trim(source_{_kind}_id) as source_{_kind}_id, match_confidence, trim(match_rule) as match_rule,
  coalesce(is_primary, false) as is_primary, effective_date, termination_date,
  (case when termination_date is null then true when termination_date >= {AS_OF_SQL} then true else false end)
    as is_active,
  created_at, _loaded_at
from raw_{_kind}_crosswalk""")


# ----------------------------------------------------------------- silver
def _ymd(d):
    return f"strftime({d}, '%Y-%m')"


model("dim_date_bounds", """
select cast(date_trunc('year', min(service_from_date)) as date) as start_date,
  cast(date_trunc('year', max(greatest(service_from_date, service_to_date))) + interval 1 year - interval 1 day as date)
    as end_date
from stg_clclaim""")

model("dim_date", f"""
select date_day as date_key, date_day, dayofweek(date_day) as day_of_week,
  left(dayname(date_day), 3) as day_of_week_name, left(dayname(date_day), 3) as day_of_week_name_short,
  day(date_day) as day_of_month, dayofyear(date_day) as day_of_year, weekofyear(date_day) as week_of_year,
  cast(date_day - cast(dayofweek(date_day) as integer) + 1 as date) as week_start_date,
  cast(date_day + (7 - cast(dayofweek(date_day) as integer)) as date) as week_end_date,
  month(date_day) as month_of_year, left(monthname(date_day), 3) as month_name,
  left(monthname(date_day), 3) as month_name_short, cast(date_trunc('month', date_day) as date) as month_start_date,
  last_day(date_day) as month_end_date, quarter(date_day) as quarter_of_year,
  cast(date_trunc('quarter', date_day) as date) as quarter_start_date,
  cast(date_trunc('quarter', date_day) + interval 3 month - interval 1 day as date) as quarter_end_date,
  year(date_day) as year_number, cast(date_trunc('year', date_day) as date) as year_start_date,
  cast(date_trunc('year', date_day) + interval 1 year - interval 1 day as date) as year_end_date,
  month(date_day) as fiscal_month_of_year, quarter(date_day) as fiscal_quarter_of_year,
  year(date_day) as fiscal_year_number,
  case when dayofweek(date_day) in (0, 6) then true else false end as is_weekend,
  case when dayofweek(date_day) not in (0, 6) then true else false end as is_weekday,
  case when date_day = {AS_OF_SQL} then true else false end as is_today,
  datediff('day', date_day, {AS_OF_SQL}) as days_ago,
  cast((cast(date_trunc('week', {AS_OF_SQL}) as date) - cast(date_trunc('week', date_day) as date)) / 7 as integer)
    as weeks_ago,
  {month_idx(AS_OF_SQL)} - {month_idx('date_day')} as months_ago,
  year({AS_OF_SQL}) - year(date_day) as years_ago,
  {_ymd('date_day')} as year_month, strftime(date_day, '%Y') || '-Q' || quarter(date_day) as year_quarter,
  strftime(date_day, '%b %Y') as month_year_name
from (select cast(d as date) as date_day
      from dim_date_bounds, generate_series(start_date, end_date, interval 1 day) t(d))""")

ELIG_ORDER = ("effective_date desc nulls last, termination_date desc nulls last, eligibility_id desc nulls last, "
              "lob_id desc nulls last, line_of_business desc nulls last, plan_id desc nulls last, "
              "plan_name desc nulls last, product_id desc nulls last, group_id desc nulls last, "
              "subgroup_id desc nulls last, coverage_type desc nulls last, relationship_code desc nulls last, "
              "subscriber_id desc nulls last, pcp_provider_id desc nulls last, eligibility_status_code desc nulls last")

model("latest_eligibility", f"""
from (from (select list(e order by {ELIG_ORDER})[1] as newest from stg_mbrelig e group by e.member_id) select unnest(newest))
select member_id, effective_date, termination_date, eligibility_id, lob_id, line_of_business, plan_id, plan_name,
  product_id, group_id, subgroup_id, coverage_type, relationship_code, subscriber_id, pcp_provider_id,
  eligibility_status_code""")

# One row per member and segment, an open end being the reporting date for months and the far end for the last day.
model("cover_segments", f"""
from stg_mbrelig
select member_id, eligibility_id, min(effective_date) as opened, max(coalesce(termination_date, date '9999-12-31')) as closed,
  sum(coalesce({member_months('effective_date', f'coalesce(termination_date, {AS_OF_SQL})')}, 0)) as months
group by all""")
model("eligibility_summary", """
from cover_segments
select member_id, count(eligibility_id) as total_eligibility_segments, min(opened) as first_effective_date,
  max(closed) as last_termination_date, sum(months)::bigint as total_member_months
group by all""")

# A missing date never rules anything out.
def _open_until(c):
    return f"coalesce({c} >= {AS_OF_SQL}, true)"


model("cover_now", """
from latest_eligibility
select member_id, eligibility_id as current_eligibility_id, effective_date as current_elig_effective_date,
  termination_date as current_elig_termination_date, lob_id as current_lob_id, line_of_business as current_line_of_business,
  plan_id as current_plan_id, plan_name as current_plan_name, product_id as current_product_id,
  group_id as current_group_id, coverage_type as current_coverage_type, relationship_code, subscriber_id,
  pcp_provider_id as current_pcp_provider_id""")

model("dim_member", f"""
from (from stg_member select * exclude (_loaded_at)) person
left join cover_now using (member_id)
left join eligibility_summary using (member_id)
select {skey('member_id')} as member_key, person.member_id, first_name, middle_name, last_name, date_of_birth,
  gender_code, gender, ssn, medicaid_id, medicare_id, email, preferred_language, status_code, member_status,
  columns(cover_now.* exclude (member_id)), columns(eligibility_summary.* exclude (member_id)),
  first_name || ' ' || last_name as full_name, {age('date_of_birth')} as current_age,
  {_open_until('current_elig_termination_date')} as is_currently_eligible,
  coalesce(relationship_code in ('18', 'SELF'), false) as is_subscriber, created_at, updated_at""")

model("dim_provider", f"""
from stg_provider
select {skey('provider_id')} as provider_key, provider_id, npi, tax_id, license_number, dea_number, upin, provider_name,
  provider_last_name, provider_first_name, provider_middle_name, suffix, credential, provider_type_code, provider_type,
  entity_type_code, entity_type, taxonomy_code, provider_status_code, provider_status, effective_date, termination_date,
  is_valid_npi, created_at, updated_at,
  if(entity_type_code = 'I',
     coalesce(provider_last_name, '') || coalesce(', ' || provider_first_name, '') || coalesce(', ' || credential, ''),
     provider_name) as display_name,
  coalesce(provider_status_code = 'A', false) and {_open_until('termination_date')} as is_active""")

model("dim_diagnosis", f"""
from stg_diagcode
select {skey('diagnosis_code', 'diagnosis_code_type')} as diagnosis_key, diagnosis_code, diagnosis_description,
  diagnosis_short_description, diagnosis_code_type, diagnosis_code_system, category_code, category_description,
  chapter_code, chapter_description, effective_date, termination_date, is_billable, is_header,
  if(diagnosis_code_type = 'ICD10', substr(diagnosis_code, 1, 3), null) as mdc_code,
  coalesce(effective_date <= {AS_OF_SQL}, true) and {_open_until('termination_date')} as is_current""")

# Golden records, one rule for both kinds: what comes from the golden record itself, and what from the source record.
_GOLDEN = {
    "member": (
        "first_name, last_name, first_name || ' ' || last_name as full_name, date_of_birth, "
        f"{age('date_of_birth')} as current_age, gender_code, gender, ssn",
        {"medicaid_id": "medicaid_id", "medicare_id": "medicare_id", "email": "email", "preferred_language": "preferred_language",
         "status_code": "qnxt_status_code", "member_status": "qnxt_member_status"}),
    "provider": (
        "provider_name, npi, tax_id, provider_type_code, primary_specialty_code",
        {"provider_name": "qnxt_provider_name", "provider_type_code": "qnxt_provider_type_code",
         "provider_type": "qnxt_provider_type", "provider_status_code": "qnxt_status_code", "taxonomy_code": "qnxt_taxonomy_code",
         "coalesce(provider_status_code = 'A', false)": "is_qnxt_active"}),
}
for _kind, (_own, _from_source) in _GOLDEN.items():
    _gid, _sid = f"golden_{_kind}_id", f"qnxt_{_kind}_id"
    model(f"active_links_{_kind}", f"from stg_{_kind}_crosswalk select * where is_active")
    model(f"identity_summary_{_kind}", f"""
from active_links_{_kind}
select {_gid}, array_to_string(list_sort(list_distinct(list(source_system))), ', ') as source_systems,
  count(distinct source_system) as source_system_count, count(*) as total_crosswalk_links group by all""")
    model(f"source_record_{_kind}", f"from stg_{_kind} select {_kind}_id as {_sid}, true as found, "
          + ", ".join(f"{c} as {a}" for c, a in _from_source.items()))
    model(f"dim_golden_{_kind}", f"""
from (from stg_golden_{_kind} select {_gid}, {_own}, match_confidence, is_active as is_golden_active,
        created_at as golden_created_at, updated_at as golden_updated_at where is_active) golden
left join (from active_links_{_kind} select {_gid}, source_{_kind}_id as {_sid}, is_primary as is_qnxt_primary
           where source_system = 'QNXT') link using ({_gid})
left join source_record_{_kind} using ({_sid})
left join identity_summary_{_kind} using ({_gid})
select {skey(_gid)} as golden_{_kind}_key, columns(golden.*), link.{_sid}, is_qnxt_primary,
  {", ".join(_from_source.values())}, source_system_count, source_systems, total_crosswalk_links,
  coalesce(found, false) as has_qnxt_record""")

model("line_rollup", """
select claim_id, count(*) as line_count, cast(sum(billed_amount) as decimal(38,2)) as total_line_billed,
  cast(sum(allowed_amount) as decimal(38,2)) as total_line_allowed,
  cast(sum(paid_amount) as decimal(38,2)) as total_line_paid,
  cast(sum(service_units) as decimal(38,2)) as total_service_units
from stg_clline group by claim_id""")

# Ids of a claim by role, and what they resolve to, both in long form.
_ROLES = {"member": "member", "billing": "provider", "servicing": "provider", "referring": "provider"}
model("claim_ids", "\nunion all\n".join(
    f"select claim_id, '{r}' as role, '{k}' as kind, {k if r == k else r + '_provider'}_id as id from stg_clclaim"
    for r, k in _ROLES.items()))
model("legacy_ids", "\nunion all\n".join(
    f"select '{k}' as kind, {k}_id as id, {k}_key as legacy_key from dim_{k}" for k in ("member", "provider")))
model("golden_ids", "\nunion all\n".join(f"""
select '{k}' as kind, source_{k}_id as id, golden_{k}_id as golden_id, golden_{k}_key as golden_key
from (from active_links_{k} where source_system = 'QNXT')
left join (select golden_{k}_id, golden_{k}_key from dim_golden_{k}) using (golden_{k}_id)"""
                                          for k in ("member", "provider")))
for _name, _ids in (("legacy", "legacy_ids"), ("golden", "golden_ids")):
    model(f"claim_{_name}", f"from claim_ids join {_ids} using (kind, id)")


def _role(kind, role):
    return f"(from claim_{kind} where role = '{role}') {kind}_{role} on {kind}_{role}.claim_id = c.claim_id"


_CLAIM_COLUMNS = f"""c.claim_id, facility_id, service_from_date, service_to_date, admit_date, discharge_date, received_date,
  processed_date, paid_date, adjudicated_date, claim_type_code, claim_type, form_type, bill_type, claim_status_code, claim_status,
  billed_amount, allowed_amount, paid_amount, copay_amount, coinsurance_amount, deductible_amount, cob_amount, withhold_amount,
  drg_code, admit_type, admit_source, discharge_status, length_of_stay, authorization_id, reference_number,
  internal_control_number, document_control_number, created_at, updated_at,
  {skey('c.claim_id')} as claim_key,
  billed_amount - allowed_amount as discount_amount, paid_amount - withhold_amount as net_paid_amount,
  copay_amount + coinsurance_amount + deductible_amount as member_responsibility_amount,
  coalesce(line_count, 0) as line_count, coalesce(total_service_units, 0) as total_service_units,
  """ + ", ".join(f"coalesce({c}, false) as {a}" for a, c in {
    "is_approved": "claim_status_code = 'A'", "is_denied": "claim_status_code = 'D'", "is_pending": "claim_status_code = 'P'",
    "is_paid": "paid_amount > 0", "is_institutional": "claim_type_code = 'I'", "is_professional": "claim_type_code = 'P'",
}.items()) + """,
  processed_date - received_date as days_to_process, paid_date - processed_date as days_to_pay,
  paid_date - received_date as days_to_final, service_to_date - service_from_date + 1 as service_days"""

model("fct_claim", "from stg_clclaim c left join line_rollup using (claim_id)"
      + "".join(f"\nleft join {_role('legacy', r)}" for r in _ROLES)
      + f"\nselect {_CLAIM_COLUMNS}, c.member_id, legacy_member.legacy_key as member_key"
      + "".join(f", c.{r}_provider_id, legacy_{r}.legacy_key as {r}_provider_key" for r in _ROLES if r != "member"))

model("fct_claim_conformed", "from stg_clclaim c left join line_rollup using (claim_id)"
      + "".join(f"\nleft join {_role(kind, r)}" for r in _ROLES for kind in ("golden", "legacy"))
      + f"\nselect {_CLAIM_COLUMNS}, golden_member.golden_id as member_golden_id, golden_member.golden_key as golden_member_key, "
      + "c.member_id as source_member_id, legacy_member.legacy_key as legacy_member_key"
      + "".join(f", golden_{r}.golden_id as {r}_provider_golden_id, golden_{r}.golden_key as {r}_provider_golden_key, "
                f"c.{r}_provider_id as source_{r}_provider_id, legacy_{r}.legacy_key as legacy_{r}_provider_key"
                for r in _ROLES if r != "member")
      + ", golden_member.golden_id is not null as has_golden_member, golden_billing.golden_id is not null as "
      + "has_golden_billing_provider, golden_servicing.golden_id is not null as has_golden_servicing_provider")


# ------------------------------------------------------------------- gold
_SUMS = {"billed": "total_billed", "allowed": "total_allowed", "paid": "total_paid",
         "member_responsibility": "total_member_responsibility", "discount": "total_discount"}
model("claims_monthly", """
from fct_claim left join (select member_id, current_line_of_business as line_of_business from dim_member) using (member_id)
select date_trunc('month', service_from_date)::date as service_month, line_of_business, claim_type, claim_status,
  strftime(any_value(service_from_date), '%Y-%m') as year_month, year(any_value(service_from_date))::integer as service_year,
  quarter(any_value(service_from_date))::integer as service_quarter,
  count(distinct claim_id) as claim_count, count(distinct member_id) as unique_members,
  count(distinct billing_provider_id) as unique_providers,
  """ + ", ".join([
    *(f"count(*) filter (where is_{f}) as {f}_claims" for f in ("approved", "denied", "pending")),
    *(f"count(*) filter (where is_{f}) as {f}_claim_count" for f in ("institutional", "professional")),
    *(f"coalesce(sum(paid_amount) filter (where is_{f}), 0)::decimal(38,2) as {f}_paid" for f in ("institutional", "professional")),
    *(f"sum({c}_amount)::decimal(38,2) as {a}" for c, a in _SUMS.items()),
    *(f"count({c}_amount) as n_{c}" for c in ("billed", "allowed", "paid")),
    *(f"sum({c}) as sum_{c}, count({c}) as n_{c}" for c in ("days_to_process", "days_to_pay")),
]) + """, sum(line_count) as sum_lines, count(line_count) as n_lines,
  sum(length_of_stay) filter (where is_institutional) as sum_los, count(length_of_stay) filter (where is_institutional) as n_los
where service_from_date is not null group by 1, 2, 3, 4""")

model("mart_claims_summary", f"""
select {skey('service_month', 'line_of_business', 'claim_type', 'claim_status')} as summary_key,
  service_month, year_month, service_year, service_quarter, line_of_business, claim_type, claim_status,
  claim_count, unique_members, unique_providers, approved_claims, denied_claims, pending_claims,
  {ratio('approved_claims * 100', 'claim_count', 2)} as approval_rate,
  {ratio('denied_claims * 100', 'claim_count', 2)} as denial_rate,
  total_billed, total_allowed, total_paid, total_member_responsibility, total_discount,
  {ratio(cents('total_allowed') + ' * 100', cents('total_billed'), 2)} as allowed_to_billed_ratio,
  {ratio(cents('total_paid') + ' * 100', cents('total_allowed'), 2)} as paid_to_allowed_ratio,
  {ratio(cents('total_billed'), 'n_billed * 100', 2)} as avg_billed_per_claim,
  {ratio(cents('total_allowed'), 'n_allowed * 100', 2)} as avg_allowed_per_claim,
  {ratio(cents('total_paid'), 'n_paid * 100', 2)} as avg_paid_per_claim,
  {ratio('sum_days_to_process', 'n_days_to_process', 1)} as avg_days_to_process,
  {ratio('sum_days_to_pay', 'n_days_to_pay', 1)} as avg_days_to_pay,
  {ratio('sum_lines', 'n_lines', 1)} as avg_lines_per_claim,
  institutional_claim_count, institutional_paid,
  {ratio('sum_los', 'n_los', 1)} as avg_length_of_stay,
  professional_claim_count, professional_paid,
  {ratio(cents('total_paid'), 'unique_members * 100', 2)} as paid_per_member,
  {ratio('claim_count', 'unique_members', 2)} as claims_per_member
from claims_monthly""")

MONTH_LCM = 377580  # lcm(28, 29, 30, 31)

_MONTH_FROM = f"({AS_OF_SQL} - interval 5 year)::date"
model("member_month_detail_units", f"""
from stg_mbrelig e, lateral (
  select unnest(generate_series(
    date_trunc('month', greatest(e.effective_date, {_MONTH_FROM}) + interval 1 month - interval 1 day),
    date_trunc('month', least(coalesce(e.termination_date, {AS_OF_SQL}), {AS_OF_SQL})), interval 1 month))::date as calendar_month)
select e.member_id, e.eligibility_id, calendar_month, e.lob_id, e.line_of_business, e.plan_id, e.plan_name,
  e.product_id, e.group_id, e.subgroup_id, e.coverage_type, e.relationship_code, e.pcp_provider_id,
  (least(coalesce(e.termination_date, last_day(calendar_month)), last_day(calendar_month)) - calendar_month + 1)
    * ({MONTH_LCM} // day(last_day(calendar_month))) as member_month_units
where e.effective_date is not null""")

model("member_month_detail", f"""
select member_id, eligibility_id, calendar_month, lob_id, line_of_business, plan_id, plan_name, product_id,
  group_id, subgroup_id, coverage_type, relationship_code, pcp_provider_id,
  member_month_units / {MONTH_LCM} as member_month_fraction, cast(member_month_units as bigint) as member_month_units
from member_month_detail_units""")

# What is counted in a month's group, in long form: one row per group, measure and distinct id.
_MONTH_GROUP = "calendar_month, line_of_business, plan_id, plan_name, group_id, coverage_type"
_SUBSCRIBES = "relationship_code in ('18', 'SELF')"
_COUNTED = {"enrolled_members": ("member_id", "true"), "full_month_members": ("member_id", f"member_month_units = {MONTH_LCM}"),
            "active_eligibility_segments": ("eligibility_id", "true"), "assigned_pcps": ("pcp_provider_id", "true"),
            "subscriber_count": ("member_id", _SUBSCRIBES), "dependent_count": ("member_id", f"not {_SUBSCRIBES}")}
model("covered_months", "from member_month_detail where member_month_units > 0")
model("covered_ids", "\nunion\n".join(
    f"select {_MONTH_GROUP}, '{what}' as what, {i} as id from covered_months where {i} is not null and {when}"
    for what, (i, when) in _COUNTED.items()))
model("covered_counts", f"from covered_ids select {_MONTH_GROUP}, "
      + ", ".join(f"count(*) filter (what = '{what}') as {what}" for what in _COUNTED) + " group by all")
model("covered_units", f"from covered_months select {_MONTH_GROUP}, sum(member_month_units) as units group by all")
model("member_months_monthly", f"""
from covered_units u left join covered_counts c
  on {" and ".join(f"u.{k} is not distinct from c.{k}" for k in _MONTH_GROUP.split(", "))}
select u.*, {", ".join(f"coalesce(c.{what}, 0) as {what}" for what in _COUNTED)}, strftime(u.calendar_month, '%Y-%m') as year_month,
  year(u.calendar_month)::integer as calendar_year, quarter(u.calendar_month)::integer as calendar_quarter,
  month(u.calendar_month)::integer as calendar_month_num""")

model("mart_member_months", f"""
select {skey('calendar_month', 'line_of_business', 'plan_id', 'group_id', 'coverage_type')} as member_month_key,
  calendar_month, year_month, calendar_year, calendar_quarter, calendar_month_num, line_of_business, plan_id,
  plan_name, group_id, coverage_type,
  cast(cast(round({ratio('units', str(MONTH_LCM), 2)} * 100) as decimal(38,0)) / 100 as decimal(38,2)) as member_months,
  enrolled_members, full_month_members, active_eligibility_segments, assigned_pcps, subscriber_count, dependent_count,
  {ratio('dependent_count', 'subscriber_count', 2)} as dependent_ratio,
  {ratio('enrolled_members', 'assigned_pcps', 1)} as members_per_pcp
from member_months_monthly""")

model("expense_claims", """
from mart_claims_summary
select service_month as report_month, line_of_business, claim_type, sum(claim_count) as claim_count,
  sum(unique_members) as members_with_claims, """ + ", ".join(
    f"sum({c})::decimal(38,2) as {c}" for c in ("total_billed", "total_allowed", "total_paid", "total_member_responsibility",
                                                "institutional_paid", "professional_paid")) + " group by all")
model("expense_months", """
from mart_member_months
select calendar_month as report_month, line_of_business, sum(member_months)::decimal(38,2) as member_months,
  sum(enrolled_members) as enrolled_members group by all""")
# Claims with their enrolment, then enrolment that no claim row met.
model("expense_rows", """
from expense_claims left join expense_months using (report_month, line_of_business)
union all by name
from expense_months anti join expense_claims using (report_month, line_of_business)""")
model("expense_combined", "from expense_rows select report_month, line_of_business, claim_type, "
      "strftime(report_month, '%Y-%m') as year_month, year(report_month)::integer as report_year, "
      "quarter(report_month)::integer as report_quarter, " + ", ".join(
          f"coalesce({c}, 0) as {c}" for c in (
              "claim_count", "members_with_claims", "total_billed", "total_allowed", "total_paid", "total_member_responsibility",
              "institutional_paid", "professional_paid", "member_months", "enrolled_members")))

model("mart_medical_expense", f"""
select {skey('report_month', 'line_of_business', 'claim_type')} as expense_key, report_month, year_month,
  report_year, report_quarter, line_of_business, claim_type, cast(claim_count as bigint) as claim_count,
  cast(enrolled_members as bigint) as enrolled_members, cast(members_with_claims as bigint) as members_with_claims,
  member_months, total_billed, total_allowed, total_paid, total_member_responsibility, institutional_paid,
  professional_paid,
  {gratio(cents('total_paid'), cents('member_months'), 2)} as paid_pmpm,
  {gratio(cents('total_allowed'), cents('member_months'), 2)} as allowed_pmpm,
  {gratio(cents('total_billed'), cents('member_months'), 2)} as billed_pmpm,
  {gratio(cents('institutional_paid'), cents('member_months'), 2)} as institutional_pmpm,
  {gratio(cents('professional_paid'), cents('member_months'), 2)} as professional_pmpm,
  case when claim_count > 0 then {ratio(cents('total_paid'), 'claim_count * 100', 2)} else 0.0 end as avg_paid_per_claim,
  {gratio('members_with_claims * 100', 'enrolled_members', 2)} as utilization_rate,
  case when member_months > 0 then {ratio('claim_count * 100000', cents('member_months'), 1)} else 0.0 end
    as claims_per_1000_mm,
  case when total_paid > 0 then {ratio(cents('institutional_paid') + ' * 100', cents('total_paid'), 2)} else 0.0 end
    as institutional_pct,
  case when total_paid > 0 then {ratio(cents('professional_paid') + ' * 100', cents('total_paid'), 2)} else 0.0 end
    as professional_pct,
  cast(total_billed - total_allowed as decimal(38,2)) as total_discount,
  case when total_billed > 0 then {ratio('(' + cents('total_billed') + ' - ' + cents('total_allowed') + ') * 100', cents('total_billed'), 2)}
    else 0.0 end as discount_pct
from expense_combined""")


# ----------------------------------------------------------------- assembly
_IDENT = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    names = set(_IDENT.findall(sql))
    out = [n for n in MODELS if n in names]
    out += [f"raw_{t}" for t in RAW_TABLES if f"raw_{t}" in names]
    return out


def _ordered(target: str) -> list[str]:
    seen: list[str] = []

    def visit(n: str):
        if n in seen:
            return
        body = raw_sql(n[4:], DUCKDB) if n.startswith("raw_") else MODELS[n]
        if not n.startswith("raw_"):
            for dep in _deps(body):
                if dep != n:
                    visit(dep)
        seen.append(n)

    visit(target)
    return seen


def query(target: str, final: str | None = None) -> str:
    names = _ordered(target)
    ctes = []
    for n in names:
        body = raw_sql(n[4:], DUCKDB) if n.startswith("raw_") else MODELS[n]
        ctes.append(f"{n} as ({body}\n)")
    return "with " + ",\n".join(ctes) + "\n" + (final or f"select * from {target}")
