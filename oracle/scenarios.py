"""DuckDB SQL for the multi-run scenarios, the quality suite and lookups."""

from __future__ import annotations

import re

from carespark.functions.cleaning import CLAIM_STATUS_REFERENCE
from carespark.operators.quality import Check
from carespark.plans import checks, scenarios
from carespark.sources.schemas import RAW_SCHEMAS, SOURCES

from .sql import AS_OF_SQL, MODELS, model, ratio
from .sql import _deps as sql_deps

# ------------------------------------------------------------ incremental
_stg_adj = MODELS["stg_cladjust"]
model("adj_b1", "select * from raw_cladjust where _loaded_at < timestamp '2024-01-16 00:00:00'")
model("adj_b2", """
select * from raw_cladjust where _loaded_at >= timestamp '2024-01-16 00:00:00'
union all by name
select * replace ('CR' as adjustgroup, 'Corrected' as adjustdesc, _loaded_at + interval 20 day as _loaded_at)
from adj_b1 where cast(adjustseq as bigint) % 50 = 0
union all by name
select * replace ('Late duplicate' as adjustdesc) from adj_b1 where _loaded_at = (select max(_loaded_at) from adj_b1)""")
model("adj_stg1", _stg_adj.replace("from raw_cladjust", "from adj_b1"))
model("adj_stg2", _stg_adj.replace("from raw_cladjust", "from adj_b2"))
model("incremental_watermark", """
select * from adj_stg2
where (select max(_loaded_at) from adj_stg1) is null or _loaded_at > (select max(_loaded_at) from adj_stg1)""")
model("incremental_upsert", """
select * from adj_stg1 t
where not exists (select 1 from incremental_watermark s where s.claim_adjustment_id = t.claim_adjustment_id)
union all
select * from incremental_watermark""")
model("schema_append", """
select *, cast(null as varchar) as adjustment_channel from adj_stg1 t
where not exists (select 1 from incremental_watermark s where s.claim_adjustment_id = t.claim_adjustment_id)
union all
select *, case when adjustment_group_code = 'CR' then 'manual' else 'edi' end as adjustment_channel
from incremental_watermark""")


for _t, (_stg, _key, _col) in {"clclaim": ("stg_clclaim", "claim_id", "formtype"), "clline": ("stg_clline", "claim_line_id", "ndc"),
                               "cldiag": ("stg_cldiag", "claim_diagnosis_id", "poa"),
                               "clproc": ("stg_clproc", "claim_procedure_id", "proccode")}.items():
    model(f"{_t}_loads", f"""
from raw_{_t} select *, if(_loaded_at < timestamp '1998-01-01 00:00:00', 1, 2) as load
union all by name
from raw_{_t} select * replace ('X' as {_col}, _loaded_at + interval 4000 day as _loaded_at), 2 as load
where _loaded_at < timestamp '1998-01-01 00:00:00' and right(claimid, 1) = '7'""")
    for _i in (1, 2):
        model(f"{_t}_load{_i}", MODELS[_stg].replace(f"from raw_{_t}", f"from (from {_t}_loads select * exclude (load) where load = {_i})"))
    model(f"{_t}_fresh", f"from {_t}_load2 where _loaded_at > coalesce((select max(_loaded_at) from {_t}_load1), timestamp '0001-01-01')")
    model(f"incremental_{_t}", f"from {_t}_load1 anti join {_t}_fresh using ({_key}) union all by name from {_t}_fresh")


# ----------------------------------------------- marts over the loaded claims
def _over(target: str, other: dict[str, str], tag: str) -> str:
    """The name of ``target`` with ``other``'s tables read in place of its own, and likewise all between."""
    if target in other:
        return other[target]
    body = MODELS.get(target)
    if body is None:
        return target
    new = {dep: _over(dep, other, tag) for dep in sql_deps(body) if dep != target}
    changed = {d: n for d, n in new.items() if d != n}
    if not changed:
        return target
    model(f"{tag}_{target}", re.sub(r"\b(" + "|".join(map(re.escape, changed)) + r")\b", lambda m: changed[m[0]], body))
    return f"{tag}_{target}"


_LOADED = {"stg_clclaim": "incremental_clclaim", "stg_clline": "incremental_clline"}
for _mart, _name in (("mart_claims_summary", "refresh_claims_summary"), ("mart_medical_expense", "refresh_medical_expense")):
    model(_name, f"from {_over(_mart, _LOADED, 'loaded')}")

model("claims_rollup", """
select line_of_business, plan_id, grouping(line_of_business, plan_id)::integer as level, count(*) as claim_count,
  sum(paid_amount)::decimal(38,2) as total_paid, count(distinct member_id) as unique_members
from (from fct_claim select member_id, paid_amount) c
left join (from dim_member select member_id, current_line_of_business as line_of_business, current_plan_id as plan_id) m using (member_id)
group by rollup (line_of_business, plan_id)""")


# --------------------------------------------------------------- snapshots
_DIGITS = {
    "member": ("right(member_id, 1)", "left(right(member_id, 2), 1)"),
    "eligibility": ("left(right(eligibility_id, 3), 1)", "right(eligibility_id, 1)"),
    "provider": ("right(provider_id, 1)", "left(right(provider_id, 2), 1)"),
}


def _scd_step(prev, src, key, change, cols, run):
    run_sql = f"timestamp '{run.isoformat(sep=' ')}'"
    chg = f"coalesce(s.{change}, {run_sql})"
    new = (", ".join(f"s.{c}" for c in cols)
           + f", md5(coalesce(cast(s.{key} as varchar), '') || '|' || coalesce(cast({chg} as varchar), ''))"
           + f" as dbt_scd_id, {chg} as dbt_updated_at, {chg} as dbt_valid_from,"
           + " cast(null as timestamp) as dbt_valid_to")
    if prev is None:
        return f"select {new} from {src} s"
    old = ", ".join(f"o.{c}" for c in cols)
    return f"""
select * from {prev} where dbt_valid_to is not null
union all
select {old}, o.dbt_scd_id, o.dbt_updated_at, o.dbt_valid_from,
  case when s.{key} is not null and s.{change} > o.dbt_updated_at then s.{change}
       when s.{key} is null then {run_sql} else o.dbt_valid_to end as dbt_valid_to
from (select * from {prev} where dbt_valid_to is null) o left join {src} s on o.{key} = s.{key}
union all
select {new}
from {src} s left join (select * from {prev} where dbt_valid_to is null) o on o.{key} = s.{key}
where o.{key} is null or s.{change} > o.dbt_updated_at"""


for _name, (_stg, _key, _chg, _cols, _changed, *_r) in scenarios.SNAPSHOTS.items():
    d1, d2 = _DIGITS[_name]
    plain = ", ".join(_cols)
    v2_cols = ", ".join(
        f"case when {d1} = '5' then 'Changed' else {c} end as {c}" if c == _changed
        else f"case when {d1} = '5' then {c} + interval 1 day else {c} end as {c}" if c == _chg
        else c
        for c in _cols)
    back_cols = ", ".join(f"{c} + interval 2 day as {c}" if c == _chg else c for c in _cols)
    model(f"snap_{_name}_v1", f"select {plain} from {_stg} where {d1} <> '7'")
    model(f"snap_{_name}_v2", f"select {v2_cols} from {_stg} where {d1} <> '3'")
    model(f"snap_{_name}_v3", f"select * from snap_{_name}_v2 union all select {back_cols} from {_stg} "
                              f"where {d1} = '3' and {d2} = '1'")
    r1, r2, r3 = scenarios.SNAPSHOT_RUNS
    model(f"snap_{_name}_h1", _scd_step(None, f"snap_{_name}_v1", _key, _chg, _cols, r1))
    model(f"snap_{_name}_h2", _scd_step(f"snap_{_name}_h1", f"snap_{_name}_v2", _key, _chg, _cols, r2))
    model(f"snapshot_{_name}", _scd_step(f"snap_{_name}_h2", f"snap_{_name}_v3", _key, _chg, _cols, r3))

model("snapshot_asof", """
select * from snapshot_member
where dbt_valid_from <= timestamp '2001-06-20 00:00:00'
  and (dbt_valid_to is null or timestamp '2001-06-20 00:00:00' < dbt_valid_to)""")


# ------------------------------------------------------------------ quality
DUCK_TYPES = {"date": "DATE", "string": "VARCHAR", "integer": "INTEGER", "boolean": "BOOLEAN"}


def _lit(v):
    return f"'{v}'" if isinstance(v, str) else str(v)


def failing_rows_sql(ch: Check) -> str:
    m, c = ch.model, ch.column
    cond = f"({ch.row_condition})" if ch.row_condition else "true"
    if ch.kind == "not_null":
        return f"select * from {m} where {c} is null"
    if ch.kind == "accepted_values":
        return f"select * from {m} where {c} not in ({', '.join(_lit(v) for v in ch.values)})"
    if ch.kind == "between":
        ok = []
        if ch.min_value is not None:
            ok.append(f"{c} >= {ch.min_value}")
        if ch.max_value is not None:
            ok.append(f"{c} <= {ch.max_value}")
        return f"select * from {m} where {cond} and not ({' and '.join(ok)})"
    if ch.kind == "pair_ge":
        op = ">=" if ch.or_equal else ">"
        return f"select * from {m} where {cond} and not ({c} {op} {ch.column_b})"
    if ch.kind == "unique":
        names = c.split("+")
        known = " and ".join(f"{n} is not null" for n in names)
        return f"select {', '.join(names)}, count(*) as count from {m} where {cond} and {known} group by all having count(*) > 1"
    if ch.kind == "relationships":
        return (f"select * from {m} c where c.{c} is not null and not exists "
                f"(select 1 from {ch.to_model} p where p.{ch.to_field} = c.{c})")
    raise ValueError(ch.kind)


def check_sql(ch: Check) -> str:
    meta = (f"'{ch.model}' as table_name, '{ch.kind}' as rule, '{ch.column}' as column_name, "
            f"'{ch.severity}' as severity")
    if ch.kind == "type":
        n = f"(select count(*) from {ch.model} where typeof({ch.column}) <> '{DUCK_TYPES[ch.type_name]}')"
    else:
        n = f"(select count(*) from ({failing_rows_sql(ch)}) f)"
    return f"select {meta}, cast({n} as bigint) as failures"


def report_sql(suite) -> str:
    body = "\nunion all\n".join(check_sql(ch) for ch in suite)
    return (f"select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end "
            f"as status from ({body}) r")


model("dq_report", report_sql(checks.SUITE))

for _n, _sql in {
    "dq_not_null": "from stg_member where date_of_birth is null",
    "dq_unique": "from stg_mbrelig select member_id, count(*) as count group by 1 having count > 1 and member_id is not null",
    "dq_accepted_values": "from stg_clclaim where claim_type_code not in ('I', 'P', 'D', 'R')",
    "dq_relationships": "from stg_clclaim c where servicing_provider_id is not null and not exists "
                        "(from stg_provider p where p.provider_id = c.servicing_provider_id)",
    "dq_between": "from fct_claim where days_to_process not between 0 and 10",
    "dq_pair_order": "from stg_clclaim where not (received_date > service_to_date)",
    "dq_type": "from stg_member select 'stg_member' as table_name, 'type' as rule, 'date_of_birth' as column_name, 'error' as severity, "
               "count(*) filter (where typeof(date_of_birth) <> 'DATE') as failures, if(failures = 0, 'pass', 'fail') as status",
}.items():
    model(_n, _sql)

FRESHNESS_AS_OF = "2001-06-30 00:00:00"
_GROUPS = {"extracts": "member mbrelig provider clclaim clline cldiag clproc cladjust diagcode",
           "identity": "golden_member golden_provider member_crosswalk provider_crosswalk"}
_fresh_union = "\nunion all\n".join(
    f"select '{g}' as source_group, '{s}' as source_name, max(_loaded_at) as max_loaded_at from raw_{s}"
    for g, names in _GROUPS.items() for s in names.split())
_micros = f"date_diff('microsecond', max_loaded_at, timestamp '{FRESHNESS_AS_OF}')"
model("freshness", f"""
select source_group, source_name, max_loaded_at, {ratio(_micros, '3600000000', 2)} as age_hours,
  case when max_loaded_at is null then 'error' when {_micros} > 48 * 3600000000 then 'error'
       when {_micros} > 24 * 3600000000 then 'warn' else 'pass' end as status
from ({_fresh_union}) f""")


# ------------------------------------------------------------ registry
def _profile(group, name, declared, here):
    """Declared columns first, then what has arrived besides; a table declared without columns takes any."""
    for c in dict.fromkeys([*declared, *here]):
        state = "absent" if not here else "missing" if c not in here else "matched" if not declared or c in declared else "undeclared"
        yield (f"select '{group}' as source_group, '{name}' as source_name, '{c}' as column_name, '{state}' as state, "
               + (f"count(*) as rows, {f'count({c})' if c in here else 'null::bigint'} as filled from raw_{name}" if here
                  else "null::bigint as rows, null::bigint as filled"))


_IDENTITY_COLUMNS = {n: t.split() for n, t in SOURCES["identity"].items()}
_ARRIVED = {n: [f.name for f in st.fields] for n, st in RAW_SCHEMAS.items()} | _IDENTITY_COLUMNS
model("source_profile", "\nunion all\n".join(
    sql for g, tables in SOURCES.items() for n, text in tables.items() for sql in _profile(g, n, text.split(), _ARRIVED.get(n, []))))


# ------------------------------------------------------------- lookups etc.
model("identity_lookup", """
select x.golden_member_id, g.full_name, x.source_system, x.source_member_id, x.is_primary, x.match_confidence
from stg_member_crosswalk x join dim_golden_member g on x.golden_member_id = g.golden_member_id
where x.is_active = true""")

model("resolved_claims", """
select c.claim_id, c.member_golden_id, g.full_name, g.source_systems, c.service_from_date, c.paid_amount
from fct_claim_conformed c join dim_golden_member g on c.member_golden_id = g.golden_member_id""")

_STATUS_VALUES = ", ".join(
    f"('{a}', '{b}', '{c}', {str(d).lower()}, {str(e).lower()})" for a, b, c, d, e in CLAIM_STATUS_REFERENCE)
model("status_lookup", f"""
select c.claim_id, c.claim_status_code, r.status_name, r.status_category, r.is_final, r.is_payable
from stg_clclaim c left join (values {_STATUS_VALUES}) r(status_code, status_name, status_category, is_final, is_payable)
  on c.claim_status_code = r.status_code""")

ROW_COUNT_TABLES = ("member", "mbrelig", "provider", "clclaim", "clline", "cldiag", "clproc", "cladjust", "diagcode")
model("row_counts", "\nunion all\n".join(
    f"select '{t}' as table_name, count(*) as row_count from raw_{t}" for t in ROW_COUNT_TABLES))

_SEED_MEMBER = ("memid", "fname", "lname", "dob", "sex", "status", "email", "language")
_WIDE_MEMBER = ("memid fname mname lname dob sex ssn medid mcrid altid email language status createdate "
                "modifydate").split()
model("conform_schema", "select " + ", ".join(
    c if c in _SEED_MEMBER else f"cast(null as varchar) as {c}" for c in _WIDE_MEMBER)
    + ", _loaded_at from raw_member")



# ----------------------------------------------------------- column helpers
from .sql import (  # noqa: E402
    CLAIM_STATUS, DIAG_TYPE, GENDER, LOB, MEMBER_STATUS, POA, PROC_TYPE, age, amt, case_map, clean, code,
    int_default, int_or_null, member_months, month_idx, pdate, pts, skey)


def _weeks(a, b):
    return f"cast((cast(date_trunc('week', {b}) as date) - cast(date_trunc('week', {a}) as date)) / 7 as integer)"


_FN = {
    "fn_clean_string": ("raw_member", f"memid, {clean('fname')} as fname_clean, {clean('mname')} as mname_clean, "
                                      f"{clean('language')} as language_clean"),
    "fn_parse_date": ("raw_member", f"memid, dob, {pdate('dob')} as dob_parsed"),
    "fn_parse_datetime": ("raw_member", f"memid, modifydate, {pts('modifydate')} as modified_at"),
    "fn_amount": ("raw_clclaim", f"claimid, {amt('deductamt')} as deduct, {amt('cobamt')} as cob, "
                                 f"{amt('coinsamt')} as coins"),
    "fn_format_ids": ("raw_clclaim", f"claimid, {code('claimid')} as claim_id, {code('memid')} as member_id, "
                                     f"{code('provid')} as provider_id"),
    "fn_claim_status": ("raw_clclaim", f"claimid, claimstatus as status_raw, {code('claimstatus')} as status_code, "
                                       f"{case_map('claimstatus', CLAIM_STATUS, chr(39) + 'Unknown' + chr(39))} "
                                       "as status_label"),
    "fn_gender": ("raw_member", f"memid, {case_map(code('sex'), GENDER, chr(39) + 'Unknown' + chr(39))} as gender"),
    "fn_member_status": ("raw_member", f"memid, {case_map(code('status'), MEMBER_STATUS, chr(39) + 'Unknown' + chr(39))}"
                                       " as member_status"),
    "fn_line_of_business": ("raw_mbrelig", f"eligid, {case_map(code('lobid'), LOB, 'lobid')} as lob"),
    "fn_age": ("stg_member", f"member_id, {age('date_of_birth')} as age"),
    "fn_member_months": ("stg_mbrelig", f"eligibility_id, {member_months('effective_date', 'termination_date')} "
                                        f"as months, {member_months('effective_date', AS_OF_SQL)} as months_to_as_of"),
    "fn_valid_npi": ("raw_provider", "provid, npi, (length(trim(npi)) = 10 and regexp_full_match(trim(npi), "
                                     "'[0-9]+')) as is_valid_npi"),
    "fn_phone": ("raw_member", "memid, regexp_replace(email, '[^0-9]', '', 'g') as digits"),
    "fn_zip": ("raw_provider", "provid, left(regexp_replace(taxonomy, '[^0-9]', '', 'g'), 5) as zip5"),
    "fn_surrogate_key": ("raw_clline", f"claimid, lineseq, {skey('claimid', 'lineseq')} as line_key"),
    "fn_code_maps": ("raw_cldiag", f"claimid, diagseq, {case_map(code('diagtype'), DIAG_TYPE, chr(39) + 'Unknown' + chr(39))}"
                                   f" as diag_type, {case_map(code('diagtype'), PROC_TYPE, chr(39) + 'Unknown' + chr(39))}"
                                   f" as proc_type, {case_map(code('poa'), POA)} as poa"),
    "fn_int_defaults": ("raw_clclaim", f"claimid, {int_default('los')} as los, {int_or_null('los')} as los_or_null"),
    "fn_boundary_diffs": ("stg_clclaim", "claim_id, datediff('day', service_from_date, paid_date) as days, "
                                         f"{_weeks('service_from_date', 'paid_date')} as weeks, "
                                         f"{month_idx('paid_date')} - {month_idx('service_from_date')} as months, "
                                         "year(paid_date) - year(service_from_date) as years"),
}
for _n, (_src, _cols) in _FN.items():
    model(_n, f"select {_cols} from {_src}")

_r1, _r2, _r3 = (f"timestamp '{r.isoformat(sep=' ')}'" for r in scenarios.SNAPSHOT_RUNS)
model("snapshot_changes", f"""
select c.* exclude (opened, first_run), md5(coalesce(cast(member_id as varchar), '') || '|' || coalesce(cast(opened as varchar), '')) as dbt_scd_id,
  opened as dbt_updated_at, opened as dbt_valid_from,
  lead(opened) over (partition by member_id order by opened) as dbt_valid_to
from (select *, coalesce(updated_at, first_run) as opened
      from (select * exclude (run), min(run) as first_run
            from (select *, {_r1} as run from snap_member_v1 union all select *, {_r2} from snap_member_v2
                  union all select *, {_r3} from snap_member_v3) u group by all) g) c""")

model("setup_eligibility", """
select memid, memid || '-ELIG001' as eligid, '20240101' as effdate, '20241231' as termdate, 'COM' as lobid,
  'PLAN001' as planid, 'Commercial Plan 001' as planname, 'PROD001' as productid, 'GRP001' as groupid,
  cast(null as varchar) as subgroupid, 'MED' as covtype, 'S' as relation, memid as subscriberid,
  cast(null as varchar) as pcpid, cast(null as varchar) as pcpassigndate, 'A' as eligstatus,
  '2001-06-01 00:00:00' as createdate, '2001-06-01 00:00:00' as modifydate,
  timestamp '2001-06-01 00:00:00' as _loaded_at
from raw_member""")
