"""Test-input adapter: derive raw health-plan extracts from the driver tables.

The driver ships TPC-H-like tables (customer, supplier, part, orders,
lineitem, events).  Each raw extract the staging layer expects (member,
eligibility, provider, claims, lines, diagnoses, procedures, adjustments,
diagnosis codes and the identity-mastering tables) is derived from them with a
deterministic rule, including the dirty values the cleaning layer must cope
with (padding, lower case, blanks, '0' dates, bad NPIs, orphan ids ...).

The rules are written once as SQL and rendered for two dialects:
Spark SQL (tables bound as DataFrame parameters of ``spark.sql``) and DuckDB
(tables referenced by name), so the engine and the independent SQL check see
byte-identical inputs.  Every derived table has a row for every row of the
driver table it comes from (members without segments and crosswalk gaps are
rules of the fixture), so it grows linearly with it.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the derived data set.
AS_OF = _dt.date(2001, 6, 30)
SOURCE_SYSTEM = "QNXT"
LOAD_TS = "2001-06-01 00:00:00"

DRIVER_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def t(self, table: str) -> str:
        return "{" + table + "}" if self.spark else table

    def ymd(self, x: str) -> str:
        return f"date_format({x}, 'yyyyMMdd')" if self.spark else f"strftime({x}, '%Y%m%d')"

    def iso(self, x: str) -> str:
        return f"date_format({x}, 'yyyy-MM-dd')" if self.spark else f"strftime({x}, '%Y-%m-%d')"

    def ts_text(self, x: str) -> str:
        return f"date_format({x}, 'yyyy-MM-dd HH:mm:ss')" if self.spark else f"strftime({x}, '%Y-%m-%d %H:%M:%S')"

    def add_days(self, d: str, n: str) -> str:
        return f"date_add({d}, cast(({n}) as int))" if self.spark else f"({d} + cast(({n}) as integer))"

    def ts_lit(self, s: str) -> str:
        return f"timestamp_ntz'{s}'" if self.spark else f"timestamp '{s}'"

    def to_ts(self, x: str) -> str:
        return f"cast({x} as timestamp_ntz)" if self.spark else f"cast({x} as timestamp)"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")


def s(x: str) -> str:
    return f"cast({x} as string)"


def _member(d: Dialect) -> str:
    k = "c_custkey"
    dob = d.add_days("date '1940-01-01'", f"({k} * 37) % 22000")
    return f"""
select
  case when {k} % 3 = 0 then concat(' mem', {s(k)}, ' ') else concat('MEM', {s(k)}) end as memid,
  case when {k} % 50 = 1 then '' else c_mktsegment end as fname,
  case when {k} % 5 = 0 then '  ' else 'M' end as mname,
  substr(c_name, 10) as lname,
  case when {k} % 19 = 0 then '19991340'
       when {k} % 17 = 0 then ''
       when {k} % 13 = 0 then '0'
       when {k} % 11 = 0 then {d.iso(dob)}
       else {d.ymd(dob)} end as dob,
  case {k} % 4 when 0 then 'M' when 1 then 'f' when 2 then ' U ' else null end as sex,
  concat('9', lpad({s(k)}, 8, '0')) as ssn,
  case when {k} % 4 = 0 then concat('MCD', {s(k)}) else null end as medid,
  case when {k} % 6 = 0 then concat('MCR', {s(k)}) else '' end as mcrid,
  cast(null as string) as altid,
  case when {k} % 7 = 0 then null else concat('m', {s(k)}, '@example.org') end as email,
  case {k} % 3 when 0 then 'EN' when 1 then 'ES' else ' ' end as language,
  case {k} % 5 when 0 then 'A' when 1 then 't' when 2 then 'P' when 3 then 'C' else 'X' end as status,
  concat('2000-01-', lpad({s(f"1 + {k} % 28")}, 2, '0'), ' 08:00:00') as createdate,
  case when {k} % 23 = 0 then '' else concat('2001-0', {s(f"1 + {k} % 5")}, '-15 12:30:00') end as modifydate,
  {d.ts_lit(LOAD_TS)} as _loaded_at
from {d.t('customer')}
"""


def _mbrelig(d: Dialect) -> str:
    k = "c.c_custkey"
    eff = d.add_days("date '1995-01-01'", f"{k} % 400 + 700 * g.i")
    term = d.add_days(eff, f"600 + {k} % 37")
    return f"""
select
  case when {k} % 6 = 1 then concat('mem', {s(k)}) else concat('MEM', {s(k)}) end as memid,
  concat('ELG', {s(k)}, '-', {s('g.i')}) as eligid,
  {d.ymd(eff)} as effdate,
  case when g.i = {k} % 3 and {k} % 2 = 0 then null else {d.ymd(term)} end as termdate,
  case when {k} % 97 = 5 then ' zzz'
       else case ({k} + g.i) % 5 when 0 then 'COM' when 1 then 'MCD ' when 2 then 'mcr' when 3 then 'MKT' else 'SNP' end
  end as lobid,
  concat('PLN', {s(f"{k} % 7")}) as planid,
  concat('Plan ', {s(f"{k} % 7")}) as planname,
  concat('PRD', {s(f"{k} % 3")}) as productid,
  concat('GRP', {s(f"{k} % 4")}) as groupid,
  case when {k} % 2 = 0 then 'SG1' else '' end as subgroupid,
  case when {k} % 2 = 0 then 'MED' else 'DEN' end as covtype,
  case {k} % 5 when 0 then '18' when 1 then 'SELF' when 2 then '01' when 3 then '19' else null end as relation,
  concat('SUB', {s(k)}) as subscriberid,
  case when {k} % 9 = 0 then null
       else concat('prov', {s(f"{k} % (select count(*) from {d.t('supplier')})")}) end as pcpid,
  {d.ymd(eff)} as pcpassigndate,
  case when g.i = {k} % 3 then ' a' else 'T' end as eligstatus,
  '2000-03-01 00:00:00' as createdate,
  '2001-05-01 00:00:00' as modifydate,
  {d.ts_lit(LOAD_TS)} as _loaded_at
from {d.t('customer')} c
join (select 0 as i union all select 1 union all select 2) g on g.i <= {k} % 3
where {k} % 25 <> 0
"""


def _provider(d: Dialect) -> str:
    k = "s_suppkey"
    return f"""
select
  concat('PROV', {s(k)}) as provid,
  case when {k} % 13 = 0 then null
       when {k} % 11 = 0 then concat('12345678A', {s(f"{k} % 10")})
       when {k} % 7 = 0 then lpad({s(k)}, 9, '1')
       else concat('1', lpad({s(k)}, 9, '0')) end as npi,
  concat('TX', {s(k)}) as taxid,
  concat('LIC', {s(k)}) as license,
  cast(null as string) as dea,
  '' as upin,
  s_name as provname,
  case {k} % 3 when 0 then 'Smith' when 1 then 'Jones' else null end as provlname,
  case {k} % 3 when 0 then 'Ann' when 2 then 'Bo' else null end as provfname,
  cast(null as string) as provmname,
  cast(null as string) as suffix,
  case {k} % 3 when 1 then 'MD' when 2 then ' ' else null end as credential,
  case when {k} % 2 = 0 then 'PCP' else 'SPC' end as provtype,
  case when {k} % 2 = 0 then 'Primary Care' else 'Specialist' end as provtypedesc,
  case {k} % 4 when 0 then 'I' when 1 then 'O' when 2 then 'i' else null end as entitytype,
  concat('207Q', lpad({s(f"{k} % 100")}, 6, '0')) as taxonomy,
  case {k} % 5 when 0 then 'A' when 1 then 'T' when 2 then 'P' when 3 then 'S' else 'a' end as provstatus,
  '19900101' as effdate,
  case {k} % 6 when 0 then '20000101' when 1 then '20251231' when 2 then '2030-12-31' else '' end as termdate,
  '2000-02-01 09:00:00' as createdate,
  concat('2001-02-', lpad({s(f"1 + {k} % 28")}, 2, '0'), ' 10:00:00') as modifydate,
  {d.ts_lit(LOAD_TS)} as _loaded_at
from {d.t('supplier')}
"""


def _clclaim(d: Dialect) -> str:
    k = "o_orderkey"
    od = "cast(o_orderdate as date)"
    recvd = d.add_days(od, f"{k} % 9 + 2")
    proc = d.add_days(recvd, f"{k} % 20")
    paid = d.add_days(proc, f"{k} % 7")
    billed = "cast(o_totalprice as decimal(18,2))"
    status = (
        f"case (case o_orderstatus when 'F' then 0 when 'O' then 3 else 6 end + {k} % 3)"
        " when 0 then 'A' when 1 then 'D' when 2 then 'P' when 3 then 'V' when 4 then 'S'"
        " when 5 then 'I' when 6 then 'R' when 7 then ' a' else 'x' end"
    )
    pri = "substr(o_orderpriority, 1, 1)"
    ns = f"(select count(*) from {d.t('supplier')})"
    return f"""
select
  case when {k} % 10 = 0 then concat('clm', {s(k)}) else concat('CLM', {s(k)}) end as claimid,
  case when o_custkey % 4 = 1 then concat(' mem', {s('o_custkey')}) else concat('MEM', {s('o_custkey')}) end as memid,
  concat('prov', {s(f"{k} % {ns}")}) as provid,
  concat('PROV', {s(f"({k} + 7) % ({ns} + 3)")}) as servprovid,
  case when {k} % 4 = 0 then concat('PROV', {s(f"({k} * 3) % {ns}")}) else null end as refprovid,
  case when {pri} = '1' then 'FAC1' else '' end as facilityid,
  case {pri} when '1' then 'I' when '2' then 'p' when '3' then 'D' when '4' then 'R' else 'Z' end as claimtype,
  case when {pri} = '1' then 'UB04' else 'CMS1500' end as formtype,
  case when {pri} = '1' then '111' else null end as billtype,
  case when {k} % 101 = 0 then null else {d.ymd(od)} end as svcfromdate,
  {d.ymd(d.add_days(od, f"{k} % 6"))} as svctodate,
  case when {pri} = '1' then {d.ymd(od)} else null end as admitdate,
  case when {pri} = '1' then {d.ymd(d.add_days(od, f"{k} % 9"))} else null end as dischargedate,
  {d.ymd(recvd)} as recvddate,
  {d.ymd(proc)} as processdate,
  case when {k} % 8 = 0 then '' else {d.ymd(paid)} end as paiddate,
  {d.ymd(proc)} as adjuddate,
  {status} as claimstatus,
  {s(billed)} as billedamt,
  {s(f"cast(round({billed} * 0.8, 2) as decimal(18,2))")} as allowedamt,
  case when ({k} % 3 = 1 and o_orderstatus = 'F') then '0'
       else {s(f"cast(round({billed} * 0.7, 2) as decimal(18,2))")} end as paidamt,
  '20' as copayamt,
  {s(f"{k} % 50")} as coinsamt,
  case when {k} % 6 = 0 then '' else '15.50' end as deductamt,
  cast(null as string) as cobamt,
  {s(f"{k} % 3")} as withholdamt,
  case when {pri} = '1' then concat('DRG', {s(f"{k} % 50")}) else null end as drg,
  case when {pri} = '1' then '1' else '' end as admittype,
  case when {pri} = '1' then '7' else null end as admitsource,
  case when {pri} = '1' then '01' else null end as dischargestatus,
  case when {pri} = '1' then {s(f"{k} % 9")} else '' end as los,
  case when {k} % 5 = 0 then concat('AUTH', {s(k)}) else '  ' end as authid,
  concat('REF', {s(k)}) as refnum,
  concat('ICN', {s(k)}) as icn,
  cast(null as string) as dcn,
  {d.ts_text(od)} as createdate,
  {d.ts_text(recvd)} as modifydate,
  {d.to_ts('o_orderdate')} as _loaded_at
from {d.t('orders')}
"""


def _numbering(d: Dialect) -> str:
    return f"""
  select l.*,
    row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate,
                       l_extendedprice, l_quantity, l_discount, l_tax) as lineseq
  from {d.t('lineitem')} l
"""


def _numbered_lines(d: Dialect) -> str:
    # Spark gets the numbered lines as a table, so that they can be dealt to tasks while they are narrow.
    return f"numbered_lines as (select * from {d.t('numbered_lines')})" if d.spark else f"numbered_lines as ({_numbering(d)})"


def _claimid_of(k: str) -> str:
    return f"case when {k} % 10 = 0 then concat('clm', {s(k)}) else concat('CLM', {s(k)}) end"


def _clline(d: Dialect) -> str:
    billed = "cast(l_extendedprice as decimal(18,2))"
    allowed = f"cast(round({billed} * (1 - cast(l_discount as decimal(4,2))), 2) as decimal(18,2))"
    sd = "cast(l_shipdate as date)"
    ns = f"(select count(*) from {d.t('supplier')})"
    return f"""
with {_numbered_lines(d)}
select
  {_claimid_of('l_orderkey')} as claimid,
  {s('lineseq')} as lineseq,
  concat('9', lpad({s('l_partkey % 1000')}, 4, '0')) as proccode,
  case when l_partkey % 3 = 0 then '25' else '' end as modifier1,
  cast(null as string) as modifier2,
  cast(null as string) as modifier3,
  cast(null as string) as modifier4,
  case when l_suppkey % 2 = 0 then concat('0', {s('100 + l_suppkey % 200')}) else null end as revcode,
  cast(null as string) as ndc,
  {d.ymd(sd)} as svcfromdate,
  {d.ymd(d.add_days(sd, 'l_linenumber % 3'))} as svctodate,
  case l_linenumber % 3 when 0 then '11' when 1 then '21' else '' end as pos,
  {s('cast(l_quantity as decimal(18,2))')} as svcunits,
  {s(billed)} as billedamt,
  {s(allowed)} as allowedamt,
  case when l_returnflag = 'R' then '0'
       else {s(f"cast(round({allowed} * 0.9, 2) as decimal(18,2))")} end as paidamt,
  '' as copayamt,
  cast(null as string) as coinsamt,
  cast(null as string) as deductamt,
  cast(null as string) as cobamt,
  '0' as withholdamt,
  case when l_returnflag = 'R' then 'D' when l_linestatus = 'O' then 'P' else 'A' end as linestatus,
  '1' as diagptr1,
  case when l_linenumber % 2 = 0 then '2' else '' end as diagptr2,
  cast(null as string) as diagptr3,
  cast(null as string) as diagptr4,
  concat('prov', {s(f"l_suppkey % {ns}")}) as servprovid,
  {d.ts_text('l_shipdate')} as createdate,
  {d.ts_text('l_shipdate')} as modifydate,
  {d.to_ts('l_shipdate')} as _loaded_at
from numbered_lines
"""


def _cldiag(d: Dialect) -> str:
    return f"""
with {_numbered_lines(d)}
select
  {_claimid_of('l_orderkey')} as claimid,
  {s('lineseq')} as diagseq,
  concat('D', {s('l_partkey')}) as diagcode,
  case l_partkey % 5 when 0 then 'ICD9' when 1 then 'icd10' when 2 then '9' when 3 then '10' else '?' end as diagtype,
  case l_suppkey % 6 when 0 then 'Y' when 1 then 'N' when 2 then 'U' when 3 then 'W' when 4 then '1' else null end as poa,
  {d.to_ts('l_shipdate')} as _loaded_at
from numbered_lines
"""


def _clproc(d: Dialect) -> str:
    return f"""
with {_numbered_lines(d)}
select
  {_claimid_of('l_orderkey')} as claimid,
  {s('lineseq')} as procseq,
  concat('P', {s('l_partkey % 300')}) as proccode,
  case l_partkey % 5 when 0 then 'ICD9' when 1 then 'icd10' when 2 then '9' when 3 then '10' else '?' end as proctype,
  {d.ymd('cast(l_shipdate as date)')} as procdate,
  {d.to_ts('l_shipdate')} as _loaded_at
from numbered_lines
"""


def _proccode(d: Dialect) -> str:
    return f"""
select concat('P', {s('code')}) as proccode, concat('Procedure ', {s('code')}) as procdesc,
  case when code % 2 = 0 then 'CPT' else 'HCPCS' end as proctype, {d.ts_lit(LOAD_TS)} as _loaded_at
from (select distinct l_partkey % 300 as code from {d.t('lineitem')}) codes
"""


def _cladjust(d: Dialect) -> str:
    return f"""
select
  concat('CLM', {s(f"event_id % (select count(*) from {d.t('orders')})")}) as claimid,
  {s('event_id')} as adjustseq,
  event_type as adjustcode,
  concat('Adjustment ', event_type) as adjustdesc,
  case event_id % 3 when 0 then 'CO' when 1 then 'PR' else '' end as adjustgroup,
  {s('cast(-value as decimal(18,2))')} as adjustamt,
  {d.ymd('cast(ts as date)')} as adjustdate,
  {d.to_ts('ts')} as _loaded_at
from {d.t('events')}
"""


def _diagcode(d: Dialect) -> str:
    k = "p_partkey"
    return f"""
select
  concat('D', {s(k)}) as diagcode,
  p_name as diagdesc,
  substr(p_name, 1, 20) as diagshortdesc,
  case when {k} % 2 = 0 then 'ICD10' else 'icd9' end as diagtype,
  p_brand as category,
  p_type as categorydesc,
  concat('CH', {s(f"{k} % 20")}) as chapter,
  concat('Chapter ', {s(f"{k} % 20")}) as chapterdesc,
  case {k} % 4 when 0 then '19900101' when 1 then '20020101' when 2 then '' else '1995-01-01' end as effdate,
  case {k} % 4 when 0 then '' when 1 then '' when 2 then '20000101' else '20301231' end as termdate,
  case {k} % 3 when 0 then 'Y' when 1 then 'n' else null end as billable,
  case when {k} % 10 = 0 then 'Y' else 'N' end as header,
  {d.ts_lit(LOAD_TS)} as _loaded_at
from {d.t('part')}
"""


def _golden_member(d: Dialect) -> str:
    k = "c_custkey"
    return f"""
select
  concat('GM-', {s(k)}) as golden_member_id,
  concat(' ', c_mktsegment) as first_name,
  substr(c_name, 10) as last_name,
  {d.add_days("date '1940-01-01'", f"({k} * 37) % 22000")} as date_of_birth,
  case {k} % 3 when 0 then 'm' when 1 then 'F' else null end as gender,
  concat('9', lpad({s(k)}, 8, '0')) as ssn,
  cast(concat({s(f"50 + {k} % 50")}, '.', {s(f"{k} % 10")}) as decimal(5,2)) as match_confidence,
  concat('[', chr(123), '"source": "QNXT", "id": "MEM', {s(k)}, '"', chr(125), ']') as merge_history,
  {k} % 20 <> 0 as is_active,
  {d.ts_lit('2000-06-01 00:00:00')} as created_at,
  {d.ts_lit('2001-03-01 00:00:00')} as updated_at,
  {d.ts_lit(LOAD_TS)} as _loaded_at
from {d.t('customer')}
"""


def _member_crosswalk(d: Dialect) -> str:
    k = "c_custkey"
    term = (
        f"case when {k} % 30 = 7 then date '2000-12-31' when {k} % 30 = 8 then date '2002-01-01' "
        "else cast(null as date) end"
    )
    common = f"""
  cast(concat({s(f"60 + {k} % 40")}, '.5') as decimal(5,2)) as match_confidence,
  date '2000-01-01' as effective_date,
  {d.ts_lit('2000-01-01 10:30:00')} as created_at,
  {d.ts_lit(LOAD_TS)} as _loaded_at"""
    return f"""
select concat('XWM-', {s(k)}, '-Q') as crosswalk_id, concat('GM-', {s(k)}) as golden_member_id,
  'QNXT' as source_system, concat('MEM', {s(k)}, case when {k} % 8 = 3 then ' ' else '' end) as source_member_id,
  ' SSN_DOB_NAME ' as match_rule, case when {k} % 11 = 0 then null else true end as is_primary,
  {term} as termination_date, {common}
from {d.t('customer')} where {k} % 15 <> 0
union all
select concat('XWM-', {s(k)}, '-L'), concat('GM-', {s(k)}), ' labs', concat('LAB-', {s(k)}),
  'NAME_DOB', false, cast(null as date), {common}
from {d.t('customer')} where {k} % 4 = 0
union all
select concat('XWM-', {s(k)}, '-C'), concat('GM-', {s(k)}), 'CRM', concat('CRM', {s(k)}),
  'EMAIL', cast(null as boolean), cast(null as date), {common}
from {d.t('customer')} where {k} % 6 = 0
union all
select concat('XWM-', {s(k)}, '-D'), concat('GM-', {s(f"{k} + 1")}), 'qnxt', concat('MEM', {s(k)}),
  'PROBABLE', false, cast(null as date), {common}
from {d.t('customer')} where {k} % 150 = 2
"""


def _golden_provider(d: Dialect) -> str:
    k = "s_suppkey"
    return f"""
select
  concat('GP-', {s(k)}) as golden_provider_id,
  concat(s_name, ' ') as provider_name,
  concat(' 1', lpad({s(k)}, 9, '0')) as npi,
  concat('TX', {s(k)}) as tax_id,
  case when {k} % 2 = 0 then 'pcp' else 'SPC ' end as provider_type,
  concat('SP', {s(f"{k} % 12")}) as primary_specialty,
  cast(concat({s(f"70 + {k} % 30")}, '.', {s(f"{k} % 10")}) as decimal(5,2)) as match_confidence,
  {k} % 20 <> 0 as is_active,
  {d.ts_lit('2000-06-01 00:00:00')} as created_at,
  {d.ts_lit('2001-03-01 00:00:00')} as updated_at,
  {d.ts_lit(LOAD_TS)} as _loaded_at
from {d.t('supplier')}
"""


def _provider_crosswalk(d: Dialect) -> str:
    k = "s_suppkey"
    common = f"""
  cast('97.50' as decimal(5,2)) as match_confidence,
  date '2000-01-01' as effective_date,
  {d.ts_lit('2000-01-01 10:30:00')} as created_at,
  {d.ts_lit(LOAD_TS)} as _loaded_at"""
    return f"""
select concat('XWP-', {s(k)}, '-Q') as crosswalk_id, concat('GP-', {s(k)}) as golden_provider_id,
  'QNXT' as source_system, concat('PROV', {s(k)}) as source_provider_id,
  'NPI_TAXID' as match_rule, case when {k} % 11 = 0 then null else true end as is_primary,
  case when {k} % 30 = 7 then date '2000-12-31' else cast(null as date) end as termination_date, {common}
from {d.t('supplier')} where {k} % 15 <> 0
union all
select concat('XWP-', {s(k)}, '-N'), concat('GP-', {s(k)}), 'nppes ', concat('1', lpad({s(k)}, 9, '0')),
  'NPI', false, cast(null as date), {common}
from {d.t('supplier')} where {k} % 3 = 0
"""


RAW_BUILDERS = {
    "member": (_member, ("customer",)),
    "mbrelig": (_mbrelig, ("customer", "supplier")),
    "provider": (_provider, ("supplier",)),
    "clclaim": (_clclaim, ("orders", "supplier")),
    "clline": (_clline, ("lineitem", "supplier")),
    "cldiag": (_cldiag, ("lineitem",)),
    "clproc": (_clproc, ("lineitem",)),
    "cladjust": (_cladjust, ("events", "orders")),
    "diagcode": (_diagcode, ("part",)),
    "proccode": (_proccode, ("lineitem",)),
    "golden_member": (_golden_member, ("customer",)),
    "member_crosswalk": (_member_crosswalk, ("customer",)),
    "golden_provider": (_golden_provider, ("supplier",)),
    "provider_crosswalk": (_provider_crosswalk, ("supplier",)),
}
RAW_TABLES = tuple(RAW_BUILDERS)
#: Extracts over lines that are numbered within their order.
NUMBERED = {"clline", "cldiag", "clproc"}


def raw_sql(name: str, dialect: Dialect) -> str:
    return RAW_BUILDERS[name][0](dialect)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Landing paths already verified in this process (their inputs are fingerprinted
# into the path, so a verified path never goes stale).
_VERIFIED: set[str] = set()

# Extracts loaded incrementally: landed partitioned by load month so a
# watermark read prunes whole folders (see ``operators.upsert.after_watermark``).
INCREMENTAL_SOURCES = {"clclaim", "clline", "cldiag", "clproc", "cladjust"}
LOAD_PARTITION = "load_month"


def load_month(loaded_at):
    """The folder that a load time belongs to."""
    return F.trunc(F.to_date(loaded_at), "MM")


# Bytes and rows of driver input per landed partition; hot or large extracts get more partitions, never one task.
# Extracts are many times as wide as the rows that they come from, and a segment becomes up to 60 member-months.
LANDING_BYTES = 32 << 20
LANDING_ROWS = 250_000
LANDING_ROWS_OF = {"mbrelig": 25_000}
# The load time of an incremental extract in the rows it comes from, and the ids that spread rows of one load time over range partitions.
SPREAD_KEY = {"clclaim": ("o_orderdate", "o_orderkey"), "cladjust": ("ts", "event_id")} | {
    n: ("l_shipdate", "l_orderkey", "lineseq") for n in ("clline", "cldiag", "clproc")}
# Extracts that are reduced from the driver's rows; all others are written by the tasks that its rows are dealt to.
REDUCED = {"proccode"}


def input_files(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """(path, bytes, modification time) of every file of a table, as Spark's file source lists them.

    Works for any store the cluster reads, and reads no file: one row per file
    of one input table, which the driver lists anyway to plan a scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return sorted((r[0], r[1], str(r[2])) for r in files.select("path", "length", "modificationTime").collect())


class RawSource:
    """Raw extracts over one driver data directory.

    By default every extract is *landed* once as parquet under the shared work
    root (``spark.checkpoint.dir``) - the bronze landing zone - and read back
    from there, exactly as the engine reads real source extracts.  The landing
    path is keyed by the data directory, the driver files' paths, sizes and
    modification times (as Spark's file source reports them) and the text of the derivation rule, so a changed input or rule lands a
    new copy.  A copy counts only once its commit record exists (see ``VersionedTable``).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, land: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.land = land
        self._driver: dict[str, DataFrame] = {}
        self._raw: dict[str, DataFrame] = {}
        self._files: dict[str, list] = {}
        self._rows: dict[str, int] = {}

    @property
    def names(self) -> tuple[str, ...]:
        return RAW_TABLES

    def driver(self, name: str) -> DataFrame:
        if name not in self._driver:
            self._driver[name] = read_driver(self.spark, self.sf_dir, name)
        return self._driver[name]

    def files(self, name: str) -> list[tuple[str, int, str]]:
        if name not in self._files:
            self._files[name] = input_files(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._files[name]

    def partitions(self, name: str) -> int:
        """As many as the bytes of the driver tables ask for, or the rows of the one that it has its rows from."""
        deps = RAW_BUILDERS[name][1]
        size = sum(f[1] for t in deps for f in self.files(t))
        return max(1, -(-size // LANDING_BYTES), -(-self.rows(deps[0]) // LANDING_ROWS_OF.get(name, LANDING_ROWS)))

    def rows(self, name: str) -> int:
        """Rows of a driver table, from its files' footers."""
        if name not in self._rows:
            self._rows[name] = self.driver(name).count()
        return self._rows[name]

    def derived(self, name: str, dealt: bool = False) -> DataFrame:
        """The extract as a lazy plan over the driver tables (no landing).

        With ``dealt`` the driver's rows, a few columns each, are shuffled to the tasks that
        make and write the extract's wide rows from them: by ranges of (load time, hash of the id), so contiguous
        slices of loads and few month folders per task, and a bulk load with one timestamp still
        spreads over all tasks; evenly if it isn't an incremental extract.
        """
        builder, deps = RAW_BUILDERS[name]
        tables = {t: self.driver(t) for t in deps}
        main = deps[0]
        if name in NUMBERED:
            main = "numbered_lines"
            tables[main] = self.spark.sql(_numbering(SPARK), lineitem=tables.pop("lineitem"))
        if dealt and name in INCREMENTAL_SOURCES:
            at, *ids = SPREAD_KEY[name]
            tables[main] = tables[main].repartitionByRange(self.partitions(name), at, F.xxhash64(*ids))
        elif dealt and name not in REDUCED:
            tables[main] = tables[main].repartition(self.partitions(name))
        return self.spark.sql(builder(SPARK), **tables)

    def landing_path(self, name: str) -> str:
        import hashlib

        from ..session import work_root

        _, deps = RAW_BUILDERS[name]
        rule = raw_sql(name, SPARK) + (_numbering(SPARK) if name in NUMBERED else "")
        h = hashlib.md5((rule + ("|by-load-month" if name in INCREMENTAL_SOURCES else "")).encode())
        h.update(self.sf_dir.encode())
        for t in sorted(deps):
            h.update(f"{t}:{self.files(t)}".encode())
        return f"{work_root(self.spark).rstrip('/')}/landing/{name}-{h.hexdigest()[:16]}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._raw:
            if not self.land:
                self._raw[name] = self.derived(name)
            else:
                from .io import VersionedTable

                path = self.landing_path(name)
                table = VersionedTable(self.spark, path)
                if path not in _VERIFIED and table.current_path() is None:
                    df = self.derived(name, dealt=True)
                    parts = None
                    if name in INCREMENTAL_SOURCES:
                        df = df.withColumn(LOAD_PARTITION, load_month(F.col("_loaded_at")))
                        parts = [LOAD_PARTITION]
                    table.write(df, partition_by=parts)
                _VERIFIED.add(path)
                self._raw[name] = self.spark.read.parquet(table.version_path(1))
        return self._raw[name]

    def tables(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in RAW_TABLES}


def duckdb_raw_ctes(names) -> list[tuple[str, str]]:
    """(cte_name, sql) pairs that build the raw extracts in DuckDB."""
    return [(f"raw_{n}", raw_sql(n, DUCKDB)) for n in names]
