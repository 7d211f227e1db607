"""Raw extract schemas (wide form) and conforming narrow extracts to them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _strings(names: str, loaded_at: bool = True) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names.split()]
    if loaded_at:
        fields.append(T.StructField("_loaded_at", T.TimestampNTZType(), True))
    return T.StructType(fields)


AMOUNTS = "billedamt allowedamt paidamt copayamt coinsamt deductamt cobamt withholdamt"

RAW_SCHEMAS: dict[str, T.StructType] = {
    "member": _strings("memid fname mname lname dob sex ssn medid mcrid altid email language status "
                       "createdate modifydate"),
    "mbrelig": _strings("memid eligid effdate termdate lobid planid planname productid groupid subgroupid covtype "
                        "relation subscriberid pcpid pcpassigndate eligstatus createdate modifydate"),
    "provider": _strings("provid npi taxid license dea upin provname provlname provfname provmname suffix credential "
                         "provtype provtypedesc entitytype taxonomy provstatus effdate termdate createdate modifydate"),
    "clclaim": _strings("claimid memid provid servprovid refprovid facilityid claimtype formtype billtype svcfromdate "
                        "svctodate admitdate dischargedate recvddate processdate paiddate adjuddate claimstatus "
                        f"{AMOUNTS} drg admittype admitsource dischargestatus los authid refnum icn dcn "
                        "createdate modifydate"),
    "clline": _strings("claimid lineseq proccode modifier1 modifier2 modifier3 modifier4 revcode ndc svcfromdate "
                       f"svctodate pos svcunits {AMOUNTS} linestatus diagptr1 diagptr2 diagptr3 diagptr4 servprovid "
                       "createdate modifydate"),
    "cldiag": _strings("claimid diagseq diagcode diagtype poa"),
    "clproc": _strings("claimid procseq proccode proctype procdate"),
    "cladjust": _strings("claimid adjustseq adjustcode adjustdesc adjustgroup adjustamt adjustdate"),
    "diagcode": _strings("diagcode diagdesc diagshortdesc diagtype category categorydesc chapter chapterdesc "
                         "effdate termdate billable header"),
    "proccode": _strings("proccode procdesc proctype"),
}

# The declared source tables by group, each with its declared columns.
# ``claims system`` tables without an extract of their own are declared only.
SOURCES: dict[str, dict[str, str]] = {
    "extracts": {
        "member": "memid fname lname dob sex ssn",
        "mbrelig": "memid eligid effdate termdate lobid planid",
        "mbrenroll": "memid enrollid enrolleffdate enrolltermdate",
        "mbraddress": "memid addrtype addr1 addr2 city state zip",
        "mbrphone": "memid phonetype phone",
        "clclaim": "claimid memid provid svcfromdate svctodate recvddate paiddate claimstatus billedamt allowedamt paidamt claimtype",
        "clline": "claimid lineseq proccode revcode svcunits billedamt allowedamt paidamt pos",
        "cladjust": "claimid adjustseq adjustcode adjustamt adjustdate",
        "cldiag": "claimid diagseq diagcode diagtype",
        "clproc": "claimid procseq proccode proctype",
        "provider": "provid provname npi taxid provtype provstatus",
        "provaddr": "provid addrtype addr1 city state zip",
        "provspec": "provid speccode spectype effdate termdate",
        "provcontract": "provid contractid networkid effdate termdate",
        "provnetwork": "networkid networkname networktype",
        "diagcode": "diagcode diagdesc diagtype effdate termdate",
        "proccode": "proccode procdesc proctype",
        "revcode": "revcode revdesc",
        "postype": "poscode posdesc",
        "claimstatus": "statuscode statusdesc",
    },
    "samples": {"cldiag": "", "clproc": "", "cladjust": ""},
    "identity": {
        "golden_member": "golden_member_id first_name last_name date_of_birth gender ssn match_confidence merge_history is_active "
                         "created_at updated_at _loaded_at",
        "golden_provider": "golden_provider_id provider_name npi tax_id provider_type primary_specialty match_confidence is_active "
                           "created_at updated_at _loaded_at",
        "member_crosswalk": "crosswalk_id golden_member_id source_system source_member_id match_confidence match_rule is_primary "
                            "effective_date termination_date created_at _loaded_at",
        "provider_crosswalk": "crosswalk_id golden_provider_id source_system source_provider_id match_confidence match_rule is_primary "
                              "effective_date termination_date created_at _loaded_at",
    },
}


def source_profile(sources: Mapping[str, DataFrame]) -> DataFrame:
    """The registry against what has arrived: a row per declared or arrived column.

    ``state`` is matched, missing (declared, not in the arrived table), undeclared
    (arrived, not declared; tables declared without columns take any) or absent (the table hasn't arrived);
    ``rows`` and ``filled`` (values that are not null) come from one pass over each table.
    """
    parts = []
    for group, tables in SOURCES.items():
        for name, text in tables.items():
            declared, df = text.split(), sources.get(name)
            here = df.columns if df is not None else []
            columns = list(dict.fromkeys([*declared, *(c for c in here if c != LOAD_FOLDER)]))
            if not columns:  # declared by name alone, and not arrived
                continue
            state = {c: "absent" if df is None else "missing" if c not in here else "matched" if not declared or c in declared else "undeclared"
                     for c in columns}
            told = [F.struct(F.lit(group).alias("source_group"), F.lit(name).alias("source_name"), F.lit(c).alias("column_name"),
                             F.lit(state[c]).alias("state"), (F.col("rows") if df is not None else F.lit(None).cast("long")).alias("rows"),
                             (F.col(f"filled_{i}") if c in here else F.lit(None).cast("long")).alias("filled")) for i, c in enumerate(columns)]
            if df is None:
                spark = next(iter(sources.values())).sparkSession
                one = spark.range(1)
            else:
                one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"filled_{i}") for i, c in enumerate(columns) if c in here])
            parts.append(one.select(F.inline(F.array(*told))))
    return reduce(DataFrame.unionByName, parts)


#: The folder column that landed incremental extracts have besides their own.
LOAD_FOLDER = "load_month"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: present columns are cast, absent ones become typed NULLs.

    Column order follows the schema; extra columns of ``df`` are dropped.
    """
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def read_csv_seed(spark, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema (never inferred); doubled quotes escape quotes."""
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .schema(schema).csv(path))


# The default eligibility segment the source setup derives for
# every member that arrives without one (eligibility id = member id + suffix).
DEFAULT_SEGMENT = {
    "eligid_suffix": "-ELIG001",
    "effdate": "20240101",
    "termdate": "20241231",
    "lobid": "COM",
    "planid": "PLAN001",
    "planname": "Commercial Plan 001",
    "productid": "PROD001",
    "groupid": "GRP001",
    "covtype": "MED",
    "relation": "S",
    "eligstatus": "A",
}


def default_eligibility(members: DataFrame, load_ts: str) -> DataFrame:
    """One wide eligibility extract row per member row, from the fixed defaults.

    ``load_ts`` (ISO text) replaces the load-time clock, so reruns are identical.
    """
    d = DEFAULT_SEGMENT
    ts = F.lit(load_ts)
    rows = members.select(
        F.col("memid"),
        F.concat(F.col("memid"), F.lit(d["eligid_suffix"])).alias("eligid"),
        *[F.lit(d[c]).alias(c) for c in ("effdate", "termdate", "lobid", "planid", "planname", "productid",
                                          "groupid")],
        F.lit(None).cast("string").alias("subgroupid"),
        F.lit(d["covtype"]).alias("covtype"),
        F.lit(d["relation"]).alias("relation"),
        F.col("memid").alias("subscriberid"),
        F.lit(None).cast("string").alias("pcpid"),
        F.lit(None).cast("string").alias("pcpassigndate"),
        F.lit(d["eligstatus"]).alias("eligstatus"),
        ts.alias("createdate"),
        ts.alias("modifydate"),
        ts.cast("timestamp_ntz").alias("_loaded_at"),
    )
    return conform(rows, RAW_SCHEMAS["mbrelig"])
