"""Column-level cleaning helpers for raw health-plan extracts.

Every helper takes and returns a ``Column`` built only from
``pyspark.sql.functions`` so that expressions stay inside whole-stage codegen.
No Python UDF is used anywhere in this module.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_text(c: ColumnOrName) -> Column:
    return _c(c).cast("string")


# A helper given a plain column *name* emits one SQL expression (one JVM call
# to build) instead of a tree of Column calls; a helper given a Column uses the
# Column API.  Both produce the same Catalyst expression.
def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text_sql(name: str) -> str:
    return f"cast({_ident(name)} as string)"


def _quote(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case_sql(key_sql: str, labels: Mapping[str, str], default_sql: str) -> str:
    whens = " ".join(f"when {_quote(k)} then {_quote(v)}" for k, v in labels.items())
    return f"case {key_sql} {whens} else {default_sql} end"


# --------------------------------------------------------------------------
# Code -> label maps.  These must equal the source system's
# code tables for results to match; they are listed in their natural order.
# --------------------------------------------------------------------------
CLAIM_STATUS_LABELS = {
    "A": "Approved",
    "D": "Denied",
    "P": "Pending",
    "V": "Void",
    "S": "Suspended",
    "I": "In Process",
    "R": "Rejected",
}
GENDER_LABELS = {"M": "Male", "F": "Female", "U": "Unknown"}
MEMBER_STATUS_LABELS = {"A": "Active", "T": "Terminated", "P": "Pending", "C": "Cancelled"}
LINE_OF_BUSINESS_LABELS = {
    "COM": "Commercial",
    "MCD": "Medicaid",
    "MCR": "Medicare",
    "MKT": "Marketplace",
    "SNP": "Special Needs Plan",
}
CLAIM_TYPE_LABELS = {"I": "Institutional", "P": "Professional", "D": "Dental", "R": "Pharmacy"}
DIAGNOSIS_TYPE_LABELS = {"ICD9": "ICD-9-CM", "ICD10": "ICD-10-CM", "9": "ICD-9-CM", "10": "ICD-10-CM"}
PROCEDURE_TYPE_LABELS = {"ICD9": "ICD-9-PCS", "ICD10": "ICD-10-PCS", "9": "ICD-9-PCS", "10": "ICD-10-PCS"}
DIAGNOSIS_SYSTEM_LABELS = {"ICD9": "ICD-9-CM", "ICD10": "ICD-10-CM"}
POA_LABELS = {
    "Y": "Yes - Present on Admission",
    "N": "No - Not Present on Admission",
    "U": "Unknown",
    "W": "Clinically Undetermined",
    "1": "Unreported/Not Used",
}
ENTITY_TYPE_LABELS = {"I": "Individual", "O": "Organization"}
PROVIDER_STATUS_LABELS = {"A": "Active", "T": "Terminated", "P": "Pending", "S": "Suspended"}
# Claim status reference rows: code, name, category, is_final, is_payable.
CLAIM_STATUS_REFERENCE = [
    ("A", "Approved", "Finalized", True, True),
    ("D", "Denied", "Finalized", True, False),
    ("P", "Pending", "In Process", False, False),
    ("V", "Void", "Finalized", True, False),
    ("S", "Suspended", "In Process", False, False),
    ("I", "In Process", "In Process", False, False),
    ("R", "Rejected", "Finalized", True, False),
    ("H", "Hold", "In Process", False, False),
    ("W", "Waiting", "In Process", False, False),
    ("C", "Cancelled", "Finalized", True, False),
]
SUBSCRIBER_RELATIONSHIP_CODES = ("18", "SELF")


def map_code(key: Column, labels: Mapping[str, str], default: Column | str | None) -> Column:
    """Simple CASE ``key WHEN k THEN v ... ELSE default``; NULL key hits ELSE."""
    expr = None
    for code, label in labels.items():
        expr = F.when(key == F.lit(code), F.lit(label)) if expr is None else expr.when(key == F.lit(code), F.lit(label))
    other = F.lit(default) if default is None or isinstance(default, str) else default
    return expr.otherwise(other)


# ----------------------------------------------------------------- strings
def clean_string(c: ColumnOrName) -> Column:
    """Trim spaces; empty string becomes NULL."""
    if isinstance(c, str):
        return F.expr(f"nullif(trim({_text_sql(c)}), '')")
    return F.nullif(F.trim(_as_text(c)), F.lit(""))


def _code_sql(name: str) -> str:
    return f"upper(trim({_text_sql(name)}))"


def normalize_code(c: ColumnOrName) -> Column:
    """``upper(trim(c))`` - used for natural ids and codes."""
    if isinstance(c, str):
        return F.expr(_code_sql(c))
    return F.upper(F.trim(_as_text(c)))


def _mapped(c: ColumnOrName, labels: Mapping[str, str], default: str | None, normalize: bool = True,
            default_raw: bool = False, default_code: bool = False) -> Column:
    """Code -> label over ``upper(trim(c))`` (or the raw text); the ELSE is a
    literal, NULL, the raw input or the normalised code."""
    if isinstance(c, str):
        key = _code_sql(c) if normalize else _text_sql(c)
        if default_raw:
            other = _text_sql(c)
        elif default_code:
            other = _code_sql(c)
        else:
            other = "cast(null as string)" if default is None else _quote(default)
        return F.expr(_case_sql(key, labels, other))
    key = normalize_code(c) if normalize else _as_text(c)
    other = _as_text(c) if default_raw else normalize_code(c) if default_code else default
    return map_code(key, labels, other)


format_member_id = normalize_code
format_provider_id = normalize_code
format_claim_id = normalize_code


def claim_status(c: ColumnOrName) -> Column:
    """Status label from the *raw* code: no trim, no upper (so ' a' is Unknown)."""
    return _mapped(c, CLAIM_STATUS_LABELS, "Unknown", normalize=False)


def gender(c: ColumnOrName) -> Column:
    return _mapped(c, GENDER_LABELS, "Unknown")


def member_status(c: ColumnOrName) -> Column:
    return _mapped(c, MEMBER_STATUS_LABELS, "Unknown")


def line_of_business(c: ColumnOrName) -> Column:
    """Known codes map to names; anything else passes through *unchanged* (untrimmed)."""
    return _mapped(c, LINE_OF_BUSINESS_LABELS, None, default_raw=True)


def claim_type(c: ColumnOrName) -> Column:
    return _mapped(c, CLAIM_TYPE_LABELS, "Unknown")


def diagnosis_type(c: ColumnOrName) -> Column:
    return _mapped(c, DIAGNOSIS_TYPE_LABELS, "Unknown")


def procedure_type(c: ColumnOrName) -> Column:
    return _mapped(c, PROCEDURE_TYPE_LABELS, "Unknown")


def diagnosis_code_system(c: ColumnOrName) -> Column:
    return _mapped(c, DIAGNOSIS_SYSTEM_LABELS, None, default_code=True)


def poa_description(c: ColumnOrName) -> Column:
    return _mapped(c, POA_LABELS, None)


def entity_type(c: ColumnOrName) -> Column:
    return _mapped(c, ENTITY_TYPE_LABELS, "Unknown")


def provider_status(c: ColumnOrName) -> Column:
    return _mapped(c, PROVIDER_STATUS_LABELS, "Unknown")


def yes_flag(c: ColumnOrName) -> Column:
    """'Y' (any case / padding) -> true, everything else including NULL -> false."""
    if isinstance(c, str):
        return F.expr(f"coalesce({_code_sql(c)} = 'Y', false)")
    return F.coalesce(normalize_code(c) == F.lit("Y"), F.lit(False))


def is_valid_npi(c: ColumnOrName) -> Column:
    """Ten digits after trimming.  NULL input gives NULL.

    ``\\z`` anchors at the true end of input: Java's ``$`` would also accept a
    trailing newline.
    """
    t = F.trim(_as_text(c))
    return (F.length(t) == 10) & t.rlike(r"^[0-9]+\z")


def npi_luhn_ok(c: ColumnOrName) -> Column:
    """Extra check (not part of ``is_valid_npi``): NPI Luhn digit with the 80840 prefix."""
    t = F.trim(_as_text(c))
    digits = F.transform(F.split(F.concat(F.lit("80840"), t), ""), lambda d: d.cast("int"))
    # Double every second digit counted from the right-most digit.
    weighted = F.transform(
        F.reverse(digits),
        lambda d, i: F.when(i % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d),
    )
    total = F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x)
    return F.when(is_valid_npi(c), total % 10 == 0)


def standardize_phone(c: ColumnOrName) -> Column:
    return F.regexp_replace(_as_text(c), "[^0-9]", "")


def standardize_zip(c: ColumnOrName) -> Column:
    return F.left(standardize_phone(c), F.lit(5))


def is_subscriber(relationship_code: ColumnOrName) -> Column:
    rc = _c(relationship_code)
    return F.coalesce(rc.isin(*SUBSCRIBER_RELATIONSHIP_CODES), F.lit(False))
