"""Silver layer: conformed dimensions and claim facts.

Plan notes (scale):
* Dimension lookups join on narrow ``(id, key)`` projections; Catalyst prunes
  every other column before the exchange, and AQE turns a lookup into a
  broadcast join only when the *measured* side is below
  ``spark.sql.autoBroadcastJoinThreshold``.  No lookup is broadcast by hint,
  because member and provider dimensions grow with the data.
* Latest eligibility and the eligibility summary come out of ONE aggregation
  keyed by member_id; top-1 is ``max(struct(...))``, which combines map-side,
  so a member with a huge number of segments never lands in one sort.
* Line roll-up is aggregated before it meets the claim header (no fan-out) and
  both sides end hash-partitioned by claim_id.
* Crosswalk -> golden joins are resolved once per identity type, combined with
  the legacy key of the same source id, and reused for every role: the wide
  conformed fact meets 5 joins instead of 13.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators.skew import split_join

OPEN_END = dt.date(9999, 12, 31)

# The golden dimensions publish source-specific columns with the
# prefix ``qnxt_`` (qnxt_member_id, is_qnxt_primary, qnxt_status_code, ...) and
# filter the crosswalk on the source system 'QNXT' by default.  Both are part of
# the published schema / data contract, so they are kept verbatim.


# ------------------------------------------------------------------ dim_date
def date_spine(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def dim_date_from_bounds(bounds: DataFrame, as_of: dt.date) -> DataFrame:
    """Calendar rows for every day between ``bounds.start_date`` and ``bounds.end_date``.

    ``bounds`` is a one-row frame, so the explode runs in one task and yields
    at most a few thousand rows per decade.
    """
    today = fx.as_date(as_of)
    d = F.col("date_day")
    dow = fx.day_of_week_sun0(d)
    days = bounds.select(date_spine(F.col("start_date"), F.col("end_date")).alias("date_day"))
    return days.select(
        d.alias("date_key"),
        d,
        dow.alias("day_of_week"),
        F.dayname(d).alias("day_of_week_name"),
        F.substring(F.dayname(d), 1, 3).alias("day_of_week_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_add(d, (1 - dow).cast("int")).alias("week_start_date"),
        F.date_add(d, (7 - dow).cast("int")).alias("week_end_date"),
        F.month(d).alias("month_of_year"),
        F.monthname(d).alias("month_name"),
        F.substring(F.monthname(d), 1, 3).alias("month_name_short"),
        fx.month_start(d).alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.quarter(d).alias("quarter_of_year"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        fx.quarter_end(d).alias("quarter_end_date"),
        F.year(d).alias("year_number"),
        F.trunc(d, "year").alias("year_start_date"),
        fx.year_end(d).alias("year_end_date"),
        F.month(d).alias("fiscal_month_of_year"),
        F.quarter(d).alias("fiscal_quarter_of_year"),
        F.year(d).alias("fiscal_year_number"),
        F.coalesce(dow.isin(0, 6), F.lit(False)).alias("is_weekend"),
        F.coalesce(~dow.isin(0, 6), F.lit(False)).alias("is_weekday"),
        (d == today).alias("is_today"),
        fx.days_between(d, today).alias("days_ago"),
        fx.weeks_between_boundaries(d, today).alias("weeks_ago"),
        fx.months_between_boundaries(d, today).alias("months_ago"),
        fx.years_between_boundaries(d, today).alias("years_ago"),
        fx.year_month(d).alias("year_month"),
        F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.date_format(d, "MMM yyyy").alias("month_year_name"),
    )


def dim_date(spark: SparkSession, start: dt.date, end: dt.date, as_of: dt.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    return dim_date_from_bounds(bounds, as_of)


def claim_calendar_bounds(claims: DataFrame) -> DataFrame:
    """Whole calendar years covering every service date of the staged claims."""
    return claims.agg(
        F.trunc(F.min("service_from_date"), "year").alias("start_date"),
        fx.year_end(F.max(F.greatest("service_from_date", "service_to_date"))).alias("end_date"),
    )


# ------------------------------------------------------------ eligibility
ELIG_PAYLOAD = [
    "eligibility_id", "lob_id", "line_of_business", "plan_id", "plan_name", "product_id", "group_id",
    "subgroup_id", "coverage_type", "relationship_code", "subscriber_id", "pcp_provider_id",
    "eligibility_status_code",
]


def _latest_struct(elig: DataFrame) -> Column:
    # Field order is the sort order: effective desc, termination desc (NULLs
    # sort lowest in a struct max, i.e. last), then eligibility_id and the
    # rest as deterministic tie-breaks.
    return F.max(F.struct("effective_date", "termination_date", *ELIG_PAYLOAD)).alias("latest")


def eligibility_by_member(elig: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per member: the latest segment plus the segment summary."""
    eff, term = F.col("effective_date"), F.col("termination_date")
    months = (
        F.when(eff.isNull(), F.lit(0))
        .when(term.isNull(), fx.member_months(eff, fx.as_date(as_of)))
        .otherwise(fx.member_months(eff, term))
    )
    return elig.groupBy("member_id").agg(
        _latest_struct(elig),
        F.count_distinct("eligibility_id").alias("total_eligibility_segments"),
        F.min(eff).alias("first_effective_date"),
        F.max(F.coalesce(term, F.lit(OPEN_END))).alias("last_termination_date"),
        F.sum(months).alias("total_member_months"),
    )


def latest_eligibility(elig: DataFrame) -> DataFrame:
    latest = elig.groupBy("member_id").agg(_latest_struct(elig))
    return latest.select("member_id", "latest.*")


def eligibility_summary(elig: DataFrame, as_of: dt.date) -> DataFrame:
    return eligibility_by_member(elig, as_of).drop("latest")


def dim_member(members: DataFrame, elig: DataFrame, as_of: dt.date) -> DataFrame:
    e = eligibility_by_member(elig, as_of)
    m = members.alias("m")
    j = m.join(e.alias("e"), F.col("m.member_id") == F.col("e.member_id"), "left")
    le = lambda c: F.col(f"e.latest.{c}")
    return j.select(
        fx.surrogate_key(F.col("m.member_id")).alias("member_key"),
        F.col("m.member_id"),
        "m.first_name", "m.middle_name", "m.last_name",
        F.concat(F.col("m.first_name"), F.lit(" "), F.col("m.last_name")).alias("full_name"),
        "m.date_of_birth",
        fx.age_years("m.date_of_birth", as_of).alias("current_age"),
        "m.gender_code", "m.gender", "m.ssn", "m.medicaid_id", "m.medicare_id", "m.email",
        "m.preferred_language", "m.status_code", "m.member_status",
        le("eligibility_id").alias("current_eligibility_id"),
        le("effective_date").alias("current_elig_effective_date"),
        le("termination_date").alias("current_elig_termination_date"),
        le("lob_id").alias("current_lob_id"),
        le("line_of_business").alias("current_line_of_business"),
        le("plan_id").alias("current_plan_id"),
        le("plan_name").alias("current_plan_name"),
        le("product_id").alias("current_product_id"),
        le("group_id").alias("current_group_id"),
        le("coverage_type").alias("current_coverage_type"),
        le("relationship_code").alias("relationship_code"),
        le("subscriber_id").alias("subscriber_id"),
        le("pcp_provider_id").alias("current_pcp_provider_id"),
        "e.total_eligibility_segments", "e.first_effective_date", "e.last_termination_date",
        "e.total_member_months",
        # A member without any segment has no end date and therefore counts as eligible.
        F.coalesce(
            le("termination_date").isNull() | (le("termination_date") >= fx.as_date(as_of)), F.lit(False)
        ).alias("is_currently_eligible"),
        fx.is_subscriber(le("relationship_code")).alias("is_subscriber"),
        "m.created_at", "m.updated_at",
    )


# ---------------------------------------------------------------- providers
def dim_provider(providers: DataFrame, as_of: dt.date) -> DataFrame:
    last, first, cred = F.col("provider_last_name"), F.col("provider_first_name"), F.col("credential")
    individual_name = F.concat(
        F.coalesce(last, F.lit("")),
        F.when(first.isNotNull(), F.concat(F.lit(", "), first)).otherwise(F.lit("")),
        F.when(cred.isNotNull(), F.concat(F.lit(", "), cred)).otherwise(F.lit("")),
    )
    term = F.col("termination_date")
    return providers.select(
        fx.surrogate_key("provider_id").alias("provider_key"),
        "provider_id", "npi", "tax_id", "license_number", "dea_number", "upin", "provider_name",
        "provider_last_name", "provider_first_name", "provider_middle_name", "suffix", "credential",
        # Tests the cleaned, not upper-cased, entity code ('i' keeps provider_name).
        F.when(F.col("entity_type_code") == "I", individual_name).otherwise(F.col("provider_name")).alias("display_name"),
        "provider_type_code", "provider_type", "entity_type_code", "entity_type", "taxonomy_code",
        "provider_status_code", "provider_status", "effective_date", "termination_date",
        F.coalesce(
            (F.col("provider_status_code") == "A") & (term.isNull() | (term >= fx.as_date(as_of))), F.lit(False)
        ).alias("is_active"),
        "is_valid_npi", "created_at", "updated_at",
    )


def dim_diagnosis(codes: DataFrame, as_of: dt.date) -> DataFrame:
    eff, term, today = F.col("effective_date"), F.col("termination_date"), fx.as_date(as_of)
    return codes.select(
        fx.surrogate_key("diagnosis_code", "diagnosis_code_type").alias("diagnosis_key"),
        "diagnosis_code", "diagnosis_description", "diagnosis_short_description", "diagnosis_code_type",
        "diagnosis_code_system", "category_code", "category_description", "chapter_code", "chapter_description",
        F.when(F.col("diagnosis_code_type") == "ICD10", F.left("diagnosis_code", F.lit(3))).alias("mdc_code"),
        "effective_date", "termination_date",
        F.coalesce((eff.isNull() | (eff <= today)) & (term.isNull() | (term >= today)), F.lit(False)).alias("is_current"),
        "is_billable", "is_header",
    )


# ------------------------------------------------------------ golden dims
def identity_summary(crosswalk: DataFrame, golden_id: str) -> DataFrame:
    """Per golden id: distinct systems, their sorted list, and link count."""
    return crosswalk.groupBy(golden_id).agg(
        F.count_distinct("source_system").alias("source_system_count"),
        F.array_join(F.array_sort(F.collect_set("source_system")), ", ").alias("source_systems"),
        F.count(F.lit(1)).alias("total_crosswalk_links"),
    )


def dim_golden_member(golden: DataFrame, crosswalk: DataFrame, members: DataFrame, as_of: dt.date,
                      source_system: str = "QNXT") -> DataFrame:
    record = golden.filter(F.col("is_active") == True).alias("record")  # noqa: E712
    xw = crosswalk.filter(F.col("is_active") == True)  # noqa: E712
    link = xw.filter(F.col("source_system") == source_system).select(
        "golden_member_id", F.col("source_member_id").alias("qnxt_member_id"),
        F.col("is_primary").alias("is_qnxt_primary"),
    ).alias("link")
    own = members.select("member_id", "medicaid_id", "medicare_id", "email", "preferred_language",
                        "status_code", "member_status").alias("own")
    systems = identity_summary(xw, "golden_member_id").alias("systems")
    j = (record.join(link, F.col("record.golden_member_id") == F.col("link.golden_member_id"), "left")
           .join(own, F.col("link.qnxt_member_id") == F.col("own.member_id"), "left")
           .join(systems, F.col("record.golden_member_id") == F.col("systems.golden_member_id"), "left"))
    return j.select(
        fx.surrogate_key(F.col("record.golden_member_id")).alias("golden_member_key"),
        F.col("record.golden_member_id"), "link.qnxt_member_id", "link.is_qnxt_primary",
        "record.first_name", "record.last_name",
        F.concat(F.col("record.first_name"), F.lit(" "), F.col("record.last_name")).alias("full_name"),
        "record.date_of_birth", fx.age_years("record.date_of_birth", as_of).alias("current_age"),
        "record.gender_code", "record.gender", "record.ssn",
        "own.medicaid_id", "own.medicare_id", "own.email", "own.preferred_language",
        F.col("own.status_code").alias("qnxt_status_code"), F.col("own.member_status").alias("qnxt_member_status"),
        "record.match_confidence", "systems.source_system_count", "systems.source_systems", "systems.total_crosswalk_links",
        F.col("record.is_active").alias("is_golden_active"),
        F.col("own.member_id").isNotNull().alias("has_qnxt_record"),
        F.col("record.created_at").alias("golden_created_at"), F.col("record.updated_at").alias("golden_updated_at"),
    )


def dim_golden_provider(golden: DataFrame, crosswalk: DataFrame, providers: DataFrame,
                        source_system: str = "QNXT") -> DataFrame:
    record = golden.filter(F.col("is_active") == True).alias("record")  # noqa: E712
    xw = crosswalk.filter(F.col("is_active") == True)  # noqa: E712
    link = xw.filter(F.col("source_system") == source_system).select(
        "golden_provider_id", F.col("source_provider_id").alias("qnxt_provider_id"),
        F.col("is_primary").alias("is_qnxt_primary"),
    ).alias("link")
    own = providers.select(
        "provider_id", F.col("provider_name").alias("qnxt_provider_name"),
        F.col("provider_type_code").alias("qnxt_provider_type_code"),
        F.col("provider_type").alias("qnxt_provider_type"), "provider_status_code",
        F.col("taxonomy_code").alias("qnxt_taxonomy_code"),
        F.coalesce(F.col("provider_status_code") == "A", F.lit(False)).alias("is_qnxt_active"),
    ).alias("own")
    systems = identity_summary(xw, "golden_provider_id").alias("systems")
    j = (record.join(link, F.col("record.golden_provider_id") == F.col("link.golden_provider_id"), "left")
           .join(own, F.col("link.qnxt_provider_id") == F.col("own.provider_id"), "left")
           .join(systems, F.col("record.golden_provider_id") == F.col("systems.golden_provider_id"), "left"))
    return j.select(
        fx.surrogate_key(F.col("record.golden_provider_id")).alias("golden_provider_key"),
        F.col("record.golden_provider_id"), "link.qnxt_provider_id", "link.is_qnxt_primary",
        "record.provider_name", "record.npi", "record.tax_id", "record.provider_type_code", "record.primary_specialty_code",
        "own.qnxt_provider_name", "own.qnxt_provider_type_code", "own.qnxt_provider_type",
        F.col("own.provider_status_code").alias("qnxt_status_code"), "own.qnxt_taxonomy_code", "own.is_qnxt_active",
        "record.match_confidence", "systems.source_system_count", "systems.source_systems", "systems.total_crosswalk_links",
        F.col("record.is_active").alias("is_golden_active"),
        F.col("own.provider_id").isNotNull().alias("has_qnxt_record"),
        F.col("record.created_at").alias("golden_created_at"), F.col("record.updated_at").alias("golden_updated_at"),
    )


# ------------------------------------------------------------------- facts
#: The columns of a line that its roll-up reads.
ROLLED = ["claim_id", "billed_amount", "allowed_amount", "paid_amount", "service_units"]


def line_rollup(lines: DataFrame) -> DataFrame:
    """Per-claim line count and unit total (pre-aggregated before the join)."""
    return lines.groupBy("claim_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        fx.sum_money("billed_amount").alias("total_line_billed"),
        fx.sum_money("allowed_amount").alias("total_line_allowed"),
        fx.sum_money("paid_amount").alias("total_line_paid"),
        fx.sum_money("service_units").alias("total_service_units"),
    )


def _claim_measures(c: str = "c") -> list:
    col = lambda n: F.col(f"{c}.{n}")
    return [
        (col("copay_amount") + col("coinsurance_amount") + col("deductible_amount")).alias("member_responsibility_amount"),
        (col("paid_amount") - col("withhold_amount")).alias("net_paid_amount"),
        (col("billed_amount") - col("allowed_amount")).alias("discount_amount"),
    ]


_DATES = ["service_from_date", "service_to_date", "admit_date", "discharge_date", "received_date",
          "processed_date", "paid_date", "adjudicated_date"]
_AMOUNTS = ["billed_amount", "allowed_amount", "paid_amount", "copay_amount", "coinsurance_amount",
            "deductible_amount", "cob_amount", "withhold_amount"]
_INSTITUTIONAL = ["drg_code", "admit_type", "admit_source", "discharge_status", "length_of_stay"]
_REFS = ["authorization_id", "reference_number", "internal_control_number", "document_control_number"]


def _claim_flags_and_metrics() -> list:
    c = lambda n: F.col(f"c.{n}")
    flag = lambda cond: F.coalesce(cond, F.lit(False))
    return [
        F.coalesce(c("line_count"), F.lit(0)).alias("line_count"),
        F.coalesce(c("total_service_units"), F.lit(0).cast(fx.MONEY_SUM)).alias("total_service_units"),
        flag(c("claim_status_code") == "A").alias("is_approved"),
        flag(c("claim_status_code") == "D").alias("is_denied"),
        flag(c("claim_status_code") == "P").alias("is_pending"),
        flag(c("paid_amount") > 0).alias("is_paid"),
        flag(c("claim_type_code") == "I").alias("is_institutional"),
        flag(c("claim_type_code") == "P").alias("is_professional"),
    ]


def _claim_day_metrics() -> list:
    c = lambda n: F.col(f"c.{n}")
    return [
        fx.days_between(c("received_date"), c("processed_date")).alias("days_to_process"),
        fx.days_between(c("processed_date"), c("paid_date")).alias("days_to_pay"),
        fx.days_between(c("received_date"), c("paid_date")).alias("days_to_final"),
        (fx.days_between(c("service_from_date"), c("service_to_date")) + 1).alias("service_days"),
    ]


# Which id of the claim header each role looks up, and among whose ids.
ROLES = (("member", "member", "member_id"), ("billing", "provider", "billing_provider_id"),
         ("servicing", "provider", "servicing_provider_id"), ("referring", "provider", "referring_provider_id"))


def key_links(dim: DataFrame, kind: str, id_col: str, key_col: str) -> DataFrame:
    """(kind, id, link) rows of a dimension, a link being its key."""
    return dim.select(F.lit(kind).alias("kind"), F.col(id_col).alias("id"), F.struct(F.col(key_col).alias("key")).alias("link"))


def _row_ids() -> Column:
    """Tells rows of one claim with other ids apart (eight bytes instead of four ids)."""
    return F.xxhash64(*[F.coalesce(F.col(col), F.lit("\0")) for _, _, col in ROLES])


def role_ids(claims: DataFrame) -> DataFrame:
    """claim_id, row, role, kind, id: the ids of all roles, without NULLs (an optional role's NULLs never form a hot key)."""
    roles = F.explode(F.array(*[F.struct(F.lit(role).alias("role"), F.lit(kind).alias("kind"), F.col(col).alias("id")) for role, kind, col in ROLES]))
    ids = claims.filter(F.col("claim_id").isNotNull()).select("claim_id", _row_ids().alias("row"), roles.alias("r"))
    return ids.select("claim_id", "row", "r.*").filter(F.col("id").isNotNull())


#: From so many ids with links on, their lookup isn't a broadcast.
WIDE_LINKS = 250_000


def link_profile(links: DataFrame) -> tuple[list[str], int]:
    """The kinds that have an id with several links, and the number of ids (a job over the links; one row per kind reaches the driver)."""
    per_id = links.filter(F.col("id").isNotNull()).groupBy("kind", "id").count()
    kinds = per_id.groupBy("kind").agg(F.count(F.lit(1)).alias("ids"), F.max("count").alias("most")).collect()
    return sorted(r.kind for r in kinds if r.most > 1), sum(r.ids for r in kinds)


def fanned_kinds(links: DataFrame) -> list[str]:
    return link_profile(links)[0]


def lookup_plan(links: DataFrame, tasks: int) -> dict:
    """How ``resolve_roles`` looks these links up, for claims that lie in ``tasks`` parts by claim_id."""
    fanned, ids = link_profile(links)
    return {"fanned": fanned, "dealt": tasks if ids >= WIDE_LINKS else None}


def resolve_roles(claims: DataFrame, lines: DataFrame, links: DataFrame, busy=(), fanned=None, dealt: int | None = None) -> DataFrame:
    """Claims (alias ``c``) with their line roll-up and one struct per role (NULL: no link).

    An id with one link is a lookup: its link comes back as a scalar of its role,
    by one aggregation per claim.  The few ids with several links are joined
    apart, a row per link, and fan a claim out as a left join would; the links of an id are
    never gathered.  Every join of the wide header is on ``claim_id``, so a header stored in buckets
    of it (``Warehouse.by_claim``) isn't shuffled.  ``busy`` are the heavy ids of the
    claims (``skew.heavy_keys`` of ``role_ids``), which are looked up in pieces.  ``fanned`` are the kinds that have
    ids with several links (``fanned_kinds``; None: any may); the ids of other kinds aren't shuffled a second time to look for them.
    With ``dealt``, what was found is dealt to so many parts by claim_id at once, where it is gathered and meets the header;
    otherwise it is shuffled by claim and row to be gathered, and again to meet it, unless the lookup is a broadcast.
    """
    key = ["kind", "id"]
    held = links.schema["link"].dataType.names
    links = links.withColumn("link", F.struct(*[fx.packed(f"link.{n}").alias(n) for n in held]))  # hashes are short on their way to the claims
    known = links.filter(F.col("id").isNotNull())
    per_id = known.groupBy(*key).agg(F.count(F.lit(1)).alias("links"), F.max("link").alias("link"))
    ids = role_ids(claims)
    met = split_join(ids, per_id.filter(F.col("links") == 1).drop("links"), key, busy)
    if dealt:
        met = met.repartition(dealt, "claim_id")
    single = met.groupBy("claim_id", "row").agg(*[F.max(F.when(F.col("role") == role, F.col("link"))).alias(role) for role, _, _ in ROLES])
    several = known.join(per_id.filter(F.col("links") > 1).select(*key), key, "left_semi")
    rolled = line_rollup(lines).filter(F.col("claim_id").isNotNull())
    j = claims.withColumn("own_row", _row_ids()).alias("c").join(rolled.alias("cl"), F.col("c.claim_id") == F.col("cl.claim_id"), "left")

    def same(claim: str, row: str) -> Column:
        # Two comparisons, not an equality, so that claim_id alone stays the key on which both sides lie together.
        return (F.col("c.claim_id") == F.col(claim)) & (F.col("c.own_row") >= F.col(row)) & (F.col("c.own_row") <= F.col(row))

    j = j.join(single.alias("one"), same("one.claim_id", "one.row"), "left")
    may_fan = {role for role, kind, _ in ROLES if fanned is None or kind in fanned}
    for role, kind, _ in ROLES:
        if role not in may_fan:
            continue
        fan = split_join(ids.filter(F.col("role") == role), several.filter(F.col("kind") == kind), key, [b for b in busy if b[0] == kind])
        fan = fan.select(*[F.col(c).alias(f"{role}_{c}") for c in ("claim_id", "row", "link")])
        j = j.join(fan, same(f"{role}_claim_id", f"{role}_row"), "left")
    linked = [(F.coalesce(F.col(f"{role}_link"), F.col(f"one.{role}")) if role in may_fan else F.col(f"one.{role}")).alias(role) for role, _, _ in ROLES]
    j = j.select("c.*", F.col("cl.line_count"), F.col("cl.total_service_units"), *linked).drop("own_row")
    text = {role: F.when(F.col(role).isNotNull(), F.struct(*[fx.unpacked(f"{role}.{n}").alias(n) for n in held])) for role, _, _ in ROLES}
    return j.withColumns(text).alias("c")


def legacy_links(members: DataFrame, providers: DataFrame) -> DataFrame:
    """The links of member and provider ids to the keys of their dimensions."""
    return key_links(members, "member", "member_id", "member_key").unionByName(
        key_links(providers, "provider", "provider_id", "provider_key"))


def fct_claim(claims: DataFrame, lines: DataFrame, members: DataFrame, providers: DataFrame, busy=(), fanned=None, dealt: int | None = None) -> DataFrame:
    j = resolve_roles(claims, lines, legacy_links(members, providers), busy, fanned, dealt)
    cc = lambda n: F.col(f"c.{n}")
    return j.select(
        fx.surrogate_key(cc("claim_id")).alias("claim_key"),
        cc("claim_id"),
        F.col("member.key").alias("member_key"),
        F.col("billing.key").alias("billing_provider_key"),
        F.col("servicing.key").alias("servicing_provider_key"),
        F.col("referring.key").alias("referring_provider_key"),
        cc("member_id"), cc("billing_provider_id"), cc("servicing_provider_id"), cc("referring_provider_id"),
        cc("facility_id"),
        *[cc(n) for n in _DATES],
        cc("claim_type_code"), cc("claim_type"), cc("form_type"), cc("bill_type"),
        cc("claim_status_code"), cc("claim_status"),
        *[cc(n) for n in _AMOUNTS],
        *_claim_measures(),
        *[cc(n) for n in _INSTITUTIONAL],
        *[cc(n) for n in _REFS],
        *_claim_flags_and_metrics(),
        *_claim_day_metrics(),
        cc("created_at"), cc("updated_at"),
    )


def golden_resolution(crosswalk: DataFrame, golden_dim: DataFrame, kind: str, source_system: str = "QNXT") -> DataFrame:
    """source id -> (golden id, golden key), crosswalk and golden dim pre-joined once."""
    src, gid, gkey = f"source_{kind}_id", f"golden_{kind}_id", f"golden_{kind}_key"
    xw = crosswalk.filter((F.col("source_system") == source_system) & (F.col("is_active") == True))  # noqa: E712
    xw = xw.select(F.col(src).alias("id"), F.col(gid).alias("gid")).alias("x")
    g = golden_dim.select(F.col(gid).alias("g_id"), F.col(gkey).alias("gkey")).alias("g")
    return xw.join(g, F.col("x.gid") == F.col("g.g_id"), "left").select("x.id", "x.gid", "g.gkey")


def identity_links(legacy: DataFrame, resolution: DataFrame) -> DataFrame:
    """(kind, id, link): legacy key, golden id and golden key of each source id.

    Full outer join of the two id-keyed sides of all kinds at once.  Ids on one
    side only keep NULLs for the other; several crosswalk links of an id fan out.
    """
    a, b = legacy.alias("l"), resolution.alias("r")
    j = a.join(b, (F.col("l.kind") == F.col("r.kind")) & (F.col("l.id") == F.col("r.id")), "full")
    return j.select(F.coalesce("l.kind", "r.kind").alias("kind"), F.coalesce("l.id", "r.id").alias("id"),
                    F.struct(F.col("l.link.key").alias("legacy_key"), F.col("r.gid").alias("gid"), F.col("r.gkey").alias("gkey")).alias("link"))


def conformed_links(member_xw: DataFrame, provider_xw: DataFrame, golden_members: DataFrame, golden_providers: DataFrame,
                    members: DataFrame, providers: DataFrame, source_system: str = "QNXT") -> DataFrame:
    """The links of member and provider ids to their legacy keys, golden ids and golden keys."""
    golden = [golden_resolution(xw, dim, kind, source_system).withColumn("kind", F.lit(kind))
              for xw, dim, kind in ((member_xw, golden_members, "member"), (provider_xw, golden_providers, "provider"))]
    return identity_links(legacy_links(members, providers), golden[0].unionByName(golden[1]))


def fct_claim_conformed(claims: DataFrame, lines: DataFrame, member_xw: DataFrame, provider_xw: DataFrame,
                        golden_members: DataFrame, golden_providers: DataFrame, members: DataFrame,
                        providers: DataFrame, source_system: str = "QNXT", busy=(), fanned=None,
                        dealt: int | None = None) -> DataFrame:
    """Claim fact with golden and legacy keys for the member and three provider roles."""
    links = conformed_links(member_xw, provider_xw, golden_members, golden_providers, members, providers, source_system)
    j = resolve_roles(claims, lines, links, busy, fanned, dealt)
    cc = lambda n: F.col(f"c.{n}")
    return j.select(
        fx.surrogate_key(cc("claim_id")).alias("claim_key"),
        cc("claim_id"),
        F.col("member.gid").alias("member_golden_id"), F.col("member.gkey").alias("golden_member_key"),
        F.col("billing.gid").alias("billing_provider_golden_id"), F.col("billing.gkey").alias("billing_provider_golden_key"),
        F.col("servicing.gid").alias("servicing_provider_golden_id"), F.col("servicing.gkey").alias("servicing_provider_golden_key"),
        F.col("referring.gid").alias("referring_provider_golden_id"), F.col("referring.gkey").alias("referring_provider_golden_key"),
        cc("member_id").alias("source_member_id"), F.col("member.legacy_key").alias("legacy_member_key"),
        cc("billing_provider_id").alias("source_billing_provider_id"),
        F.col("billing.legacy_key").alias("legacy_billing_provider_key"),
        cc("servicing_provider_id").alias("source_servicing_provider_id"),
        F.col("servicing.legacy_key").alias("legacy_servicing_provider_key"),
        cc("referring_provider_id").alias("source_referring_provider_id"),
        F.col("referring.legacy_key").alias("legacy_referring_provider_key"),
        cc("facility_id"),
        *[cc(n) for n in _DATES],
        cc("claim_type_code"), cc("claim_type"), cc("form_type"), cc("bill_type"),
        cc("claim_status_code"), cc("claim_status"),
        *[cc(n) for n in _AMOUNTS],
        *_claim_measures(),
        *[cc(n) for n in _INSTITUTIONAL],
        *[cc(n) for n in _REFS],
        *_claim_flags_and_metrics(),
        F.col("member.gid").isNotNull().alias("has_golden_member"),
        F.col("billing.gid").isNotNull().alias("has_golden_billing_provider"),
        F.col("servicing.gid").isNotNull().alias("has_golden_servicing_provider"),
        *_claim_day_metrics(),
        cc("created_at"), cc("updated_at"),
    )
