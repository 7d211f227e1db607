"""Multi-run scenarios over data derived from the driver tables.

* Incremental: the adjustments extract is split by load time into two batches;
  batch 2 also carries later corrections of batch-1 keys and one row whose
  load time equals the watermark (it must be skipped).  Both go through the stored table.
* Snapshots: three runs of member / eligibility / provider sources where some
  keys change, some disappear, some appear and some come back.

Selection uses characters of the natural key, so the same rule is easy to
state in SQL and costs nothing to evaluate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ntz_lit
from ..operators import scd2, upsert
from . import staging

BATCH_SPLIT = dt.datetime(2024, 1, 16)
SNAPSHOT_RUNS = (dt.datetime(2001, 6, 1), dt.datetime(2001, 6, 15), dt.datetime(2001, 7, 1))


# ------------------------------------------------------------ incremental
def adjustment_batches(raw_adjust: DataFrame) -> tuple[DataFrame, DataFrame]:
    ts = F.col("_loaded_at")
    split = ntz_lit(BATCH_SPLIT)
    b1 = raw_adjust.filter(ts < split)
    later = raw_adjust.filter(ts >= split)
    corrections = (b1.filter(F.col("adjustseq").cast("bigint") % 50 == 0)
                     .withColumn("adjustgroup", F.lit("CR"))
                     .withColumn("adjustdesc", F.lit("Corrected"))
                     .withColumn("_loaded_at", ts + F.expr("interval 20 days")))
    at_watermark = (b1.join(b1.agg(F.max("_loaded_at").alias("_wm")), ts == F.col("_wm"), "left_semi")
                      .withColumn("adjustdesc", F.lit("Late duplicate")))
    return b1, later.unionByName(upsert.reload_month(corrections)).unionByName(at_watermark)


ADJUST_KEY = "claim_adjustment_id"


def first_adjustments(spark, raw_adjust: DataFrame, root: str) -> tuple[upsert.IncrementalTable, DataFrame]:
    """The stored adjustments after their first load, and the second batch."""
    first, second = adjustment_batches(raw_adjust)
    table = upsert.IncrementalTable(spark, "stg_cladjust", ADJUST_KEY, root=root)
    table.upsert(first, stage=staging.stg_cladjust)
    return table, second


def incremental_watermark(spark, raw_adjust: DataFrame, root: str) -> DataFrame:
    """The rows of the second batch that the committed watermark lets through."""
    table, batch = first_adjustments(spark, raw_adjust, root)
    return staging.stg_cladjust(upsert.after_watermark(batch, table.watermark()))


def incremental_upsert(spark, raw_adjust: DataFrame, root: str) -> DataFrame:
    table, batch = first_adjustments(spark, raw_adjust, root)
    return table.upsert(batch, stage=staging.stg_cladjust)


def schema_append(spark, raw_adjust: DataFrame, root: str) -> DataFrame:
    """The second batch brings a new column; rows stored before get NULL for it."""
    table, batch = first_adjustments(spark, raw_adjust, root)
    channel = F.when(F.col("adjustment_group_code") == "CR", F.lit("manual")).otherwise(F.lit("edi"))
    return table.upsert(batch, stage=lambda raw: staging.stg_cladjust(raw).withColumn("adjustment_channel", channel))


# Every incrementally loaded extract: staged model, its key, raw id whose last digit picks corrections, corrected column.
INCREMENTAL = {
    "clclaim": ("stg_clclaim", "claim_id", "claimid", "formtype"),
    "clline": ("stg_clline", "claim_line_id", "claimid", "ndc"),
    "cldiag": ("stg_cldiag", "claim_diagnosis_id", "claimid", "poa"),
    "clproc": ("stg_clproc", "claim_procedure_id", "claimid", "proccode"),
}
LOAD_SPLIT = dt.datetime(1998, 1, 1)


def load_batches(raw: DataFrame, id_col: str, changed: str) -> tuple[DataFrame, DataFrame]:
    """First loads, then later ones with corrections (loaded later still) of some earlier rows."""
    ts, split = F.col("_loaded_at"), ntz_lit(LOAD_SPLIT)
    first = raw.filter(ts < split)
    corrections = (first.filter(F.right(F.col(id_col), F.lit(1)) == "7").withColumn(changed, F.lit("X"))
                   .withColumn("_loaded_at", ts + F.expr("interval 4000 days")))
    return first, raw.filter(ts >= split).unionByName(upsert.reload_month(corrections))


def incremental_load(spark, raw: DataFrame, name: str, root: str) -> DataFrame:
    """Both batches through the stored table: literal watermark on the raw scan, staging, duplicate guard, merge."""
    model, key, id_col, changed = INCREMENTAL[name]
    table = upsert.IncrementalTable(spark, model, key, root=root)
    for batch in load_batches(raw, id_col, changed):
        table.upsert(batch, stage=getattr(staging, model))
    return table.read()


# --------------------------------------------------------------- snapshots
MEMBER_TRACKED = ["member_id", "first_name", "middle_name", "last_name", "date_of_birth", "gender_code", "gender",
                  "ssn", "medicaid_id", "medicare_id", "email", "preferred_language", "status_code", "member_status",
                  "updated_at"]
ELIG_TRACKED = ["member_id", "eligibility_id", "effective_date", "termination_date", "lob_id", "line_of_business",
                "plan_id", "plan_name", "product_id", "group_id", "subgroup_id", "coverage_type",
                "relationship_code", "subscriber_id", "pcp_provider_id", "eligibility_status_code", "_loaded_at"]
PROVIDER_TRACKED = ["provider_id", "npi", "tax_id", "license_number", "dea_number", "provider_name",
                    "provider_last_name", "provider_first_name", "provider_middle_name", "credential",
                    "provider_type_code", "provider_type", "entity_type_code", "entity_type", "taxonomy_code",
                    "provider_status_code", "provider_status", "effective_date", "termination_date", "is_valid_npi",
                    "updated_at"]

# name -> (staged model, key, change column, tracked columns, changed column, key digit expression)
SNAPSHOTS = {
    "member": ("stg_member", "member_id", "updated_at", MEMBER_TRACKED, "member_status",
               lambda k: F.right(k, F.lit(1)), lambda k: F.left(F.right(k, F.lit(2)), F.lit(1))),
    "eligibility": ("stg_mbrelig", "eligibility_id", "_loaded_at", ELIG_TRACKED, "plan_name",
                    lambda k: F.left(F.right(k, F.lit(3)), F.lit(1)), lambda k: F.right(k, F.lit(1))),
    "provider": ("stg_provider", "provider_id", "updated_at", PROVIDER_TRACKED, "provider_status",
                 lambda k: F.right(k, F.lit(1)), lambda k: F.left(F.right(k, F.lit(2)), F.lit(1))),
}


def snapshot_sources(staged: DataFrame, spec) -> tuple[DataFrame, DataFrame, DataFrame]:
    _, key, change, tracked, changed_col, digit, digit2 = spec
    src = staged.select(*tracked)
    d, d2 = digit(F.col(key)), digit2(F.col(key))
    v1 = src.filter(d != "7")
    is_changed = d == "5"
    v2 = (src.filter(d != "3")
             .withColumn(changed_col, F.when(is_changed, F.lit("Changed")).otherwise(F.col(changed_col)))
             .withColumn(change, F.when(is_changed, F.col(change) + F.expr("interval 1 day")).otherwise(F.col(change))))
    back = src.filter((d == "3") & (d2 == "1")).withColumn(change, F.col(change) + F.expr("interval 2 days"))
    v3 = v2.unionByName(back)
    return v1, v2, v3


def snapshot_history(staged: DataFrame, name: str) -> DataFrame:
    spec = SNAPSHOTS[name]
    key, change = spec[1], spec[2]
    v1, v2, v3 = snapshot_sources(staged, spec)
    h = scd2.snapshot_merge(None, v1, key, change, SNAPSHOT_RUNS[0])
    h = scd2.snapshot_merge(h, v2, key, change, SNAPSHOT_RUNS[1])
    return scd2.snapshot_merge(h, v3, key, change, SNAPSHOT_RUNS[2])


def stored_snapshot(spark, staged: DataFrame, name: str, root: str) -> DataFrame:
    """Three runs and a replayed one through the stored history."""
    _, key, change, *_ = spec = SNAPSHOTS[name]
    table = scd2.SnapshotTable(spark, f"{root}/{name}_snapshot", key, change)
    runs = list(zip(snapshot_sources(staged, spec), SNAPSHOT_RUNS))
    for source, run in [*runs, runs[-1]]:
        table.run(source, run)
    return table.read()


def snapshot_asof(staged_members: DataFrame, ts: dt.datetime = dt.datetime(2001, 6, 20)) -> DataFrame:
    return scd2.as_of(snapshot_history(staged_members, "member"), ts)


def snapshot_changes(staged_members: DataFrame) -> DataFrame:
    """Bulk form: history rebuilt from the change log of all three member runs.

    A version without a change time opens at the first run that shows it.
    """
    spec = SNAPSHOTS["member"]
    versions = [v.withColumn("_run", ntz_lit(run)) for v, run in zip(snapshot_sources(staged_members, spec), SNAPSHOT_RUNS)]
    seen = versions[0].unionByName(versions[1]).unionByName(versions[2]).groupBy(*spec[3]).agg(F.min("_run").alias("_run"))
    changes = seen.withColumn("_opened", F.coalesce("updated_at", "_run")).drop("_run")
    return scd2.history_from_changes(changes, "member_id", "_opened").drop("_opened")
