"""Type-2 slowly changing history (timestamp strategy, hard deletes closed).

History rows carry the tracked columns plus ``dbt_scd_id``, ``dbt_updated_at``,
``dbt_valid_from`` and ``dbt_valid_to`` (NULL = current).  One run compares
the *open* history rows with the current source by key in a single full
outer join (one shuffle on the key), then unions the untouched closed rows.

Semantics kept on purpose: a key that comes back after a hard delete opens
a new row at its *source* change time; if that time did not move, the new
row overlaps the closed one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.dates import ntz_lit
from ..sources.io import PartTable

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def scd_id(key: Column, ts: Column) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(ts.cast("string"), F.lit(""))))


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    return ntz_lit(value)


def snapshot_step(opened: DataFrame | None, source: DataFrame, key: str, updated_at: str, run_ts,
                  invalidate_hard_deletes: bool = True) -> DataFrame:
    """What becomes of the open rows (None: first run) and the source's rows: history rows, open and newly closed."""
    run = _ts(run_ts)
    cols = source.columns
    # New keys open at their change time; a NULL change time opens at the run time.
    change = F.coalesce(F.col(f"s.{updated_at}"), run)
    new_row = [F.col(f"s.{c}").alias(c) for c in cols] + [
        scd_id(F.col(f"s.{key}"), change).alias("dbt_scd_id"),
        change.alias("dbt_updated_at"),
        change.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    ]
    if opened is None:
        return source.alias("s").select(*new_row)
    # A literal marks which side a row comes from; a NULL key is a key like any other.
    open_rows = opened.withColumn("_there", F.lit(True)).alias("h")
    j = open_rows.join(source.withColumn("_there", F.lit(True)).alias("s"), F.col(f"h.{key}").eqNullSafe(F.col(f"s.{key}")), "full")
    in_h, in_s = F.col("h._there").isNotNull(), F.col("s._there").isNotNull()
    newer = in_h & in_s & F.coalesce(F.col(f"s.{updated_at}") > F.col("h.dbt_updated_at"), F.lit(False))
    h_valid_to = (F.when(newer, F.col(f"s.{updated_at}"))
                  .when(in_h & ~in_s & F.lit(invalidate_hard_deletes), run)
                  .otherwise(F.col("h.dbt_valid_to")))
    old_row = F.struct(*[F.col(f"h.{c}").alias(c) for c in cols], F.col("h.dbt_scd_id"), F.col("h.dbt_updated_at"),
                       F.col("h.dbt_valid_from"), h_valid_to.alias("dbt_valid_to"))
    # Each joined pair gives the old row, a new one, or both: one pass over the join.
    rows = F.array_compact(F.array(F.when(in_h, old_row), F.when((~in_h & in_s) | newer, F.struct(*new_row))))
    return j.select(F.explode(rows).alias("r")).select("r.*")


def snapshot_merge(history: DataFrame | None, source: DataFrame, key: str, updated_at: str, run_ts,
                   invalidate_hard_deletes: bool = True) -> DataFrame:
    """The whole history after a run, as a plan."""
    if history is None:
        return snapshot_step(None, source, key, updated_at, run_ts)
    is_open = F.col("dbt_valid_to").isNull()
    step = snapshot_step(history.filter(is_open), source, key, updated_at, run_ts, invalidate_hard_deletes)
    return history.filter(~is_open).unionByName(step)


class SnapshotTable(PartTable):
    """A stored type-2 history: an open part, rewritten by every run, and closed parts, appended once and never read by a run.

    A run joins the open rows with the source once; what it closes becomes a part
    of its own.  The commit record holds the run's time, so a replayed run changes
    nothing, and an earlier one is refused.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, updated_at: str, invalidate_hard_deletes: bool = True):
        super().__init__(spark, path)
        self.key = key
        self.updated_at = updated_at
        self.invalidate_hard_deletes = invalidate_hard_deletes

    def run(self, source: DataFrame, run_ts: dt.datetime) -> dict:
        before = self.current()
        if before:
            last = dt.datetime.fromisoformat(before["run"])
            if run_ts == last:
                return before
            if run_ts < last:
                raise ValueError(f"{self.path}: a run at {run_ts} after one at {last}")
        opened = self.read(["open"], before) if before else None
        history = snapshot_step(opened, source, self.key, self.updated_at, run_ts, self.invalidate_hard_deletes)
        part = F.when(F.col("dbt_valid_to").isNull(), "open").otherwise(f"closed-{self.version() + 1:06d}")
        return self.replace(history, part, ["open"], {"run": run_ts.isoformat()})


def history_from_changes(changes: DataFrame, key: str, change_ts: str) -> DataFrame:
    """Bulk form: each change row is valid until the next change of its key."""
    w = Window.partitionBy(key).orderBy(F.col(change_ts))
    return changes.select(
        *changes.columns,
        scd_id(F.col(key), F.col(change_ts)).alias("dbt_scd_id"),
        F.col(change_ts).alias("dbt_updated_at"),
        F.col(change_ts).alias("dbt_valid_from"),
        F.lead(change_ts).over(w).alias("dbt_valid_to"),
    )


def as_of(history: DataFrame, ts) -> DataFrame:
    """Point-in-time read: the version valid at ``ts``."""
    t = _ts(ts)
    return history.filter((F.col("dbt_valid_from") <= t) & (F.col("dbt_valid_to").isNull() | (t < F.col("dbt_valid_to"))))
