"""Incremental load: watermark filter, key-based upsert, column append.

``merge_upsert`` is the pure plan (anti-join + union); ``IncrementalTable``
adds storage by key buckets: a run writes new copies of the buckets it touches
and one commit record that publishes them, so a reader never sees a half-written
table, a failed run leaves the previous version intact, and a retried task or a
lost executor only re-executes tasks of the buckets being written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ntz_lit
from ..functions.keys import packed, unpacked
from ..session import work_root
from ..sources.adapter import LOAD_PARTITION, load_month
from ..sources.io import PART, PartTable, store

LOADED_AT = "_loaded_at"


def watermark(target: DataFrame | None, col: str = LOADED_AT):
    """Driver-side scalar ``max(col)`` of the target (one value, one row)."""
    if target is None:
        return None
    return target.agg(F.max(col)).first()[0]


def after_watermark(src: DataFrame, wm, col: str = LOADED_AT) -> DataFrame:
    """Strictly newer rows only.  A missing/empty target (``wm is None``) loads everything.

    The watermark is a literal, so the comparison reaches the parquet scan as
    a pushed filter and skips row groups whose max is not newer.
    """
    if wm is None:
        return src
    lit = ntz_lit(wm) if isinstance(wm, dt.datetime) else F.lit(wm)
    out = src.filter(F.col(col) > lit.cast(src.schema[col].dataType))
    if LOAD_PARTITION in src.columns and isinstance(wm, dt.datetime):
        # Extracts landed by load month: also prune whole month folders.  The
        # folder has to be that of the row's load time; a batch whose times were
        # changed calls ``reload_month`` first, and ``checked_month`` guards writes.
        out = out.filter(F.col(LOAD_PARTITION) >= F.lit(wm.date().replace(day=1)))
    return out


def reload_month(src: DataFrame, col: str = LOADED_AT) -> DataFrame:
    """``src`` with the load month computed from its load time (after changing the latter)."""
    return src.withColumn(LOAD_PARTITION, load_month(F.col(col))) if LOAD_PARTITION in src.columns else src


def checked_month(src: DataFrame, col: str = LOADED_AT) -> DataFrame:
    """Fails the job on a row whose load month is not that of its load time."""
    if LOAD_PARTITION not in src.columns:
        return src
    stale = ~F.col(LOAD_PARTITION).eqNullSafe(load_month(F.col(col)))
    guard = F.when(stale, F.raise_error(F.concat(F.lit("stale load month "), F.coalesce(F.col(LOAD_PARTITION).cast("string"), F.lit("null")))).cast("boolean"))
    return src.filter(F.coalesce(guard, F.lit(True)))


def dedupe_batch(src: DataFrame, key: str, on_duplicate: str = "error", order_col: str = LOADED_AT) -> DataFrame:
    """Guard against several rows for one key inside one batch.

    ``error`` fails the job (lazily, inside the tasks) on the first duplicate;
    ``latest`` keeps the row with the greatest ``order_col`` (then greatest
    remaining columns) via a map-side-combinable ``max(struct)``.
    """
    if on_duplicate == "latest":
        rest = [c for c in src.columns if c not in (key, order_col)]
        best = F.max(F.struct(order_col, *rest)).alias("_r")
        keyed = src.filter(F.col(key).isNotNull()).groupBy(key).agg(best)
        keyed = keyed.select(key, *[F.col(f"_r.{c}").alias(c) for c in [order_col, *rest]]).select(*src.columns)
        return keyed.unionByName(src.filter(F.col(key).isNull()))  # NULL keys never match: all of them stay
    if on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate={on_duplicate!r}")
    # Count per key with map-side combine (a hot key never lands in one sort),
    # reduce to ONE row holding a duplicated key if any, and let that row raise
    # inside the tasks.  The one-row side is a broadcast of proven size.
    dup = (src.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)
              .agg(F.min(F.col(key).cast("string")).alias("_dup_key")))
    guard = F.when(F.col("_dup_key").isNotNull(),
                   F.raise_error(F.concat(F.lit(f"duplicate {key} in incremental batch: "), F.col("_dup_key"))))
    return (src.crossJoin(F.broadcast(dup))
               .filter(F.coalesce(guard.cast("boolean"), F.lit(True)))
               .drop("_dup_key"))


def merge_upsert(target: DataFrame | None, src: DataFrame, key: str) -> DataFrame:
    """Rows of ``src`` replace target rows with the same key; others are kept.

    NULL keys never match (they are inserted), as in a SQL MERGE.  Columns
    present on only one side are kept and filled with NULL on the other.
    """
    if target is None:
        return src
    kept = target.join(src.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


#: A row's bucket as the number of its task.
_AT = f"{PART}_at"
BUCKETS = 16
#: Rows of the first load per bucket: what one task sorts and writes.
BUCKET_ROWS = 250_000


class IncrementalTable(PartTable):
    """A stored table kept current by upserts, laid out in buckets of the key's hash.

    A batch's rows are dealt to their buckets and written once; of the buckets that it has keys for, no others, the
    rows that it leaves are written again beside them.  The watermark
    (newest load time) comes from the commit record, so the target isn't scanned
    for it; columns that a batch brings are appended to the stored schema.
    The number of buckets is fixed by the first commit: ``buckets``, or as many as make ``BUCKET_ROWS``
    rows of the first load a bucket, if these are more.  Rows with a NULL key, which never match, are spread over the
    buckets by their load time and contents.  One writer per table at a time.

    Re-running a batch is harmless: rows not newer than the watermark are
    skipped, and a batch that leaves none makes no version.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, root: str | None = None,
                 on_duplicate: str = "error", buckets: int = BUCKETS, loaded_at: str = LOADED_AT):
        super().__init__(spark, f"{(root or work_root(spark)).rstrip('/')}/{name}")
        self.name = name
        self.key = key
        self.on_duplicate = on_duplicate
        self.buckets = buckets
        self.loaded_at = loaded_at

    def watermark(self, record: dict | None = None) -> dt.datetime | None:
        """The newest load time of the stored rows, as committed."""
        record = record or self.current()
        return dt.datetime.fromisoformat(record["watermark"]) if record and record["watermark"] else None

    def _bucket(self, df: DataFrame, buckets: int) -> Column:
        null = F.xxhash64(*[F.col(c) for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])
        hashed = F.when(F.col(self.key).isNull(), null).otherwise(F.xxhash64(F.col(self.key)))
        return F.pmod(hashed, F.lit(buckets)).cast("string")

    def upsert(self, batch: DataFrame, stage=None) -> DataFrame:
        """Keeps batch rows past the watermark, merges them by key and commits; returns the table.

        With ``stage`` the batch is a *raw* extract: the watermark is applied to
        the raw scan first (pushed to parquet, month folders pruned), then the
        surviving rows are staged.  Staging passes the load time through, so
        both orders give the same rows.
        """
        before = self.current()
        fresh = after_watermark(checked_month(batch), self.watermark(before), self.loaded_at)
        self.merge(stage(fresh) if stage is not None else fresh)
        return self.read()

    def merge(self, fresh: DataFrame, newest_wins: bool = False, meta: dict | None = None) -> dict | None:
        """Merges staged rows by key; returns the new record (None: no rows, nothing written).

        With ``newest_wins`` a row that isn't newer than the stored row of its key goes to
        the side table ``late`` instead of the target.
        """
        before = self.current()
        version = before["version"] + 1 if before else 1
        schema = self.appended(fresh, before)
        unique = self.on_duplicate == "latest" or newest_wins
        buckets = before["buckets"] if before else max(self.buckets, -(-fresh.count() // BUCKET_ROWS))
        if unique:
            fresh = dedupe_batch(fresh, self.key, "latest", self.loaded_at)
        fresh = fresh.select(*[f.name for f in schema.fields if f.name in fresh.columns])
        # Written once, in their buckets: these files are the table's, and what the steps below read.
        kind = "arrived" if before else "data"
        dealt = self._dealt(fresh, buckets) if unique else self._dealt(fresh, buckets, self._distinct)
        try:
            counts = self._write(dealt, self._folder(version, kind=kind))
        except PySparkException:
            again = None if unique else self._duplicate(fresh)
            if again is None:
                raise
            raise ValueError(f"duplicate {self.key} in incremental batch: {again}") from None
        if not counts and before:
            return None
        incoming = self._read_arrived(version, kind, schema)
        marks = [m for m in (incoming.agg(F.max(self.loaded_at)).first()[0], self.watermark(before)) if m is not None]
        meta = {"stream": (before or {}).get("stream"), **(meta or {}), "buckets": buckets,
                "watermark": max(marks).isoformat() if marks else None, "arrived": version, "arrived_in": kind}
        live = {p: {"version": version, "rows": n, "in": [kind]} for p, n in counts.items()}
        target = self.read(counts, before) if before else None
        if target is not None and newest_wins:
            merged = merge_upsert(target, self._newer(incoming, target, version), self.key)
            live = {p: {"version": version, "rows": n} for p, n in self._write(self._dealt(merged, buckets), self._folder(version)).items()}
        elif target is not None:
            for p, n in self._write(self._kept(target, incoming, buckets), self._folder(version)).items():
                if p not in live:
                    raise ValueError(f"{self.path}: rows for a part that was not to be replaced: {p}")
                live[p] = {"version": version, "rows": live[p]["rows"] + n, "in": ["data", kind]}
        return self._publish(before, schema, live, counts, meta)

    def _dealt(self, df: DataFrame, buckets: int, there: Callable[[DataFrame], DataFrame] = lambda met: met) -> DataFrame:
        """df with its buckets, the rows of each in a task of their own: a bucket is one task's work by its size, so it is one file.

        ``there`` is done in those tasks, on rows that lie by ``_AT`` and have short keys.
        """
        part = F.col(PART) if PART in df.columns else self._bucket(df, buckets)
        hashed = isinstance(df.schema[self.key].dataType, T.StringType)
        df = df.withColumn(_AT, part.cast("int")).drop(PART)
        if hashed:
            df = df.withColumn(self.key, packed(self.key))
        df = there(df.repartitionById(buckets, F.col(_AT)))
        if hashed:
            df = df.withColumn(self.key, unpacked(self.key))
        return df.withColumn(PART, F.col(_AT).cast("string")).drop(_AT)

    def _same_key(self, of: Column) -> Column:
        """``of`` the rows of a key, inside its bucket's task."""
        return of.over(Window.partitionBy(_AT, self.key))

    def _distinct(self, met: DataFrame) -> DataFrame:
        """Fails the job on a key that comes twice."""
        twice = F.col(self.key).isNotNull() & (F.col("_n") > 1)
        guard = F.when(twice, F.raise_error(F.lit(f"duplicate {self.key} in incremental batch"))).cast("boolean")
        return met.withColumn("_n", self._same_key(F.count(F.lit(1)))).filter(F.coalesce(guard, F.lit(True))).drop("_n")

    def _duplicate(self, fresh: DataFrame) -> str | None:
        """The first key that comes twice."""
        per_key = fresh.filter(F.col(self.key).isNotNull()).groupBy(self.key).count().filter(F.col("count") > 1)
        return per_key.agg(F.min(F.col(self.key).cast("string"))).first()[0]

    def _kept(self, target: DataFrame, incoming: DataFrame, buckets: int) -> DataFrame:
        """The rows of target that incoming has no key of: both meet in their buckets, so each row is shuffled once."""
        keys = incoming.filter(F.col(self.key).isNotNull()).select(self.key)
        old, new = (df.withColumn(PART, self._bucket(df, buckets)) for df in (target, keys))
        both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)

        def left(met: DataFrame) -> DataFrame:
            gone = F.col(self.key).isNotNull() & F.col("_gone")
            return met.withColumn("_gone", self._same_key(F.max("_new"))).filter(~F.col("_new") & ~gone).drop("_new", "_gone")

        return self._dealt(both, buckets, left)

    def _read_arrived(self, version: int, kind: str, schema: T.StructType) -> DataFrame:
        """The rows that a version got, as they arrived."""
        return self.spark.read.schema(schema).parquet(self._folder(version, kind=kind)).select(*schema.names)

    def _newer(self, incoming: DataFrame, target: DataFrame, version: int) -> DataFrame:
        """incoming without the rows whose key is stored with the same or a newer load time; those go to the side table."""
        stored = target.where(F.col(self.key).isNotNull()).select(F.col(self.key).alias("_k"), F.col(self.loaded_at).alias("_at"))
        met = incoming.join(stored, F.col(self.key) == F.col("_k"), "left")
        old = F.coalesce(F.col("_at") >= F.col(self.loaded_at), F.col("_at").isNotNull())
        store(met.where(old).drop("_k", "_at"), f"{self.path}/late/v-{version:06d}")
        return met.where(~old).drop("_k", "_at")

    def late(self) -> DataFrame | None:
        """Rows that came too late to be merged: at or before a load's watermark, or older than their key's stored row."""
        try:
            return self.spark.read.schema(self.schema()).option("recursiveFileLookup", "true").parquet(f"{self.path}/late")
        except AnalysisException:
            return None

    def changes(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """What the last (or the given) upsert changed: the rows as they arrived, and the rows that they replaced."""
        record = self.record(version) if version else self.current()
        new = self._read_arrived(record["arrived"], record.get("arrived_in", "arrived"), self.schema(record))
        before = self.record(record["arrived"] - 1)
        if before is None:
            return new, new.limit(0)
        touched = [p for p, held in record["parts"].items() if held["version"] == record["arrived"]]
        old = self.read(touched, before).join(new.select(self.key), self.key, "left_semi")
        return new, old
