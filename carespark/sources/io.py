"""Table storage: layer routing and atomically published parquet tables.

A table is a folder of data folders plus commit records.  A version exists for
readers only once its commit record does (one small file, written by a Spark
job whose commit is all-or-nothing); a write that died half-way left none, so
its data folder is overwritten by the next attempt.  Everything goes through
Spark readers and writers, so a path may be any URI that the cluster reaches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import freed_shuffles

LAYER_SCHEMAS = {"bronze": "BRONZE", "silver": "SILVER", "gold": "GOLD"}


def schema_name(custom: str | None, default_schema: str, layer_schemas: Mapping[str, str] = LAYER_SCHEMAS) -> str:
    """Medallion routing: bronze/silver/gold map to their configured schema,
    no custom schema means the default one, anything else ``<default>_<custom>``."""
    if custom is None:
        return default_schema
    configured = layer_schemas.get(custom.lower())
    if configured is not None:
        return configured
    return f"{default_schema}_{custom.strip()}"


#: Of stored tables: they are written once or twice and read often, and ids and hashes take half the bytes of the default codec.
CODEC = "zstd"


def store(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Writes df to ``path`` in place of what lies there; its shuffle files go with the write."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").option("compression", CODEC).partitionBy(*partition_by).parquet(path)


def layer_path(root: str, schema: str, table: str) -> str:
    return f"{root.rstrip('/')}/{schema}/{table}"


def newest(there: Callable[[int], bool], known: int = 0) -> int:
    """The last of the versions 1, 2, ... (``known`` is one of them, or 0) in a number of looks that grows with their logarithm."""
    step = 1
    while there(known + step):
        known, step = known + step, step * 2
    while step > 1:
        step //= 2
        if there(known + step):
            known += step
    return known


class CommitLog:
    """Numbered commit records (JSON texts) under ``path/commits``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._known = 0
        self._seen: dict[int, dict] = {}

    def record(self, version: int) -> dict | None:
        """What version ``version`` recorded; None if it was never committed."""
        if version < 1:
            return None
        if version not in self._seen:
            try:
                row = self.spark.read.schema("value string").text(f"{self.path}/commits/v-{version:06d}", wholetext=True).first()
            except AnalysisException:
                return None
            if row is None:
                return None
            self._seen[version] = json.loads(row.value)  # a record never changes
        return self._seen[version]

    def version(self) -> int:
        """The current version; 0 before the first commit."""
        self._known = newest(lambda v: self.record(v) is not None, self._known)
        return self._known

    def current(self) -> dict | None:
        return self.record(self.version())

    def versions(self) -> list[int]:
        return list(range(1, self.version() + 1))

    def _commit(self, record: dict) -> dict:
        """Publishes a version; fails if another writer has published the same one."""
        row = self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(record, sort_keys=True)).alias("value"))
        row.write.mode("errorifexists").text(f"{self.path}/commits/v-{record['version']:06d}")
        self._seen[record["version"]] = record
        return record


class VersionedTable(CommitLog):
    """A table of which each write is a complete version in ``v-<n>``."""

    def version_path(self, v: int) -> str:
        return f"{self.path}/v-{v:06d}"

    def current_path(self) -> str | None:
        v = self.version()
        return self.version_path(v) if v else None

    def read(self) -> DataFrame | None:
        p = self.current_path()
        return self.spark.read.parquet(p) if p else None

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        nxt = self.version() + 1
        store(df, self.version_path(nxt), partition_by or ())  # in place of an uncommitted leftover at most
        self.commit_written()
        return self.spark.read.parquet(self.version_path(nxt))

    def commit_written(self) -> None:
        """Publishes the next version, whose data the caller has written to its folder."""
        self._commit({"version": self.version() + 1})


PART = "_part"


class PartTable(CommitLog):
    """A table of named parts (key buckets, months, open and closed history), of which a write replaces some.

    The commit record holds, for every part, the version whose folder has its rows
    and their count (and the folders, if a version has several: the parts it rewrote, the rows it got), the
    table's schema, and whatever the owner keeps beside it (watermark, run time ...).  So a reader opens the parts' folders without
    listing or scanning others, an untouched part is never written again, and
    statistics are read from the record instead of the table.  Columns may be
    appended: parts written before give NULL for them.
    """

    def _folder(self, version: int, part: str | None = None, kind: str = "data") -> str:
        whole = f"{self.path}/{kind}/v-{version:06d}"
        return whole if part is None else f"{whole}/{PART}={part}"

    def schema(self, record: dict | None = None) -> T.StructType | None:
        record = record or self.current()
        return T.StructType.fromJson(record["schema"]) if record else None

    def read(self, parts: Iterable[str] | None = None, record: dict | None = None) -> DataFrame | None:
        """The rows of ``parts`` (default: all) as of ``record`` (default: the current version)."""
        record = record or self.current()
        if record is None:
            return None
        wanted = record["parts"] if parts is None else [p for p in parts if p in record["parts"]]
        schema = self.schema(record)
        held = {p: record["parts"][p] for p in wanted}
        folders = [self._folder(h["version"], p, kind) for p, h in held.items() if h["rows"] for kind in h.get("in", ["data"])]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def count(self) -> int:
        record = self.current()
        return sum(p["rows"] for p in record["parts"].values()) if record else 0

    def replace(self, df: DataFrame, part: Column, gone: Iterable[str] = (), meta: dict | None = None) -> dict:
        """Writes ``df`` into the parts that ``part`` (a string column) names, in place of the parts ``gone``; returns the record.

        A part that gets rows has to be new or among ``gone``.  The caller deals df's rows to tasks.
        """
        before = self.current()
        version = before["version"] + 1 if before else 1
        schema = self.appended(df, before)
        counts = self._write(df.withColumn(PART, part), self._folder(version))
        return self._publish(before, schema, {p: {"version": version, "rows": n} for p, n in counts.items()}, gone, meta)

    def appended(self, df: DataFrame, before: dict | None) -> T.StructType:
        """The stored schema with the columns that df brings."""
        own = T.StructType([f for f in df.schema.fields if f.name != PART])
        return _appended(self.schema(before) if before else own, own)

    def _write(self, df: DataFrame, folder: str) -> dict[str, int]:
        """Writes df into a folder per part; returns the rows of each part."""
        store(df, folder, [PART])
        written = df.sparkSession.read.schema(T.StructType([T.StructField(PART, T.StringType())])).parquet(folder)
        return {r[0]: r[1] for r in written.groupBy(PART).count().collect()}  # one row per part written

    def _publish(self, before: dict | None, schema: T.StructType, new: dict[str, dict], gone: Iterable[str], meta: dict | None) -> dict:
        gone = set(gone)
        parts = {p: v for p, v in (before["parts"] if before else {}).items() if p not in gone}
        clash = set(parts) & set(new)
        if clash:
            raise ValueError(f"{self.path}: rows for parts that were not to be replaced: {sorted(clash)[:3]}")
        version = before["version"] + 1 if before else 1
        return self._commit({"version": version, "schema": json.loads(schema.json()), "parts": parts | new, **(meta or {})})

    def note(self, **meta) -> dict:
        """A commit that changes what the owner keeps, not the rows."""
        before = self.current()
        return self._commit({**before, **meta, "version": before["version"] + 1})


def _appended(old: T.StructType, new: T.StructType) -> T.StructType:
    types = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} was {types[f.name].simpleString()}, is {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*old.fields, *(f for f in new.fields if f.name not in types)]])


def with_audit(df: DataFrame) -> DataFrame:
    """The writer-only audit column (kept out of compared queries)."""
    return df.withColumn("dbt_updated_at", F.current_timestamp())
