"""Helpers shared by the operators: written tables, global positions, free column names."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carespark.session import work_root

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: monotonically_increasing_id() keeps the partition above, the place in it below this bit.
_PLACE_BITS = 33


_PACKAGE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers of the session are told where this package lies."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _PACKAGE not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in [_PACKAGE, *paths] if p)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder that the cluster names in spark.checkpoint.dir."""
    return f"{work_root(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


#: Spark's own switch to free a query's shuffle files once it has ended.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """df as a written table: cuts the lineage and survives lost executors.

    The write's shuffle files are freed with it: nothing reads them once the table is there.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    passing = _PASSING.get()
    if passing is not None:
        passing.append((label, path))
    return spark.read.schema(df.schema).parquet(path)


_PASSING: ContextVar[list[tuple[str, str]] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Deletes the tables that ``saved`` writes inside the block once it has ended, but for those labelled ``kept``.

    For steps whose last table is written when the block ends: nothing reads the others then, not even a
    task that is run again.  After an error all tables stay.
    """
    written: list[tuple[str, str]] = []
    outer = _PASSING.set(written)
    try:
        yield
    finally:
        _PASSING.reset(outer)
    above = _PASSING.get()
    for label, path in written:
        if label not in kept:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
        elif above is not None:
            above.append((label, path))


def free(df: DataFrame, name: str) -> str:
    """name, with underscores in front until no column of df has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows: what a worker and its answer hold at once."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def in_order(df: DataFrame, order: Sequence[Column], label: str) -> tuple[DataFrame, str, str]:
    """df range-partitioned and sorted by ``order`` and written, with each row's
    range partition and place in it; gives the table and the two columns' names.

    The places are frozen by the write, so later jobs and retried tasks agree on them.
    """
    at, part, place = free(df, "at"), free(df, "part"), free(df, "place")
    table = saved(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn(at, F.monotonically_increasing_id()), label)
    return (table.withColumn(part, F.shiftright(at, _PLACE_BITS))
            .withColumn(place, F.col(at).bitwiseAND((1 << _PLACE_BITS) - 1)).drop(at), part, place)


def numbered(df: DataFrame, order: Sequence[Column], label: str, name: str) -> DataFrame:
    """df with a gapless global row number from 0 in ``order`` as column ``name``.

    Only one count per range partition is gathered (the broadcast side has as
    many rows as there are shuffle partitions).
    """
    table, part, place = in_order(df, order, label)
    counts = table.groupBy(part).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(part, F.coalesce(before, F.lit(0)).alias(free(table, "start")))
    start = starts.columns[1]
    return (table.join(F.broadcast(starts), part)
            .withColumn(name, F.col(start) + F.col(place)).drop(part, place, start))


def ranked(df: DataFrame, group: str, order: Sequence[Column], label: str, name: str) -> DataFrame:
    """df with the gapless row number from 1 within ``group`` in ``order`` as column ``name``.

    A group may hold any share of the rows: it is spread over range partitions,
    and a row's number is its distance from the group's first row in its
    partition plus the group's rows in the partitions before.  Only one row
    per group and partition is gathered.  ``order`` has to be fine enough to
    split a group (end it with a key).
    """
    table, part, place = in_order(df, [F.col(group).asc_nulls_last(), *order], label)
    g, p, first, before = (free(table, x) for x in ("g", "p", "first", "before"))
    runs = table.groupBy(F.col(group).alias(g), F.col(part).alias(p)).agg(F.min(place).alias(first), F.count("*").alias("rows"))
    earlier = Window.partitionBy(g).orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    runs = saved(runs.select(g, p, first, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(before)), f"{label}-runs")
    return (table.join(runs, (F.col(part) == F.col(p)) & F.col(group).eqNullSafe(F.col(g)))
            .withColumn(name, F.col(place) - F.col(first) + F.col(before) + 1).drop(part, place, first, before, g, p))
