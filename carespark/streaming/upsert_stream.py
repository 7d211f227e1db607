"""Structured Streaming form of the incremental load, exactly once.

New raw extract files arriving in a folder are staged and merged into an
``IncrementalTable`` micro-batch by micro-batch (``foreachBatch``).  The table's
commit record names the stream (its checkpoint), the last epoch merged and the
watermark at which the load began:

* an epoch that is replayed after a failure is found in the record and skipped;
* a load's watermark is the one from before its first epoch, however its files are cut
  into epochs; among the load's own rows of a key the newest wins.  So one file an epoch
  gives the same table as all files at once;
* rows at or before that watermark, without a load time, or older than what is stored for
  their key go to the table's side table (``IncrementalTable.late``) instead of being lost.

``drain`` takes in everything present and stops (the scheduled-batch way of
running it); ``stream_upsert`` with a processing-time trigger runs continuously.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ntz_lit
from ..operators.upsert import IncrementalTable, after_watermark, checked_month


def merge_epoch(table: IncrementalTable, batch: DataFrame, epoch: int, checkpoint: str, stage: Callable[[DataFrame], DataFrame]) -> bool:
    """Merges one micro-batch unless its epoch is committed already; tells whether it did."""
    before = table.current()
    state = (before or {}).get("stream") or {}
    if state.get("checkpoint") != checkpoint:
        state = {"checkpoint": checkpoint, "epoch": -1, "open": False}
    if epoch <= state["epoch"]:
        return False
    if not state["open"]:
        mark = table.watermark(before)
        state |= {"open": True, "base": mark.isoformat() if mark else None}
    base = None if state["base"] is None else dt.datetime.fromisoformat(state["base"])
    state |= {"epoch": epoch}
    rows = checked_month(batch)
    if base is not None:
        at = F.col(table.loaded_at)
        stale = rows.where(F.coalesce(at <= ntz_lit(base), F.lit(True)))
        stage(stale).write.mode("overwrite").parquet(f"{table.path}/late/stream-{epoch:09d}-{table.version() + 1:06d}")
        rows = after_watermark(rows, base, table.loaded_at)
    if table.merge(stage(rows), newest_wins=True, meta={"stream": state}) is None:
        table.note(stream=state)  # nothing to merge: the epoch is done all the same
    return True


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, stage: Callable[[DataFrame], DataFrame],
                  table: IncrementalTable, checkpoint: str, files_per_batch: int | None = None, available_now: bool = True):
    """Starts the query and returns it."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)
    writer = (stream.writeStream.foreachBatch(lambda batch, epoch: merge_epoch(table, batch, epoch, checkpoint, stage))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def drain(spark: SparkSession, source_dir: str, schema: T.StructType, stage: Callable[[DataFrame], DataFrame],
          table: IncrementalTable, checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Takes in all files present as one load, and closes the load; returns the table.

    A drain that failed is called again: it goes on with the load's epochs and its watermark.
    """
    stream_upsert(spark, source_dir, schema, stage, table, checkpoint, files_per_batch).awaitTermination()
    state = (table.current() or {}).get("stream")
    if state and state["open"]:
        table.note(stream={**state, "open": False})
    return table.read()
