"""Sharding by a Feistel permutation over global row numbers.

Row r of N (in key order) goes to place P(r), where P permutes 0..N-1: a
balanced Feistel network over the smallest even number of bits that holds N,
walked along its cycle until the value falls below N.  Place p is slot
``p // shards`` of shard ``p % shards``, so counts differ by one at most and
slots are gapless.  N and the seed decide everything: :func:`place_of` finds a
row's shard and slot, and :func:`row_of` the row at a shard and slot, without
reading any data.

Defined cases: null keys sort first; equal keys are ordered by the tie columns
(rows equal in all of them are interchangeable); an empty table gives no rows;
columns of the input stay, whatever their names, and the new ones must be free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, free, numbered

SHARDS = 16
SEED = 20240501
ROUNDS = 6
_U = np.uint64


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, seed: int, i: int) -> np.ndarray:
    """The round function: a 64-bit mix of the half and the round's key."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _walk(x: np.ndarray, n: int, seed: int, rounds: Sequence[int], forward: bool) -> np.ndarray:
    bits = _half_bits(n)
    low, h = _U((1 << bits) - 1), _U(bits)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> h, v & low
        for i in rounds:
            if forward:
                left, right = right, left ^ (_mix(right, seed, i) & low)
            else:
                left, right = right ^ (_mix(left, seed, i) & low), left
        return (left << h) | right

    with np.errstate(over="ignore"):
        x = once(np.asarray(x, dtype=_U))
        out = np.flatnonzero(x >= _U(n))
        while len(out):  # the domain is under four times n: a few steps on average
            x[out] = once(x[out])
            out = out[x[out] >= _U(n)]
    return x


def permute(rows, n: int, seed: int = SEED) -> np.ndarray:
    """P(row) for each row number."""
    return _walk(rows, n, seed, range(ROUNDS), True)


def unpermute(places, n: int, seed: int = SEED) -> np.ndarray:
    return _walk(places, n, seed, range(ROUNDS - 1, -1, -1), False)


def place_of(rows, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    p = permute(rows, n, seed)
    return p % _U(shards), p // _U(shards)


def row_of(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    return int(unpermute(np.array([slot * shards + shard]), n, seed)[0])


def shard_rows(df: DataFrame, key: str, ties: Sequence[str] = (), shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """df with ``shard`` int and ``slot`` long, by the row's number in (key, ties) order."""
    row = free(df, "row_no")
    rows = numbered(df, [F.col(c).asc_nulls_first() for c in (key, *ties)], "shard", row)
    n = max(1, rows.count())  # one number; footers only

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(permute(b.to_numpy(), n, seed).astype(np.int64))

    p = free(df, "place_no")
    return (rows.withColumn(p, place(row))
            .withColumn("shard", (F.col(p) % shards).cast("int"))
            .withColumn("slot", F.expr(f"`{p}` div {shards}")).drop(p, row))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in slot order within files."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return (shard_rows(docs, "doc_id", ("text_crc32", "size"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
