"""Lookups whose busy keys don't meet in one task.

A key with at least a thousandth of the rows is *heavy*: there are at most a
thousand of them, whatever the size of the input.  ``spread_lookup`` broadcasts
their table rows; ``split_join`` cuts a heavy key of either side into pieces of about a
thousandth of that side and copies the other side's rows of the key to each
piece.  In both, all other keys go through an ordinary shuffle join, in which no key
holds more than that share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy from one row in so many on; also the most keys that can be heavy.
SHARE = 1000
#: Keys with fewer rows are never worth a broadcast.
LEAST = 1000


def heavy(rows_of_key: Column, total: int, share: int = SHARE, least: int = LEAST) -> Column:
    """Whether a key with so many of ``total`` rows is heavy (at most ``share`` keys are)."""
    return (rows_of_key * share >= F.lit(total)) & (rows_of_key >= least)


def spread_lookup(rows: DataFrame, table: DataFrame, key: str, is_heavy: Column) -> DataFrame:
    """rows (inner) joined with ``table``, which has one row per ``key``; those where ``is_heavy`` are broadcast.

    The caller proves the bound by building ``is_heavy`` from ``heavy``.
    """
    busy, rest = table.where(is_heavy), table.where(~is_heavy)
    direct = rows.join(F.broadcast(busy), key)
    shuffled = rows.join(F.broadcast(busy.select(key)), key, "left_anti").join(rest, key)
    return direct.unionByName(shuffled)


def heavy_keys(df: DataFrame, keys: Sequence[str], share: int = SHARE, least: int = LEAST) -> list[tuple]:
    """(key values..., pieces) of the heavy keys of ``df``; at most ``share`` rows reach the driver."""
    known = df.where(" and ".join(f"{k} is not null" for k in keys))
    counts = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = known.agg(F.count(F.lit(1)).alias("total"))
    found = counts.where(F.col("n") >= least).crossJoin(F.broadcast(total)).where(heavy(F.col("n"), F.col("total"), share, least))
    return [(*(r[k] for k in keys), -(-r.n * share // r.total)) for r in found.collect()]


def split_join(rows: DataFrame, links: DataFrame, keys: Sequence[str], busy: Sequence[tuple] = (), wide: Sequence[tuple] = ()) -> DataFrame:
    """rows (inner) joined with links on ``keys``.

    ``busy`` are the heavy keys of rows, ``wide`` those of links (``heavy_keys``).
    A busy key's rows are dealt over its pieces by their hash and meet a copy of its links in each; a wide
    key's links are dealt likewise.  The copies come to no more than about twice ``SHARE`` rows per
    side, since the pieces of all heavy keys together do.
    """
    if not busy and not wide:
        return rows.join(links, list(keys))
    pieces: dict[tuple, list[int]] = {}
    for at, held in enumerate((busy, wide)):
        for *key, n in held:
            pieces.setdefault(tuple(key), [1, 1])[at] = n
    spark = rows.sparkSession
    schema = links.select(*keys).schema.simpleString()[len("struct<"):-1]
    plan = F.broadcast(spark.createDataFrame([(*k, *n) for k, n in pieces.items()], f"{schema},_rows:int,_links:int"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*[c for c in df.columns]), F.coalesce(own, F.lit(1)))
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        df = df.join(plan, list(keys), "left")
        return df.select(*[c for c in df.columns if c not in ("_rows", "_links")], place.cast("int").alias(f"_at{own}"), copies.alias(f"_at{other}"))

    met = dealt(rows, "_rows", "_links").join(dealt(links, "_links", "_rows"), [*keys, "_at_rows", "_at_links"])
    return met.drop("_at_rows", "_at_links")
