"""Mixing sources to target weights by systematic sampling.

Targets: sources in code point order (null last) take the weights in turn and
share ``share`` of all sizes; a target stops at ``cap`` times its source's
size and the excess is shared again by weight until none is above (the level
is found in closed form from the sources sorted by cap over weight).

Sampling: a document's expected copies are target over size of its source, as
a whole number of 2^-24 units.  Prefix-summed within the source in size order
(a row's number times the rate) and shifted by one offset per source (from a
hash of seed and source), a document is emitted once for every integer
boundary its interval crosses.
With one rate for a source, size order makes the taken words miss the target
by about one largest document at most.  Row numbers are dealt out over range
partitions, so a source may hold any share of the rows.

Defined cases: null size counts 0; a null source is a source of its own; a
source without words gets target 0 and no copies; repeated rows are rows of
their own; an empty table gives no rows; columns of the input stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, free, ranked, saved

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # of all sizes: 150 %
CAP = 2
SEED = 7
UNIT = 1 << 24


def targets(sized: DataFrame, source: str, size: str, weights: Sequence[int] = WEIGHTS,
            share: tuple[int, int] = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: mix_source, source_size long, target double."""
    num, den = share
    own = sized.groupBy(F.col(source).alias("mix_source")).agg(F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("source_size"))
    in_turn = Window.orderBy(F.col("mix_source").asc_nulls_last())
    rank = (F.row_number().over(in_turn) - 1).cast("int")
    picks = F.array(*[F.lit(w) for w in weights])
    own = (own.withColumn("turn", rank).withColumn("weight", F.element_at(picks, F.col("turn") % len(weights) + 1).cast("long"))
           .withColumn("cap", F.lit(cap) * F.col("source_size")))
    fill = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "turn")
    before, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((num * F.sum("source_size").over(everything) - den * F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
             / (den * F.sum("weight").over(rest)).cast("double"))
    steps = own.withColumn("step", F.row_number().over(fill)).withColumn("level", level)
    fits = F.col("level") <= F.col("cap").cast("double") / F.col("weight")
    found = F.min_by("level", F.when(fits, F.col("step"))).over(everything)
    steps = steps.withColumn("found", F.when(F.max(fits).over(everything), found))
    capped = F.col("found").isNull() | (F.col("found") * F.col("weight") > F.col("cap"))
    return steps.select("mix_source", "source_size",
                        F.when(capped, F.col("cap").cast("double")).otherwise(F.col("found") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, source: str, size: str, order: Sequence[str], weights: Sequence[int] = WEIGHTS,
        share: tuple[int, int] = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """docs with source_size, target and copies (long): how often the mix takes the row."""
    t = targets(docs, source, size, weights, share, cap)
    key, want, total = free(docs, "mix_key"), free(docs, "target"), free(docs, "source_size")
    t = saved(t.select(F.col("mix_source").alias(key), F.col("source_size").alias(total), F.col("target").alias(want)), "targets")
    expected, turn, offset = free(docs, "expected"), free(docs, "turn"), free(docs, "offset")
    rate = F.when(F.col(total) > 0, F.floor(F.col(want) / F.col(total) * UNIT)).otherwise(0).cast("long")
    numbers = ranked(docs, source, [F.col(size).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]], "mix", turn)
    named = F.concat(F.lit(f"{seed}:"), F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("is:"), F.col(source))))
    start = F.conv(F.substring(F.md5(named), 1, 6), 16, 10).cast("long")  # 24 bits: one offset in [0, 1)
    # With one rate for a source, the prefix sum up to a row is its number times the rate.
    upto = F.col(turn) * F.col(expected) + F.col(offset)
    crossed = F.shiftright(upto, 24) - F.shiftright(upto - F.col(expected), 24)
    return (numbers.join(t, F.col(source).eqNullSafe(F.col(key))).drop(key)
            .withColumn(expected, rate).withColumn(offset, start).withColumn(free(docs, "copies"), crossed).drop(expected, turn, offset))


def emit(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as the mix takes it."""
    n = free(mixed, "copy_no")
    return (mixed.where(F.col(copies) > 0)
            .withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).drop(n))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return mix(docs, "source", "size", ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP9_SQL = f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, 2 * source_size as cap, row_number() over (order by source nulls last) - 1 as turn,
         ([3, 1, 2])[((row_number() over (order by source nulls last) - 1) % 3) + 1]::bigint as weight from s
), l as (
  select *, row_number() over f as step,
         (3 * (select sum(source_size) from w) - 2 * coalesce(sum(cap) over (f rows between unbounded preceding and 1 preceding), 0))::double
           / (2 * sum(weight) over (f rows between current row and unbounded following))::double as level
  from w window f as (order by cap::double / weight, turn)
), v as (
  select arg_min(level, step) filter (where level <= cap::double / weight) as found from l
), t as (
  select source, source_size,
         case when found is null or found * weight > cap then cap::double else found * weight end as target from l, v
), r as (
  select d.doc_id, d.size, t.source_size, t.target,
         case when t.source_size > 0 then floor(t.target / t.source_size * {UNIT})::bigint else 0 end as rate,
         row_number() over (partition by d.source order by d.size, d.doc_id nulls first) as n,
         ('0x' || substr(md5('{SEED}:' || case when d.source is null then 'null' else 'is:' || d.source end), 1, 6))::bigint as offs
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       (((n * rate + offs) >> 24) - (((n - 1) * rate + offs) >> 24)) * size as taken
from r
"""
