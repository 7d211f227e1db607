"""Exact top-k inner-product search by columnar branch and bound.

Vectors are held by dimension.  For a query, partial products are accumulated
over one block of dimensions at a time; by Cauchy-Schwarz the dimensions to
come add at most |rest of query| * |rest of vector| either way.  A candidate
whose upper bound is below the k-th best lower bound can't be among the best k
and is dropped; the survivors are compacted before the next block.  Scores of
those that remain are complete, so the result is exact.

Candidates are dealt by hash into blocks of about ``block_bytes`` and queries
into blocks of about ``query_rows``; each pair of blocks is one bounded task,
and only k rows per query and block go on to the final ranking.  Exact search
without an index compares each query with every candidate: a candidate is shuffled once
per block of queries, and the bounds save dimensions, not candidates.

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part; only vectors of equal length are compared; every row stands for itself,
so repeated rows and ids are each a query and a candidate, and a query leaves out its own row
only; null ids take no part; fewer candidates than k give them all; an empty table gives no
rows; further columns are ignored.  Whole numbers beyond +-2^53 raise an error; where sums of products could pass
2^53, scores are computed in Python's integers, and one beyond a long raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import saved, table

BLOCK_BYTES = 8 << 20
QUERY_ROWS = 4_096
DIM_BLOCK = 8
K = 5


def best_in_block(queries: np.ndarray, q_own: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray | None = None, k: int = K,
                  dim_block: int = DIM_BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, row id, score) of each query's best k rows, ties to the smaller id.

    ``own`` names the rows (default: their ids); a query leaves out the row that is named as in ``q_own``.
    """
    own = ids if own is None else own
    order = np.argsort(ids, kind="stable")
    ids, rows, own = ids[order], rows[order], own[order]
    n, dims = rows.shape
    if dims and float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * dims >= 1 << 53:
        return _best_of_large(queries, q_own, rows, ids, own, k)
    vertical = np.ascontiguousarray(rows.T.astype(np.float64))
    cuts = [*range(0, dims, dim_block), dims]
    row_rest = np.zeros((len(cuts), n))
    query_rest = np.zeros((len(cuts), len(queries)))
    for b in range(len(cuts) - 2, -1, -1):
        row_rest[b] = row_rest[b + 1] + np.square(vertical[cuts[b]:cuts[b + 1]]).sum(0)
        query_rest[b] = query_rest[b + 1] + np.square(queries[:, cuts[b]:cuts[b + 1]].astype(np.float64)).sum(1)
    # A little more than the exact norm, so that rounding never drops a row.
    row_rest, query_rest = np.sqrt(row_rest) * (1 + 1e-9), np.sqrt(query_rest) * (1 + 1e-9)
    found: tuple[list, list, list] = ([], [], [])
    for i, q in enumerate(queries.astype(np.float64)):
        alive = np.flatnonzero(own != q_own[i])
        if not len(alive):
            continue
        score = np.zeros(len(alive))
        for b in range(len(cuts) - 1):
            part = vertical[cuts[b]:cuts[b + 1]]
            if len(alive) < n // 2:
                part = part[:, alive]
                score += q[cuts[b]:cuts[b + 1]] @ part
            else:
                score += (q[cuts[b]:cuts[b + 1]] @ part)[alive]
            if b + 2 < len(cuts) and len(alive) > 4 * k:
                slack = query_rest[b + 1, i] * row_rest[b + 1, alive]
                least = np.partition(score - slack, len(alive) - k)[len(alive) - k]
                keep = score + slack >= least
                if keep.sum() < 0.8 * len(alive):
                    alive, score = alive[keep], score[keep]
        exact = np.rint(score).astype(np.int64)
        top = np.lexsort((ids[alive], -exact))[:k] if len(alive) <= 64 else _top(exact, ids[alive], k)
        found[0].append(np.full(len(top), i))
        found[1].append(ids[alive[top]])
        found[2].append(exact[top])
    if not found[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in found)


def _best_of_large(queries, q_own, rows, ids, own, k):
    """As best_in_block, in Python's integers: products of such numbers aren't exact as doubles."""
    found = []
    for i, q in enumerate(queries.astype(object)):
        scores = rows.astype(object) @ q
        best = sorted((-int(s), int(r)) for s, r, o in zip(scores, ids, own) if o != q_own[i])[:k]
        found += [(i, r, -s) for s, r in best]
    at, hit, score = zip(*found) if found else ((), (), ())
    return np.array(at, np.int64), np.array(hit, np.int64), np.array(score, np.int64)


def _top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best k, ties to the smaller id."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= edge)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))][:k]


def whole(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as long; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    limit = F.lit(float(1 << 53))
    ints = F.transform(vector, lambda x: F.when(F.abs(x.cast("double") * scale) < limit, F.floor(x.cast("double") * scale).cast("long"))
                       .otherwise(F.raise_error(F.concat(F.lit("beyond 2^53 once scaled: "), x.cast("string"))).cast("long")))
    return F.when(F.col(vector).isNotNull() & ~bad, ints)


def top_k(vectors: DataFrame, id_col: str, ints: str, is_query: Column, k: int = K,
          block_bytes: int = BLOCK_BYTES, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's best k; ``ints``: array<long>, null takes no part."""
    rows = (vectors.where(F.col(ints).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(ints).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")))
    # Written, so that a row keeps its name in retried tasks.
    rows = saved(rows.withColumn("own", F.monotonically_increasing_id()), "vectors")
    n_q, size = rows.agg(F.count_if("q"), F.sum(F.size("v").cast("long") * 8)).first()
    blocks, q_blocks = max(1, -(-(size or 0) // block_bytes)), max(1, -(-n_q // query_rows))

    def spread(df: DataFrame, mine: str, n_mine: int, other: str, n_other: int) -> DataFrame:
        return (df.select("id", "own", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("own"), F.lit(n_mine)).cast("int").alias(mine))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    left = spread(rows.where("q"), "qb", q_blocks, "cb", blocks)
    right = spread(rows, "cb", blocks, "qb", q_blocks)

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        def of(t):
            c = t.combine_chunks()
            ids = c["id"].to_numpy()
            flat = [x.flatten().to_numpy(zero_copy_only=False) for x in c["v"].chunks]
            v = np.concatenate(flat or [np.zeros(0, np.int64)]).reshape(len(ids), -1) if len(ids) else np.zeros((0, 0), np.int64)
            return ids, c["own"].to_numpy(), v

        (q_ids, q_own, q), (ids, own, v) = of(a), of(b)
        if not len(q_ids) or not len(ids):
            at, hit, score = (np.zeros(0, np.int64),) * 3
        else:
            at, hit, score = best_in_block(q, q_own, v, ids, own, k)
        return pa.table({"query": pa.array(q_own[at], pa.int64()), "query_id": pa.array(q_ids[at], pa.int64()),
                         "vec_id": pa.array(hit, pa.int64()), "score": pa.array(score, pa.int64())})

    keys = ["dims", "cb", "qb"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op6_topk(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", whole("embedding").alias("ints"))
    return top_k(vectors, "vec_id", "ints", F.col("vec_id") % 50 == 0)


OP6_SQL = """
with v as (
  select vec_id, row_number() over () as own, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as ints from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), p as (
  select q.own, q.vec_id as query_id, c.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.ints, c.ints), lambda z: z[1] * z[2])), 0)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.own <> q.own and len(q.ints) = len(c.ints)
), r as (
  select *, row_number() over (partition by own order by score desc, vec_id)::int as rank from p
)
select query_id, rank, vec_id, score from r where rank <= 5
"""
