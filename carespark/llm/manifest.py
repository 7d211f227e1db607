"""Merkle manifest of a dataset as a tree of SHA-256 midstates.

A leaf is the hash of a row's columns.  The leaves of one group (a source) in key
order, and then the groups' subroots, are hashed up in runs of FAN children: a
parent is the hash of its children's hex digests.  Beside its digest a parent
keeps a copy of the hash state *before each child slot*.  A digest in hex is just
one SHA-256 block, so such a state is 32 bytes that a table can hold
(``sha256.py``).  To fold a changed leaf into the root, the parent's state at the leaf's slot is
resumed with the replacement and the siblings to the right; nothing to the left
is hashed again.

The tree is cut into blocks of LEVELS levels (FAN^LEVELS leaves), so a block is
a bounded task whatever the size of a group, and no key holds more rows:

1. up: each block of items gives one row with all its parents' digests and states and its top
   digest, which is an item of the next stage, until every group has one item;
   the subroots are the items of one more tree;
2. down: each block's steps to the root (state, siblings to the left and right) are its own
   steps within the block above it and that one's steps;
3. the leaves of a block are folded together, with the block's states and steps.

Every table between is written.  Defined cases: null groups come first, null keys first within a group, equal
keys in the order of their leaves; a null column is marked apart from empty text; texts
of any length are hashed whole; repeated rows are leaves of their own; a group
of one row has its leaf as subroot, and one group's subroot is the root; a single row has
no siblings, so its proof is the hash of nothing; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, numbered, ranked, saved
from .sha256 import START, absorb, finish, hex_blocks, packed, unpacked

FAN = 3
LEVELS = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ITEM = "tree string, idx long, full binary, lone binary"
_STEPS = "array<struct<left:binary,state:binary,right:binary>>"


def field(c: Column) -> Column:
    """A value as ``length:text``, or ``-`` for null."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def parents(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parents' digests (p, 8) and states before each child slot (p, FAN, 8)."""
    blocks, count = hex_blocks(digests), len(digests)
    runs = np.minimum(FAN, count - np.arange(0, count, FAN))
    states = np.zeros((len(runs), FAN, 8), np.uint32)
    now = np.tile(START, (len(runs), 1))
    for slot in range(FAN):
        states[:, slot] = now
        has = runs > slot
        now[has] = absorb(now[has], blocks[slot::FAN])
    return finish(now, runs), states


def grown(digests: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The digests of the levels 0 to ``levels`` over the items, and the states of the levels above the items."""
    nodes, states = [digests], []
    for _ in range(levels):
        up, kept = parents(nodes[-1])
        nodes.append(up)
        states.append(kept)
    return nodes, states


def until_single(count: int, levels: int) -> int:
    """How many levels ``count`` items need to become one node."""
    up = 0
    while count > 1:
        count, up = -(-count // FAN), up + 1
    return min(up, levels)


def build_stage(items: DataFrame, levels: int) -> DataFrame:
    """tree, block, items, digests, states, full, lone: a row per block of the items (tree, idx, full, lone).

    ``full`` is the digest after all levels, for trees of several blocks; ``lone`` that of the first single node.
    """

    def run(key: tuple[pa.Scalar, ...], block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        nodes, states = grown(unpacked(b"".join(block.column("full").to_pylist()), len(block)), levels)
        lone = block.column("lone")[0].as_py() if len(block) == 1 else packed(nodes[until_single(len(block), levels)])
        return pa.Table.from_pylist([{
            "tree": key[0].as_py(), "block": key[1].as_py(), "items": len(block), "digests": packed(np.concatenate(nodes[1:])),
            "states": packed(np.concatenate(states)), "full": packed(nodes[-1]), "lone": lone}], schema=schema)

    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("items", pa.int64()), ("digests", pa.binary()),
                        ("states", pa.binary()), ("full", pa.binary()), ("lone", pa.binary())])
    return items.withColumn("block", F.expr(f"idx div {FAN**levels}")).groupBy("tree", "block").applyInArrow(
        run, "tree string, block long, items long, digests binary, states binary, full binary, lone binary")


def build(leaves: DataFrame, levels: int, label: str) -> list[tuple[DataFrame, DataFrame]]:
    """Per stage the items and their blocks, up to the stage at which every tree is one block."""
    stages, items = [], leaves
    while True:
        blocks = saved(build_stage(items, levels), f"{label}-{len(stages)}")
        stages.append((items, blocks))
        if not blocks.agg(F.max("block")).first()[0]:
            return stages
        items = blocks.select("tree", F.col("block").alias("idx"), "full", "lone")


class _Block:
    """A block's levels as they were built, from its row."""

    def __init__(self, row: dict, items: np.ndarray, levels: int):
        sizes = [len(items)]
        for _ in range(levels):
            sizes.append(-(-sizes[-1] // FAN))
        cuts = np.cumsum([0, *sizes[1:]])
        digests, states = unpacked(row["digests"], cuts[-1]), unpacked(row["states"], cuts[-1], FAN)
        self.used = until_single(sizes[0], levels) if row["alone"] else levels
        self.nodes = [items, *(digests[a:b] for a, b in pairwise(cuts))]
        self.states = [states[a:b] for a, b in pairwise(cuts)]
        self.above = row["steps"]

    def siblings(self, level: int, child: int) -> tuple[list[bytes], list[bytes]]:
        first = child - child % FAN
        names = self.names[level]
        return names[first:child], names[child + 1:first + FAN]

    @property
    def names(self) -> list[list[bytes]]:
        if not hasattr(self, "_names"):
            self._names = [[packed(d).hex().encode() for d in level] for level in self.nodes[:self.used]]
        return self._names

    def steps(self, child: int) -> list[dict]:
        """The steps of an item within the block, then those above."""
        out = []
        for level in range(self.used):
            left, right = self.siblings(level, child)
            out.append({"left": b"".join(left), "state": packed(self.states[level][child // FAN, child % FAN]), "right": b"".join(right)})
            child //= FAN
        return out + self.above

    def proofs(self) -> list[str]:
        """The hash of each item's siblings, level by level up to the root."""
        above = [b"".join(s["left"] + s["right"] for s in self.above)]
        for level in reversed(range(self.used)):
            here = []
            for child in range(len(self.nodes[level])):
                left, right = self.siblings(level, child)
                here.append(b"".join([*left, *right, above[child // FAN]]))
            above = here
        return [hashlib.sha256(p).hexdigest() for p in above]

    def folded(self, replaced: np.ndarray) -> np.ndarray:
        """The root for each item's replacement, each by itself: kept state, replacement, right siblings."""
        now, place = replaced, np.arange(len(replaced))
        for level in range(self.used):
            blocks, slot, parent = hex_blocks(self.nodes[level]), place % FAN, place // FAN
            runs = np.minimum(FAN, len(blocks) - parent * FAN)
            state = absorb(self.states[level][parent, slot], hex_blocks(now))
            for k in range(1, FAN):
                has = slot + k < runs
                state[has] = absorb(state[has], blocks[place[has] + k])
            now, place = finish(state, runs), parent
        for step in self.above:
            state = absorb(np.tile(unpacked(step["state"]), (len(now), 1)), hex_blocks(now))
            right = np.frombuffer(step["right"], ">u4").astype(np.uint32).reshape(-1, 16)
            for sibling in right:
                state = absorb(state, sibling)
            now = finish(state, np.full(len(now), len(step["left"]) // 64 + 1 + len(right)))
        return now


_PATH = f"tree string, idx long, alone boolean, steps {_STEPS}, subroot binary, root binary"


def _below(items: DataFrame, blocks: DataFrame, paths: DataFrame, levels: int, run, schema: str) -> DataFrame:
    """``run`` over each block's items and its one row with states and path."""
    held = blocks.drop("full", "lone").join(paths.withColumnRenamed("idx", "block"), ["tree", "block"])
    items = items.withColumn("block", F.expr(f"idx div {FAN**levels}"))
    return items.groupBy("tree", "block").cogroup(held.groupBy("tree", "block")).applyInArrow(run, schema)


def _opened(items: pa.Table, held: pa.Table, levels: int) -> tuple[pa.Table, dict, _Block]:
    items, row = items.sort_by("idx"), held.to_pylist()[0]
    return items, row, _Block(row, unpacked(b"".join(items.column("full").to_pylist()), len(items)), levels)


def item_paths(items: DataFrame, blocks: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """The paths (steps to the root) of the items of one stage, from those of their blocks."""

    def run(items: pa.Table, held: pa.Table) -> pa.Table:
        items, row, block = _opened(items, held, levels)
        out = [{"tree": row["tree"], "idx": idx, "alone": row["alone"] and len(items) == 1, "steps": block.steps(child),
                "subroot": row["subroot"], "root": row["root"]} for child, idx in enumerate(items.column("idx").to_pylist())]
        return pa.Table.from_pylist(out, schema=schema)

    step = pa.list_(pa.struct([("left", pa.binary()), ("state", pa.binary()), ("right", pa.binary())]))
    schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("alone", pa.bool_()), ("steps", step), ("subroot", pa.binary()), ("root", pa.binary())])
    return _below(items, blocks, paths, levels, run, _PATH)


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """id, leaf, subroot, root, proof, folded (all hex) of rows (tree, id, leaf, now).

    ``tree`` names a row's group (not null, in the groups' order), ``leaf`` is its
    hash, ``now`` the hash to fold into the root in its place (null: its own).
    """
    placed = ranked(rows, "tree", [F.col("id").asc_nulls_first(), F.col("leaf")], "leaves", "idx")
    placed = saved(placed.withColumn("idx", F.col("idx") - 1).withColumn("full", F.unhex("leaf")).withColumn("lone", F.col("full")), "leaves")
    stages = build(placed, levels, "manifest")
    tops = stages[-1][1].select("tree", F.col("lone").alias("subroot"))
    tops = saved(numbered(tops, [F.col("tree")], "subroots", "idx"), "subroots")
    roots = build(tops.select(F.lit("").alias("tree"), "idx", F.col("subroot").alias("full"), F.col("subroot").alias("lone")), levels, "manifest-roots")
    none = F.array().cast(_STEPS)
    paths = roots[-1][1].select("tree", F.col("block").alias("idx"), F.lit(True).alias("alone"), none.alias("steps"),
                                F.lit(None).cast("binary").alias("subroot"), F.col("lone").alias("root"))
    for at, (items, blocks) in reversed(list(enumerate(roots))):
        paths = saved(item_paths(items, blocks, paths, levels), f"root-paths-{at}")
    paths = paths.drop("tree", "subroot").join(tops, "idx").select(
        "tree", F.lit(0).cast("long").alias("idx"), F.lit(True).alias("alone"), "steps", "subroot", "root")
    for at, (items, blocks) in reversed(list(enumerate(stages[1:], 1))):
        paths = saved(item_paths(items, blocks, paths, levels), f"paths-{at}")

    def run(items: pa.Table, held: pa.Table) -> pa.Table:
        items, row, block = _opened(items, held, levels)
        leaves = items.column("leaf").to_pylist()
        now = [n or leaf for n, leaf in zip(items.column("now").to_pylist(), leaves)]
        folded = block.folded(unpacked(bytes.fromhex("".join(now)), len(now)))
        return pa.Table.from_pydict({
            "id": items.column("id"), "leaf": leaves, "subroot": [row["subroot"].hex()] * len(items), "root": [row["root"].hex()] * len(items),
            "proof": block.proofs(), "folded": [packed(f).hex() for f in folded]})

    return _below(*stages[0], paths, levels, run, "id long, leaf string, subroot string, root string, proof string, folded string")


def document_rows(docs: DataFrame, key: str = "doc_id", group: str = "source", text: str = "text", columns: Sequence[str] = COLUMNS) -> DataFrame:
    """tree, id, leaf, now: ``now`` is the leaf without the text's line feeds for every other document (by the id's crc32)."""
    tampered = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    cut = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in columns]
    leaf = leaf_hash([F.col(c) for c in columns])
    # Equal to the order of the names as UTF-8 bytes, null first.
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group)))
    return docs.select(tree.alias("tree"), F.col(key).cast("long").alias("id"), leaf.alias("leaf"),
                       F.when(tampered & F.contains(F.col(text), F.lit("\n")), leaf_hash(cut)).alias("now"))


def op12_manifest(spark, sf_dir: str) -> DataFrame:
    out = manifest(document_rows(documents(spark, sf_dir).select(*COLUMNS)))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                      F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def oracle(depth: int = 24) -> str:
    """DuckDB SQL for op12's rows: every tree hashed up level by level, ``depth`` levels at most, and every document folded."""
    return f"""
WITH RECURSIVE named AS (
  SELECT doc_id, source, text,
         concat({', '.join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in COLUMNS[:4])}) AS head,
         -- crc32, bit by bit
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
             lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                               lambda x, _: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 2 = 0 AS tampered
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         CASE WHEN tampered AND text IS NOT NULL THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) END AS now
  FROM named),
placed AS (
  SELECT *, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaves),
-- All levels of the sources' trees.  A tree of one node is done.
low AS (
  SELECT tree, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS nodes FROM placed
  UNION ALL
  SELECT * FROM (
    SELECT tree, level + 1, idx // {FAN}, sha256(string_agg(digest, '' ORDER BY idx)), any_value((nodes + {FAN - 1}) // {FAN})
    FROM low WHERE nodes > 1 AND level < {depth} GROUP BY tree, level, idx // {FAN}) AS up),
subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx FROM low WHERE nodes = 1),
high AS (
  SELECT '*' AS tree, 0 AS level, idx, digest, count(*) OVER () AS nodes FROM subroots
  UNION ALL
  SELECT * FROM (
    SELECT '*', level + 1, idx // {FAN}, sha256(string_agg(digest, '' ORDER BY idx)), any_value((nodes + {FAN - 1}) // {FAN})
    FROM high WHERE nodes > 1 AND level < {depth} GROUP BY level, idx // {FAN}) AS up),
nodes AS (
  SELECT 0 AS part, tree, level, idx, digest, nodes FROM low UNION ALL SELECT 1, tree, level, idx, digest, nodes FROM high),
around AS (  -- a node's siblings to the left and right
  SELECT part, tree, level, idx, nodes,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE nodes > 1 WINDOW w AS (PARTITION BY part, tree, level, idx // {FAN} ORDER BY idx)),
walk AS (  -- every document on its way up
  SELECT p.doc_id, p.tree AS own, p.idx AS own_idx, 0 AS part, p.tree, 0 AS level, p.idx, coalesce(p.now, p.leaf) AS digest, '' AS siblings
  FROM placed p
  UNION ALL
  SELECT w.doc_id, w.own, w.own_idx,
         CASE WHEN a.tree IS NULL THEN w.part + 1 ELSE w.part END,
         CASE WHEN a.tree IS NULL THEN '*' ELSE w.tree END,
         CASE WHEN a.tree IS NULL THEN 0 ELSE w.level + 1 END,
         CASE WHEN a.tree IS NULL THEN s.idx ELSE w.idx // {FAN} END,
         CASE WHEN a.tree IS NULL THEN w.digest ELSE sha256(a.before || w.digest || a.after) END,
         CASE WHEN a.tree IS NULL THEN w.siblings ELSE w.siblings || a.before || a.after END
  FROM walk w
  LEFT JOIN around a ON a.part = w.part AND a.tree = w.tree AND a.level = w.level AND a.idx = w.idx
  LEFT JOIN subroots s ON s.tree = w.tree
  WHERE w.part < 2)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(w.siblings) AS proof_sha256, w.digest AS folded_root,
       w.digest = r.digest AS verified
FROM walk w JOIN placed p ON p.tree = w.own AND p.idx = w.own_idx
JOIN subroots s ON s.tree = w.own
JOIN high r ON r.nodes = 1
WHERE w.part = 2
"""


OP12_SQL = oracle()
