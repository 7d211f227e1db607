"""SimHash near-dedup by a self-join of the binary trie of fingerprints.

1. Every whole text gets a 64-bit fingerprint: a bit is set if more than half
   of its shingles' XXH64 hashes (repeats counted) have it set.  Rows of one
   fingerprint are one class, held by its smallest id; only classes are joined.
2. The fingerprints are a binary trie, first bit at the root.  The join walks
   pairs of nodes of equal depth from (root, root) down: a pair of children
   differs in the bits that its parents differ in, and in one more if the
   children's own bits differ; beyond ``radius`` differing bits the pair and
   all below it are given up.
3. The upper levels are walked as a table of node pairs (STEP bits a round).  As
   soon as both nodes of a pair hold no more than ``leaf`` fingerprints
   together, the pair is walked to its end inside one task, in numpy, so a
   busy prefix is only walked further down and no task holds more than that.
   A task holds a bounded part of its frontier at a time, gives up node pairs
   whose fingerprints it has already joined into one component, and returns a
   spanning forest of the links it found, never all pairs of a dense group.
4. Connected components over all forests give the groups.

A fingerprint has at most C(64,1)+C(64,2)+C(64,3) = 43,744 others within three bits,
and n fingerprints make about n * (1+d+C(d,2)+C(d,3)) / 2 node pairs at depth d = log2(n), after
which pairs without a near partner die out.

Defined cases: texts that are null, empty or without words have fingerprint
zero and are linked like any other; a text with fewer words than a shingle
takes is one shingle; texts of any length are read whole; repeated rows and ids each give a row
of their own; a null id keeps its row and names a component only if
all its ids are null (the component is null then); further columns are not read, whatever their names; empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespark.operators.skew import heavy, spread_lookup

from .common import documents, free, saved, sliced
from .components import components

WIDTH = 3
RADIUS = 3
SEED = 42
#: Most fingerprints of a node pair that one task walks to the end.
LEAF = 1 << 15
#: Bits that a round of the upper walk goes down.
STEP = 2
#: Node pairs that a task holds at once on one branch of its walk.
FRONTIER = 1 << 17
_BITS = 64
_ROWS = 1 << 14


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint of a text; A-Z count as a-z, words are runs of anything but ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    width = min(width, len(words))
    begin, stop = starts[:len(words) - width + 1].tolist(), (ends[width - 1:] - 1).tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(_BITS, np.int64)
    for at in range(0, len(begin), _ROWS):
        hashes = b"".join([digest(data[a:b], SEED) for a, b in zip(begin[at:at + _ROWS], stop[at:at + _ROWS])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(begin)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """id, fp: the fingerprint of every row's whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "fp": pa.array(found.view(np.int64))})

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, fp long")


class Forest:
    """Components of places 0..n-1: each place knows the smallest place of its component."""

    def __init__(self, n: int):
        self.low = np.arange(n)
        self._runs: np.ndarray | None = None

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.low[a], self.low[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            self._runs = None
            np.minimum.at(self.low, np.maximum(x, y), np.minimum(x, y))
            while True:
                shorter = self.low[self.low]
                if np.array_equal(shorter, self.low):
                    break
                self.low = shorter

    def one(self, u: np.ndarray, u_end: np.ndarray, v: np.ndarray, v_end: np.ndarray) -> np.ndarray:
        """Whether all places of [u, u_end) and [v, v_end) are in one component."""
        if self._runs is None:
            self._runs = _next_break(self.low[1:] != self.low[:-1])
        return (self._runs[u] >= u_end) & (self._runs[v] >= v_end) & (self.low[u] == self.low[v])


def _next_break(breaks: np.ndarray) -> np.ndarray:
    """For each place the end of its run; breaks[i]: a run ends between i and i + 1."""
    n = len(breaks) + 1
    at = np.append(np.where(breaks, np.arange(1, n), n), n)
    return np.minimum.accumulate(at[::-1])[::-1]


def walk(fps: np.ndarray, u: int, v: int, depth: int, differing: int, radius: int = RADIUS, frontier: int = FRONTIER) -> np.ndarray:
    """For each of the sorted distinct ``fps`` the first place of its component over the links found below the node pair.

    The nodes are those at ``depth`` that hold the places ``u`` and ``v`` (u <= v), with ``differing`` bits apart so far.
    """
    n = len(fps)
    shared = np.full(max(n - 1, 0), _BITS)
    for bit in range(_BITS):  # leading bits that neighbours have in common
        shared[(shared == _BITS) & ((fps[1:] ^ fps[:-1]) >> np.uint64(_BITS - 1 - bit) != 0)] = bit
    ends: dict[int, np.ndarray] = {}

    def end(d: int) -> np.ndarray:
        if d not in ends:
            ends[d] = _next_break(shared < d)
        return ends[d]

    forest = Forest(n)
    stack = [(depth, np.array([u]), np.array([v]), np.array([differing], np.int8))]
    while stack:
        d, a, b, err = stack.pop()
        a_end, b_end = end(d)[a], end(d)[b]
        single = (a_end - a == 1) & (b_end - b == 1)
        if single.any():
            x, y = a[single], b[single]
            near = (x != y) & (np.bitwise_count(fps[x] ^ fps[y]) <= radius)
            forest.join(x[near], y[near])
        live = ~single & ~forest.one(a, a_end, b, b_end)
        a, b, err, a_end, b_end = a[live], b[live], err[live], a_end[live], b_end[live]
        if not len(a):
            continue
        if len(a) > frontier:  # nearest pairs first: what they join needn't be walked again
            order = np.argsort(err, kind="stable")
            for half in (order[len(a) // 2:], order[:len(a) // 2]):
                stack.append((d, a[half], b[half], err[half]))
            continue
        a_bit, b_bit = ((fps[p] >> np.uint64(_BITS - 1 - d)).astype(np.int8) & 1 for p in (a, b))
        a_mid, b_mid = end(d + 1)[a], end(d + 1)[b]  # where a second child begins, if there is one
        a_two, b_two, same = a_mid < a_end, b_mid < b_end, a == b
        cases = [(a, b, err + (a_bit ^ b_bit), np.ones(len(a), bool)), (a, b_mid, err + (a_bit ^ 1), b_two),
                 (a_mid, b, err + (1 ^ b_bit), a_two & ~same), (a_mid, b_mid, err, a_two & b_two)]
        kept = [(x[k], y[k], e[k]) for x, y, e, has in cases for k in [has & (e <= radius)]]
        stack.append((d + 1, *(np.concatenate(column) for column in zip(*kept))))
    return forest.low


def _node(depth: int) -> Column:
    return F.shiftrightunsigned("fp", _BITS - depth) if depth else F.lit(0).cast("long")


_PAIR = "u long, v long, differing int"


def node_pairs(classes: DataFrame, radius: int, leaf: int) -> Iterator[tuple[int, DataFrame]]:
    """(depth, u, v, differing) of the node pairs whose fingerprints fit one task, from the upper walk."""
    spark = classes.sparkSession
    pairs, live, depth = spark.createDataFrame([(0, 0, 0)], _PAIR), classes, 0
    while True:
        nodes = live.groupBy(_node(depth).alias("node")).agg(F.count("*").alias("n"))
        met = pairs
        for side in ("u", "v"):
            met = met.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
        both = F.col("n_u") + F.when(F.col("u") == F.col("v"), 0).otherwise(F.col("n_v"))
        met = saved(met.select("u", "v", "differing", (both > max(leaf, 1 << STEP + 1)).alias("open")), "node-pairs")
        yield depth, met.where(~F.col("open"))
        held = met.where("open")
        if held.isEmpty():
            return
        wanted = held.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        live = classes.withColumn("node", _node(depth)).join(wanted, "node", "left_semi").select("fp")
        depth += STEP
        below = live.select(_node(depth).alias("node")).distinct()
        pairs = held.select("u", "v", "differing")
        for side in ("u", "v"):
            child = below.select(F.shiftrightunsigned("node", STEP).alias(side), F.col("node").alias(f"{side}_child"))
            pairs = pairs.join(child, side)
        apart = F.bit_count(F.col("u_child").bitwiseXOR(F.col("v_child")).bitwiseAND((1 << STEP) - 1))
        pairs = pairs.select(F.col("u_child").alias("u"), F.col("v_child").alias("v"), (F.col("differing") + apart).cast("int").alias("differing"))
        # Below a node paired with itself, each pair of children is met both ways.
        pairs = saved(pairs.where((F.col("differing") <= radius) & (F.col("u") <= F.col("v"))), "children")


def trie_links(classes: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """a, b: links of a spanning forest per node pair between the names of classes (fp, name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(len(batch))):
                at = {name: row.column(name)[0] for name in row.schema.names}
                parts = [_sorted(at["fps_u"].values, at["ids_u"].values)]
                if at["u"] != at["v"]:
                    parts.append(_sorted(at["fps_v"].values, at["ids_v"].values))
                fps, ids = np.concatenate([f for f, _ in parts]), pa.concat_arrays([i for _, i in parts])
                other = len(parts[0][0]) if len(parts) > 1 else 0
                low = walk(fps, 0, other, at["depth"].as_py(), at["differing"].as_py(), radius)
                linked, signed = np.flatnonzero(low != np.arange(len(low))), fps.view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": pa.array(signed[linked]), "a_id": ids.take(pa.array(linked)),
                                                  "b": pa.array(signed[low[linked]]), "b_id": ids.take(pa.array(low[linked]))})

    # A stated number of tasks: the pairs are few bytes and much work, so they aren't merged into fewer.
    tasks, out = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), None
    for depth, pairs in node_pairs(classes.select("fp"), radius, leaf):
        wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        blocks = classes.withColumn("node", _node(depth)).join(wanted, "node", "left_semi").groupBy("node")
        blocks = blocks.agg(F.collect_list(F.struct("fp", "id")).alias("held")).select("node", F.col("held.fp").alias("fps"), F.col("held.id").alias("ids"))
        met, blocks = pairs.withColumn("depth", F.lit(depth)), blocks.repartition(tasks, "node")
        for side in ("u", "v"):
            held = blocks.select(*[F.col(c).alias(s) for c, s in (("node", side), ("fps", f"fps_{side}"), ("ids", f"ids_{side}"))])
            met = met.repartition(tasks, side).join(held.hint("merge"), side)
        out = met if out is None else out.unionByName(met)
    found = out.mapInArrow(run, "a long, a_id long, b long, b_id long")
    return found.select(_name("a_id", "a").alias("a"), _name("b_id", "b").alias("b"))


def _sorted(fps: pa.Array, ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
    fps = fps.to_numpy().view(np.uint64)
    order = np.argsort(fps)
    return fps[order], ids.take(pa.array(order))


def _name(key: str, fp: str) -> Column:
    """What a class is called: ordered by its smallest id, classes without any last."""
    return F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("id"), F.col(fp).alias("fp"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS,
                    leaf: int = LEAF) -> DataFrame:
    """A row per document: id, fp (signed), component (the smallest id that links reach)."""
    rows = saved(fingerprints(docs, key, text, width), "fingerprints")
    classes = saved(rows.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("rows")), "fingerprint-classes")
    links = saved(trie_links(classes.select("fp", "id"), radius, leaf), "trie-links")
    parts = components(links).select(F.col("node.fp").alias("fp"), F.col("component.id").alias("reached"))
    named = classes.join(parts, "fp", "left").select("fp", "rows", F.coalesce("reached", "id").alias("component"))
    named = saved(named, "fingerprint-components")
    total = rows.count()
    return spread_lookup(rows, named, "fp", heavy(F.col("rows"), total)).select("id", "fp", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The rows of docs whose id is the smallest of its group (rows without an id stay)."""
    gone = free(docs, "gone_id")
    found = near_duplicates(docs, key, text, width, radius).where(F.col("id") != F.col("component")).select(F.col("id").alias(gone)).distinct()
    return docs.join(found, F.col(key) == F.col(gone), "left_anti")


def op11_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
