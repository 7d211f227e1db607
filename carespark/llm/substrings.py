"""Dedup of long substrings: every byte of a ``window``-byte string that also starts elsewhere.

1. Each window has one content-chosen anchor gram, so equal windows meet under
   the same gram, and the bytes of an anchor's windows are its fragment
   (``anchors.py``).  Grams with one occurrence can't repeat and go.
2. Fragments with the same bytes become one with a count; from two on, all
   their windows repeat.
3. Where a gram has several fragments, their bytes are cut from the texts and
   gathered by gram.  Each task joins whole grams to strings of about INDEX_BYTES,
   fragments set apart by a byte that UTF-8 never has, builds the run-length
   index (``runindex.py``) and streams matching statistics: a window whose
   statistic is at least ``window`` also starts in another fragment.
4. Spans go back to every occurrence of a fragment and are merged per document.

A gram whose fragments have over GROUP_BYTES in all doesn't go to one task:
its windows are hashed (128 bits) and counted by Spark instead (:func:`by_windows`),
which needs no group in one place.

Defined cases: null text counts as empty; texts shorter than the window keep
all; repeated rows (same doc_id and text) repeat each other; null doc_ids are
rows like others; columns of the input stay; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import anchors
from .common import documents, free, saved, sliced
from .runindex import RunIndex
from .shingles import mix, prefix_hashes

WINDOW = 200
GRAM = 32
INDEX_BYTES = 1 << 20
GROUP_BYTES = 2 << 20
_APART = b"\xff"
_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def found_anchors(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """gram, frag, d, t, a, b: the anchors of rows (d, t, text); windows a..b (byte places) are the anchor's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            for of, a, b, g, f in anchors(texts, window, gram):
                own = batch.select(["d", "t"]).take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g), pa.array(f), *own.columns, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                    names=["gram", "frag", "d", "t", "a", "b"])

    return rows.mapInArrow(run, "gram long, frag long, d long, t int, a int, b int")


def cut(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """gram, frag, big, data: the bytes of the fragments that ``wanted`` (gram, frag, d, t, a, b, big) names."""
    lists = (wanted.groupBy(F.col("d").alias("wd"), F.col("t").alias("wt"))
             .agg(F.collect_list(F.struct("gram", "frag", "a", "b", "big")).alias("cuts")))
    met = (rows.join(lists, rows.d.eqNullSafe(lists.wd) & (rows.t == lists.wt))
           .select("text", "cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out: dict[str, list] = {"gram": [], "frag": [], "big": [], "data": []}
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
                data = text.encode()
                for c in cuts:
                    out["gram"].append(c["gram"])
                    out["frag"].append(c["frag"])
                    out["big"].append(c["big"])
                    out["data"].append(data[c["a"]:c["b"] + window])
            yield pa.RecordBatch.from_pydict({"gram": pa.array(out["gram"], pa.int64()), "frag": pa.array(out["frag"], pa.int64()),
                                              "big": pa.array(out["big"], pa.bool_()), "data": pa.array(out["data"], pa.binary())})

    # A repeated row has the same cuts; one of each fragment is enough.
    return met.mapInArrow(run, "gram long, frag long, big boolean, data binary")


def repeating(fragments: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """For each (different) fragment the runs of window starts, first and last, that also start in another one."""
    data = np.frombuffer(_APART.join(fragments) + _APART, np.uint8)
    longest = RunIndex(data, window).matches()
    sizes = np.array([len(f) for f in fragments])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    out = []
    for a, size in zip(begin, sizes):
        hit = np.flatnonzero(longest[a:a + size - window + 1] >= window)
        if len(hit):
            edge = np.flatnonzero(np.diff(hit) > 1)
            out.append(list(zip(hit[np.append(0, edge + 1)].tolist(), hit[np.append(edge, len(hit) - 1)].tolist())))
        else:
            out.append([])
    return out


def by_index(fragments: DataFrame, window: int, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """gram, frag, runs: the runs of window starts that repeat, by a run-length index over whole grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[int] = []
        frags: list[int] = []
        data: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            runs = repeating(data, window)
            keep = [i for i, r in enumerate(runs) if r]
            return pa.RecordBatch.from_pydict({
                "gram": pa.array([grams[i] for i in keep], pa.int64()), "frag": pa.array([frags[i] for i in keep], pa.int64()),
                "runs": pa.array([[{"a": a, "b": b} for a, b in runs[i]] for i in keep], _SPANS)})

        for batch in batches:
            for g, f, x in zip(*(batch.column(c).to_pylist() for c in ("gram", "frag", "data"))):
                if size >= index_bytes and g != grams[-1]:
                    yield flush()
                    grams, frags, data, size = [], [], [], 0
                if not (grams and grams[-1] == g and frags[-1] == f):  # repeated rows cut a fragment again
                    grams.append(g)
                    frags.append(f)
                    data.append(x)
                    size += len(x) + 1
        if data:
            yield flush()

    dealt = fragments.repartition(F.col("gram")).sortWithinPartitions("gram", "frag")
    return dealt.mapInArrow(run, "gram long, frag long, runs array<struct<a:long,b:long>>")


def by_windows(fragments: DataFrame, window: int) -> DataFrame:
    """The same by counting the hashes of all windows; no gram has to be in one task."""
    tables = [np.random.Generator(np.random.PCG64(s)).integers(1, 1 << 63, 256, np.uint64) for s in (21, 22)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, f, x in zip(*(batch.column(c).to_pylist() for c in ("gram", "frag", "data"))):
                data = np.frombuffer(x, np.uint8)
                both = []
                for table in tables:
                    s, down = prefix_hashes(data, table)
                    both.append(mix((s[window:] - s[:-window]) * down[:len(data) - window + 1]).view(np.int64))
                n = len(both[0])
                yield pa.RecordBatch.from_pydict({
                    "gram": pa.array(np.full(n, g, np.int64)), "frag": pa.array(np.full(n, f, np.int64)),
                    "at": pa.array(np.arange(n)), "x": pa.array(both[0]), "y": pa.array(both[1])})

    windows = fragments.dropDuplicates(["gram", "frag"]).mapInArrow(run, "gram long, frag long, at long, x long, y long")
    twice = windows.groupBy("x", "y").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("x", "y")
    hits = windows.join(saved(twice, "windows"), ["x", "y"]).groupBy("gram", "frag").agg(F.collect_set("at").alias("hits"))
    return hits.select("gram", "frag", F.transform("hits", lambda i: F.struct(i.alias("a"), i.alias("b"))).alias("runs"))


def repeated_spans(docs: DataFrame, key: str, text: str, window: int = WINDOW, gram: int = GRAM,
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """d, t (the row: key and a hash of its text), spans: byte ranges a..b (b not included) that repeat elsewhere."""
    rows = keyed(docs, key, text)
    found = found_anchors(rows, window, gram)
    grams = saved(found.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("gram"), "grams")
    met = saved(found.join(grams, "gram"), "anchors")
    kinds = saved(met.groupBy("gram", "frag").agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "a", "b")).alias("at")), "fragments")
    length = (F.col("at.b") - F.col("at.a") + window).cast("long")
    several = saved(kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum(length).alias("bytes")).where(F.col("kinds") > 1), "several")
    mixed = kinds.join(several, "gram").select("gram", "frag", "at.*", (F.col("bytes") > group_bytes).alias("big"))
    pieces = saved(cut(rows, mixed, window), "pieces")  # texts are gone through once for both ways
    runs = by_index(pieces.where(~F.col("big")), window).union(by_windows(pieces.where("big"), window))
    # Fragments with a count of two or more repeat from end to end.
    whole = kinds.where(F.col("n") > 1).select("gram", "frag", F.array(F.struct(
        F.lit(0).cast("long").alias("a"), (F.col("at.b") - F.col("at.a")).cast("long").alias("b"))).alias("runs"))
    single = kinds.where(F.col("n") == 1).select("gram", "frag")
    marks = saved(whole.union(runs.join(single, ["gram", "frag"])), "marks")
    spans = met.join(marks, ["gram", "frag"]).select("d", "t", F.explode("runs").alias("r"), "a")
    spans = spans.select("d", "t", F.struct((F.col("a") + F.col("r.a")).cast("int").alias("a"),
                                            (F.col("a") + F.col("r.b") + window).cast("int").alias("b")).alias("s"))
    return spans.groupBy("d", "t").agg(F.collect_set("s").alias("spans"))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("d"), F.hash(text).alias("t"), F.coalesce(text, F.lit("")).alias("text"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """docs with removed (array of maximal byte ranges a..b, b not included) and kept (the remaining bytes)."""
    spans = repeated_spans(docs, key, text, window, gram, group_bytes)
    d, t, s, own = (free(docs, x) for x in ("span_d", "span_t", "spans", "own_t"))
    spans = spans.select(F.col("d").alias(d), F.col("t").alias(t), F.col("spans").alias(s))
    met = (docs.withColumn(own, F.hash(text))
           .join(spans, F.col(key).cast("long").eqNullSafe(F.col(d)) & (F.col(own) == F.col(t)), "left").drop(d, t, own))
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields,
                           T.StructField("removed", T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            gone, kept = [], []
            for x, spots in zip(batch.column(text).to_pylist(), batch.column(s).to_pylist()):
                data = (x or "").encode()
                runs = merged([(p["a"], p["b"]) for p in spots or []])
                gone.append([{"a": a, "b": b} for a, b in runs])
                stops = [0, *(b for _, b in runs)]
                kept.append(b"".join(data[i:j] for i, j in zip(stops, [*(a for a, _ in runs), len(data)])))
            own_columns = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*own_columns, pa.array(gone, _SPANS), pa.array(kept, pa.binary())], names=[*columns, "removed", "kept"])

    return met.mapInArrow(run, schema)


def op8_substrings(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    size: Column = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
