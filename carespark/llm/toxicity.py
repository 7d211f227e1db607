"""Toxicity: a counterfactual-regularised classifier.

Features of a text: its distinct words (letters, any case) and their prefixes
of 4 to 8 letters, hashed to FEATURES buckets; only whether one is present
counts, so a long text is not toxic for being long.

Fitting: document frequencies by class over all labelled rows (one distributed
count) choose the SELECTED features of the largest log-odds z-score.  A logistic
regression over them is fitted on the driver on at most MAX_ROWS labelled rows
(an even hash sample; each is a short list of feature numbers).  Every labelled
text that names identity terms also gives a counterfactual, in which each term is swapped
for another of its group or for the group's neutral word.  The loss adds
COUNTERFACTUAL times the mean squared change of the logit between the two, so
terms that merely name a group take no weight of their own and a neutral
mention raises no score.

Scoring: one pass over whole texts with the few thousand weights.

Defined cases: null and empty texts have the score of the intercept; null labels
teach nothing; of several labels of one doc_id the largest counts; null doc_ids
are scored, never learned from; with no or one class in the labels every
score is the share of class 1 (0 without labels); columns of the input stay;
empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, free, saved, sliced, table
from .pieces import Memo

FEATURES = 1 << 20
SELECTED = 2_048
MAX_ROWS = 40_000  # bound of the labelled sample that the driver fits on
COUNTERFACTUAL = 1.0
RIDGE = 1e-4
STEPS = 400
THRESHOLD = 0.5
_WORDS = re.compile(r"[^\W\d_]+").findall

#: Words that name groups, with the neutral word of each group first.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("person", "woman", "man", "girl", "boy"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("residents", "immigrants", "refugees", "migrants", "foreigners"),
    ("human", "black", "white", "asian", "latino", "hispanic", "african", "arab", "indigenous"),
    ("couple", "gay", "lesbian", "bisexual", "queer", "straight", "heterosexual", "homosexual"),
    ("citizen", "american", "mexican", "chinese", "indian", "russian", "german", "french", "turkish", "polish"),
    ("adult", "old", "young", "elderly", "teenager"),
    ("patient", "disabled", "deaf", "blind", "autistic"),
    ("personnes", "femmes", "hommes", "musulmans", "juifs", "chrétiens", "immigrés"),
    ("menschen", "frauen", "männer", "muslime", "juden", "christen", "ausländer"),
    ("personas", "mujeres", "hombres", "musulmanes", "judíos", "cristianos", "inmigrantes"),
)
_GROUP = {term: group for group in IDENTITY_TERMS for term in group}


def words_of(text: str | None) -> set[str]:
    return set(_WORDS(text.lower())) if text else set()


def buckets(word: str) -> tuple[int, ...]:
    """The features that a word sets off."""
    prefixes = [f"{word[:n]}*" for n in range(4, min(len(word), 9))]
    return tuple(zlib.crc32(x.encode()) % FEATURES for x in (word, *prefixes))


def swapped(words: set[str], key: int) -> set[str] | None:
    """The words after a counterfactual swap of each identity term (None: there is none)."""
    named = [w for w in words if w in _GROUP]
    if not named:
        return None
    out = words.difference(named)
    for w in named:
        others = [x for x in _GROUP[w] if x != w]
        # Half of the swaps are with the neutral word, the others deal out the group.
        h = zlib.crc32(f"{key}:{w}".encode())
        out.add(_GROUP[w][0] if h % 2 and w != _GROUP[w][0] else others[(h >> 1) % len(others)])
    return out


@dataclass
class Model:
    """Weights by feature bucket, and the intercept."""

    bias: float = -30.0
    weights: dict[int, float] = field(default_factory=dict)

    def logits(self, texts: Iterator[str | None]) -> np.ndarray:
        known = self.weights
        hit = Memo(lambda w: tuple(b for b in buckets(w) if b in known))
        out = []
        for t in texts:
            found = set().union(*map(hit.__getitem__, words_of(t)))
            out.append(self.bias + sum(map(known.__getitem__, sorted(found))))
        return np.array(out, dtype=float)

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def labelled_texts(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """A written table of key, text, label of all labelled documents, each key once."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    # Always a shuffled join: labels grow with the documents, and the plan is the same at every size.
    return saved(rows.join(known.hint("merge"), "key"), "labelled")


def frequencies(labelled: DataFrame) -> DataFrame:
    """bucket, pos, neg: in how many labelled texts of each class a feature is present."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((2, FEATURES), np.int32)
        of = Memo(buckets)
        for batch in sliced(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = set().union(*map(of.__getitem__, words_of(text)))
                both[int(label > 0), np.fromiter(found, np.int64, len(found))] += 1
        some = np.flatnonzero(both.any(0))
        for at in range(0, len(some), 50_000):
            part = some[at:at + 50_000]
            yield pa.RecordBatch.from_pydict({"bucket": part.astype(np.int32), "neg": both[0, part], "pos": both[1, part]})

    found = labelled.select("text", "label").mapInArrow(count, "bucket int, neg int, pos int")
    return found.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        selected: int = SELECTED, max_rows: int = MAX_ROWS, counterfactual: float = COUNTERFACTUAL) -> Model:
    rows = labelled_texts(docs, labels, key, text, label)
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("label") > 0, 1)), F.lit(0))).first()
    if not 0 < ones < n:
        return Model(bias=30.0 if n and ones == n else -30.0)

    def odds(c, of):
        return F.log((F.col(c) + 0.5) / (F.lit(of) - F.col(c) + 0.5)), 1 / (F.col(c) + 0.5) + 1 / (F.lit(of) - F.col(c) + 0.5)

    (a, va), (b, vb) = odds("pos", ones), odds("neg", n - ones)
    z = F.abs((a - b) / F.sqrt(va + vb))
    chosen = sorted(r.bucket for r in frequencies(rows).orderBy(z.desc(), "bucket").limit(selected).select("bucket").collect())
    # An even sample of at most about max_rows; all rows where there are no more.
    sample = rows if n <= max_rows else rows.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {b: i for i, b in enumerate(chosen)}
        of = Memo(lambda w: tuple(at[b] for b in buckets(w) if b in at))
        here = lambda words: sorted(set().union(*map(of.__getitem__, words)))
        for batch in sliced(batches):
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            other = [swapped(w, zlib.crc32(str(k).encode())) for w, k in zip(words, batch.column("key").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([str(k) for k in batch.column("key").to_pylist()]), "label": batch.column("label"),
                "has": pa.array([here(w) for w in words], pa.list_(pa.int32())),
                "swap": pa.array([None if w is None else here(w) for w in other], pa.list_(pa.int32()))})

    got = sample.mapInArrow(reduce, "key string, label int, has array<int>, swap array<int>").toArrow().sort_by("key").to_pydict()
    weights, bias = _regression(got["has"], got["swap"], np.array(got["label"]) > 0, len(chosen), counterfactual)
    return Model(bias, {b: float(w) for b, w in zip(chosen, weights) if w})


def _entries(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in lists]
    return np.repeat(np.arange(len(lists)), sizes), np.fromiter((c for x in lists for c in x), np.int64, sum(sizes))


def _regression(has: list, swap: list, label: np.ndarray, width: int, counterfactual: float) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise log loss + ridge + counterfactual * mean squared logit change."""
    n, y = len(has), label.astype(float)
    row, col = _entries(has)
    pairs = [i for i, x in enumerate(swap) if x is not None]
    lost_row, lost_col = _entries([has[i] for i in pairs])
    new_row, new_col = _entries([swap[i] for i in pairs])
    params, mean, square = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if n else 0.5
    params[-1] = np.log(share / (1 - share))
    for step in range(1, STEPS + 1):
        w = params[:-1]
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], n) + params[-1], -30, 30)))
        off = (p - y) / max(1, n)
        slope = np.append(np.bincount(col, off[row], width) + RIDGE * w, off.sum())
        if pairs:
            change = np.bincount(new_row, w[new_col], len(pairs)) - np.bincount(lost_row, w[lost_col], len(pairs))
            pull = 2 * counterfactual / len(pairs) * change
            slope[:-1] += np.bincount(new_col, pull[new_row], width) - np.bincount(lost_col, pull[lost_row], width)
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        params = params - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return params[:-1], float(params[-1])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with ``out``, the probability that a text is toxic."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = pa.array(model.scores(batch.column(text).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def held_out(key: str):
    """One row in five, by crc32 of the key's text (null: as the empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col(key).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """The model that labels outside the held-out fifth teach."""
    return fit(docs.where(~held_out("doc_id")).select("doc_id", "text"), labels.where(~held_out("doc_id")).select("doc_id", "toxic"))


def reject(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that score at least ``threshold``."""
    s = free(docs, "toxicity")
    return score(docs, model, text, s).where(F.col(s) < threshold).drop(s)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = learned(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
