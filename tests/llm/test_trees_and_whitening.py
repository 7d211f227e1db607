"""SimHash by the fingerprint trie, the midstate manifest and whitening against brute force."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from conftest import SF_SMALL
from fixtures import BASE, family, frame

from carespark.llm import manifest, simhash, whitening
from carespark.llm.common import documents, table
from carespark.llm.queries import QUERIES
from carespark.llm.sha256 import packed, unpacked

SF_MORE = SF_SMALL.replace("0.001", "0.01")


# simhash

def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(fps, radius=3):
    """For each place of fps the smallest place that links of at most ``radius`` bits reach, by all pairs."""
    fps, top = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius):
            a, b = find(i), find(i + 1 + j)
            top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B", "x y z", "A b\x0bc\td é É 日本", "w " * 5000, BASE])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def some_fingerprints(seed, count, spread):
    r = np.random.default_rng(seed)
    fps = r.integers(0, 1 << 64, count, np.uint64)
    for _ in range(spread):  # chains of ever more distant copies
        fps = np.concatenate([fps, fps[-9:] ^ (np.uint64(1) << r.integers(0, 64, min(9, len(fps[-9:])), np.uint64))])
    return np.unique(np.append(fps, [np.uint64(0), np.uint64((1 << 64) - 1)]))


@pytest.mark.parametrize("seed,count,spread", [(1, 600, 0), (2, 200, 40), (3, 1, 60), (4, 1, 0)])
@pytest.mark.parametrize("frontier", [16, 1 << 17])
def test_walk(seed, count, spread, frontier):
    fps = some_fingerprints(seed, count, spread)
    assert simhash.walk(fps, 0, 0, 0, 0, 3, frontier).tolist() == smallest_reachable(fps)


@pytest.mark.parametrize("leaf", [16, 1 << 15])
def test_trie_join_at_any_cut(spark, leaf):
    fps = some_fingerprints(5, 150, 30)
    # a busy prefix: many fingerprints that differ in their last bits only
    busy = np.unique(np.uint64(77 << 40) | np.random.default_rng(6).integers(0, 1 << 14, 200, np.uint64))
    fps = np.unique(np.concatenate([fps, busy]))
    classes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, id long")
    links = [(r.a.id, r.b.id) for r in simhash.trie_links(classes, leaf=leaf).collect()]
    top = list(range(len(fps)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        assert int(fps[a] ^ fps[b]).bit_count() > 0
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == smallest_reachable(fps)


def test_op11_on_given_documents(spark):
    got = QUERIES["op11_simhash"](spark, SF_MORE).collect()
    texts = {r.doc_id: r.text for r in documents(spark, SF_MORE).collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{f:016x}", ids[s]) for i, f, s in zip(ids, fps, smallest_reachable(fps))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(ids)


def test_simhash_of_awkward_rows(spark):
    docs = frame(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    reach = smallest_reachable([f for _, f in rows])
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    want = sorted((i is None, i or 0, signed(f), -1 if rows[s][0] is None else rows[s][0]) for (i, f), s in zip(rows, reach))
    assert sorted((r.id is None, r.id or 0, r.fp, -1 if r.component is None else r.component) for r in got) == want
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_simhash_of_a_hot_group(spark):
    texts = family(9, 60, words=300, edits=3) + [BASE] * 50 + family(10, 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = smallest_reachable([plain_fingerprint(t) for t in texts])
    assert {r.id: r.component for r in simhash.near_duplicates(docs, leaf=8).collect()} == dict(enumerate(want))


# manifest

def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """The levels of a tree of hex digests."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_steps(levels, at):
    for level in levels[:-1]:
        first = at - at % 3
        yield level[first:at], level[at + 1:first + 3]
        at //= 3


def plain_leaf(row):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plain_manifest(docs):
    """Rows (doc_id, leaf, subroot, root, proof, folded) of (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in docs:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted(trees[s], key=lambda x: x[:3]) for s in names}
    levels = {s: plain_tree([x[2] for x in held[s]]) for s in names}
    top = plain_tree([levels[s][-1][0] for s in names])
    for at, s in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(held[s]):
            steps = [*plain_steps(levels[s], i), *plain_steps(top, at)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            now = plain_leaf((*row[:4], row[4].replace("\n", ""))) if changed else leaf
            for left, right in steps:
                now = digest([*left, now, *right])
            yield row[0], leaf, levels[s][-1][0], top[-1][0], digest(d for left, right in steps for d in left + right), now


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 28])
def test_states_and_parents(count):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(count)]
    up, states = manifest.parents(unpacked(b"".join(leaves), count))
    assert [packed(d).hex() for d in up] == [digest(x.hex() for x in leaves[i:i + 3]) for i in range(0, count, 3)]
    assert states.shape == (len(up), 3, 8) and (states[:, 0] == states[0, 0]).all()


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_as_brute_force(spark, levels):
    docs = [(i, ["b", "a", None, "é", "", "z"][min(i % 9, 5)], "en", i, [f"text {i}\nmore", "", None, "plain"][i % 4]) for i in range(120)]
    docs += [(500, "one", None, None, None), (None, "b", "en", 3, "null\nkey"), (7, "a", "en", 1, "a repeated id"), docs[5], docs[5]]
    frame = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    got = manifest.manifest(manifest.document_rows(frame), levels).collect()
    order = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r)
    assert sorted(map(tuple, ((r.id, r.leaf, r.subroot, r.root, r.proof, r.folded) for r in got)), key=order) == sorted(plain_manifest(docs), key=order)


def test_manifest_of_awkward_rows(spark):
    docs = frame(spark)
    rows = [tuple(r[c] for c in manifest.COLUMNS) for r in docs.collect()]
    got = manifest.manifest(manifest.document_rows(docs), 2).collect()
    assert {(r.id, r.leaf, r.root, r.proof, r.folded) for r in got} == {(i, leaf, root, proof, f) for i, leaf, _, root, proof, f in plain_manifest(rows)}
    assert len(got) == len(rows)
    assert manifest.manifest(manifest.document_rows(docs.limit(0))).collect() == []
    single = manifest.manifest(manifest.document_rows(docs.where("doc_id = 49"))).collect()
    assert [(r.leaf == r.subroot == r.root, r.proof) for r in single] == [(True, hashlib.sha256().hexdigest())]


# whitening

def plain_whitening(vectors, components):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    c = (n * x - sums) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1], axes[:, ::-1]
    return c @ axes[:, :components] / np.sqrt(values[:components]), ((n * x - sums) ** 2).sum(1), values[:components] / values.sum()


def test_op13_on_given_embeddings(spark):
    got = QUERIES["op13_whitening"](spark, SF_MORE).toPandas().sort_values(["vec_id", "component"])
    rows = sorted((r.vec_id, list(r.embedding)) for r in table(spark, SF_MORE, "embeddings").collect())
    want, deviation, explained = plain_whitening([v for _, v in rows], 32)
    y = got.whitened.to_numpy().reshape(len(rows), 32)
    assert (got.vec_id.to_numpy().reshape(len(rows), 32)[:, 0] == [i for i, _ in rows]).all() and set(got.n) == {len(rows)}
    assert np.abs(y - want * np.sign((y * want).sum(0))).max() < 1e-9
    assert (got.deviation.to_numpy().reshape(len(rows), 32)[:, 5] == deviation).all()
    assert np.allclose(got.explained.to_numpy()[:32], explained, rtol=1e-9) and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    assert got.component.tolist() == list(range(1, 33)) * len(rows)


def test_whitening_of_awkward_rows(spark):
    r = np.random.default_rng(4)
    good = [(i, v) for i, v in enumerate(r.normal(size=(40, 4)).tolist())]
    good += [(100 + i, good[0][1]) for i in range(60)] + [(5, good[1][1]), (None, good[2][1]), (5, good[7][1])]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]),
           (905, [1.0, 2.0]), (906, [1e300, 0.0, 0.0, 0.0])]
    rows = spark.createDataFrame([(i, v, "x") for i, v in good + bad], "vec_id long, embedding array<double>, y string")
    got = whitening.whitened_rows(rows, components=3).collect()
    want, deviation, _ = plain_whitening([v for _, v in good], 3)
    assert len(got) == len(good) and got[0].identity_error < 1e-9 and got[0].n == len(good)
    sign = np.sign((np.array([g.y for g in got if g.id == 3][0])) * want[3])
    key = lambda i, d, y: (-1 if i is None else i, d, *np.round(y, 6) + 0.0)
    assert sorted(key(g.id, g.deviation, np.array(g.y)) for g in got) == sorted(key(i, d, w * sign) for (i, _), d, w in zip(good, deviation.tolist(), want))
    weighted_once = whitening.whitened_rows(rows, components=3, counts=False).first()
    assert weighted_once.n == 40 and weighted_once.identity_error < 1e-9
    for few in (rows.limit(0), rows.where("vec_id = 3"), rows.where("vec_id >= 100 and vec_id < 900"), rows.where("vec_id = 900")):
        assert whitening.whitened_rows(few).collect() == []


def test_whitening_of_a_flat_dimension(spark):
    rows = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(30)], "vec_id long, embedding array<double>")
    got = whitening.whitened_rows(rows).collect()
    assert {len(g.y) for g in got} == {1} and abs(got[0].explained[0] - 1) < 1e-9


def test_a_deviation_beyond_a_long_raises(spark):
    rows = spark.createDataFrame([(1, [1e12]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="deviation"):
        whitening.whitened_rows(rows).collect()
