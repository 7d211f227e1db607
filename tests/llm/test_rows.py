"""Toxicity, sharding, search, mixing, fingerprints and the pipeline."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from fixtures import BASE, frame, near_components, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from carespark.llm import bpe, fingerprint, lines, mixing, search, sharding, toxicity
from carespark.llm.common import documents, saved, table
from carespark.llm.queries import ORACLE_SQL, QUERIES
from oracle.compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert not compare(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE_SQL[name])


def test_entry_has_them():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


# toxicity

def test_toxicity_of_held_out_rows(spark):
    sf = SF_SMALL.replace("0.001", "0.1")
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    labels = [(got[r.doc_id].score, r.toxic) for r in table(spark, sf, "labels").collect() if got[r.doc_id].held_out]
    bad, good = ([s for s, y in labels if y == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in bad for b in good])
    assert auc > 0.95 and sum(s >= 0.5 for s in good) <= 0.02 * len(good)


def planted(spark):
    rows = [(i, f"you {['awful', 'vile'][i % 2]} {['muslims', 'women'][i // 2 % 2] if i % 4 else 'fools'} go item{i}", 1) for i in range(60)]
    rows += [(100 + i, f"a calm day item{i} with tea and bread", 0) for i in range(120)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5, None), (9999, 1)], "doc_id long, toxic int")


def test_counterfactuals_lower_neutral_mentions(spark):
    docs, labels = planted(spark)
    plain = toxicity.fit(docs, labels, counterfactual=0.0)
    fair = toxicity.fit(docs, labels, counterfactual=50.0)
    neutral, vile = "a calm day with tea for muslims and women", "you awful fools go"
    assert fair.scores([neutral])[0] < plain.scores([neutral])[0]
    assert fair.scores([neutral])[0] < 0.5 < fair.scores([vile])[0]
    change = lambda m: abs(np.subtract(*m.logits(["tea for muslims", "tea for christians"])))
    assert change(fair) < 0.5 * change(plain)


def test_swaps_stay_in_their_group():
    words = {"the", "muslims", "and", "women"}
    for key in range(20):
        out = toxicity.swapped(words, key)
        assert {"the", "and"} <= out and not out & {"muslims", "women"} and len(out) == 4
    assert toxicity.swapped({"tea"}, 1) is None


def test_toxicity_of_awkward_rows(spark):
    docs, labels = planted(spark)
    model = toxicity.fit(docs, labels)
    odd = frame(spark).drop("score")
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.reject(frame(spark), model).columns == frame(spark).columns
    assert toxicity.score(odd.limit(0), model).collect() == []
    none = toxicity.fit(docs, labels.limit(0))
    assert none.scores(["x", None]).max() < 0.01 and toxicity.fit(docs, labels.where("toxic = 1")).scores([""])[0] > 0.99


# sharding

@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 100, 1000, 4097])
def test_permutation(n):
    p = sharding.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n)) and sharding.unpermute(p, n).tolist() == list(range(n))
    assert n < 100 or p.tolist() != sharding.permute(np.arange(n), n, seed=1).tolist() != list(range(n))
    shard, slot = sharding.place_of(np.arange(n), n, 5)
    assert all(sharding.row_of(int(s), int(t), n, 5) == i for i, (s, t) in enumerate(zip(shard[:50], slot[:50])))


def check_shards(got, count):
    sizes = Counter(r.shard for r in got)
    assert sum(sizes.values()) == count and max(sizes.values(), default=0) - min((sizes.get(i, 0) for i in range(16)), default=0) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))


def test_shards(spark):
    got = QUERIES["op3_sharding"](spark, SF_SMALL).collect()
    check_shards(got, len(got))
    texts = {r.doc_id: (r.text or "").encode() for r in documents(spark, SF_SMALL).collect()}
    ids = sorted(texts)
    for r in got:
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        assert sharding.row_of(r.shard, r.slot, len(ids)) == ids.index(r.doc_id)
    assert sorted(got) == sorted(QUERIES["op3_sharding"](spark, SF_SMALL).repartition(3).collect())


def test_shards_of_awkward_rows(spark, tmp_path):
    docs = frame(spark).drop("shard", "slot")
    out = sharding.shard_rows(docs, "doc_id", ("text",))
    assert out.columns[-2:] == ["shard", "slot"] and set(docs.columns) < set(out.columns)
    check_shards(out.collect(), docs.count())
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()
    assert sharding.shard_rows(docs.limit(0), "doc_id").collect() == []


# search

def brute_top(vectors, k=5):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in vectors if v is not None and i is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, ints) in enumerate(rows):
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(ints, v)), i) for other, (i, v) in enumerate(rows) if other != at and len(v) == len(ints))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"block_bytes": 6000, "query_rows": 2}])
def test_top_k_as_brute_force(spark, blocks):
    r = np.random.default_rng(4)
    vectors = [(i, r.normal(size=19).tolist()) for i in range(0, 400)]
    vectors += [(500 + i, vectors[3][1]) for i in range(30)]  # a common vector: ties
    vectors += [(600, None), (650, [float("nan")] * 19), (700, [None] * 19), (750, [1.0, 2.0]), (751, [2.0, 1.0]), (800, []), (None, [1.0] * 19), vectors[50], (-50, [0.0] * 19),
                (1, [9.0] * 19), (1, [9.0] * 19), (100, [3.0] * 19)]  # repeated rows and ids, also of queries
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, score string")
    got = search.top_k(df.select("vec_id", search.whole("embedding").alias("ints"), "score"), "vec_id", "ints", df.vec_id % 50 == 0, **blocks)
    assert sorted(map(tuple, got.collect())) == brute_top(vectors)
    assert search.top_k(df.limit(0).select("vec_id", search.whole("embedding").alias("ints")), "vec_id", "ints", df.vec_id % 50 == 0).collect() == []


def test_large_numbers_stay_exact_or_raise(spark):
    big = 2.0**30
    df = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 1.0]), (2, [big, -1.0])], "vec_id long, embedding array<double>")
    got = search.top_k(df.select("vec_id", F.array(*[F.get("embedding", F.lit(i)).cast("long") for i in (0, 1)]).alias("v")), "vec_id", "v", df.vec_id == 0)
    assert [(r.vec_id, r.score) for r in got.collect()] == [(1, 2**60 + 1), (2, 2**60 - 1)]
    with pytest.raises(Exception, match="2.53"):
        spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>").select(search.whole("embedding")).collect()


def test_bounds_drop_candidates_early():
    r = np.random.default_rng(5)
    rows = (r.normal(size=(3000, 64)) * 50).astype(np.int64)
    rows[:, :8] *= 20
    at, hit, score = search.best_in_block(rows[:4], np.arange(4), rows, np.arange(3000))
    full = rows[:4] @ rows.T
    for q in range(4):
        full[q, q] = -(10**12)
        best = np.lexsort((np.arange(3000), -full[q]))[:5]
        assert hit[at == q].tolist() == best.tolist() and score[at == q].tolist() == full[q, best].tolist()


# mixing

def test_mix_takes_near_its_targets(spark):
    docs = spark.createDataFrame([(i, f"s{i % 4}" if i % 7 else None, i % 13 + 1 + (500 if i == 1 else 0)) for i in range(4000)], "doc_id long, source string, size long")
    got = mixing.mix(docs, "source", "size", ["doc_id"]).collect()
    by = {}
    for r in got:
        assert 0 <= r.copies <= 2
        by.setdefault((r.source, r.target, r.source_size), []).append(r.copies * r.size)
    assert abs(sum(t for _, t, _ in by) - 1.5 * sum(s for _, _, s in by)) < 1e-6 * len(got)
    for (_, target, size), taken in by.items():
        assert target <= 2 * size and abs(sum(taken) - target) <= 520
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(5), "source", "size", ["doc_id"]).collect()))
    emitted = mixing.emit(mixing.mix(docs, "source", "size", ["doc_id"]))
    assert emitted.count() == sum(r.copies for r in got)


def test_capped_targets(spark):
    sized = spark.createDataFrame([("a", 1), ("b", 100), ("c", 3), ("d", 1000), (None, 0)], "source string, size long")
    got = {r.mix_source: r.target for r in mixing.targets(sized, "source", "size").collect()}
    # weights 3 1 2 3 1; 1656 to share; a, b and c stop at twice their size, d takes the rest
    assert got == {"a": 2.0, "b": 200.0, "c": 6.0, "d": 1448.0, None: 0.0}


def test_mix_of_awkward_rows(spark):
    docs = frame(spark)
    sized = docs.selectExpr("*", "cast(length(text) as long) as size")
    got = mixing.mix(sized, "source", "size", ["doc_id"])
    assert got.count() == docs.count() and set(sized.columns) < set(got.columns)
    assert mixing.mix(sized.limit(0), "source", "size", ["doc_id"]).collect() == []


# fingerprints

def trees(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df.selectExpr("doc_id", "text").withColumn("tree", fingerprint.tree(fingerprint.F.coalesce("text", fingerprint.F.lit(""))))


def test_tree_locates_edits(spark):
    a = "\n".join(f"paragraph {i} with some words" for i in range(40))
    b = a.replace("paragraph 17 ", "changed 17 ") + "\nadded"
    df = trees(spark, [a, b])
    one, two = (df.where(f"doc_id = {i}").select(fingerprint.F.col("tree").alias(f"t{i}")) for i in (0, 1))
    got = one.crossJoin(two).select(fingerprint.differing(fingerprint.F.col("t1"), fingerprint.F.col("t0")).alias("x")).first().x
    assert got == [17, 40]


def test_fingerprints_of_awkward_rows(spark):
    docs = frame(spark)
    got = fingerprint.fingerprints(docs, "text")
    assert got.columns == [*docs.columns, "fingerprint"]
    prints = {}
    for r in got.collect():
        assert prints.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)
    root = prints[BASE].split(".")[0]
    leaf = hashlib.md5(BASE.encode()).hexdigest()
    assert root == hashlib.sha256(hashlib.md5(leaf.encode()).hexdigest().encode()).hexdigest()


@pytest.mark.parametrize("some", [rows(), rows()[:16], rows()[:1], []])
def test_next_heads(spark, some):
    got = fingerprint.with_next_head(frame(spark, some), "doc_id", "text", "head", "after").collect()
    assert len(got) == len(some)
    if some and len({r[0] for r in some}) == len(some):
        order = sorted(some, key=lambda r: (r[0] is not None, r[0] or 0))
        for r, s in zip(order, [*order[1:], order[0]]):
            head = next(g.head for g in got if g.key == r[0])
            assert head == (s[1] or "")[:len(r[1] or "") // 4]


# pipeline

def test_pipeline_stages(spark):
    sf = SF_SMALL
    docs = documents(spark, sf)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "near dedup", "mixing", "bpe"]
    inputs = []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = saved(stage(spark, docs, sf), "t")
        assert name == "bpe" or docs.schema.simpleString() == inputs[0].schema.simpleString()
    read = [[r.asDict() for r in x.collect()] for x in inputs]
    model = toxicity.learned(inputs[0], table(spark, sf, "labels"))
    score = model.scores([r["text"] for r in read[0]])
    assert sorted(r["doc_id"] for r in read[1]) == sorted(r["doc_id"] for r, s in zip(read[0], score) if s < 0.5)

    def sql(query, given):
        con = duckdb.connect()
        con.register("documents", pa.Table.from_pylist(given, schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])))
        return con.execute(query).fetchall()

    kept = {r["doc_id"]: r["text"] for r in read[2]}
    for doc_id, _, _, digest in sql(lines.OP4_SQL, read[1]):
        assert hashlib.sha256(kept[doc_id].encode()).hexdigest() == digest
    assert all(r["n_chars"] == len(r["text"]) for r in read[2])
    groups = near_components(kept, 5)
    assert sorted(r["doc_id"] for r in read[3]) == sorted(set(groups.values()))
    copies = Counter(r["doc_id"] for r in read[4])
    for doc_id, size, _, _, taken in sql(mixing.OP9_SQL, read[3]):
        assert copies[doc_id] * size == taken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.RANKS, "rb"))}
    import public_tokenizers
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in read[4]:
        ids = library.encode_ordinary(r["text"])
        want[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in docs.collect()) == want


def test_pipeline_stages_on_awkward_rows(spark):
    for given in (frame(spark), frame(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = saved(stage(spark, given, SF_SMALL), "t")
            assert name == "bpe" or out.columns == given.columns
            assert given.count() or out.count() == 0
