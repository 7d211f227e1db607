"""Near dedup, substring dedup and line dedup against brute force."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from fixtures import BASE, CLASHES, NEAR, family, frame, near_components, rows, shingles

import corpus_pipeline
from carespark.llm import lines, minhash, substrings
from carespark.llm.anchors import anchors, sliding_min
from carespark.llm.common import passing_tables, saved
from carespark.llm.components import components
from carespark.llm.runindex import RunIndex
from carespark.llm.shingles import shingle_sets


def test_shingle_sets():
    texts = [None, "", " \t", "A", "a b", "A  b\x0bC é É x", BASE, "a b a b a b"]
    for width in (1, 2, 5):
        for t, s in zip(texts, shingle_sets(texts, width)):
            assert len(s) == len(shingles(t, width))
    a, b = list(shingle_sets(["x Y z", "X y z w"], 2))
    assert len(set(a.tolist()) & set(b.tolist())) == 2


def test_enough_matches_are_asked_for():
    assert minhash.matches_needed(64, 80, 1e-7) == 33
    assert minhash.matches_needed(8, 100) == 8


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_as_brute_force(spark, width):
    texts = [t for s in range(6) for t in family(s, 12, edits=1 + 2 * s)]
    texts += [f"{a} {BASE}" for a in "abc"] + ["", "word", "word", None]
    # boilerplate that many texts share, and one hot group of exact copies
    texts += [f"{BASE[:200]} " + " ".join(f"own{i}k{j}" for j in range(40)) for i in range(25)] + [BASE] * 40
    random.Random(3).shuffle(texts)
    docs = dict(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), width=width).collect()
    want = near_components(docs, width)
    assert {r.id: (r.n, r.component) for r in got} == {i: (len(shingles(t, width)), want[i]) for i, t in docs.items()}
    assert len(got) == len(docs)


def test_near_duplicates_of_awkward_rows(spark):
    docs = frame(spark)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert all(r.component is None for r in got if r.id is None)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    same = [r[0] for r in rows() if r[0] is not None and r[1] and r[1].lower().startswith("w0x0")]
    assert [i for i in ids if i in same] == [min(same)] * same.count(min(same)) and ids.count(None) == 2


def test_near_duplicates_follow_the_text_of_a_repeated_id(spark):
    clean = " ".join(f"clean{i}" for i in range(60))
    docs = [(1, NEAR), (7, BASE), (7, clean), (9, clean.replace("clean9 ", "other ")), (9, "a text of its own")]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.id, r.component, r.kept) for r in got) == [(1, 1, True), (7, 1, False), (7, 7, True), (9, 7, False), (9, 9, True)]
    kept = minhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == [(1, NEAR), (7, clean), (9, "a text of its own")]


def test_sizes_that_allow_a_link_as_brute_force(spark):
    rng, rows = random.Random(8), []
    for hub, nh in enumerate([1, 40, 300, 300]):
        some = [(rng.randint(0, nh // 2), rng.randint(0, nh // 4)) for _ in range(60)]
        least = min(e for _, e in some)
        rows += [(hub, 100 * hub + i, rng.randint(0, 3), nh, d, e, least) for i, (d, e) in enumerate(some)]
    near = spark.createDataFrame(rows, "hub long, id long, component long, nh long, D long, E long, least_e long")
    got = minhash._by_sizes(near.withColumn("stray", minhash.F.col("component") > 0), 80).collect()
    want = {frozenset((x[1], c[1])) for x in rows for c in rows if x[0] == c[0] and x[2] != c[2]
            and 180 * (x[3] - max(x[4], c[4])) >= 80 * (2 * x[3] - x[4] - c[4] + x[5] + c[5])}
    assert want and {frozenset((r.id_x, r.id_c)) for r in got} == want and len(got) == len(want)


def test_extras_are_looked_at_only_as_far_as_sizes_ask(spark):
    """Strays around one hub of 100 things: pairs are those that share what their own sizes ask for, and no link is lost."""
    def row(i, lacking, beyond):
        return (0, 100, i, i, len(lacking), len(beyond), sorted(lacking), sorted(beyond), True)

    r = random.Random(5)
    many = [row(i, r.sample(range(100), 30), [200 + j for j in range(5)] + [1000 * i + j for j in range(35)]) for i in range(1, 31)]
    short = row(40, range(50), [])  # the shortest around: by its size 2 shared things would do
    kin = [row(i, range(10), [500 + j for j in range(28)] + [1000 * i, 1000 * i + 1]) for i in (41, 42)]
    mixed = [row(i, r.sample(range(12), r.randrange(8)), r.sample(range(700, 740), r.randrange(40))) for i in range(50, 80)]
    strays = [*many, short, *kin, *mixed]
    near = spark.createDataFrame(strays, "hub long, nh long, id long, component long, D long, E long, lacking array<long>, beyond array<long>, stray boolean")
    found = {(x, c) for _, x, c in minhash._by_extras(near, 80).collect()}
    sets = {s[2]: (set(range(100)) - set(s[6])) | set(s[7]) for s in strays}
    linked = {(x, c) for x in sets for c in sets if x < c and 100 * len(sets[x] & sets[c]) >= 80 * len(sets[x] | sets[c])}
    sized = {(x, c) for _, x, c in minhash._by_sizes(near.withColumn("least_e", F.lit(0)), 80).collect()}
    assert linked <= found | sized and len(linked) > 10 and (41, 42) in found
    assert not any(x <= 30 and c <= 30 for x, c in found)


def test_passing_tables_go(spark):
    with passing_tables(spark, "kept"):
        gone, kept = (saved(spark.range(3), label) for label in ("gone", "kept"))
        paths = [df.inputFiles()[0].removeprefix("file://") for df in (gone, kept)]
    assert [os.path.exists(path) for path in paths] == [False, True] and kept.count() == 3


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 107), (107, 103), (9, 9)] + [(200, x) for x in range(201, 230)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 103: 100, 107: 100, **{x: 200 for x in range(200, 230)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_repeats(texts, window):
    """For each text the bytes covered by a window-long string that starts twice."""
    seen = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            seen[t[i:i + window]] = seen.get(t[i:i + window], 0) + 1
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone.update(range(i, i + window))
        out.append(gone)
    return out


def check_repeats(spark, texts, **options):
    data = [(t or "").encode() for t in texts]
    want = brute_repeats(data, options.get("window", 200))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in substrings.remove_repeats(docs, **options).collect()}
    assert len(got) == len(texts)
    for i, (t, gone) in enumerate(zip(data, want)):
        assert {x for s in got[i].removed for x in range(s.a, s.b)} == gone, i
        assert bytes(got[i].kept) == bytes(c for x, c in enumerate(t) if x not in gone)
        assert all(p.b < q.a for p, q in zip(got[i].removed, got[i].removed[1:]))
    return got


@pytest.mark.parametrize("group_bytes", [1 << 20, 0])
def test_repeats_as_brute_force(spark, group_bytes):
    r = random.Random(5)
    passage = [" ".join(f"p{k}q{r.randrange(999)}" for _ in range(30)) for k in range(4)]
    texts = [None, "", "short", "é" * 90, "ab" * 100, passage[0], passage[0]]
    for _ in range(40):
        t = " ".join(str(r.randrange(10**6)) for _ in range(r.randrange(5, 60)))
        for p in r.sample(passage, r.randrange(3)):
            a = r.randrange(40)
            at = r.randrange(len(t) + 1)
            t = t[:at] + p[a:len(p) - r.randrange(40)] + t[at:]
        texts.append(t)
    check_repeats(spark, texts, window=40, gram=8, group_bytes=group_bytes)


def test_repeats_at_production_parameters(spark):
    r = random.Random(6)
    long = "".join(r.choice("abcdefgh ") for _ in range(900))
    check_repeats(spark, [long, "x" + long[100:299] + "y", "x" + long[100:300] + "y", long[:450] + "Z" + long[450:], "q" * 1000, None, long[700:899] + "é"])


def test_repeats_of_awkward_rows(spark):
    docs = frame(spark)
    got = substrings.remove_repeats(docs).collect()
    assert len(got) == docs.count()
    assert substrings.remove_repeats(docs).columns == [*docs.columns, "removed", "kept"]
    assert all(not r.kept for r in got if r.text == BASE)
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


def test_sliding_min_and_equal_windows_share_anchors():
    x = np.random.default_rng(1).integers(0, 50, 500)
    assert sliding_min(x, 7).tolist() == [x[i:i + 7].min() for i in range(494)]
    t = bytes(random.Random(2).choice(b"ab c") for _ in range(400))
    sets = []
    for of, a, b, g, f in anchors([t, b"zz" + t, t[50:250]], 60, 10):
        assert len(of)
        for k in range(3):
            m = of == k
            sets.append({(int(y) - int(x), int(h)) for x, y, h in zip(a[m], b[m], f[m])})
            assert sum(y - x + 1 for x, y in zip(a[m], b[m])) == [341, 343, 141][k]
    assert len(sets[0] & sets[1]) >= len(sets[0]) - 1


def test_run_index():
    r = random.Random(1)
    for _ in range(60):
        data = b"\xff".join(bytes(r.choice(b"ab") for _ in range(r.randrange(1, 50))) for _ in range(r.randrange(1, 8))) + b"\xff"
        index = RunIndex(np.frombuffer(data, np.uint8))
        longest = index.matches()
        for i in range(0, len(data), 3):
            best = max((k for k in range(len(data) - i + 1) if any(data.startswith(data[i:i + k], j) for j in range(len(data)) if j != i)), default=0)
            assert longest[i] == best
        for p in (b"a", b"ab", b"bba", b"\xffa", b"zz"):
            assert index.count(p) == sum(data.startswith(p, i) for i in range(len(data)))
    index = RunIndex(np.frombuffer(b"abcdefgh" * 500 + b"\xff", np.uint8))
    assert len(index.starts) < 40  # a repetitive string has few runs


def test_matches_beyond_the_usual_depth(spark):
    r = random.Random(8)
    shared = "".join(r.choice("abcdefghij ") for _ in range(1500))
    docs = spark.createDataFrame([(1, "left side " + shared), (2, "the right side " + shared), (3, "own")], "doc_id long, text string")
    for window in (200, 1200, 1400):
        got = {x.doc_id: sum(span.b - span.a for span in x.removed) for x in substrings.remove_repeats(docs, window=window).collect()}
        assert got[1] >= 1500 and got[2] >= 1500 and got[3] == 0, window


def test_templates_with_variable_fields_go(spark):
    rest = lambda i, k: f"clean line of its own {i} number {k} with word{i * 31 + k} here"
    texts = [f"{'ab'[i % 2]}{i} first words\nuser logged in from host{i} at port {i * 7}\n{rest(i, 0)}x{i}\nshort line\nread our terms of service before use" for i in range(30)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, leaf string")
    got = {r.doc_id: r for r in lines.drop_templates(docs, dropped="n_dropped").collect()}
    assert got[0].text == texts[0] and got[0].n_dropped == 0  # the first keeps its lines
    for i in range(1, 30):
        kept = got[i].text.split("\n")
        assert "read our terms of service before use" not in kept and got[i].n_dropped >= 1
        assert kept[0] == texts[i].split("\n")[0] and "short line" not in kept


def test_long_lines_go_from_three_texts_on(spark):
    long, seldom = (" ".join(f"{w}{i}" for i in range(60)) for w in ("often", "twice"))
    texts = [f"own {i}\n{long}\n{seldom if i < 2 else i}\nmiddling line of nine words that stands in five" for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.drop_templates(docs).collect()}
    assert got[0] == texts[0] and all(got[i] == texts[i].replace(f"{long}\n", "") for i in range(1, 5))


def test_copies_of_a_document_are_no_template(spark):
    docs = spark.createDataFrame([(i, "one clean line of many words here\nand a second line that is as clean") for i in range(200)], "doc_id long, text string")
    assert all(r.n_dropped == 0 for r in lines.drop_templates(docs, dropped="n_dropped").collect())


def test_lines_of_awkward_rows(spark):
    docs = frame(spark)
    got = lines.drop_templates(docs, dropped="taken", min_texts=1)
    assert got.columns == [*docs.columns, "taken"] and got.count() == docs.count()
    same = lines.drop_templates(docs, min_texts=50)
    order = lambda df: sorted(map(repr, df.collect()))
    assert order(same) == order(docs) and same.columns == docs.columns
    assert lines.drop_templates(frame(spark, [])).collect() == []
    assert len(CLASHES) > 20 and hashlib.sha256(b"").hexdigest()


def staged(spark, texts):
    """The texts after the pipeline's line stage."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in sorted(corpus_pipeline.line_stage(spark, docs, "").collect())]


def test_short_and_space_free_lines_go_in_the_pipeline(spark):
    often = ["All rights reserved.", "本文は引用を除き著作権法により保護されています。", "Les."]
    texts = ["\n".join([f"own{i}", *often, "page %d" % i, "seldom" if i < 9 else f"x{i}", ""]) for i in range(20)]
    got = staged(spark, texts)
    assert got[0] == texts[0]
    assert got[1:] == ["\n".join([f"own{i}", "page %d" % i, "seldom" if i < 9 else f"x{i}", ""]) for i in range(1, 20)]


@pytest.mark.parametrize("size", [60, 2000])
def test_templates_with_fields_of_few_values_go_at_every_size(spark, size):
    name = lambda k: "".join(chr(97 + int(c)) for c in str(100 + k))
    texts = [f"own{i} x\nThis article was written by {name(i % 20)} {name(50 + i // 20 % 20)} for readers\nrest{i} y" for i in range(size)]
    assert staged(spark, texts) == [texts[0], *(f"own{i} x\nrest{i} y" for i in range(1, size))]


def test_lines_with_digits_go_in_the_pipeline(spark):
    name = lambda k: "".join(chr(97 + int(c)) for c in str(100 + k))
    same = ["Copyright (c) 2024 Acme 2001-2024", "Tel. 030 1234567 Fax 030 7654321"]
    texts = ["\n".join([f"own{i}", *same, f"2024-01-{i + 1:02} 12:00:{i:02} INFO job {i * 7} finished in {i + 3} s",
                        f"(c) 2024 by {name(i)} and sons 2001-2024", f"{i} {i + 1} {i + 2} {i + 3} total"]) for i in range(20)]
    got = staged(spark, texts)
    assert got == [texts[0], *(f"own{i}\n{i} {i + 1} {i + 2} {i + 3} total" for i in range(1, 20))]
