"""BPE against tiktoken, the wavelet matrix against plain lists and the tokenizers library."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from conftest import SF_SMALL
from tokenizers import Tokenizer

from carespark.llm import bpe, wavelet
from carespark.llm.common import documents
from carespark.llm.pieces import Memo
from carespark.llm.queries import QUERIES

TEXTS = [None, "", " ", "  ", "a", " a  b   c \n\n d\t e \n", "don't we'll 's", "été über niño 12345 ñ…", "x" * 5000, "日本語 🙂🙂 <|endoftext|>",
         "word " * 3000, "\n \n", "tail  ", "tail\n ", " \n  x   y", "a\x1c b \x85 c"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(wavelet.MODEL)


def unpack(data):
    return np.frombuffer(data, "<u4").tolist()


ODD = st.text(alphabet=st.sampled_from(list("ab'slt .,\n\t\r19é日🙂  \x1c")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(ODD | st.text(max_size=60))
def test_any_text_as_the_libraries_do(reference, library, text):
    text = text.encode("utf-8", "ignore").decode()
    vocabulary = bpe.vocabulary(bpe.RANKS)
    ids = unpack(vocabulary.encode(text))
    assert ids == reference.encode_ordinary(text)
    assert vocabulary.decode(ids) == text.encode()
    assert unpack(wavelet.encoder(wavelet.MODEL)[0](text)) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=30))
def test_backtracking_gives_the_merges(data):
    vocabulary = bpe.vocabulary(bpe.RANKS)
    assert vocabulary.encode_piece(data) == ([vocabulary.ranks[data]] if data in vocabulary.ranks else vocabulary.merged(data))


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "a \n<|endoftext|>b  c", "x<|endoftext|><|endoftext|> "])
def test_special_strings_as_the_library_does(library, text):
    ids = unpack(wavelet.encoder(wavelet.MODEL)[0](text))
    assert ids == library.encode(text, add_special_tokens=False).ids and 50256 in ids


def test_memo_keeps_what_is_asked_for_again():
    made = []
    memo = Memo(lambda k: made.append(k) or -k, size=10)
    for k in range(100):
        assert memo[k] == -k and memo[0] == 0
    assert made.count(0) == 1 and len(memo) <= 10


def test_tokens_of_given_documents(spark, reference, library):
    """Both encodings on all documents of a table, against the libraries."""
    sf = SF_SMALL.replace("0.001", "0.01")
    texts = {r.doc_id: r.text or "" for r in documents(spark, sf).collect()}
    for r in QUERIES["op5_bpe"](spark, sf).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    start, got = 0, {r.doc_id: r for r in QUERIES["op7_wavelet"](spark, sf).collect()}
    for i in sorted(texts):
        ids = library.encode(texts[i], add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_compatible_pairs_are_remembered():
    vocabulary = bpe.vocabulary(bpe.RANKS)
    vocabulary.encode_piece(b"unbelievableness")
    assert vocabulary.fits and all(isinstance(v, bool) for v in vocabulary.fits.values())


def test_op5_rows(spark, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "  "), (None, "null key")]
    got = bpe.digests(spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, ids string")).collect()
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_op5_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=400))
def test_wavelet_matrix(ids):
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(np.array(ids, np.uint32), 7).to_bytes())
    assert m.decode().tolist() == ids
    assert [m.access(i) for i in range(len(ids))] == ids
    for t in {*ids, 5}:
        where = [i for i, x in enumerate(ids) if x == t]
        assert m.places(t).tolist() == where
        assert m.rank(t) == len(where) and [m.select(t, j) for j in range(len(where))] == where
        assert m.rank(t, len(ids) // 2) == sum(i < len(ids) // 2 for i in where)


def test_op7_files(spark, library, tmp_path):
    rows = [(i * 3 % 17, t, 1) for i, t in enumerate(TEXTS)] + [(None, "null key", 2), (100, "again", 3), (100, "again", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    folder = wavelet.write_shards(docs, "doc_id", "text", str(tmp_path / "t"), shard_tokens=2000)
    got = sorted(map(tuple, wavelet.read_documents(spark, folder).collect()), key=lambda r: r[1])
    start = 0
    by_key = {}
    for k, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        by_key.setdefault(k, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    for k, at, n, crc in got:
        assert at == start and (n, crc) in by_key[k]
        start += n
    ends = wavelet.count_token(spark, folder, 2).collect()
    assert sum(r.n for r in ends) >= len(rows) and len(ends) > 1
    places = wavelet.occurrences(spark, folder, 2).collect()
    assert len(places) == sum(r.n for r in ends)


def test_op7_empty_table(spark, tmp_path):
    folder = wavelet.write_shards(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", str(tmp_path / "e"))
    assert wavelet.read_documents(spark, folder).collect() == []


def test_words_stay_known_and_marks_need_no_new_merge(library, monkeypatch):
    """A word that came with a mark behind it, or in an earlier task, isn't merged again."""
    wavelet.encoder.cache_clear()
    encode, _ = wavelet.encoder(wavelet.MODEL)
    asked = []
    known = encode.__closure__[[c for c in encode.__code__.co_freevars].index("chunks")].cell_contents.spaced
    make = known.make
    monkeypatch.setattr(known, "make", lambda chunk: asked.append(chunk) or make(chunk))
    for text in ("a Zwölfe, x", "b Zwölfe y", "b Zwölfe. y", "b Zwölfe. y"):
        assert unpack(encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert asked == ["Zwölfe,", "Zwölfe", "x", "y", "Zwölfe."]
    assert not hasattr(encode, "rest")
    wavelet.encoder.cache_clear()


@pytest.mark.parametrize("mark", [*wavelet.STOPS, "'", "\"", "'s.", "-", "ɐ."])
def test_words_with_marks_as_the_library_does(library, mark):
    for text in (f"a word{mark}", f"word{mark} b", f"a é{mark} Wörter{mark}\n x{mark}", f" {mark} {mark}a"):
        assert unpack(wavelet.encoder(wavelet.MODEL)[0](text)) == library.encode(text, add_special_tokens=False).ids
