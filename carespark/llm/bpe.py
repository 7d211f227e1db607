"""Byte-level BPE encoding and decoding by longest matches with backtracking.

The bytes of a piece (one match of the split pattern) are read as Latin-1, so
that an automaton over all tokens (pyahocorasick) finds the longest token at a
place.  From left to right the longest token at a place is
tried first, then its longest proper prefix that is a token, and so on; a token
may follow another only if the two are compatible, i.e. if merging their joint
bytes by rank gives just these two.  Compatibility is memoised per pair.  A
place from which nothing fits is marked dead and never entered again, so each
place is left at most once.  A sequence whose neighbours are all compatible is
the one that the merges produce.

Defined cases: null and empty texts have no ids and decode to no bytes; texts
of any length are encoded whole; columns of the input stay.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, sliced
from .pieces import ChunkEncoder, Memo

#: Chunks of a generation that a worker remembers (about 50 MB).
CHUNKS = 250_000
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Decoder:
    """The bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.bytes_of = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Vocabulary(Decoder):
    """Ranks of a byte-level BPE, its automaton and the two directions."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        super().__init__(path)
        self.ranks = {b: i for i, b in self.bytes_of.items()}
        self.tokens = {token.decode("latin-1"): i for token, i in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.tokens.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.pieces = regex.compile(pattern).findall
        self.shorter = Memo(self._shorter)
        self.edges = Memo(self._edges)
        self.fits = Memo(self._fits)
        self.length = {i: len(b) for b, i in self.ranks.items()}
        self.piece = Memo(self._packed)
        self.encode = ChunkEncoder(self._spell, lambda text: b"".join(map(self.piece.__getitem__, self.pieces(text))), CHUNKS)

    def rest(self) -> None:
        for memo in (self.piece, self.fits, self.encode):
            memo.rest()

    def _packed(self, piece: str) -> bytes:
        return array("I", self.encode_piece(piece.encode())).tobytes()

    def _spell(self, chunk: str) -> bytes:
        # A plain word is one piece; up to Latin Extended-B letters are the same in any Unicode version.
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()) and (chunk.isascii() or max(chunk) < "\u0250"):
            return self._packed(chunk)
        return b"".join(map(self.piece.__getitem__, self.pieces(chunk)))

    def merged(self, data: bytes) -> list[int]:
        """The merges themselves: the pair of lowest rank first, the leftmost of equals."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one; -1: none."""
        data = self.bytes_of[token]
        return next((self.ranks[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ranks), -1)

    def _edges(self, token: int) -> tuple[list, list, bool]:
        """How a token comes about by merges of its own bytes: the parts at its right and at its left
        edge, each with the rank of the merge that made it, and whether that ends in the token by rising ranks."""
        parts = [self.bytes_of[token][i:i + 1] for i in range(len(self.bytes_of[token]))]
        right, left, last, rising = [(parts[-1], -1)], [(parts[0], -1)], -1, True
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                return right, left, False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            rising, last = rising and rank >= last, rank
            if at == len(parts) - 1:
                right.append((parts[at], rank))
            if at == 0:
                left.append((parts[at], rank))
        return right, left, rising

    def _fits(self, pair: int) -> bool:
        """May the second token follow the first? (pair: first * 2^32 + second; a negative one: the second starts)

        Side by side the two come about as each does alone, unless at some time the
        parts that meet make a token of lower rank than the next merge at either edge (of equal
        ranks the one further left is made first).
        """
        first, second = pair >> 32, pair & 0xFFFFFFFF
        _, ours, rising = self.edges[second]
        if first < 0:
            return rising or self.merged(self.bytes_of[second]) == [second]
        theirs, _, also = self.edges[first]
        if not (rising and also):
            return self.merged(self.bytes_of[first] + self.bytes_of[second]) == [first, second]
        ranks, i, j = self.ranks, 0, 0
        while True:
            after_first = theirs[i + 1][1] if i + 1 < len(theirs) else 1 << 60
            after_second = ours[j + 1][1] if j + 1 < len(ours) else 1 << 60
            joint = ranks.get(theirs[i][0] + ours[j][0])
            if joint is not None and joint < after_first and joint <= after_second:
                return False
            if after_first == after_second == 1 << 60:
                return True
            if after_first <= after_second:
                i += 1
            else:
                j += 1

    def encode_piece(self, data: bytes) -> list[int]:
        ranks, lengths, fits, shorter = self.ranks, self.length, self.fits, self.shorter
        if data in ranks:
            return [ranks[data]]
        size, latin = len(data), data.decode("latin-1")
        reach, token_of = self.automaton.longest_prefix, self.tokens.get
        out: list[int] = []
        dead: set[int] = set()
        at, before, fresh = 0, -1, True
        while at < size:
            if fresh:  # the longest token here: the automaton's longest path, cut back to where a token ends
                end = at + reach(latin[at:])
                while (token := token_of(latin[at:end], -1)) < 0 and end > at:
                    end -= 1
            while token >= 0:
                end = at + lengths[token]
                if fits[before << 32 | token] and end not in dead:
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, before, fresh = end, token, True
            else:  # nothing fits here: never come back, and shorten the token before
                if not out:
                    raise ValueError(f"the vocabulary can't spell {data!r}")
                dead.add(at)
                last = out.pop()
                at -= lengths[last]
                before = out[-1] if out else -1
                token, fresh = shorter[last], False
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, text: str, ids: str = "ids", path: str = RANKS) -> DataFrame:
    """docs with ``ids``, an array of the token ids of the whole text."""
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        spell = words.encode
        try:
            for batch in sliced(batches):
                packed = [spell(t) if t else b"" for t in batch.column(text).to_pylist()]
                ends = array("i", [0])
                for p in packed:
                    ends.append(ends[-1] + len(p) // 4)
                data = b"".join(packed)
                values = pa.Array.from_buffers(pa.int32(), len(data) // 4, [None, pa.py_buffer(data)])
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, ids])
        finally:
            words.rest()

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ids: str = "ids", out: str = "decoded", path: str = RANKS) -> DataFrame:
    """tokens with ``out``, the bytes that the ids stand for (null ids: no bytes)."""
    schema = T.StructType([*tokens.schema.fields, T.StructField(out, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = decoder(path).decode
        for batch in sliced(batches):
            column = pa.array([spell(x.tolist()) if x is not None else b"" for x in map(_values, batch.column(ids))], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, out])

    return tokens.mapInArrow(run, schema)


def _values(x: pa.ListScalar):
    return None if x.values is None else x.values.to_numpy(zero_copy_only=False)


def digests(docs: DataFrame, path: str = RANKS, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes that they decode to (and the ids)."""
    tokens = encode(docs.select("doc_id", "text"), "text", "ids", path).select("doc_id", "ids")
    return decode(tokens, "ids", "decoded", path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids"] if keep_ids else []))


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
