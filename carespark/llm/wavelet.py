"""Token ids in wavelet matrices, one compressed blob for each shard.

Documents are dealt by ascending key into range partitions; each partition
cuts its run of tokens into shards of about ``SHARD_TOKENS`` at document ends.
A shard is stored as a wavelet matrix: one bit-plane per bit of an id, from the
highest, each plane in the order that the stable sort by the planes above
gives.  The planes are packed and zstd-compressed into one blob (magic, number
of tokens and planes, then per plane its number of zeros and its bytes).  Rank
directories are rebuilt on reading.  From the blob alone a reader gets a token
(:meth:`WaveletMatrix.access`), the count of an id before a place
(:meth:`~WaveletMatrix.rank`), its j-th place (:meth:`~WaveletMatrix.select`)
and all ids in order (:meth:`~WaveletMatrix.decode`).

A shard row holds part, block, n_tokens, the documents' keys and end places
and the blob; files are Parquet written by Spark in the shared folder.

Defined cases: null and empty texts hold only the end id; null keys come
first; equal keys are ordered by their text; an empty table gives no shards;
a document longer than a shard makes a longer shard.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, scratch
from .pieces import ChunkEncoder, Memo

MODEL = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
SHARD_TOKENS = 1 << 21
CHUNKS = 600_000  # chunks of a generation that a worker remembers (about 125 MB)
#: Marks behind a word that match the pattern by themselves.
STOPS = frozenset(".,;:!?)")
_MAGIC = b"WMX1"
_HEAD = struct.Struct("<4sQB")
_PLANE = struct.Struct("<QQ")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)
_BLOCK = 64  # bytes of a plane to one entry of the rank directory


class WaveletMatrix:
    """A sequence of ids below 2^planes as bit-planes with rank and select."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.zeros, self.planes = n, zeros, planes
        self._before: list[np.ndarray | None] = [None] * len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, planes: int) -> WaveletMatrix:
        ids = np.asarray(ids, dtype=np.uint16 if planes <= 16 else np.uint32)
        zeros, packed = [], []
        for b in range(planes - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << b)) != 0
            packed.append(np.packbits(bit, bitorder="little"))
            low = ids[~bit]
            zeros.append(len(low))
            ids = np.concatenate([low, ids[bit]])
        return cls(len(ids), zeros, packed)

    def to_bytes(self) -> bytes:
        out = [_HEAD.pack(_MAGIC, self.n, len(self.planes))]
        for z, p in zip(self.zeros, self.planes):
            data = zstandard.ZstdCompressor(level=1).compress(p.tobytes())
            out += [_PLANE.pack(z, len(data)), data]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        magic, n, count = _HEAD.unpack_from(blob)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix")
        at, zeros, planes = _HEAD.size, [], []
        for _ in range(count):
            z, size = _PLANE.unpack_from(blob, at)
            at += _PLANE.size
            zeros.append(z)
            planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at:at + size]), np.uint8))
            at += size
        return cls(n, zeros, planes)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        plane = self.planes[level]
        if self._before[level] is None:
            counts = np.add.reduceat(_ONES[plane].astype(np.int64), np.arange(0, len(plane), _BLOCK)) if len(plane) else np.zeros(0, np.int64)
            self._before[level] = np.concatenate([[0], np.cumsum(counts)])
        byte, bit = divmod(i, 8)
        block = byte // _BLOCK
        ones = int(self._before[level][block]) + int(_ONES[plane[block * _BLOCK:byte]].sum())
        return ones + (bin(int(plane[byte]) & ((1 << bit) - 1)).count("1") if bit else 0)

    def access(self, i: int) -> int:
        value = 0
        for level, z in enumerate(self.zeros):
            bit = int(self.planes[level][i // 8]) >> (i % 8) & 1
            ones = self._ones(level, i)
            i = z + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences of token among the first i ids stand after the last plane."""
        low, high = 0, i
        for level, z in enumerate(self.zeros):
            a, b = self._ones(level, low), self._ones(level, high)
            low, high = (z + a, z + b) if token >> (len(self.zeros) - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def rank(self, token: int, i: int | None = None) -> int:
        """Occurrences of token among the first i ids (all, if None)."""
        low, high = self._range(token, self.n if i is None else i)
        return high - low

    def select(self, token: int, j: int) -> int:
        """The place of the j-th occurrence (from 0) of token."""
        low, high = self._range(token, self.n)
        if not 0 <= j < high - low:
            raise IndexError(j)
        at = low + j
        for level in range(len(self.zeros) - 1, -1, -1):
            one = at >= self.zeros[level]
            at = self._nth(level, at - self.zeros[level] if one else at, one)
        return at

    def places(self, token: int) -> np.ndarray:
        """All places of token, plane by plane: one pass over each plane whatever their number."""
        at = np.arange(*self._range(token, self.n))
        for level in range(len(self.zeros) - 1, -1, -1):
            if token >> (len(self.zeros) - 1 - level) & 1:
                at = np.flatnonzero(self._bits(level))[at - self.zeros[level]]
            else:
                at = np.flatnonzero(~self._bits(level))[at]
        return at

    def _nth(self, level: int, k: int, one: bool) -> int:
        """The place of the k-th one (or zero) of a plane: a binary search over ranks."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(level, mid + 1)
            if (ones if one else mid + 1 - ones) <= k:
                low = mid + 1
            else:
                high = mid
        return low

    def decode(self) -> np.ndarray:
        """All ids in order: the stable partitions undone from the lowest plane up."""
        planes = len(self.planes)
        ids = np.zeros(self.n, np.uint16 if planes <= 16 else np.uint32)
        for level in range(planes - 1, -1, -1):
            bit, z = self._bits(level), self.zeros[level]
            up = np.empty_like(ids)
            up[~bit] = ids[:z]
            up[bit] = ids[z:] | ids.dtype.type(1 << (planes - 1 - level))
            ids = up
        return ids


def _letters() -> dict[int, str]:
    """The library's letter for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Callable[[str], bytes], int]:
    """The library's plain encoding (special tokens' strings become their ids) with a memo of its pieces, and the planes that its ids need."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    merge, letters = library.model.tokenize, _letters()
    # The library's own pattern; up to Latin Extended-B its classes are the same in any Unicode version.
    pieces = regex.compile(public_tokenizers.PATTERN).findall

    def whole(text: str) -> bytes:
        return array("I", library.encode(text, add_special_tokens=False).ids).tobytes()

    def spelt(letter: str) -> bytes:
        return array("I", [t.id for t in merge(letter)]).tobytes()

    def merged(text: str) -> bytes:
        return spelt(text.encode().decode("latin-1").translate(letters))

    piece = Memo(merged)

    def spell(chunk: str) -> bytes:
        if chunk.isascii() or max(chunk) < "\u0250":
            return b"".join(map(piece.__getitem__, pieces(chunk)))
        return whole(chunk)

    def first(chunk: str) -> bytes:
        return merged(chunk) if chunk.isalpha() and max(chunk) < "\u0250" else spell(chunk)

    def spaced(chunk: str) -> bytes:
        if chunk.isalpha():  # a plain word is one piece
            if chunk.isascii():
                return spelt(space + chunk)  # ASCII letters stand for themselves
            return spelt(space + chunk.encode().decode("latin-1").translate(letters)) if max(chunk) < "\u0250" else whole(f" {chunk}")
        if chunk[:-1].isalpha() and chunk[-1] in STOPS and (chunk.isascii() or max(chunk) < "\u0250"):
            return chunks.spaced[chunk[:-1]] + piece[chunk[-1]]  # a word and the mark behind it are two
        return spell(f" {chunk}")

    space = letters[ord(" ")]
    chunks, special = ChunkEncoder(first, whole, CHUNKS, spaced), [t.content for t in library.get_added_tokens_decoder().values()]

    def encode(text: str) -> bytes:
        return whole(text) if any(s in text for s in special) else chunks(text)

    return encode, max(1, (library.get_vocab_size(with_added_tokens=True) - 1).bit_length())


def build_shards(docs: DataFrame, key: str, text: str, path: str = MODEL, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per shard: part int, block int, n_tokens long, keys array<long>, ends array<long>, blob binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, planes = encoder(path)
        end = array("I", [end_id]).tobytes()
        block, keys, ends, packed, size = 0, [], [], [], 0

        def flush(part: int) -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.frombuffer(b"".join(packed), "<u4"), planes)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "n_tokens": pa.array([size], pa.int64()),
                "keys": pa.array([keys], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int64())),
                "blob": pa.array([matrix.to_bytes()], pa.binary())})

        part = 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if len(batch) else part
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                data = (spell(t) if t else b"") + end
                size += len(data) // 4
                keys.append(k)
                ends.append(size)
                packed.append(data)
                if size >= shard_tokens:
                    yield flush(part)
                    block, keys, ends, packed, size = block + 1, [], [], [], 0
        if keys:
            yield flush(part)

    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, "part int, block int, n_tokens long, keys array<long>, ends array<long>, blob binary")


def write_shards(docs: DataFrame, key: str, text: str, folder: str, **options) -> str:
    build_shards(docs, key, text, **options).write.option("compression", "none").parquet(folder)
    return folder


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens, ids_crc32 of each document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["blob"]).decode().astype("<u4")
                cuts = [0, *row["ends"]]
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * len(crc), pa.int32()), "block": pa.array([row["block"]] * len(crc), pa.int32()),
                    "key": pa.array(row["keys"], pa.int64()), "inside": pa.array(cuts[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(cuts), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    shards = spark.read.parquet(folder)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each range partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (shards.select("part", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("block_start"))
              .join(F.broadcast(parts), "part"))
    found = shards.mapInArrow(run, "part int, block int, key long, inside long, n_tokens long, ids_crc32 long")
    return (found.join(starts, ["part", "block"])
            .select("key", (F.col("part_start") + F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def count_token(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """part, block, n: how often a token occurs in each shard, by rank alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [WaveletMatrix.from_bytes(b).rank(token) for b in batch.column("blob").to_pylist()]
            yield pa.RecordBatch.from_pydict({"part": batch.column("part"), "block": batch.column("block"), "n": pa.array(found, pa.int64())})

    return spark.read.parquet(folder).select("part", "block", "blob").mapInArrow(run, "part int, block int, n long")


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """part, block, place of each occurrence of a token within its shard, by select."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                matrix = WaveletMatrix.from_bytes(row["blob"])
                places = matrix.places(token)
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]] * len(places), pa.int32()), "block": pa.array([row["block"]] * len(places), pa.int32()),
                                                  "place": pa.array(places, pa.int64())})

    return spark.read.parquet(folder).select("part", "block", "blob").mapInArrow(run, "part int, block int, place long")


def op7_wavelet(spark, sf_dir: str) -> DataFrame:
    folder = write_shards(documents(spark, sf_dir), "doc_id", "text", scratch(spark, "tokens"))
    return read_documents(spark, folder).withColumnRenamed("key", "doc_id")
