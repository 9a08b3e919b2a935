"""Wavelet matrices: token ids of a shard in one compressed file that can be read, counted and searched.

A wavelet matrix keeps one bit-plane per bit of an id, from the highest down. Before each next plane the ids are
parted stably by the bit of this one, zeros first. With the number of ones before any place of a plane (rank), an id
can be read, an id's occurrences counted up to any place, and (with select, the inverse) all of them found, without
unpacking the sequence.

File: the magic, eight little-endian unsigned 64-bit numbers (ids, planes, documents, and the packed sizes of the five
parts), then the parts, each a zstd frame: planes (64-bit words, lowest bit first), counts of ones before every eighth word
(unsigned 32 bits, plane by plane), zeros per plane (unsigned 64), doc_ids (signed 64, after one byte each that tells null
from the rest), ids per document (unsigned 64).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import shared_folder
from quarterdeck.llm.units import UnitEncoder, encoder

MAGIC = b"WVLTMTX1"
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SHARD_TOKENS = 1 << 20
_BLOCK = 8  # words per stored count


class WaveletMatrix:
    """Planes with rank and select. Build with ``of`` or read with ``from_bytes``."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, zeros: np.ndarray, size: int):
        self.words, self.counts, self.zeros, self.size = words, counts, zeros, size

    @property
    def planes(self) -> int:
        return len(self.zeros)

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        size = len(ids)
        planes = max(1, int(ids.max(initial=0)).bit_length())
        words = np.zeros((planes, size // 64 + 1), dtype="<u8")
        zeros = np.zeros(planes, dtype=np.int64)
        for k in range(planes):
            ones = (ids >> (planes - 1 - k)) & 1 != 0
            packed = np.packbits(ones, bitorder="little")
            words[k].view(np.uint8)[: len(packed)] = packed
            low = ids[~ones]
            zeros[k] = len(low)
            ids = np.concatenate([low, ids[ones]])
        return cls(words, cls._count(words), zeros, size)

    @staticmethod
    def _count(words: np.ndarray) -> np.ndarray:
        before = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.uint32) - np.bitwise_count(words)
        return before[:, ::_BLOCK].astype("<u4")

    def to_bytes(self) -> list[bytes]:
        return [self.words.tobytes(), self.counts.tobytes(), self.zeros.astype("<u8").tobytes()]

    @classmethod
    def from_bytes(cls, size: int, planes: int, words: bytes, counts: bytes, zeros: bytes) -> WaveletMatrix:
        grid = np.frombuffer(words, dtype="<u8").reshape(planes, -1)
        return cls(grid, np.frombuffer(counts, dtype="<u4").reshape(planes, -1), np.frombuffer(zeros, dtype="<u8").astype(np.int64), size)

    def rank(self, plane: int, at: np.ndarray) -> np.ndarray:
        """The number of ones of a plane before the places ``at``."""
        at = np.asarray(at, dtype=np.int64)
        word = at >> 6
        ones = self.counts[plane, word // _BLOCK].astype(np.int64)
        for back in range(_BLOCK):
            earlier = (word // _BLOCK) * _BLOCK + back
            ones += np.where(earlier < word, np.bitwise_count(self.words[plane, np.minimum(earlier, word)]), 0)
        part = self.words[plane, word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return ones + np.bitwise_count(part)

    def select(self, plane: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """The places of the ``nth`` (from 0) ones or zeros of a plane, by halving over rank."""
        nth = np.asarray(nth, dtype=np.int64)
        low, high = np.zeros_like(nth), np.full_like(nth, self.size)
        while (low < high).any():
            middle = (low + high) // 2
            ones = self.rank(plane, middle + 1)
            enough = (ones if bit else middle + 1 - ones) > nth
            low, high = np.where(enough | (low >= high), low, middle + 1), np.where(enough & (low < high), middle, high)
        return low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at the places ``at``."""
        at = np.asarray(at, dtype=np.int64)
        ids = np.zeros(len(at), dtype=np.int64)
        for k in range(self.planes):
            ones = self.rank(k, at)
            bit = (self.words[k, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
            ids = ids << 1 | bit
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return ids

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        ends = np.array([start, stop], dtype=np.int64)
        if token >> self.planes:
            return 0, 0
        for k in range(self.planes):
            ones = self.rank(k, ends)
            ends = self.zeros[k] + ones if token >> (self.planes - 1 - k) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id occurs from ``start`` to before ``stop``."""
        low, high = self._range(token, start, self.size if stop is None else stop)
        return high - low

    def occurrences(self, token: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """All places of an id from ``start`` to before ``stop``, in order."""
        places = np.arange(*self._range(token, start, self.size if stop is None else stop), dtype=np.int64)
        for k in reversed(range(self.planes)):
            if token >> (self.planes - 1 - k) & 1:
                places = self.select(k, 1, places - self.zeros[k])
            else:
                places = self.select(k, 0, places)
        return places

    def decode(self) -> np.ndarray:
        """The whole sequence: the parting of each plane undone, from the last to the first."""
        ids = np.zeros(self.size, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        for k in reversed(range(self.planes)):
            ones = np.unpackbits(self.words[k].view(np.uint8), count=self.size, bitorder="little").view(bool)
            back = np.empty_like(ids)
            back[~ones] = ids[: self.zeros[k]]
            back[ones] = ids[self.zeros[k] :] | ids.dtype.type(1 << (self.planes - 1 - k))
            ids = back
        return ids


def write_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One file: the documents of a shard and their ids."""
    matrix = WaveletMatrix.of(ids)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = [*matrix.to_bytes(), known.tobytes() + numbers.tobytes(), np.array(lengths, dtype="<u8").tobytes()]
    packed = [pack(p) for p in parts]
    head = np.array([len(ids), matrix.planes, len(doc_ids), *map(len, packed)], dtype="<u8")
    return MAGIC + head.tobytes() + b"".join(packed)


def read_shard(file: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """doc_ids, ids per document and the matrix of a file."""
    if file[: len(MAGIC)] != MAGIC:
        raise ValueError("not a wavelet shard")
    head = np.frombuffer(file, dtype="<u8", count=8, offset=len(MAGIC)).astype(np.int64).tolist()
    size, planes, documents, *packed = head
    unpack, at, parts = zstandard.ZstdDecompressor().decompress, len(MAGIC) + 64, []
    for n in packed:
        parts.append(unpack(file[at : at + n]))
        at += n
    known = np.frombuffer(parts[3], dtype=np.uint8, count=documents)
    numbers = np.frombuffer(parts[3], dtype="<i8", offset=documents).tolist()
    doc_ids = [d if k else None for d, k in zip(numbers, known)]
    return doc_ids, np.frombuffer(parts[4], dtype="<u8").astype(np.int64), WaveletMatrix.from_bytes(size, planes, *parts[:3])


def _write(name: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = encoder(UnitEncoder, name, True), TaskContext.get().partitionId()
        doc_ids, lengths, held, size, number = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            file = write_shard(doc_ids, lengths, np.concatenate(held))
            columns = [[part], [number], [size], [file]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "number", "tokens", "file"])

        for batch in batches:
            for first, ids, ends in codec.encode(batch.column(1)):
                docs = batch.column(0).slice(first, len(ends)).to_pylist()
                for doc_id, own in zip(docs, np.split(ids, ends[:-1])):
                    if held and size + len(own) + 1 > shard_tokens:
                        yield shard()
                        doc_ids, lengths, held, size, number = [], [], [], 0, number + 1
                    doc_ids.append(doc_id)
                    lengths.append(len(own) + 1)
                    held.append(np.append(own, own.dtype.type(END_ID)))
                    size += len(own) + 1
        if held:
            yield shard()

    return run


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of all ``docs(doc_id, text)``, in ascending doc_id order, as wavelet shards below ``path``.

    Spark's writer commits the shards, one to a Parquet file (columns part, number, tokens, file), so they reach any
    file system that Spark does and no task's loss leaves half a shard. ``part`` and ``number`` order the shards. A
    document lies in one shard; a shard ends before it would pass ``shard_tokens``, so only one document larger
    than that makes a larger one.

    Null texts count as empty; each document ends with ``END_ID``. Documents without doc_id come first; equal doc_ids lie
    side by side, ordered by a hash of their texts. An empty table writes no shard.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    # The tie-break lets many rows of one doc_id, or of none, spread over partitions.
    ordered = narrow.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    shards = ordered.mapInArrow(_write(vocabulary, shard_tokens), "part int, number int, tokens long, file binary")
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, file in zip(*(batch.column(k) for k in range(3))):
            doc_ids, lengths, matrix = read_shard(file.as_py())
            ids, ends = matrix.decode().astype("<u4"), np.cumsum(lengths)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            n = len(doc_ids)
            columns = [pa.array([part.as_py()] * n, pa.int32()), pa.array([number.as_py()] * n, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "number", "doc_id", "offset", "n_tokens", "ids_crc32"])


def read_shards(shards: DataFrame) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32, read from the files."""
    sizes = shards.select("part", "number", "tokens")
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, of which there are as many as the writing job had partitions.
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("all"))
    parts = parts.select("part", F.coalesce(F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    begins = sizes.join(parts, "part").select("part", "number", (F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("begin"))
    rows = shards.select("part", "number", "file").mapInArrow(_read, "part int, number int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return rows.join(begins, ["part", "number"]).select("doc_id", (F.col("begin") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` as shards to the shared folder and read them back (see ``write_shards``, ``read_shards``)."""
    path = shared_folder(docs.sparkSession, "wavelet-shards")
    write_shards(docs, path, vocabulary, shard_tokens)
    shards = docs.sparkSession.read.schema("part int, number int, tokens long, file binary").parquet(path)
    return read_shards(shards)
