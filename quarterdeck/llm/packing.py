"""Packing documents into windows with neighbours from a sharded BM25 index.

Stretches of a document that fill a window are windows of their own. What remains of each document is routed by its
commonest token and a min-hash of its token triples, so that related remainders lie side by side, and cut into index shards.
A shard's inverted index holds all its remainders and is asked with all terms of a seed; idf and the mean length come from the whole corpus. Each seed, the
first unused remainder, asks the index for its unused neighbours, which fill the window in order of score; the last
one is cut to fit and the rest of it stays unused. When a shard is used up, its open window goes on with the next
one, and a partition's last window is cut at powers of two, so no window is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import staged
from quarterdeck.llm.units import UnitEncoder, encoder, gather

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1
SHARD_DOCS = 1024  # remainders of one index shard
_K1, _B = 1.2, 0.75  # the usual constants of BM25
_SUMS = 16  # partial sums of the corpus counts, each one number per id of the vocabulary

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_CUT = f"kind int, {_PIECE}, ids binary, common int, triple long"
_FULL, _REST, _COUNTS = 0, 1, 2


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4"))


def _triple_hash(ids: np.ndarray) -> int:
    """The smallest hash of three ids in a row."""
    if len(ids) < 3:
        return -1
    wide = ids.astype(np.uint64)
    mixed = (wide[:-2] << np.uint64(32) | wide[1:-1] << np.uint64(16) | wide[2:]) * np.uint64(0x9E3779B97F4A7C15)
    return int((mixed ^ mixed >> np.uint64(29)).min() >> np.uint64(1))


def _cut(name: str, window: int):
    """Ids of each document; its full windows, its remainder, and at the end the task's document frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, task = encoder(UnitEncoder, name, False), TaskContext.get().partitionId()
        size = codec.tokenizer.get_vocab_size()
        # Documents with each id, then the number of documents and of ids.
        counts = np.zeros(size + 2, dtype=np.int64)
        names, kinds = _CUT_SCHEMA.names, _CUT_SCHEMA.types
        number = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for first, flat, ends in codec.encode(batch.column(1)):
                rows = []
                docs = batch.column(0).slice(first, len(ends)).to_pylist()
                for doc_id, own in zip(docs, np.split(flat, ends[:-1])):
                    ids = np.append(own, own.dtype.type(END_ID))
                    full = len(ids) // window * window
                    for start in range(0, full, window):
                        rows.append((_FULL, doc_id, start, window, _crc(ids[start : start + window]), len(ids), (task << 33 | number) << 1, 0, None, None, None))
                        number += 1
                    tally = np.bincount(ids, minlength=size)
                    counts[:size] += tally > 0
                    counts[size:] += (1, len(ids))
                    if full < len(ids):
                        rest = ids[full:]
                        rows.append((_REST, doc_id, full, len(rest), None, len(ids), None, None, rest.tobytes(), int(tally.argmax()), _triple_hash(rest)))
                yield batch_of(rows)
        yield batch_of([(_COUNTS, *[None] * 7, counts.tobytes(), None, None)])

    return run


_CUT_SCHEMA = pa.schema(
    [("kind", pa.int32())]
    + [(c.split()[0], pa.int64()) for c in _PIECE.split(", ")]
    + [("ids", pa.binary()), ("common", pa.int32()), ("triple", pa.int64())]
)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column(0):
            own = np.frombuffer(x.as_py(), dtype=np.int64)
            total = own if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["ids"])


class _Index:
    """BM25 over the remainders of a shard, as postings ordered by term."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.array([len(r) for r in rests])
        self.size, self.idf = len(rests), idf
        owner = np.repeat(np.arange(len(rests), dtype=np.int64), sizes)
        keys, counts = np.unique(np.concatenate(rests).astype(np.int64) * len(rests) + owner, return_counts=True)
        terms, self.docs = np.divmod(keys, len(rests))
        self.begins = np.searchsorted(terms, np.arange(len(idf) + 1))
        self.weights = idf[terms] * counts * (_K1 + 1) / (counts + _K1 * (1 - _B + _B * sizes[self.docs] / mean))

    def scores(self, seed: np.ndarray) -> np.ndarray:
        """The score of every remainder for all terms of the seed, each asked once."""
        terms = np.unique(seed)
        begins = self.begins[terms]
        lengths = self.begins[terms.astype(np.int64) + 1] - begins
        return np.bincount(gather(self.docs, begins, lengths), weights=gather(self.weights, begins, lengths), minlength=self.size)


class _Packer:
    """Fills windows from one index shard after the other."""

    def __init__(self, task: int, window: int, idf: np.ndarray, mean: float):
        self.task, self.window, self.idf, self.mean = task, window, idf, mean
        self.number, self.open, self.filled, self.seed = 0, [], 0, None
        self.rows: list[tuple] = []

    def _sequence(self) -> int:
        self.number += 1
        return (self.task << 33 | self.number) << 1 | 1

    def _close(self) -> None:
        sequence, offset = self._sequence(), 0
        for doc_id, start, ids, total in self.open:
            self.rows.append((doc_id, start, len(ids), _crc(ids), total, sequence, offset))
            offset += len(ids)
        self.open, self.filled, self.seed = [], 0, None

    def pack(self, shard: list[tuple]) -> None:
        """``shard``: (doc_id, start, ids, doc_tokens) of each remainder."""
        index = _Index([ids for _, _, ids, _ in shard], self.idf, self.mean)
        taken = np.zeros(len(shard), dtype=np.int64)
        left = np.array([len(ids) for _, _, ids, _ in shard], dtype=np.int64)
        following = 0

        def take(k: int) -> None:
            doc_id, start, ids, total = shard[k]
            n = min(int(left[k]), self.window - self.filled)
            begin = int(taken[k])
            self.open.append((doc_id, start + begin, ids[begin : begin + n], total))
            self.filled += n
            taken[k] += n
            left[k] -= n

        while True:
            while following < len(shard) and not left[following]:
                following += 1
            if following == len(shard):
                return
            if self.seed is None:
                self.seed = shard[following][2]
                take(following)
            if self.filled < self.window:
                scores = index.scores(self.seed)
                scores[left == 0] = 0
                found = np.flatnonzero(scores)
                for k in found[np.argsort(-scores[found], kind="stable")]:
                    if self.filled == self.window:
                        break
                    take(int(k))
            # Without a neighbour left, whatever comes next.
            while self.filled < self.window and following < len(shard):
                if left[following]:
                    take(following)
                else:
                    following += 1
            if self.filled == self.window:
                self._close()

    def finish(self) -> None:
        """Cut the last window at powers of two."""
        rest = [[d, s, ids, t] for d, s, ids, t in self.open]
        left = self.filled
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            self.open, self.filled = [], 0
            while self.filled < size:
                piece = rest[0]
                n = min(len(piece[2]), size - self.filled)
                self.open.append((piece[0], piece[1], piece[2][:n], piece[3]))
                self.filled += n
                piece[1], piece[2] = piece[1] + n, piece[2][n:]
                if not len(piece[2]):
                    rest.pop(0)
            left -= size
            self._close()


def _pack(window: int, shard_docs: int, idf: np.ndarray, mean: float, dtype: str):
    names = [c.split()[0] for c in _PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, shard = _Packer(TaskContext.get().partitionId(), window, idf, mean), []

        def rows() -> pa.RecordBatch:
            columns = zip(*packer.rows) if packer.rows else [[]] * len(names)
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
            packer.rows = []
            return out

        for batch in batches:
            for doc_id, start, ids, total in zip(*(batch.column(k).to_pylist() for k in range(4))):
                shard.append((doc_id, start, np.frombuffer(ids, dtype=dtype), total))
                if len(shard) == shard_docs:
                    packer.pack(shard)
                    shard = []
                    yield rows()
        if shard:
            packer.pack(shard)
        packer.finish()
        yield rows()

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text and ``END_ID``; each id lies in one piece. A sequence has ``window`` ids; only
    the last ones of a task have fewer, always a power of two.

    A null text counts as empty, so its document is ``END_ID`` alone. Rows may repeat or lack a doc_id: each is a document
    of its own. Other columns are not read; an empty table gives an empty result.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = staged(narrow.mapInArrow(_cut(vocabulary, window), _CUT), "pack-cut")

    sums = cut.where(F.col("kind") == _COUNTS).select("ids").coalesce(_SUMS).mapInArrow(_add_up, "ids binary").collect()
    codec = encoder(UnitEncoder, vocabulary, False)
    counts = sum((np.frombuffer(r.ids, dtype=np.int64) for r in sums), np.zeros(codec.tokenizer.get_vocab_size() + 2, np.int64))
    seen, documents, ids = counts[:-2], int(counts[-2]), int(counts[-1])
    idf = np.log1p((documents - seen + 0.5) / (seen + 0.5))

    rest = cut.where(F.col("kind") == _REST).select("doc_id", "start", "ids", "doc_tokens", "common", "triple")
    # doc_id and start split even a routing key that very many copies share.
    order = ["common", "triple", "doc_id", "start"]
    routed = rest.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "start", "ids", "doc_tokens")
    packed = routed.mapInArrow(_pack(window, shard_docs, idf, ids / max(documents, 1), codec.dtype.__name__), _PIECE)
    names = [c.split()[0] for c in _PIECE.split(", ")]
    return cut.where(F.col("kind") == _FULL).select(*names).unionByName(packed)
