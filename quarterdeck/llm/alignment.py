"""Token ids of two vocabularies aligned over the same bytes.

Both tokenizations of a text cover the same bytes. Every token points to its farthest-right overlapping token: of the other
side, the one that holds its last byte. The second vocabulary's token that ends together with one of the first points to
itself. Doubling the pointers, for all tokens of many texts at once, leaves each token with the last token of its
component, which labels its group. Counts of linked id pairs over the corpus are summed from slices of texts, and come back
to a slice as one row, so that no link leaves its slice on its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.bpe import ForcedEncoder
from quarterdeck.llm.common import staged
from quarterdeck.llm.units import _MARK, UnitEncoder, encoder, gather

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
SLICE_BYTES = 4 << 20  # of text whose pair counts travel together, or one longer text
_STRETCH = 1 << 20  # bytes of one text that the second tokenizer takes at once
_CHUNK = 1 << 20  # tokens whose group text is made at once
_SPACE = "▁"  # a blank, as the second vocabulary writes it

_SLICES = (
    "slice string, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>, "
    "a array<int>, b array<int>, n array<long>, ends binary, pairs binary, many binary"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PlainEncoder(ForcedEncoder):
    """Byte-level ids in which the strings of special tokens are plain text."""

    def _encode_whole(self, text: str) -> np.ndarray:
        return self._encode_units([text])[0] if text else np.zeros(0, self.dtype)


class PieceEncoder(UnitEncoder):
    """Ids of a sentencepiece model, each distinct word with the blank before it encoded once.

    No piece of the model has a blank after another character, so a blank between two words always begins a piece, and the
    model itself puts one before what it encodes. Texts with other blanks are encoded in long stretches cut at such places.
    """

    def __init__(self, path: str, leading_space: bool = True):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        spelt = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.byte_lengths = np.array([len(s) for s in spelt], np.int64)
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.byte_store = np.frombuffer(b"".join(spelt), np.uint8)
        self.dtype = np.uint16 if len(pieces) <= 1 << 16 else np.uint32
        self._start()

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        if not self.cuts:
            return pa.array([""] * len(texts), pa.large_string()), pa.array([True] * len(texts))
        whole = pc.match_substring_regex(texts, f"^ |  | $|{_SPACE}|{_MARK}")
        return pc.if_else(whole, "", pc.replace_substring(texts, " ", _MARK)), whole

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.encode(units, num_threads=1)
        return np.array([*chain.from_iterable(ids)], self.dtype), np.array([len(i) for i in ids], np.int64)

    def _encode_whole(self, text: str) -> np.ndarray:
        stretches, at = [], 0
        while self.cuts and len(text) - at > _STRETCH:
            cut = text.find(" ", at + _STRETCH)
            while cut > 0 and text[cut - 1] in (" ", _SPACE):
                cut = text.find(" ", cut + 1)
            # An empty rest would lose its blank.
            if cut < 0 or cut + 1 == len(text):
                break
            stretches.append(text[at:cut])
            at = cut + 1
        return self._encode_units([*stretches, text[at:]])[0]


def _all(codec: UnitEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of ``texts``, and the number of each text's ids."""
    parts = [(ids, np.diff(ends, prepend=0)) for _, ids, ends in codec.encode(texts)]
    return np.concatenate([p[0] for p in parts]).astype(np.int32), np.concatenate([p[1] for p in parts])


def _same_bytes(flat: np.ndarray, edges: np.ndarray, codec, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which texts equal the joined bytes of their tokens."""
    sizes = np.add.reduceat(np.append(codec.byte_lengths[ids], 0), np.minimum(np.cumsum(counts) - counts, len(ids)))
    sizes[counts == 0] = 0
    same = sizes == np.diff(edges)
    token = np.cumsum(counts)
    for k in np.flatnonzero(same).tolist():
        own = ids[token[k] - counts[k] : token[k]]
        spelt = gather(codec.byte_store, codec.byte_starts[own], codec.byte_lengths[own])
        same[k] = np.array_equal(spelt, flat[edges[k] : edges[k + 1]])
    return same


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For the tokens of both sides, first those of a, the number of the last token of their component.

    Ends are ascending byte offsets over the same bytes; the last ends agree.
    """
    n = len(ends_a)
    to_b = np.searchsorted(ends_b, ends_a)  # the first token of b that ends where this one ends, or later
    to_a = np.searchsorted(ends_a, ends_b)
    own = np.arange(n, n + len(ends_b))
    successor = np.concatenate([to_b + n, np.where(ends_a[np.minimum(to_a, n - 1)] == ends_b, own, to_a)]).astype(np.int32)
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor
        successor = doubled


def _links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of overlapping tokens: each offset where a token of either side begins starts exactly one pair."""
    begins = np.sort(np.concatenate([[0], ends_a[:-1], ends_b[:-1]]), kind="stable")  # two sorted runs
    begins = begins[np.diff(begins, prepend=-1) != 0]
    return np.searchsorted(ends_a, begins, side="right"), np.searchsorted(ends_b, begins, side="right")


def _spelling(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal text of each id below ``size`` with a comma after it, and the places of these texts."""
    texts = [f"{i},".encode() for i in range(size)]
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum(lengths))


class Aligner:
    """Both encoders with what a worker keeps between slices."""

    def __init__(self, first: str, second: str):
        self.a = encoder(PlainEncoder, first, True)
        self.b = encoder(PieceEncoder, second, True)
        self.digits, self.places = _spelling(max(len(self.a.byte_lengths), len(self.b.byte_lengths)))

    def tokens(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """All ids and the number of ids of each text, for both sides; none where a side's bytes are not the text with a blank before it."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        ids_a, n_a = _all(self.a, spaced)
        ids_b, n_b = _all(self.b, texts)
        edges = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset : spaced.offset + len(spaced) + 1]
        flat = np.frombuffer(spaced.buffers()[2], np.uint8)
        good = pc.binary_length(texts).to_numpy() > 0
        good &= _same_bytes(flat, edges, self.a, ids_a, n_a) & _same_bytes(flat, edges, self.b, ids_b, n_b)
        keep_a, keep_b = np.repeat(good, n_a), np.repeat(good, n_b)
        return (ids_a[keep_a], np.where(good, n_a, 0)), (ids_b[keep_b], np.where(good, n_b, 0))

    def group_digest(self, ids_a: np.ndarray, ids_b: np.ndarray, label_a: np.ndarray, label_b: np.ndarray) -> str:
        """SHA-256 of the groups' text, made a chunk of tokens at a time; labels number the groups from 0."""
        total = len(ids_a) + len(ids_b)
        before_b = np.searchsorted(label_b, label_a)  # tokens of b in earlier groups
        at_a = np.arange(len(ids_a)) + before_b
        at_b = np.arange(len(ids_b)) + np.searchsorted(label_a, label_b, side="right")
        ids, mark = np.empty(total, np.int32), np.full(total, ord(","), np.uint8)
        ids[at_a], ids[at_b] = ids_a, ids_b
        mark[at_a[np.flatnonzero(np.diff(label_a, append=-1))]] = ord("|")
        mark[at_b[np.flatnonzero(np.diff(label_b, append=-1))]] = ord(";")
        digest = hashlib.sha256()
        for s in range(0, total, _CHUNK):
            part, marks = ids[s : s + _CHUNK], mark[s : s + _CHUNK]
            lengths = np.diff(self.places)[part]
            text = gather(self.digits, self.places[part], lengths)
            text[np.cumsum(lengths) - 1] = marks
            digest.update(text[: -1 if s + _CHUNK >= total else None].tobytes())
        return digest.hexdigest()

    def align(self, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """One slice: what is known of each text, and its linked pairs as numbers of the slice's distinct pairs."""
        (ids_a, n_a), (ids_b, n_b) = self.tokens(texts)
        ends_a, ends_b = np.cumsum(self.a.byte_lengths[ids_a]), np.cumsum(self.b.byte_lengths[ids_b])
        count = len(texts)
        links, groups, digests = np.zeros(count, np.int64), np.zeros(count, np.int64), [""] * count
        codes, owners = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(ids_a):
            last = terminals(ends_a, ends_b)
            # Terminals ascend with the offsets, so equal ones are neighbours.
            label_a, label_b = last[: len(ids_a)], last[len(ids_a) :]
            numbers = np.cumsum(np.diff(label_b, prepend=label_b[0]) != 0)
            label_a = numbers[label_a - len(ids_a)]
            label_b = numbers
            to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
            for k in np.flatnonzero(n_a).tolist():
                s, e = slice(to_a[k] - n_a[k], to_a[k]), slice(to_b[k] - n_b[k], to_b[k])
                base = label_a[s.start]
                groups[k] = label_a[s.stop - 1] - base + 1
                digests[k] = self.group_digest(ids_a[s], ids_b[e], label_a[s] - base, label_b[e] - base)
            at_a, at_b = _links(ends_a, ends_b)
            owners = np.searchsorted(to_a, at_a, side="right")
            links = np.bincount(owners, minlength=count)
            codes = ids_a[at_a].astype(np.int64) << 32 | ids_b[at_b]
        pair, distinct = pd.factorize(codes)
        many = np.bincount(pair, minlength=len(distinct))
        # Pairs of a text, each once with its number of links.
        own, repeats = np.unique(owners * max(len(distinct), 1) + pair, return_counts=True)
        owner, pair = np.divmod(own, max(len(distinct), 1))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]),
                one(ids),
                one(pa.array(n_a.astype(np.int64))),
                one(pa.array(n_b.astype(np.int64))),
                one(pa.array(groups)),
                one(pa.array(links.astype(np.int64))),
                one(pa.array(digests, pa.string())),
                one(pa.array((distinct >> 32).astype(np.int32))),
                one(pa.array((distinct & 0xFFFFFFFF).astype(np.int32))),
                one(pa.array(many.astype(np.int64))),
                pa.array([np.cumsum(np.bincount(owner, minlength=count)).astype(np.uint32).tobytes()], pa.binary()),
                pa.array([_narrow(pair, len(distinct))], pa.binary()),
                pa.array([_narrow(repeats, int(repeats.max(initial=0)) + 1)], pa.binary()),
            ],
            names=[c.strip().split(" ")[0] for c in _SLICES.split(", ")],
        )


def _narrow(values: np.ndarray, size: int) -> bytes:
    """Whole numbers below ``size`` in as few bytes each as they need, with that number of bytes first."""
    width = 1 if size <= 1 << 8 else 2 if size <= 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligned(first: str, second: str, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (first, second) not in _ALIGNERS:
            _ALIGNERS[first, second] = Aligner(first, second)
        aligner = _ALIGNERS[first, second]
        held, size = [], 0
        for batch in batches:
            bytes_ = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            firsts = np.flatnonzero(np.diff(bytes_ // slice_bytes, prepend=-1)).tolist()
            for a, b in zip(firsts, [*firsts[1:], len(batch)]):
                held.append(batch.slice(a, b - a))
                size += int(bytes_[b - 1] - (bytes_[a - 1] if a else 0))
                if size >= slice_bytes:
                    yield _joined(aligner, held)
                    held, size = [], 0
        if held:
            yield _joined(aligner, held)

    return run


def _joined(aligner: Aligner, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches)
    return aligner.align(rows.column(0).combine_chunks(), rows.column(1).combine_chunks())


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(len(batch)):
            rows = {name: batch.column(k)[r] for k, name in enumerate(batch.schema.names)}
            ids, digests, n_a, n_b, groups, links = (rows[c].values for c in ("doc_ids", "digests", "n_a", "n_b", "n_groups", "n_links"))
            ends = np.frombuffer(rows["ends"].as_py(), np.uint32).astype(np.int64)
            pair, many = _wide(rows["pairs"].as_py()), _wide(rows["many"].as_py())
            place, count, best = (rows["counts"].values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            of_pair = np.zeros((2, len(place)), np.int64)
            of_pair[0, place], of_pair[1, place] = count, best
            sums = np.zeros((2, len(pair) + 1), np.int64)
            np.cumsum(of_pair[:, pair] * many, axis=1, out=sums[:, 1:])
            totals = np.diff(sums[:, np.append(0, ends)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, n_a, n_b, groups, links, pa.array(totals[1]), pa.array(totals[0]), digests],
                names=[c.split(" ")[0] for c in _RESULT.split(", ")],
            )


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Slices of ``docs(doc_id, text)`` with both tokenizations aligned, stored in the shared folder.

    A slice lists for each of its texts the numbers of tokens, groups and links and the digest of its groups, and its distinct linked
    id pairs (``a``, ``b``) with their number of links ``n``; ``ends``, ``pairs`` and ``many`` hold the pairs of each text.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return staged(narrow.mapInArrow(_aligned(first, second, slice_bytes), _SLICES), "alignment")


def pair_counts(slices: DataFrame) -> DataFrame:
    """``(a, b, count, best)``: links of each id pair over all slices; best where no pair of the same b has more.

    One row per linked pair of ids, however many texts there are; the maximum has one row per id of the second vocabulary.
    """
    linked = slices.select(F.inline(F.arrays_zip("a", "b", "n")))
    counts = staged(linked.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def aligned_counts(docs: DataFrame, first: str = FIRST, second: str = SECOND, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side a encodes a blank and the text with ``first`` (byte-level, tokenizers library), side b the text with ``second`` (sentencepiece, which
    adds the blank); strings of special tokens are plain text. Groups are the stretches between byte offsets where tokens of both
    sides end; links are the overlapping tokens; a pair's count is its number of links in all texts. ``n_best`` counts the links
    whose pair has the highest count of its b id, ties included. A text that is null or empty, or that either side does not
    reproduce byte for byte, has zeros and the digest ''. Rows may repeat or lack a doc_id; other columns are not read; an empty table
    gives an empty result.
    """
    slices = align(docs, first, second, slice_bytes)
    places = slices.select("slice", F.posexplode(F.arrays_zip("a", "b")).alias("place", "pair"))
    wanted = places.select("slice", "place", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"))
    found = wanted.join(pair_counts(slices), ["a", "b"])
    counts = found.groupBy("slice").agg(F.collect_list(F.struct("place", "count", "best")).alias("counts"))
    none = F.array().cast("array<struct<place:int,count:long,best:long>>")
    joined = slices.drop("a", "b", "n").join(counts, "slice", "left").withColumn("counts", F.coalesce("counts", none))
    return joined.mapInArrow(_scored, _RESULT)
