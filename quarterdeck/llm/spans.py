"""Words of texts that stand in an earlier document as well, whatever the punctuation around them.

Two texts share ``SPAN_WORDS`` words in a row if a window of so many words is equal. To hash every window of the corpus
would cost a row per word, so windows are narrowed first: each names the smallest hash among the runs of ``PRINT_WORDS``
words inside it (winnowing), which depends on its words alone. Equal windows name the same one, hence a window whose
smallest hash is in no other document has no copy. In scripts without blanks each character counts as a word.

Windows in a row that name the same print are one stretch, one row in place of some seventeen. Stretches of equal words are
grouped first: all but the earliest of a group are spans as they stand. Of the others, which begin or end where
texts part, only those whose print an open stretch of another document names are taken apart into windows, and these are grouped by
print and hash. The earliest place of a window is never in a stretch that an earlier document has whole, so none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.common import discard, staged

SPAN_WORDS = 50  # words in a row that two documents must share
PRINT_WORDS = 18
BITMAP_BITS = 1 << 26  # eight megabytes that tell tasks which windows may have a copy
_BITMAP_PARTS = 8
_PART_BITS = BITMAP_BITS // _BITMAP_PARTS
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_PLACE_TYPES = [("doc_id", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("near", pa.bool_())]
_PLACE = "doc_id long, at int, n int, start int, stop int, near boolean"
_STRETCH = f"{_PLACE}, print long, hash long, check long, hashes array<long>, starts array<int>, stops array<int>"
_STRETCH_TYPES = _PLACE_TYPES + [("print", pa.int64()), ("hash", pa.int64()), ("check", pa.int64())]
_WINDOW = f"{_PLACE}, print long, hash long"
_STRETCH_WINDOWS = 4096  # a longer stretch, of a text that repeats itself, is cut
_SLICE_BYTES = 1 << 17  # of text whose windows are told at once


@cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2^64."""
    out = []
    for factor in (base, pow(base, -1, 2**64)):
        powers = np.full(1 << bits, factor, dtype=np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return tuple(out)


def _rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of each stretch of values, which depends on the values in it alone."""
    power, inverse = _powers(base, max(_SLICE_BYTES.bit_length(), len(values).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[: len(values)])])
    mixed = (sums[ends] - sums[starts]) * inverse[starts]
    mixed = (mixed ^ mixed >> np.uint64(32)) * _PRIME
    return mixed ^ mixed >> np.uint64(29)


def _unspaced(raw: np.ndarray) -> np.ndarray:
    """Whether a character of a script without blanks begins: Thai, Lao, Burmese, Khmer, and from U+3000 on."""
    after = np.append(raw[1:], np.uint8(0))
    south = (raw == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
    east = (raw == 0xE1) & ((after >= 0x80) & (after <= 0x82) | (after == 0x9E) | (after == 0x9F))
    return south | east | (raw >= 0xE3)


def words_at(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of words, and the bytes behind them."""
    blank = BLANK[raw]
    first = ~blank
    first[1:] &= blank[:-1]
    alone = np.flatnonzero(_unspaced(raw)) if len(raw) and raw.max() >= 0xE0 else ()
    if len(alone):
        first[alone] = True
        behind = alone + 3 + (raw[alone] >= 0xF0)
        behind = behind[behind < len(raw)]
        first[behind[~blank[behind]]] = True
    edges = np.flatnonzero(first | blank)
    begins = first[edges]
    return edges[begins], np.append(edges[1:], len(raw))[: len(edges)][begins]


def _grams(words: np.ndarray, size: int, base: int) -> np.ndarray:
    at = np.arange(len(words) - size + 1)
    return _rolling(words, at, at + size, base)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row, from the smallest of half as many."""
    if width == 1:
        return values
    half = (width + 1) // 2
    least = _smallest(values, half)
    return np.minimum(least[: len(least) - (width - half)], least[width - half :])


def laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts laid end to end, with A-Z folded and a line end after each, and where each text begins."""
    empty, line_end = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
    # Folded before the cast: of a slice that was cast, Arrow's kernel folds the wrong bytes.
    lowered = pc.fill_null(pc.ascii_lower(texts).cast(pa.large_string()), empty)
    joined = pc.binary_join_element_wise(lowered, line_end, empty)
    offsets = np.frombuffer(joined.buffers()[1], dtype=np.int64)[: len(texts) + 1]
    return np.frombuffer(joined.buffers()[2], dtype=np.uint8)[: offsets[-1]], offsets


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _rolling(_BYTES[raw], starts, ends, _BASES[0])


def row_hashes(words: np.ndarray, at: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Hashes of words in a row, from the hashes of the words."""
    return _rolling(words, at, behind, _BASES[0]).view(np.int64)


def row_checks(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Further hashes of words in a row, from other hashes of the words themselves."""
    words = _rolling(_BYTES[::-1][raw], starts, ends, _BASES[1])
    return _rolling(words, at, behind, _BASES[1]).view(np.int64)


class _Texts:
    """Word hashes of texts laid end to end, and for each of their windows the smallest hash of a run of words.

    A line end follows each text, so no word reaches into the next one, and every hash depends on its own words alone.
    """

    def __init__(self, texts: pa.Array):
        self.raw, self.offsets = laid_out(texts)
        self.starts, self.ends = words_at(self.raw)
        self.firsts = np.searchsorted(self.starts, self.offsets)  # the number of each text's first word
        counts = np.maximum(np.diff(self.firsts) - SPAN_WORDS + 1, 0)
        #: Of each window, its text and its first word.
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.at = np.arange(len(self.text)) + np.repeat(self.firsts[:-1] - (np.cumsum(counts) - counts), counts)
        if len(self.at):
            self.words = word_hashes(self.raw, self.starts, self.ends)
            runs = _grams(self.words, PRINT_WORDS, _BASES[1])
            self.prints = _smallest(runs, SPAN_WORDS - PRINT_WORDS + 1).view(np.int64)[self.at]

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First code points of words and those behind them, over all texts, and of the texts."""
        chars = np.cumsum((self.raw & 0xC0) != 0x80)
        return chars[self.starts] - 1, chars[self.ends - 1], np.append(chars[self.offsets[:-1]] - 1, chars[-1])


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Rows with some text at a time, so that the arrays made of it stay small."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    parts = (sizes - 1) // _SLICE_BYTES
    firsts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
    for first, last in zip(firsts, [*firsts[1:], len(batch)]):
        yield batch.slice(first, last - first)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.zeros(0, np.int64)]
        for part in slices(batch, 0):
            own = _Texts(part.column(0))
            if len(own.at):
                new = np.append(True, (np.diff(own.prints) != 0) | (np.diff(own.text) != 0))
                prints, text = own.prints[new], own.text[new]
                order = np.lexsort((prints, text))
                prints, text = prints[order], text[order]
                found.append(prints[np.append(True, (np.diff(prints) != 0) | (np.diff(text) != 0))])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["print"])


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of the bitmap that the spots of a task fall in."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        spots = np.unique(batch.column(0).to_numpy())
        numbers, first = np.unique(spots // _PART_BITS, return_index=True)
        for number, own in zip(numbers.tolist(), np.split(spots % _PART_BITS, first[1:])):
            bits = parts.setdefault(number, np.zeros(_PART_BITS // 8, dtype=np.uint8))
            head = np.flatnonzero(np.diff(own >> 3, prepend=-1))
            bits[own[head] >> 3] |= np.bitwise_or.reduceat(np.uint8(1) << (own & 7).astype(np.uint8), head)
    for number, bits in parts.items():
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([bits.tobytes()], pa.binary())], names=["part", "bits"])


def _covered(places: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """How many of the first places lie in a span, for each number of them."""
    inside = np.zeros(len(places) + 1, dtype=np.int64)
    np.add.at(inside, np.searchsorted(places, starts), 1)
    np.add.at(inside, np.searchsorted(places, stops), -1)
    return np.concatenate([[0], np.cumsum(np.cumsum(inside)[:-1] > 0)])


def _spot(places: np.ndarray) -> np.ndarray:
    """A bit for each (doc_id, at), given as one number."""
    mixed = (places.astype(np.uint64) ^ places.astype(np.uint64) >> np.uint64(31)) * _PRIME
    return (mixed >> np.uint64(38)).astype(np.int64)


def has(bits: np.ndarray, spot: np.ndarray) -> np.ndarray:
    return bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1 > 0


def _place_number(doc_id: np.ndarray, at: np.ndarray) -> np.ndarray:
    return doc_id.astype(np.int64) * np.int64(0x2545F4914F6CDD1D) + at


def _stretches(bitmap: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batches:
            for part in slices(batch, 1):
                found = _slice_stretches(part, bits)
                if found is not None:
                    yield found

    return run


def _slice_stretches(part: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch | None:
    own = _Texts(part.column(1))
    if not len(own.at):
        return None
    may = has(bits, own.prints & (BITMAP_BITS - 1))
    if not may.any():
        return None
    starts, stops, bases = own.places()
    gone = part.column(2)
    spans, of = gone.flatten(), np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False))
    # Rows that share a doc_id share what goes, which can lie behind the end of the shorter text.
    low, high = (np.minimum(spans.field(k).to_numpy() + bases[of], bases[of + 1]) for k in range(2))
    going = _covered(starts, low, high)
    may &= going[own.at + SPAN_WORDS] - going[own.at] < SPAN_WORDS
    if not may.any():
        return None
    at, text, prints = own.at[may], own.text[may], own.prints[may]
    unlike = spans.field(2).to_numpy(zero_copy_only=False).astype(bool)
    near = _covered(starts, low[unlike], high[unlike])
    near = near[at + SPAN_WORDS] > near[at]
    local = at - own.firsts[text]
    parts = (np.diff(at) > 1) | (np.diff(prints) != 0) | (near[1:] != near[:-1]) | (local[1:] % _STRETCH_WINDOWS == 0)
    first = np.flatnonzero(np.append(True, parts))
    n = np.diff(first, append=len(at))
    head, base = at[first], bases[text[first]]
    behind = head + n + SPAN_WORDS - 1
    doc_id = part.column(0).to_numpy()[text[first]]
    places = [doc_id, local[first], n, starts[head] - base, stops[behind - 1] - base, near[first], prints[first]]
    whole = [*places, row_hashes(own.words, head, behind), row_checks(own.raw, own.starts, own.ends, head, behind)]
    each = [row_hashes(own.words, at, at + SPAN_WORDS), starts[at] - bases[text], stops[at + SPAN_WORDS - 1] - bases[text]]
    arrays = [pa.array(c, t) for c, (_, t) in zip(whole, _STRETCH_TYPES)]
    offsets = pa.array(np.append(0, np.cumsum(n)), pa.int32())
    for values, kind in zip(each, (pa.int64(), pa.int32(), pa.int32())):
        arrays.append(pa.ListArray.from_arrays(offsets, pa.array(values, kind)))
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _STRETCH.split(", ")])


def _apart(bitmap: bytes):
    """The windows of the stretches that the bitmap names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batches:
            places = _place_number(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            batch = batch.filter(pa.array(has(bits, _spot(places))))
            doc_id, at, n, near, prints = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            hashes, starts, stops = (batch.column(k).flatten() for k in range(5, 8))
            total = int(n.sum())
            step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            rows = [np.repeat(doc_id, n), np.repeat(at, n) + step, np.ones(total), starts, stops, np.repeat(near, n)]
            arrays = [pa.array(c, t) for c, (_, t) in zip(rows, _PLACE_TYPES)] + [pa.array(np.repeat(prints, n), pa.int64()), hashes]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _WINDOW.split(", ")])

    return run


def _place_spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = _place_number(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(_spot(places))], names=["spot"])


def _bitmap(spots: DataFrame) -> bytes:
    """A bit for each of ``spots(spot long)``. A task marks whole parts of it, so the driver gets each part about once."""
    parts = spots.repartition(_BITMAP_PARTS, F.floor(F.col("spot") / _PART_BITS)).mapInArrow(_mark, "part int, bits binary")
    bitmap = np.zeros(BITMAP_BITS // 8, dtype=np.uint8).reshape(_BITMAP_PARTS, -1)
    for row in parts.collect():
        bitmap[row.part] |= np.frombuffer(row.bits, dtype=np.uint8)
    return bitmap.tobytes()


def _with_keepers(places: DataFrame, *key: str, how: str) -> DataFrame:
    """``places`` of equal words with ``keep``, the earliest of their ``key`` that isn't near, where that is another document's."""
    keep = F.min(F.when(~F.col("near"), F.struct("doc_id", "at", "start", "stop"))).alias("keep")
    keys = places.groupBy(*key).agg(keep, F.max("doc_id").alias("last")).where("last > keep.doc_id").drop("last")
    return places.join(keys, list(key), how)


def _later(kept: DataFrame) -> DataFrame:
    later = kept.where("doc_id > keep.doc_id")
    return later.select("doc_id", "at", "n", "start", "stop", *[F.col(f"keep.{c}").alias(f"keep_{c}") for c in ("doc_id", "at", "start", "stop")])


def repeated_spans(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``(doc_id, start, stop, keep_doc, keep_start, keep_stop)``: spans of ``docs(doc_id, text)``, and the earlier ones that they equal.

    ``gone(doc_id, start, stop, near)`` is what goes already. Windows in it alone take no part; a window that touches what
    is ``near``, unlike what stays in its place, is no window that others equal. Every word of a window of
    ``SPAN_WORDS`` that also stands in a document with a smaller doc_id lies in a span.
    """
    shared = docs.select("text").mapInArrow(_prints, "print long").groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print")
    bitmap = _bitmap(shared.select(F.col("print").bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long")).alias("spot")))

    spans = gone.groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", "near")).alias("gone"))
    texts = docs.join(spans, "doc_id", "left").select("doc_id", "text", "gone")
    stretches = staged(texts.mapInArrow(_stretches(bitmap), _STRETCH), "span-stretches")
    whole = staged(_with_keepers(stretches.drop("hashes", "starts", "stops"), "hash", "check", how="left"), "whole-stretches")

    left = whole.where("keep IS NULL OR doc_id <= keep.doc_id")
    open_prints = left.groupBy("print").agg(F.min(F.when(~F.col("near"), F.col("doc_id"))).alias("low"), F.max("doc_id").alias("high")).where("low < high")
    places = left.join(open_prints.select("print"), "print").select("doc_id", "at")
    apart = _apart(_bitmap(places.mapInArrow(_place_spots, "spot long")))
    windows = stretches.select("doc_id", "at", "n", "near", "print", "hashes", "starts", "stops").mapInArrow(apart, _WINDOW)
    later = _later(whole).unionByName(_later(_with_keepers(windows, "print", "hash", how="inner")))

    order = Window.partitionBy("doc_id").orderBy("at", "start")
    goes_on = (F.lag(F.col("at") + F.col("n")).over(order) == F.col("at")) & (F.lag("keep_doc_id").over(order) == F.col("keep_doc_id"))
    goes_on &= F.lag(F.col("keep_at") + F.col("n")).over(order) == F.col("keep_at")
    runs = later.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    found = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("keep_doc_id").alias("keep_doc"), F.min("keep_start").alias("keep_start"), F.max("keep_stop").alias("keep_stop")
    ).drop("run")
    found = staged(found, "repeated-spans")
    discard(stretches, whole)
    return found
