"""Substring dedup: repeated paragraphs by MinHash banding.

Three kinds of passages are compared across all documents:

* paragraphs (lines), by min-hashes of their five-word shingles (64-bit hashes stand for these). ``BANDS`` bands of ``ROWS`` hashes are tuned so that a
  pair at the least similarity shares a band with 0.997 probability; pairs that share one are verified by their exact
  Jaccard similarity;
* sentences, because a passage that was put into other text shares no paragraph, but its sentences. These are too
  short for a shingle to differ and still reach the similarity, so equal words are what is asked;
* spans (``spans``): words in a row, wherever they begin and end, that an earlier document has too.

Equal passages are one row from the start, however many copies there are. Links between different paragraphs are
found in rounds: first each paragraph of a band is verified against one leader, and components are formed; then pairs of a
band whose sides are in different components. Pairs inside a component need no check, and sketches of the sets rule out
most others within the join, so no link that would join two components is lost and the pairs that leave the join are
about as many as the links. Every member of a component but the earliest goes; a sentence inside a paragraph that goes
is never the one that stays, so that no text loses its last copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import ROW, discard, staged, with_row_keys
from quarterdeck.llm.components import components
from quarterdeck.llm.spans import BITMAP_BITS, BLANK, _bitmap, has, laid_out, repeated_spans, row_checks, row_hashes, slices, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
MIN_WORDS = 10  # shorter paragraphs and sentences are no passages
BANDS, ROWS = 8, 3
PARAGRAPH, SENTENCE = 0, 1
SKETCH_BITS = 256
_SKETCH = [f"sketch{k}" for k in range(SKETCH_BITS // 64)]
_PRIME_BITS = np.uint64(0x9E3779B97F4A7C15)
_SENTENCE_END = np.isin(np.arange(256), list(b".!?"))
_BAND_NAMES = [f"band{k}" for k in range(BANDS)]
_KEY = ["code", "check"]  # hashes of the words, 128 bits
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("level", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("line_start", pa.int32()), ("code", pa.int64()), ("check", pa.int64())]
    + [(n, pa.int64()) for n in _BAND_NAMES]
)
_PASSAGE = "doc_id long, level int, start int, stop int, line_start int, " + ", ".join(f"{n} long" for n in _KEY + _BAND_NAMES)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    draw = rng.integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64)
    return draw[0] | np.uint64(1), draw[1]


_ODD, _SHIFT = _permutations()


class _Units:
    """The paragraphs and sentences that have enough words, of texts laid end to end with a line end after each.

    Words are stretches between blanks. A sentence ends with the blanks behind a full stop, exclamation or question mark, and a
    paragraph that is one sentence is given once, as a paragraph. ``level``, ``text``, ``start``, ``stop`` and ``line_start`` (code
    points in the text) are arrays with a member for each unit, paragraphs first; its words are those from ``at`` to ``behind``.
    """

    def __init__(self, texts: pa.Array):
        self.raw, offsets = raw, _ = laid_out(texts)
        edges = np.flatnonzero(np.diff(BLANK[raw].view(np.int8), prepend=1))
        self.starts, self.ends = edges[::2], edges[1::2]
        line_ends = np.flatnonzero(raw == 10)
        lines = np.append(0, line_ends[:-1] + 1)
        long = np.searchsorted(self.starts, line_ends) - np.searchsorted(self.starts, lines) >= MIN_WORDS
        gap = np.flatnonzero(np.diff(((raw == 32) | (raw == 9)).view(np.int8), prepend=0))
        # Before the first byte lies the last one, a line end.
        cuts = gap[1::2][_SENTENCE_END[raw[gap[::2] - 1]]]
        of = np.searchsorted(line_ends, cuts)
        of, cuts = of[long[of]], cuts[long[of]]
        several = np.unique(of)
        low, high = np.sort(np.append(lines[several], cuts)), np.sort(np.append(cuts, line_ends[several]))
        around = np.sort(np.append(several, of))
        enough = np.searchsorted(self.starts, high) - np.searchsorted(self.starts, low) >= MIN_WORDS
        n, m = int(long.sum()), int(enough.sum())
        first, last = np.append(lines[long], low[enough]), np.append(line_ends[long], high[enough])
        line = np.append(lines[long], lines[around[enough]])
        self.paragraphs, self.level = n, np.repeat(np.array([PARAGRAPH, SENTENCE], dtype=np.int32), [n, m])
        self.at, self.behind = np.searchsorted(self.starts, first), np.searchsorted(self.starts, last)
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        self.text = np.searchsorted(offsets, first, side="right") - 1
        base = chars[offsets[self.text]]
        self.start, self.stop, self.line_start = chars[first] - base, chars[last] - base, chars[line] - base
        self.words = word_hashes(raw, self.starts, self.ends)

    def codes(self) -> np.ndarray:
        return row_hashes(self.words, self.at, self.behind)

    def checks(self) -> np.ndarray:
        return row_checks(self.raw, self.starts, self.ends, self.at, self.behind)

    def shingles(self, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles of the paragraphs, or of those chosen, and each one's number of them."""
        at, behind = (a[: self.paragraphs] if chosen is None else a[chosen] for a in (self.at, self.behind))
        return _shingle_hashes(self.words, at, behind)


def passages(text: str) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """``(level, start, stop, words)`` of the paragraphs and sentences that have enough words, as ``_Units`` finds them.

    Places are code points.
    """
    own = _Units(pa.array([text]))
    for k in np.lexsort((own.level, own.start)).tolist():
        words = [own.raw[a:b].tobytes() for a, b in zip(own.starts[own.at[k] : own.behind[k]], own.ends[own.at[k] : own.behind[k]])]
        yield int(own.level[k]), int(own.start[k]), int(own.stop[k]), words


def _shingle_hashes(words: np.ndarray, at: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all paragraphs, from one hash of each word, and each paragraph's number of them."""
    hashes = np.zeros(max(len(words) - SHINGLE_WORDS + 1, 0), dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        hashes = hashes * _PRIME_BITS + words[k : k + len(hashes)]
    hashes = (hashes ^ hashes >> np.uint64(32)) * _PRIME_BITS
    sizes = behind - at - SHINGLE_WORDS + 1
    places = np.arange(sizes.sum()) + np.repeat(at - (np.cumsum(sizes) - sizes), sizes)
    return hashes[places], sizes


def _listed(paragraphs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """``_shingle_hashes`` of paragraphs given as words."""
    raw = np.frombuffer(b"".join(word + b"\n" for own in paragraphs for word in own), dtype=np.uint8)
    ends = np.flatnonzero(raw == 10)
    behind = np.cumsum([len(own) for own in paragraphs])
    return _shingle_hashes(word_hashes(raw, np.append(0, ends[:-1] + 1), ends), np.append(0, behind[:-1]), behind)


def band_hashes(paragraphs: list[list[bytes]]) -> np.ndarray:
    """(paragraphs, BANDS): the hash of each band's min-hashes."""
    return _bands(*_listed(paragraphs)) if paragraphs else np.zeros((0, BANDS), dtype=np.int64)


def _bands(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    starts = np.cumsum(sizes) - sizes
    bands = np.zeros((BANDS, len(sizes)), dtype=np.uint64)
    if not len(sizes):
        return bands.T.view(np.int64)
    mixed, high = np.empty_like(flat), np.empty_like(flat)
    for k in range(BANDS * ROWS):
        np.multiply(flat, _ODD[k], out=mixed)
        mixed += _SHIFT[k]
        np.right_shift(mixed, np.uint64(32), out=high)
        mixed ^= high
        least = np.minimum.reduceat(mixed, starts)
        band = bands[k // ROWS]
        band[:] = (band ^ least) * _PRIME_BITS + np.uint64(k + 1)
    return bands.view(np.int64).T


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            own = _Units(part.column(1))
            if not own.paragraphs:
                continue
            doc_id = part.column(0).to_numpy()[own.text]
            columns = [doc_id, own.level, own.start, own.stop, own.line_start, own.codes(), own.checks()]
            arrays = [pa.array(c, t) for c, t in zip(columns, _SCHEMA.types)]
            bands, sentences = _bands(*own.shingles()), pa.nulls(len(doc_id) - own.paragraphs, pa.int64())
            arrays += [pa.concat_arrays([pa.array(bands[:, k]), sentences]) for k in range(BANDS)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")


def _spots(column: str) -> Column:
    """The bit of a bitmap that stands for a hash."""
    return F.col(column).bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long")).alias("spot")


def sketches(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of each paragraph's shingles, each once and in order, how many these are, and their parity bits.

    Each hash flips one of ``SKETCH_BITS`` bits, so two sketches differ in no more bits than the sets do in members.
    """
    of = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((flat, of))
    flat = flat[order]
    once = np.append(True, (flat[1:] != flat[:-1]) | (of[1:] != of[:-1]))
    flat, of = flat[once], of[once]
    spots = of * SKETCH_BITS + (flat % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(spots, minlength=len(sizes) * SKETCH_BITS).astype(np.uint8) & 1
    parity = np.packbits(odd.reshape(len(sizes), SKETCH_BITS), axis=1, bitorder="little").view(np.int64)
    return flat.view(np.int64), np.bincount(of, minlength=len(sizes)), parity


def sketch(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``sketches`` of one paragraph."""
    hashes, _, parity = sketches(*_listed([words]))
    return hashes, parity[0]


def _sketched(bitmap: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batches:
            for part in slices(batch, 0):
                own = _Units(part.column(0))
                codes = own.codes()[: own.paragraphs]
                chosen = np.flatnonzero(has(bits, codes & (BITMAP_BITS - 1)))
                if not len(chosen):
                    continue
                hashes, n, parity = sketches(*own.shingles(chosen))
                offsets = pa.array(np.append(0, np.cumsum(n)), pa.int32())
                columns = [pa.array(codes[chosen]), pa.ListArray.from_arrays(offsets, pa.array(hashes)), pa.array(n, pa.int32())]
                columns += [pa.array(parity[:, k]) for k in range(len(_SKETCH))]
                yield pa.RecordBatch.from_arrays(columns, names=["code", "shingles", "n", *_SKETCH])

    return run


def paragraph_sets(docs: DataFrame, codes: DataFrame) -> DataFrame:
    """``(code, shingles, n, sketch0, ...)`` of the paragraphs in ``codes(code)``, one row each.

    A bitmap of fixed size first keeps most other paragraphs from being hashed and shuffled; the join decides.
    """
    bitmap = _bitmap(codes.select(_spots("code")))
    schema = "code long, shingles array<long>, n int, " + ", ".join(f"{c} long" for c in _SKETCH)
    found = _narrow(docs).select("text").mapInArrow(_sketched(bitmap), schema)
    return found.dropDuplicates(["code"]).join(codes, "code", "left_semi")


def _sides(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(sketches.select(*[F.col(c).alias(f"{side}_{c}") for c in sketches.columns]) for side in "ab")


def _may_link(similarity: float) -> Column:
    """Whether two sketches leave the similarity possible: sets of it differ in a bounded share of their members."""
    differ = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in _SKETCH), F.lit(0))
    return differ <= (1 - similarity) / (1 + similarity) * (F.col("a_n") + F.col("b_n")) + 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets of shingles are similar enough."""
    left, right = sets.select(F.col("code").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("code").alias("b"), F.col("shingles").alias("y"))
    both = pairs.distinct().join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.where(F.col("common") / (F.size("x") + F.size("y") - F.col("common")) >= similarity).select("a", "b")


def _shared(bitmap: bytes):
    """The bands of paragraphs whose hash the bitmap names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batches:
            codes = batch.column(0).to_numpy()
            for k in range(BANDS):
                hashes = batch.column(1 + k).to_numpy()
                may = has(bits, hashes & (BITMAP_BITS - 1))
                if may.any():
                    columns = [pa.array(codes[may]), pa.array(np.full(int(may.sum()), k, dtype=np.int32)), pa.array(hashes[may])]
                    yield pa.RecordBatch.from_arrays(columns, names=["code", "band", "hash"])

    return run


def linked_paragraphs(docs: DataFrame, banded: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(node, root)``: components of the paragraphs ``banded(code, band0, ...)`` that are similar enough; rows may repeat.

    Only hashes that several paragraphs have travel with their paragraphs: a bitmap of fixed size keeps most others back, the
    join decides. Each hash names its band, as the band's number went into it.
    """
    hashes = banded.select("code", F.explode(F.array(*_BAND_NAMES)).alias("hash"))
    shared = hashes.groupBy("hash").agg(F.min("code").alias("leader"), F.max("code").alias("last")).where("leader <> last")
    shared = staged(shared.select("hash", "leader"), "shared-bands")
    may = banded.select("code", *_BAND_NAMES).mapInArrow(_shared(_bitmap(shared.select(_spots("hash")))), "code long, band int, hash long")
    members = staged(may.distinct().join(shared, "hash"), "band-members")
    discard(shared)
    sets = staged(paragraph_sets(docs, members.select("code").distinct()), "band-sets")
    a, b = _sides(sets.select("code", "n", *_SKETCH))

    led = members.where("code <> leader").select(F.col("leader").alias("a_code"), F.col("code").alias("b_code")).distinct()
    led = led.join(a, "a_code").join(b, "b_code").where(_may_link(similarity)).select(F.col("a_code").alias("a"), F.col("b_code").alias("b"))
    links = staged(_verified(led, sets, similarity), "led-links")
    roots = components(links).withColumnRenamed("node", "code")
    rooted = members.join(roots, "code", "left").withColumn("root", F.coalesce("root", "code"))
    # What is left: pairs of a band in different components, so only bands with several.
    split = rooted.groupBy("band", "hash").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    mixed = rooted.join(split.select("band", "hash"), ["band", "hash"]).join(sets.select("code", "n", *_SKETCH), "code")
    # The bands that a paragraph shares with others; two have none else in common.
    bands = members.groupBy("code").agg(*[F.max(F.when(F.col("band") == k, F.col("hash"))).alias(n) for k, n in enumerate(_BAND_NAMES)])
    mixed = mixed.join(bands, "code")
    mixed = staged(mixed.select("code", "root", "band", "hash", "leader", "n", *_SKETCH, *_BAND_NAMES), "mixed-bands")
    a, b = _sides(mixed)
    same = (F.col("a_band") == F.col("b_band")) & (F.col("a_hash") == F.col("b_hash"))
    new = (F.col("a_code") < F.col("b_code")) & (F.col("a_root") != F.col("b_root")) & (F.col("a_code") != F.col("a_leader"))
    # A pair comes out of the first band that it shares, not of each.
    first = F.coalesce(*[F.when(F.col(f"a_{n}") == F.col(f"b_{n}"), F.lit(k)) for k, n in enumerate(_BAND_NAMES)])
    across = a.join(b, same & new & (first == F.col("a_band")) & _may_link(similarity)).select(F.col("a_code").alias("a"), F.col("b_code").alias("b"))
    more = staged(_verified(across, sets, similarity), "more-links")
    discard(members, sets, mixed, links)
    # Components are stars by now; only what the new links join has to move.
    found = components(roots.select(F.col("code").alias("a"), F.col("root").alias("b")).unionByName(more))
    discard(roots, more)
    return found


def _place(doc_id: Column, start: Column) -> Column:
    """(doc_id, start) as one number, so that aggregation stays hashed."""
    return (doc_id.cast("decimal(20,0)") * F.lit(2**31).cast("decimal(11,0)") + start.cast("decimal(11,0)")).cast("decimal(38,0)")


def repeated_passages(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per passage of ``docs(doc_id, text)`` that is repeated: doc_id, level, start, stop, component_id, kept.

    ``level`` is paragraph or sentence, start and stop are places in code points, and component_id is
    ``doc_id:start`` of the earliest passage of the component, the one that is kept. Passages that occur once give no row.

    Null and empty texts have no passages; neither have rows without doc_id, which could not be named. Rows that
    repeat a doc_id share their places: the same passage in both is kept in both. Whole texts take part, whatever
    their length; other columns are not read; an empty table gives an empty result.
    """
    return _repeated_units(docs, similarity).drop("near")


def repeated_text(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``repeated_passages``, and those of level span, with the same columns.

    Spans are given where words go that lie in no paragraph or sentence that goes; the span that is kept may be longer than
    another of its component, and parts of it may go for a still earlier document. Only another document's words, with
    a smaller doc_id, make a span go.
    """
    units = staged(_repeated_units(docs, similarity), "repeated-units")
    spans = repeated_spans(_narrow(docs), units.where("not kept").select("doc_id", "start", "stop", "near"))
    name = _component(F.col("keep_doc"), F.col("keep_start")).alias("component_id")
    later = spans.select("doc_id", F.lit("span").alias("level"), "start", "stop", name, F.lit(False).alias("kept"))
    earliest = spans.groupBy("keep_doc", "keep_start").agg(F.max("keep_stop").alias("stop"))
    earliest = earliest.select(F.col("keep_doc").alias("doc_id"), F.lit("span").alias("level"), F.col("keep_start").alias("start"), "stop", name, F.lit(True).alias("kept"))
    return units.drop("near").unionByName(later).unionByName(earliest)


def _repeated_units(docs: DataFrame, similarity: float) -> DataFrame:
    """``repeated_passages``, and whether a passage may be unlike the one that is kept (``near``)."""
    found = staged(_narrow(docs).mapInArrow(_find, _PASSAGE), "passages")
    place = _place(F.col("doc_id"), F.col("start"))
    keys = found.groupBy(*_KEY).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.min("level").alias("level"))
    keys = staged(keys.where((F.col("n") > 1) | (F.col("level") == PARAGRAPH)), "passage-keys")
    banded = found.where(F.col("level") == PARAGRAPH).select("code", *_BAND_NAMES)
    roots = staged(linked_paragraphs(docs, banded, similarity), "paragraph-roots")

    everyone = roots.select(F.col("node").alias("code"), "root").unionByName(roots.select(F.col("root").alias("code"), "root").distinct())
    linked = keys.where(F.col("level") == PARAGRAPH).join(everyone, "code").select(*_KEY, "level", "first", F.col("root").alias("group"))
    equal = keys.where("n > 1").select(*_KEY, "level", "first", F.col("code").alias("group"))
    # A key that is linked goes by its root, others by their own code.
    groups = linked.unionByName(equal.join(linked.select(*_KEY), _KEY, "left_anti")).withColumnRenamed("level", "group_level")
    rows = found.select("doc_id", "level", "start", "stop", "line_start", *_KEY).join(groups, _KEY).drop(*_KEY)
    rows = rows.withColumns({"place": place, "line": _place(F.col("doc_id"), F.col("line_start"))}).drop("line_start")
    rows = staged(rows, "repeated-passages")
    discard(found, keys, roots)
    decided, keepers = _keepers(rows)
    keep = staged(keepers, "kept-passages")
    discard(decided)

    base = F.lit(2**31).cast("decimal(11,0)")
    doc = F.floor(F.col("keep") / base).cast("decimal(20,0)")
    return rows.join(keep, "group").select(
        "doc_id",
        F.when(F.col("level") == PARAGRAPH, "paragraph").otherwise("sentence").alias("level"),
        "start",
        "stop",
        _component(doc.cast("long"), F.col("keep") - doc * base).alias("component_id"),
        (F.col("stays") & (F.col("place") == F.col("keep"))).alias("kept"),
        (F.col("first") != F.col("keep")).alias("near"),
    )


def _component(doc_id: Column, start: Column) -> Column:
    return F.concat_ws(":", doc_id.cast("string"), start.cast("int").cast("string"))


def _keepers(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A staged table to discard, and ``(group, keep, stays)``: the earliest place of each group that lies in no paragraph that goes.

    Groups with paragraphs come first. A sentence may stand for such a group only if the paragraph around it is sure to
    stay, as the earliest place of its own group. Groups of sentences alone then choose among what is left; if all
    their places lie in paragraphs that go, ``stays`` is false, and ``keep`` is the earliest place.
    """
    mixed = rows.where(F.col("group_level") == PARAGRAPH)

    def gone(keep: DataFrame) -> DataFrame:
        lines = rows.where(F.col("level") == PARAGRAPH).join(keep.select("group", "keep"), "group")
        return lines.where("place <> keep").select("line", F.lit(True).alias("gone")).distinct()

    def best(own: DataFrame, keep: DataFrame) -> DataFrame:
        safe = (F.col("level") == PARAGRAPH) | F.col("gone").isNull()
        valid = own.join(gone(keep), "line", "left").groupBy("group").agg(F.min(F.when(safe, F.col("place"))).alias("valid"), F.min("place").alias("lowest"))
        return valid.select("group", F.coalesce("valid", "lowest").alias("keep"), F.col("valid").isNotNull().alias("stays"))

    lowest = mixed.groupBy("group").agg(F.min("place").alias("keep"))
    decided = staged(best(mixed, lowest), "kept-paragraphs")
    return decided, decided.unionByName(best(rows.where(F.col("group_level") == SENTENCE), decided))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
            left, at = [], 0
            for span in sorted((g["start"], g["stop"]) for g in gone or []):
                left.append(text[at : max(at, span[0])])
                at = max(at, span[1])
            texts.append(None if text is None else "".join([*left, text[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the passages that aren't kept; n_chars, if there, follows the new text.

    Documents stay, in the worst case with an empty text, and untouched ones stay as they are. Rows that share or lack a doc_id are told
    apart (``with_row_keys``), so each loses its own passages only; an empty table gives an empty one.
    """
    keyed = with_row_keys(docs)
    found = repeated_text(keyed.select(F.col(ROW).alias("doc_id"), "text")).where("not kept")
    gone = found.groupBy(F.col("doc_id").alias(ROW)).agg(F.collect_set(F.struct("start", "stop")).alias("__gone"))
    joined = keyed.join(gone, ROW, "left")
    rest = [c for c in docs.columns if c != "text"]
    packed = joined.select(F.struct(*rest).alias("row"), F.col("text").cast("string").alias("text"), F.col("__gone").alias("gone"))
    kept = packed.select("row", "text", "gone").mapInArrow(_without, f"row {packed.schema['row'].dataType.simpleString()}, text string")
    out = kept.select("row.*", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
