"""Exact phrases and proximity matches from a distributed positional inverted index.

The training texts are indexed in shards of a few megabytes: a dictionary of the distinct words of a shard, and for each word the
ascending list of its positions. Test phrases come in blocks of bounded size, every block once against all shards. In a
shard, a phrase begins at its rarest word: the position list of that word, moved back by the word's place in the phrase,
gives the possible starts, and the lists of the other words, rarest first, are intersected with them at their own places.
A phrase with a word that the dictionary lacks costs one lookup. Words are compared as text, never by digest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import staged

WINDOW = 10  # words of a phrase
SHARD_BYTES = 2 << 20  # of text in a shard, or one longer text
BLOCK_WORDS = 1 << 18  # of test items handled at once
_FILE_SHARDS = 8  # in a file of the index; Spark reads up to all rows of a file at once
_STARTS = 1 << 18  # possible places of phrases held at once
_PART_WORDS = 1 << 14  # of one test item; longer items are cut into parts that overlap

_INDEX = "shard string, doc_ids array<long>, doc_words array<long>, terms array<binary>, ends binary, positions binary"
_MATCHES = "shard string, doc int, item_id string, start long, words int, exact boolean"


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of A-Z for each byte, and whether the byte belongs to a word: digits, letters, all beyond ASCII."""
    low = np.arange(256, dtype=np.uint8)
    low[0x41:0x5B] += 0x20
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x80:] = True
    return low, inside


_LOWER, _INSIDE = _byte_classes()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in order, as bytes, and the number of words in each text. Null has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    edges = offsets - offsets[0] if len(offsets) else offsets
    low = _LOWER[flat]
    inside = _INSIDE[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = edges[:-1][edges[:-1] < len(flat)]
    begins[cut] = inside[cut]  # a word ends with its text
    kept = low[inside]
    at = np.flatnonzero(begins)
    # A word's place in the kept bytes is the number of kept bytes before it.
    starts = np.cumsum(inside, dtype=np.int64)[at] - 1
    ends = np.append(starts, len(kept)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    counts = np.diff(np.searchsorted(at, edges)) if len(edges) else np.zeros(0, np.int64)
    return words, counts


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """First and last index of runs of texts of about ``size`` bytes."""
    full = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // size
    firsts = np.flatnonzero(np.diff(full, prepend=-1)).tolist()
    yield from zip(firsts, [*firsts[1:], len(texts)])


def _index(shard_bytes: int):
    def shard(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        words, counts = words_of(texts)
        coded = words.dictionary_encode()
        terms = coded.indices.to_numpy().astype(np.int64)
        # Postings: positions by word, ascending within a word.
        positions = np.argsort(terms, kind="stable").astype(np.uint32)
        ends = np.cumsum(np.bincount(terms, minlength=len(coded.dictionary))).astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(counts.astype(np.int64))),
                pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.binary())),
                pa.array([ends.tobytes()], pa.binary()),
                pa.array([positions.tobytes()], pa.binary()),
            ],
            names=["shard", "doc_ids", "doc_words", "terms", "ends", "positions"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for first, last in _slices(batch.column(1), shard_bytes):
                held.append(batch.slice(first, last - first))
                size += held[-1].column(1).nbytes
                if size >= shard_bytes:
                    joined = pa.Table.from_batches(held).combine_chunks()
                    yield shard(joined.column(0).combine_chunks(), joined.column(1).combine_chunks())
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            joined = pa.Table.from_batches(held).combine_chunks()
            yield shard(joined.column(0).combine_chunks(), joined.column(1).combine_chunks())

    return run


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard of ``docs(doc_id, text)``, stored in the shared folder.

    ``doc_ids`` and ``doc_words`` list the shard's rows and their word counts; ``terms`` are the distinct words, ``ends`` and
    ``positions`` (unsigned 32-bit, little-endian) their position lists one after the other. Positions count the words of the shard.
    A null text is a row without words; rows may repeat or lack a doc_id; other columns are not read; an empty table gives an empty index.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return staged(narrow.mapInArrow(_index(shard_bytes), _INDEX), "postings", file_rows=_FILE_SHARDS)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each item; items beyond ``_PART_WORDS`` in parts that share all but one word of a window."""
    for batch in batches:
        words, counts = words_of(batch.column(1))
        first = 0
        for item, n in zip(batch.column(0).to_pylist(), counts.tolist()):
            for at in range(0, max(n - WINDOW + 1, min(n, 1)), _PART_WORDS):
                part = words.slice(first + at, min(_PART_WORDS + WINDOW - 1, n - at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item], pa.string()), pa.array([len(part)], pa.int32()), pa.array([part.to_pylist()], pa.list_(pa.binary()))],
                    names=["item_id", "n", "words"],
                )
            first += n


def _blocks(items: DataFrame, block_words: int) -> DataFrame:
    """``(block int, item_ids, sizes, words)``: one row per block, from a running sum over narrow rows."""
    from pyspark.sql import Window

    narrow = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    parts = staged(narrow.mapInArrow(_parts, "item_id string, n int, words array<binary>").withColumn("part", F.expr("uuid()")), "phrases")
    # Blocks are dealt out by digest, so that no window runs over the whole table; a block holds block_words on average.
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = -(-total // block_words)
    dealt = parts.withColumn("block", F.pmod(F.xxhash64("part"), F.lit(max(blocks, 1))).cast("int"))
    grouped = dealt.groupBy("block").agg(F.collect_list(F.struct("item_id", "words")).alias("items"))
    return staged(grouped, "blocks", file_rows=1)


class Shard:
    """Position lists of one shard, and the phrases found in them."""

    def __init__(self, terms: pa.Array, ends: bytes, positions: bytes, doc_words: np.ndarray):
        self.terms = terms
        self.ends = np.frombuffer(ends, np.uint32).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.positions = np.frombuffer(positions, np.uint32).astype(np.int64)
        self.doc_ends = np.cumsum(doc_words)
        # Word and position as one ascending number: a search in it is a search in the word's own list.
        self.total = len(self.positions) + 1
        self.keys = np.repeat(np.arange(len(self.ends)), self.ends - self.starts) * self.total + self.positions

    def find(self, words: np.ndarray, first: np.ndarray, size: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Occurrences of the phrases ``words[first : first + size]``: phrase, start, and whether exact, in slices.

        ``words`` are numbers of the dictionary, -1 for a word it lacks. A slice holds phrases whole, and as many as have about
        ``_STARTS`` possible starts, so that phrases of frequent words take no more room than others.
        """
        lengths = np.append((self.ends - self.starts), 0)[words]  # the last entry answers for -1
        width = int(size.max(initial=0))
        steps = np.arange(width)
        for at in range(0, len(first), 1 << 14):
            f, n = first[at : at + (1 << 14)], size[at : at + (1 << 14)]
            grid = np.where(steps < n[:, None], f[:, None] + steps, f[:, None])
            counts = lengths[grid]
            held = np.flatnonzero(counts.min(axis=1) > 0)
            if not len(held):
                continue
            grid, counts, n = grid[held], counts[held], n[held]
            # Places of a phrase from its rarest word to its most frequent; places beyond a short phrase come last.
            order = np.argsort(np.where(steps < n[:, None], counts, self.total), axis=1, kind="stable")
            starts = np.cumsum(counts[np.arange(len(held)), order[:, 0]] * (2 * slop + 1))
            cuts = np.flatnonzero(np.diff(starts // _STARTS, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(held)]):
                yield self._places(words, grid[a:b], counts[a:b], order[a:b], n[a:b], slop, at + held[a:b])

    def _places(self, words, grid, counts, order, n, slop, names) -> tuple[np.ndarray, ...]:
        phrase, starts = self._begin(words, grid, counts, order, slop)
        parts = range(0, max(len(phrase), 1), _STARTS)
        found = [self._intersect(words, grid, order, n, phrase[s : s + _STARTS], starts[s : s + _STARTS], slop, names) for s in parts]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _begin(self, words, grid, counts, order, slop) -> tuple[np.ndarray, np.ndarray]:
        """Possible starts from the list of each phrase's rarest word."""
        rows = np.arange(len(grid))
        place = order[:, 0]
        term, many = words[grid[rows, place]], counts[rows, place]
        phrase = np.repeat(rows, many)
        inside = np.arange(len(phrase)) - np.repeat(np.cumsum(many) - many, many)
        found = self.positions[self.starts[term][phrase] + inside] - place[phrase]
        if not slop:
            return phrase, found
        spread = np.arange(-slop, slop + 1)
        return np.repeat(phrase, len(spread)), (found[:, None] + spread).ravel()

    def _intersect(self, words, grid, order, n, phrase, begin, slop, names) -> tuple[np.ndarray, ...]:
        inside = (begin >= 0) & (begin + n[phrase] < self.total)
        phrase, begin = phrase[inside], begin[inside]
        doc = np.searchsorted(self.doc_ends, begin, side="right")
        low = np.append(0, self.doc_ends)[doc]
        inside = begin + n[phrase] <= self.doc_ends[doc]
        phrase, begin, low, high = phrase[inside], begin[inside], low[inside], self.doc_ends[doc][inside]
        exact = np.ones(len(phrase), bool)
        for k in range(order.shape[1]):
            place = order[phrase, k]
            due = k < n[phrase]
            term = words[grid[phrase, place]] * self.total
            goal = begin + place
            near = np.searchsorted(self.keys, term + np.maximum(goal - slop, low))
            hit = self.keys[np.minimum(near, len(self.keys) - 1)]
            ok = (hit >= term) & (hit <= term + np.minimum(goal + slop, high - 1)) & (near < len(self.keys)) | ~due
            if slop:
                own = np.searchsorted(self.keys, term + goal)
                exact &= (self.keys[np.minimum(own, len(self.keys) - 1)] == term + goal) | ~due
            phrase, begin, low, high, exact = phrase[ok], begin[ok], low[ok], high[ok], exact[ok]
        return names[phrase], begin, exact


def _search(slop: int, spans: bool):
    def block(column) -> tuple:
        """Items of a block as flat words with the phrases in them."""
        items = column.as_py()
        parts = [i["words"] for i in items]
        words = pa.array([w for p in parts for w in p], pa.large_binary())
        lengths = np.array([len(p) for p in parts], np.int64)
        at = np.cumsum(lengths) - lengths
        phrases = np.maximum(lengths - WINDOW + 1, 1)
        item = np.repeat(np.arange(len(parts)), phrases)
        first = at[item] + np.arange(len(item)) - np.repeat(np.cumsum(phrases) - phrases, phrases)
        coded = words.dictionary_encode()
        return [i["item_id"] for i in items], coded.dictionary, coded.indices.to_numpy(), item, first, np.minimum(lengths, WINDOW)[item]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            names, counts, terms, ends, positions, numbers, items = (batch.column(k) for k in range(7))
            for r in range(len(batch)):
                number = numbers[r].as_py()
                if number not in known:
                    known = {number: block(items[r])}
                item_ids, distinct, coded, item, first, size = known[number]
                own = terms[r].values
                doc_words = counts[r].values.to_numpy()
                shard = Shard(own, ends[r].as_py(), positions[r].as_py(), doc_words)
                place = pc.fill_null(pc.index_in(distinct, value_set=own.cast(pa.large_binary())), -1).to_numpy().astype(np.int64)
                for phrase, start, exact in shard.find(place[coded], first, size, slop):
                    if slop:  # a start may come from several occurrences of the rarest word
                        phrase, start, exact = np.unique(np.stack([phrase, start, exact]), axis=1)
                        exact = exact.astype(bool)
                    doc = np.searchsorted(shard.doc_ends, start, side="right")
                    begin = start - np.append(0, shard.doc_ends)[doc]
                    which, words = item[phrase], size[phrase]
                    if spans:
                        doc, which, begin, words = _merged(doc, which, begin, words)
                        exact = np.ones(len(doc), bool)
                    for s in range(0, len(doc), 1 << 16):
                        e = s + (1 << 16)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([names[r].as_py()] * len(doc[s:e]), pa.string()),
                                pa.array(doc[s:e].astype(np.int32)),
                                pa.array([item_ids[i] for i in which[s:e].tolist()], pa.string()),
                                pa.array(begin[s:e]),
                                pa.array(words[s:e].astype(np.int32)),
                                pa.array(exact[s:e]),
                            ],
                            names=["shard", "doc", "item_id", "start", "words", "exact"],
                        )

    return run


def _merged(doc, item, begin, words) -> tuple[np.ndarray, ...]:
    """Stretches of words that an item's phrases cover in a document, in place of one row per phrase."""
    order = np.lexsort((begin, item, doc))
    doc, item, begin, end = doc[order], item[order], begin[order], (begin + words)[order]
    if not len(doc):
        return doc, item, begin, end
    group = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(item) != 0)))
    number = np.cumsum(np.bincount(group, minlength=len(doc)))
    # All phrases of an item but its last are equally wide, so ends ascend with starts within a group.
    new = np.append(True, (np.diff(number) != 0) | (begin[1:] > end[:-1]))
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], item[at], begin[at], end[last] - begin[at]


def _matches(index: DataFrame, items: DataFrame, slop: int, block_words: int, spans: bool) -> DataFrame:
    blocks = _blocks(items, block_words)
    found = []
    for number in sorted(r.block for r in blocks.select("block").collect()):
        # One block holds about block_words words whatever the size of the tables, so its broadcast is bounded.
        block = F.broadcast(blocks.where(F.col("block") == number))
        both = index.withColumn("block", F.lit(number)).join(block, "block")
        rows = both.select("shard", "doc_words", "terms", "ends", "positions", "block", "items")
        # One shard at a time goes to Python, with the block, whatever the number of shards in a task.
        found.append(staged(rows.mapInArrow(_search(slop, spans), _MATCHES), "matches", batch_rows=1))
    if not found:
        return index.sparkSession.createDataFrame([], _MATCHES)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _ids(index: DataFrame) -> DataFrame:
    """``(shard, doc, doc_id, n_words)`` of every row of the indexed table."""
    rows = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("doc", "row"))
    return rows.select("shard", "doc", F.col("row.doc_ids").alias("doc_id"), F.col("row.doc_words").alias("n_words"))


def phrase_matches(index: DataFrame, items: DataFrame, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every place where a phrase of ``items(item_id, text)`` stands in an indexed text.

    Returns doc_id, item_id string, start (words before the phrase in its text), words (of the phrase) and exact. A phrase is
    ``WINDOW`` words of an item in a row; an item of fewer words, but not none, is one phrase. With ``slop`` 0 the words stand in
    their order without a gap. With more, each word stands at most ``slop`` words from its place (the same word may serve two places),
    inside the text, and ``exact`` tells whether all stand in place. An item that holds a phrase twice reports it twice. Null texts
    have no phrases; an item without an id is matched and keeps its null id; repeated rows match once each.
    """
    found = _matches(index, items, slop, block_words, False)
    return found.join(_ids(index).drop("n_words"), ["shard", "doc"]).select("doc_id", "item_id", "start", "words", "exact")


def _covered(spans: Column) -> Column:
    """Words in the union of stretches, by one pass over them in order."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["start"] + s["words"] - F.greatest(acc["end"], s["start"]))).cast("long").alias("n"),
        F.greatest(acc["end"], s["start"] + s["words"]).cast("long").alias("end"),
    )
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(F.array_sort(spans), first, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, shard_bytes: int = SHARD_BYTES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a phrase (see ``phrase_matches``) of ``items(item_id, text)``; ``n_items`` the
    distinct item_ids with one. ``items_sha256`` digests these ids, sorted as text and joined by commas (of no ids: the empty text).
    Items without an id count in ``n_hit`` alone. Texts that are null or hold no words give zeros; rows may repeat or lack a
    doc_id, and each is judged by its own text; other columns are not read; an empty table on either side gives zeros or no rows.
    """
    index = build_index(docs, shard_bytes)
    found = _matches(index, items, 0, block_words, True)
    hits = found.groupBy("shard", "doc").agg(
        F.collect_list(F.struct("start", "words")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    hits = hits.select("shard", "doc", _covered(F.col("spans")).alias("n_hit"), "items")
    joined = _ids(index).join(hits, ["shard", "doc"], "left")
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
