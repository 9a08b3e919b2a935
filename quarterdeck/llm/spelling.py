"""Spelling variants: words one inserted, deleted or replaced code point apart, and the commoner form of each.

Two words differ by one such edit exactly if their common prefix and common suffix together reach the longer length less one.
Words meet in blocks: the longer length is cut into pieces, and words that agree in all but one piece share a block, so the
pair's first difference names the one block that counts it. In a block, tiles of padded code-point matrices are compared
in pairs, a whole tile against another at once. A piece has two code points (more only for words of over 32), so a block
holds no more words than its piece has spellings; larger ones are dealt out as pairs of tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import staged

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
PIECES = 16  # of a long word
TILE = 64  # words compared with as many at once
_CELLS = 1 << 25  # of the matrices of two tiles; tiles of very long words are halved
BLOCK_WORDS = 1 << 14  # of a block that one task holds; larger blocks come as pairs of parts

_NEAR = "word string, n_near long, form_n long, form string"


def _noisy(doc_id: Column, word: Column) -> Column:
    """The word, with one code point left out where the digest of document and word says so."""
    digest = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word), "utf-8"))
    place = (digest % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))
    return F.when(digest % 97 == 0, cut).otherwise(word)


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: the words of ``docs(doc_id, text)`` with at least ``min_length`` code points that occur ``min_count`` times."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    run = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))).alias("run")
    # A word never grows, so shorter runs are of no use.
    runs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), run).where(F.length("run") >= min_length)
    named = runs.select("doc_id", F.translate("run", upper, lower).alias("run"))
    counted = named.groupBy(_noisy(F.col("doc_id"), F.col("run")).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def _keys(vocabulary: DataFrame) -> DataFrame:
    """Every word with the blocks it belongs to: ``(longer, piece, first, last, hole, word, n)``.

    ``longer`` is the longer length of the pairs looked for; ``first`` and ``last`` bound the piece that may differ. A hole's digest only
    brings words together, so two holes with one digest do no harm.
    """
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer")
    sized = vocabulary.select("word", "n", longer)
    size = F.greatest(F.lit(2), F.ceil(F.col("longer") / PIECES).cast("int"))
    pieces = sized.withColumn("size", size).withColumn("first", F.explode(F.expr("sequence(0, longer - 1, size)")))
    last = F.least(F.col("first") + F.col("size"), F.col("longer"))
    suffix = F.col("longer") - last
    hole = F.xxhash64(F.substring("word", F.lit(1), F.col("first")), F.substring("word", F.length("word") - suffix + 1, suffix))
    return pieces.select("longer", "first", last.alias("last"), hole.alias("hole"), "word", "n")


def _dealt(keys: DataFrame, block_words: int) -> DataFrame:
    """Keys with ``part`` and ``own``: blocks too large for a task are cut into parts, and each pair of parts is a block.

    A word of a cut block goes to every pair that its part is in; ``own`` tells which side of the pair it is. Only words of over
    2 * ``PIECES`` code points can have such blocks, or a bound below the number of spellings of two code points.
    """
    block = ["longer", "first", "hole"]
    # Short pieces have at most 90 ** 2 + 90 spellings.
    free = F.col("last") - F.col("first") > 2 if block_words >= 8190 else F.lit(True)
    large = keys.where(free).groupBy(*block).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_words)
    parts = F.ceil(F.col("rows") * 2 / block_words).cast("int")
    large = large.select(*block, parts.alias("parts"))
    joined = keys.join(large, block, "left")
    mine = F.pmod(F.xxhash64(F.lit(1), "word"), F.col("parts")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least(F.col("mine"), other).alias("low"), F.greatest(F.col("mine"), other).alias("high")),
    )
    whole = F.array(F.struct(F.lit(-1).alias("low"), F.lit(-1).alias("high")))
    spread = joined.withColumn("mine", mine).withColumn("part", F.explode(F.when(F.col("parts").isNull(), whole).otherwise(pairs)))
    side = F.when(F.col("part.low") < F.col("part.high"), (F.col("mine") == F.col("part.high")).cast("int")).otherwise(2)
    return spread.select(*block, "last", F.col("part.low").alias("low"), F.col("part.high").alias("high"), side.alias("side"), "word", "n")


def _matrix(texts: list[str], width: int) -> np.ndarray:
    """Code points of words, one row each, padded with zeros."""
    out = np.array([*texts], dtype=f"<U{width}")
    return out.view(np.uint32).reshape(len(texts), width).astype(np.uint16)


def _common(a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix of each word of tile ``a`` with each different one of tile ``b``, and the shorter length of both."""
    shorter = np.minimum(a_len[:, None], b_len[None, :])
    return np.minimum(np.argmin(a[:, None, :] == b[None, :, :], axis=2), shorter), shorter


def _flipped(grid: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words written backwards, padded at their end."""
    width = grid.shape[1]
    back = lengths[:, None] - 1 - np.arange(width)
    return np.where(back >= 0, np.take_along_axis(grid, np.maximum(back, 0), axis=1), 0)


class _Stretch:
    """Rows of whole blocks, as matrices, and the near pairs in them."""

    def __init__(self, rows: pa.Table):
        column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
        self.words = column["word"].to_pylist()
        self.n, self.side = column["n"].to_numpy(), column["side"].to_numpy()
        self.longer, self.first, self.last = (column[c].to_numpy() for c in ("longer", "first", "last"))
        self.block = np.cumsum(_changes(rows)) - 1
        self.lengths = np.array([len(w) for w in self.words], np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of near words, each pair once."""
        edges = np.flatnonzero(np.diff(self.block, prepend=-1, append=self.block[-1] + 1 if len(self.block) else 0))
        sizes = np.diff(edges)
        left, right = [], []
        alone = np.flatnonzero(sizes > TILE).tolist()
        for k in alone:
            self._tiles(np.arange(edges[k], edges[k + 1]), left, right)
        # Small blocks share a tile; words of one length keep it narrow.
        small = np.repeat((sizes > 1) & (sizes <= TILE), sizes)
        rows = np.flatnonzero(small)
        if len(rows):
            ends = np.cumsum(sizes[(sizes > 1) & (sizes <= TILE)])
            cuts = [0]
            while cuts[-1] < len(rows):
                # As many whole blocks as fit; the next one always does.
                fit = np.searchsorted(ends, cuts[-1] + TILE, side="right")
                cuts.append(int(ends[max(fit - 1, np.searchsorted(ends, cuts[-1], side="right"))]))
            for a, b in zip(cuts, cuts[1:]):
                self._compare(rows[a:b], rows[a:b], left, right)
        both = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right)]
        return both[0], both[1]

    def _tiles(self, rows: np.ndarray, left: list, right: list) -> None:
        tiles = [rows[s : s + TILE] for s in range(0, len(rows), TILE)]
        for i, a in enumerate(tiles):
            for b in tiles[i:]:
                self._compare(a, b, left, right)

    def _compare(self, a: np.ndarray, b: np.ndarray, left: list, right: list) -> None:
        """Near pairs of a row of ``a`` with a later one of ``b``."""
        if len(a) * len(b) > 1 and len(a) * len(b) * int(self.lengths[a].max()) > _CELLS:
            for one in np.array_split(a, 2):
                for two in np.array_split(b, 2):
                    if len(one) and len(two) and one[0] < two[-1]:
                        self._compare(one, two, left, right)
            return
        a_len, b_len = self.lengths[a], self.lengths[b]
        width = int(max(a_len.max(), b_len.max())) + 1  # a column of padding ends every word
        one, two = (_matrix([self.words[k] for k in x.tolist()], width) for x in (a, b))
        prefix, shorter = _common(one, two, a_len, b_len)
        suffix, _ = _common(_flipped(one, a_len), _flipped(two, b_len), a_len, b_len)
        longer = np.maximum(a_len[:, None], b_len[None, :])
        near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & (prefix < longer)
        near &= (self.block[a][:, None] == self.block[b][None, :]) & (longer == self.longer[a][:, None])
        # The first difference lies in the piece that this block leaves open: no other block has the pair.
        near &= (prefix >= self.first[a][:, None]) & (prefix < self.last[a][:, None])
        # Parts of a cut block are compared with each other here, and with themselves where both sides are one.
        near &= (self.side[a][:, None] != self.side[b][None, :]) | (self.side[a][:, None] == 2)
        near &= a[:, None] < b[None, :]
        i, j = np.nonzero(near)
        left.append(a[i])
        right.append(b[j])

    def result(self) -> pa.RecordBatch:
        """For each word with near ones in this stretch: how many, and the commonest of them."""
        left, right = self.pairs()
        word, other = np.concatenate([left, right]), np.concatenate([right, left])
        texts = np.array(self.words, dtype=object)
        # Ties go to the smaller word; rank gives its place among the words met here.
        names, rank = np.unique(texts[other], return_inverse=True) if len(other) else (texts[:0], other)
        order = np.lexsort((rank, -self.n[other], word))
        word, other = word[order], other[order]
        at = np.flatnonzero(np.diff(word, prepend=-1))
        best = other[at]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(texts[word[at]].tolist(), pa.string()),
                pa.array(np.diff(np.append(at, len(word))).astype(np.int64)),
                pa.array(self.n[best].astype(np.int64)),
                pa.array(texts[best].tolist(), pa.string()),
            ],
            names=["word", "n_near", "form_n", "form"],
        )


def _changes(rows: pa.Table) -> np.ndarray:
    """Where a block begins, in rows ordered by block."""
    new = np.zeros(rows.num_rows, bool)
    for name in ("longer", "first", "hole", "low", "high"):
        values = rows.column(name).combine_chunks().to_numpy()
        new[1:] |= values[1:] != values[:-1]
    new[:1] = True
    return new


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        if rows.num_rows < 4096:
            continue
        # The last block may go on in the next batch.
        at = int(np.flatnonzero(_changes(rows))[-1])
        if at:
            yield _Stretch(rows.slice(0, at)).result()
            held = rows.slice(at).to_batches()
    if held:
        yield _Stretch(pa.Table.from_batches(held)).result()


def near_words(vocabulary: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(word, n_near, form_n, form)`` for each word of ``vocabulary(word, n)`` that has near words: their number and the commonest."""
    dealt = _dealt(_keys(vocabulary), block_words)
    block = ["longer", "first", "hole", "low", "high"]
    ordered = dealt.repartition(*block).sortWithinPartitions(*block)
    found = ordered.mapInArrow(_compared, _NEAR)
    best = F.min_by(F.struct("form_n", "form"), F.struct(-F.col("form_n"), F.col("form")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return summed.select("word", "n_near", "best.form_n", "best.form")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``forms(word, form)``: the last of the forms that follow a word.

    Each round doubles the steps taken. A form is at least twice as common as its word, so chains are short.
    """
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = reached.join(onward, "root", "left")
        after = staged(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        reached = after.select("word", "root")
        if after.where("moved").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = 2, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per word of ``docs(doc_id, text)``: word, form, root, n, n_near, form_n.

    Words are runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; where 97 divides the CRC-32 of ``<doc_id>:<run>``, the run loses
    the code point at that number modulo its length. Those with at least ``min_length`` code points and ``min_count`` occurrences
    count. Near words differ by exactly one code point inserted, deleted or replaced. ``form`` is the near word with the largest
    ``n``, of equal ones the smallest, if it has at least ``ratio`` times the word's ``n``; else it and ``form_n`` are null. ``root`` follows the
    forms to their end and is the word itself without one. Null texts have no words, a null doc_id counts as empty, repeated
    rows count once each; other columns are not read; an empty table gives an empty result.
    """
    vocabulary = staged(words(docs, min_length, min_count), "vocabulary")
    near = near_words(vocabulary, block_words)
    joined = staged(vocabulary.join(near, "word", "left"), "near")
    fits = F.col("form_n") >= ratio * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), *[F.when(fits, F.col(c)).alias(c) for c in ("form", "form_n")]
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form"))
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
