"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed rows of one table: for the word and for its first four and five letters, so
that unseen endings share what was learnt. Filters of one, two and three words run over the whole text; the
largest answer of each filter (at least 0) feeds a logistic output. Training takes a bounded sample of labelled rows
(``MAX_TOXIC`` and ``MAX_CLEAN``) less a fifth. All other labelled rows calibrate, scored in Spark and counted in narrow bins,
with classes weighted to their ratio among all labels: the threshold over all languages becomes score 0.5, and each
language gets a threshold of its own on that scale. Language is used for these thresholds alone, never
for a score. The model is a few megabytes whatever the corpus, and tasks score whole texts with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import ROW, staged, with_row_keys
from quarterdeck.llm.units import gather

MAX_TOXIC, MAX_CLEAN = 1500, 2500  # labelled rows that training may take, whole texts
ROWS, WIDTH, FILTERS, WIDTHS = 1 << 15, 16, 8, (1, 2, 3)
FOLDS = 5  # one of which, remainder 0, is held out
STEMS = (4, 5)  # letters of a word's beginning that have rows of their own
MIN_CALIBRATION = 20  # toxic rows a language needs for a threshold of its own
BINS = 256  # to each unit of log odds, where thresholds are sought
EPOCHS, BATCH, RATE = 8, 32, 0.1
_SLICE_BYTES = 4 << 20
_SEED = 20240229


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


@dataclass
class Words:
    """The words of some texts: a number for each word in order, each text's number of words, and for each distinct
    word its three table rows."""

    codes: np.ndarray
    counts: np.ndarray
    rows: np.ndarray

    def of(self, texts: np.ndarray) -> Words:
        """The words of some of the texts."""
        ends = np.cumsum(self.counts)
        codes = gather(self.codes, (ends - self.counts)[texts], self.counts[texts])
        used, codes = np.unique(codes, return_inverse=True)
        return Words(codes, self.counts[texts], self.rows[used])


def _hashes(words: pa.Array, salt: bytes) -> np.ndarray:
    start = zlib.crc32(salt)
    return np.fromiter((zlib.crc32(w, start) for w in words.cast(pa.large_binary()).to_pylist()), np.int64, len(words)) % ROWS


def words_of(texts: pa.Array) -> Words:
    """Runs of letters and digits, in lower case."""
    plain = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    spaced = pc.utf8_trim(pc.replace_substring_regex(plain, r"[^\pL\pN]+", " "), " ")
    lists = pc.split_pattern(spaced, " ")
    offsets = lists.offsets.to_numpy()
    coded = lists.values.dictionary_encode()
    counts, codes = np.diff(offsets).astype(np.int64), coded.indices.to_numpy().astype(np.int64)
    empty = pc.equal(spaced, "").to_numpy(zero_copy_only=False)
    if empty.any():  # such a text splits into one empty word
        keep = np.ones(len(codes), dtype=bool)
        keep[offsets[:-1][empty]] = False
        codes, counts = codes[keep], np.where(empty, 0, counts)
    words = coded.dictionary
    rows = [_hashes(words, b"")]
    for letters in STEMS:
        stems = pc.utf8_slice_codeunits(words, 0, letters).dictionary_encode()
        rows.append(_hashes(stems.dictionary, b"%d" % letters)[stems.indices.to_numpy()])
    return Words(codes.astype(np.int32), counts, np.stack(rows, axis=1).astype(np.int32))


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, WIDTH, FILTERS)
    biases: list[np.ndarray]
    output: np.ndarray
    bias: float
    cut: float = 0.5  # probability that becomes score 0.5
    thresholds: dict[str, float] = field(default_factory=dict)  # by language, on the scale of scores

    @classmethod
    def start(cls) -> Model:
        rng = np.random.default_rng(_SEED)
        filters = [rng.normal(0, 0.3, (w, WIDTH, FILTERS)).astype(np.float32) for w in WIDTHS]
        return cls(
            rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32), filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), 0.0,
        )

    def _answers(self, words: Words):
        """For each width the filter answers at every word, with zeros behind a text's end; and the word vectors."""
        vectors = self.table[words.rows].sum(axis=1)
        blank = len(vectors)
        vectors = np.concatenate([vectors, np.zeros((1, WIDTH), np.float32)])
        total, pad = len(words.codes), max(WIDTHS) - 1
        text = np.repeat(np.arange(len(words.counts)), words.counts)
        at = np.arange(total) + pad * text
        padded = np.full(total + pad * len(words.counts), blank)
        padded[at] = words.codes
        answers = []
        for weights, bias in zip(self.filters, self.biases):
            out = np.tile(bias, (total, 1))
            for j, w in enumerate(weights):
                out += (vectors @ w)[padded[at + j]]
            answers.append(out)
        return answers, vectors, padded, at

    def probabilities(self, words: Words) -> np.ndarray:
        answers, *_ = self._answers(words)
        return self._logistic(self._features(answers, words.counts)[0])

    def _logistic(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features.astype(np.float64) @ self.output + self.bias)))

    @staticmethod
    def _features(answers: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answers per text, 0 at least, and texts that have words."""
        full = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[full]
        features = np.zeros((len(counts), len(answers) * FILTERS), np.float32)
        if len(full):
            best = np.concatenate([np.maximum.reduceat(a, starts, axis=0) for a in answers], axis=1)
            features[full] = np.maximum(best, 0)
        return features, full

    def scores(self, words: Words) -> np.ndarray:
        """Probabilities, stretched so that ``cut`` becomes 0.5."""
        return self.stretched(self.probabilities(words))

    def stretched(self, p: np.ndarray) -> np.ndarray:
        return np.where(p < self.cut, 0.5 * p / self.cut, 0.5 + 0.5 * (p - self.cut) / max(1 - self.cut, 1e-12)).clip(0, 1)


class _Adagrad:
    def __init__(self, model: Model):
        self.seen = {id(x): np.full(x.shape, 1e-6, np.float32) for x in (model.table, model.output, *model.filters, *model.biases)}
        self.bias_seen = 1e-6

    def step(self, x: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
        seen = self.seen[id(x)]
        seen[rows] += gradient**2
        x[rows] -= RATE * gradient / np.sqrt(seen[rows])


def train(texts: list[str], toxic: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Fit a model to texts and their labels; classes weigh the same in sum."""
    model = Model.start()
    toxic = np.asarray(toxic, dtype=np.float64)
    if len(texts) == 0 or toxic.min() == toxic.max():
        model.bias = 20.0 * (float(toxic.mean()) - 0.5) if len(texts) else -10.0
        model.output[:] = 0
        return model
    share = toxic.mean()
    weight = np.where(toxic > 0, 0.5 / share, 0.5 / (1 - share))
    rng, adagrad, words = np.random.default_rng(_SEED), _Adagrad(model), words_of(pa.array(texts, pa.large_string()))
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            pick = order[start : start + BATCH]
            _learn(model, adagrad, words.of(pick), toxic[pick], weight[pick])
    pa.default_memory_pool().release_unused()
    return model


def _learn(model: Model, adagrad: _Adagrad, words: Words, toxic: np.ndarray, weight: np.ndarray) -> None:
    answers, vectors, padded, at = model._answers(words)
    features, full = model._features(answers, words.counts)
    error = ((model._logistic(features) - toxic) * weight / len(toxic)).astype(np.float32)
    active = np.outer(error, model.output) * (features > 0)  # gradient of each text's features
    d_vectors = np.zeros_like(vectors)
    starts = np.cumsum(words.counts) - words.counts
    changes = []
    for n, (answer, filters) in enumerate(zip(answers, model.filters)):
        own = active[:, n * FILTERS : (n + 1) * FILTERS]
        # Where each text's largest answer stands.
        place = np.zeros((len(words.counts), FILTERS), dtype=np.int64)
        for i in full:
            place[i] = starts[i] + answer[starts[i] : starts[i] + words.counts[i]].argmax(axis=0)
        gradient = np.zeros_like(filters)
        for j in range(len(filters)):
            used = padded[at[place[full]] + j]  # (texts, filters)
            for f in range(FILTERS):
                gradient[j, :, f] = own[full, f] @ vectors[used[:, f]]
                np.add.at(d_vectors, used[:, f], own[full, f][:, None] * filters[j, :, f])
        changes.append((filters, gradient, model.biases[n], own.sum(axis=0)))
    d_output, d_bias = error @ features, float(error.sum())

    touched = np.flatnonzero(np.abs(d_vectors[:-1]).sum(axis=1))
    which, inverse = np.unique(words.rows[touched], return_inverse=True)
    d_rows = np.zeros((len(which), WIDTH), np.float32)
    np.add.at(d_rows, inverse.reshape(-1), np.repeat(d_vectors[touched], 3, axis=0))
    adagrad.step(model.table, d_rows, which)
    for filters, d_filters, bias, d_bias_own in changes:
        adagrad.step(filters, d_filters)
        adagrad.step(bias, d_bias_own)
    adagrad.step(model.output, d_output)
    adagrad.bias_seen += d_bias**2
    model.bias -= RATE * d_bias / adagrad.bias_seen**0.5


@dataclass
class Bins:
    """Calibrating rows of a range of scores each, the highest first: weights of toxic and of all rows, least and largest score."""

    toxic: np.ndarray
    total: np.ndarray
    low: np.ndarray
    high: np.ndarray


def best_cut(bins: Bins) -> float:
    """Between the bins where F1 is highest, the middle of the gap there."""
    f1 = 2 * np.cumsum(bins.toxic) / (np.cumsum(bins.total) + bins.toxic.sum())
    k = int(f1.argmax())
    below = bins.high[k + 1] if k + 1 < len(f1) else 0.0
    return float(np.clip((bins.low[k] + below) / 2, 1e-6, 1 - 1e-6))


def calibrate(model: Model, rows: DataFrame, fitted: tuple[int, int]) -> None:
    """Set the cut over all languages, and the threshold of each language with enough toxic rows.

    ``rows(lang, toxic, p)`` had no part in training; ``fitted`` are the numbers of toxic and clean rows that had.
    """
    p = F.least(F.greatest("p", F.lit(1e-15)), F.lit(1 - 1e-15))
    counted = rows.withColumn("bin", F.floor(F.log(p / (1 - p)) * BINS)).groupBy("lang", "bin")
    bins = staged(counted.agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("total"), F.min("p").alias("low"), F.max("p").alias("high")), "toxicity-bins")
    sums = [F.sum("toxic").alias("toxic"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]
    whole = bins.groupBy("bin").agg(*sums).orderBy(F.desc("bin")).collect()
    toxic, total = sum(r.toxic for r in whole), sum(r.total for r in whole)
    if toxic in (0, total):
        return
    weights = (toxic + fitted[0]) / toxic, (total - toxic + fitted[1]) / (total - toxic)

    def weighted(found: list) -> Bins:
        own, every, low, high = (np.array([r[c] for r in found], dtype=np.float64) for c in ("toxic", "total", "low", "high"))
        return Bins(own * weights[0], own * weights[0] + (every - own) * weights[1], low, high)

    model.cut = best_cut(weighted(whole))
    enough = bins.where("lang is not null").groupBy("lang").agg(F.sum("toxic").alias("n"), F.sum("total").alias("of")).where((F.col("n") >= MIN_CALIBRATION) & (F.col("n") < F.col("of")))
    own: dict[str, list] = {}
    for row in bins.join(enough.select("lang"), "lang").orderBy("lang", F.desc("bin")).collect():
        own.setdefault(row.lang, []).append(row)
    for lang, found in own.items():
        stretched = weighted(found)
        stretched.low, stretched.high = model.stretched(stretched.low), model.stretched(stretched.high)
        model.thresholds[lang] = best_cut(stretched)


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> tuple[Model, DataFrame]:
    """Train on a bounded sample of the labelled rows that are not held out, calibrate on all others of them.

    Gives the model, and ``(doc_id, lang, p, row)`` of every row of ``docs``, scored once for calibration and result.

    The sample is the rows with the smallest hashes of their doc_id. Rows without doc_id or label take no part; of
    a document labelled twice every row may be drawn.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).withColumn("draw", F.xxhash64("doc_id"))
    drawn = known.where("toxic > 0").orderBy("draw", "doc_id").limit(max_toxic).unionByName(known.where("toxic <= 0").orderBy("draw", "doc_id").limit(max_clean))
    # At most max_toxic + max_clean rows of two numbers: small enough to broadcast.
    drawn = staged(drawn.where(F.col("draw") % FOLDS != 0), "toxicity-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([F.col("lang").cast("string").alias("lang")] if "lang" in docs.columns else [F.lit(None).cast("string").alias("lang")]), (F.col(ROW) if ROW in docs.columns else F.lit(None).cast("long")).alias("row"))
    fitting = texts.join(F.broadcast(drawn), "doc_id").orderBy("draw", "doc_id").limit(max_toxic + max_clean).select("text", "toxic").collect()
    toxic = np.array([int(r.toxic > 0) for r in fitting])
    model = train([r.text or "" for r in fitting], toxic)
    others = known.join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id", "left_anti")
    scored = staged(texts.mapInArrow(_score(model), "doc_id long, lang string, p double, row long"), "toxicity-scores")
    rows = scored.join(others, "doc_id").select("lang", (F.col("toxic") > 0).cast("int").alias("toxic"), "p")
    calibrate(model, rows, (int(toxic.sum()), int(len(toxic) - toxic.sum())))
    return model, scored


def _sliced(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """First rows and numbers of rows of bounded stretches of texts."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    firsts = np.flatnonzero(np.diff(size // _SLICE_BYTES, prepend=-1)).tolist()
    for first, last in zip(firsts, [*firsts[1:], len(texts)]):
        yield first, last - first


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            for part in _sliced(texts):
                p = model.probabilities(words_of(texts.slice(*part)))
                columns = [batch.column(0).slice(*part), batch.column(2).slice(*part), pa.array(p), batch.column(3).slice(*part)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "p", "row"])
            pa.default_memory_pool().release_unused()

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: doc_id, held_out, score, predicted, threshold, rejected.

    ``score`` (0 to 1) comes from the whole text alone. ``predicted`` is 1 from 0.5 on; ``rejected`` is 1 from the
    threshold of the document's language on, which is 0.5 for a language without one or a null language.

    Null and empty texts get the score of a text without words. Rows may repeat or lack a doc_id (held_out false).
    Without usable labels of both kinds all scores are equal. Other columns are not read; lang may be missing.
    """
    return _judged(*fit(docs, labels)).drop("row")


def _judged(model: Model, scored: DataFrame) -> DataFrame:
    """The rows of ``toxicity``, with the number that ``with_row_keys`` gave, if it did."""
    p, cut = F.col("p"), F.lit(model.cut)
    above = 0.5 + 0.5 * (p - cut) / F.lit(max(1 - model.cut, 1e-12))
    scored = scored.withColumn("score", F.least(F.greatest(F.when(p < cut, 0.5 * p / cut).otherwise(above), F.lit(0.0)), F.lit(1.0)))
    threshold = F.lit(0.5)
    for name, value in model.thresholds.items():
        threshold = F.when(F.col("lang") == name, F.lit(value)).otherwise(threshold)
    return scored.select(
        "row",
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        threshold.alias("threshold"),
        (F.col("score") >= threshold).cast("int").alias("rejected"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without rejected documents, with all columns.

    Rows that share or lack a doc_id are told apart (``with_row_keys``) and judged each by its own text; an empty table gives an empty one.
    """
    keyed = with_row_keys(docs)
    rejected = _judged(*fit(keyed, labels)).where("rejected = 1").select(F.col("row").alias(ROW))
    return keyed.join(rejected, ROW, "left_anti").select(*docs.columns)
