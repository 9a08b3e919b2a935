import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quarterdeck.llm import shards, topk, toxicity
from tests.llm.helpers import AWKWARD, documents, prose, tuples


def topk_brute(rows, k=5):
    clean = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean.append((i, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for q, qv in {i: (i, v) for i, v in clean if i % 50 == 0}.values():
        scores = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in clean if i != q]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def vectors(kind, seed=4, count=700, width=12):
    rng = np.random.default_rng(seed)
    grid = rng.normal(0, 1, (count, width))
    if kind == "unit":
        grid /= np.linalg.norm(grid, axis=1)[:, None]
    elif kind == "skewed":
        grid *= rng.pareto(1.0, (count, 1)) + 0.01
    elif kind == "ties":
        grid = rng.integers(-1, 2, (count, 3)) / 256
    elif kind == "one axis":
        grid[:, 0] += 8
    elif kind == "huge":
        grid *= 1e6
    return [(k, [float(x) for x in v]) for k, v in enumerate(grid)]


@pytest.mark.parametrize("kind", ["plain", "unit", "skewed", "ties", "one axis", "huge"])
def test_top_products_are_brute_force(spark, kind):
    rows = vectors(kind)
    found = topk.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), bucket_rows=64, block_rows=4)
    assert tuples(found, "query_id", "rank", "vec_id", "score") == sorted(topk_brute(rows), key=repr)


def test_top_products_of_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, []), (100, None), (150, [float("nan"), 1.0]), (200, [float("inf")]), (250, [None, 1.0]), (None, [9.0, 9.0])]
    rows += [(7, [1.0]), (8, [3.0, 4.0, 5.0]), (-50, [-1.0, -2.0]), (9, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "2 AS score", "3 AS norm", "4 AS block")
    assert tuples(topk.top_products(table), "query_id", "rank", "vec_id", "score") == sorted(topk_brute(rows), key=repr)
    assert topk.top_products(table.where("false")).count() == 0
    assert topk.top_products(table.where("vec_id = 0")).count() == 0


def test_pruning_leaves_most_candidates_out():
    rows = vectors("unit", count=2000, width=4)
    grid = np.floor(256 * np.array([v for _, v in rows]))
    bucket = topk._Bucket(np.arange(2000, dtype=np.int64).tobytes(), grid.tobytes(), 4)
    norm = float(np.linalg.norm(grid[0]))
    assert 0 < len(bucket.candidates(grid[0], norm, 0.99 * norm * bucket.longest)) < 400
    assert len(bucket.candidates(grid[0], norm, 2 * norm * bucket.longest)) == 0


def capacity_brute(sizes, shards_):
    def fits(c):
        used, filled = 1, 0
        for s in sizes:
            if s > c:
                return False
            used, filled = (used, filled + s) if filled + s <= c else (used + 1, s)
        return used <= shards_

    return next(c for c in sorted({*range(max(sizes), sum(sizes) + 1)}) if fits(c)) if sizes else 0


@pytest.mark.parametrize("count, heavy", [(300, 0), (300, 150), (5, 0), (1, 0)])
def test_shards_have_the_smallest_capacity(spark, count, heavy):
    rng = random.Random(count)
    rows = [(k, "w" * rng.randint(0, 90) + str(k % 250)) for k in range(count)] + [(5000 + k, "the hot text") for k in range(heavy)]
    rows += [(9000 + d, t) for d, t in AWKWARD[:6]]
    found = shards.minimax_shards(documents(spark, rows, clash=True), shards=7).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, t in rows:
        name = hashlib.sha256(b"" if t is None else b"t" + t.encode()).hexdigest()
        sizes[name] = sizes.get(name, 0) + len((t or "").encode()) + 16
    filled, slots = {}, {}
    for r in found:
        filled[r.shard] = filled.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(filled.values()) == capacity_brute([sizes[k] for k in sorted(sizes)], 7)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(filled) <= set(range(7))
    text = dict(rows)
    assert len({(text[r.doc_id], r.shard) for r in found}) == len(set(text.values()))


def test_shards_of_awkward_rows(spark):
    found = shards.minimax_shards(documents(spark, AWKWARD, clash=True), shards=3).collect()
    assert len(found) == len(AWKWARD)
    assert {r.text_crc32 for r in found if r.doc_id in (4, 5)} == {0} and {r["size"] for r in found if r.doc_id in (4, 5)} == {16}
    assert shards.minimax_shards(documents(spark, [])).count() == 0


def test_bounds_meet_at_the_exact_capacity():
    """Prefixes of several groups only widen the bounds; the true capacity stays between them."""
    rng = random.Random(8)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 60))]
        spans, at = [], 0
        while at < len(sizes):
            n = rng.randint(1, 6)
            spans.append(shards.Span(f"{at:04}", sum(sizes[at : at + n]), len(sizes[at : at + n])))
            at += n
        low, high = shards._bounds(spans, 5)
        assert low <= capacity_brute(sizes, 5) <= high


def labelled(count, seed):
    rng, rows, labels = random.Random(seed), [], []
    for d, text in prose(seed, count, words=45):
        toxic = rng.random() < 0.25
        if toxic:
            words = text.split(" ")
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), "vile" + rng.choice(["st", "ness", "", "ly", "rton"]))
            text = " ".join(words)
        rows.append((d, text, rng.choice(["en", "fr", None])))
        labels.append((d, int(toxic)))
    return rows, labels


def test_toxicity_learns_from_labels_alone(spark):
    rows, labels = labelled(700, 6)
    rows += [(d, t, None) for d, t in AWKWARD if d is None or d > 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score", "'y' AS toxic", "'z' AS draw")
    table = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int").selectExpr("*", "'x' AS text", "'q' AS lang")
    found = toxicity.toxicity(docs, table).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in truth and r.doc_id > 11]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.93 * len(held)
    left = toxicity.drop_toxic(docs, table)
    # Each row goes by its own text, those that share or lack a doc_id too.
    assert left.columns == docs.columns
    assert sorted(r.doc_id or -9 for r in left.collect()) == sorted(r.doc_id or -9 for r in found if not r.rejected)


def test_thresholds_come_from_all_labels_that_training_left(spark):
    """A sample of 40 toxic rows has 8 to calibrate with, too few for a language; the cut sees the true ratio."""
    rows, labels = labelled(700, 6)
    truth, hidden = dict(labels), {d for d, _ in labels if zlib.crc32(str(d).encode()) % 5 == 0}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model, _ = toxicity.fit(docs, table, max_toxic=40, max_clean=60)
    assert set(model.thresholds) == {"en", "fr"}
    draws = sorted((r.draw, r.doc_id) for r in table.selectExpr("doc_id", "xxhash64(doc_id) draw").collect() if r.doc_id not in hidden)
    used = {d for kind, most in ((1, 40), (0, 60)) for h, d in [x for x in draws if truth[x[1]] == kind][:most] if h % 5}
    others = [(d, t) for d, t, _ in rows if d not in hidden and d not in used]
    p = model.probabilities(toxicity.words_of(pa.array([t for _, t in others])))
    toxic = np.array([truth[d] for d, _ in others])
    every = np.array([truth[d] for _, d in draws])
    weight = np.where(toxic > 0, every.sum() / toxic.sum(), (1 - every).sum() / (1 - toxic).sum())

    def f1(cut):
        return 2 * (weight * toxic)[p >= cut].sum() / (weight[p >= cut].sum() + (weight * toxic).sum())

    assert f1(model.cut) >= max(map(f1, p)) - 0.01


def test_scores_ignore_language_labels_and_ids(spark):
    rows, labels = labelled(200, 3)
    words = toxicity.words_of
    model = toxicity.train([t for _, t, _ in rows], np.array([y for _, y in labels]), epochs=1)
    texts = pa.array([t for _, t, _ in rows] + [None, ""])
    together = model.scores(words(texts))
    apart = np.concatenate([model.scores(words(texts.slice(k, 1))) for k in range(len(texts))])
    assert np.allclose(together, apart, atol=1e-6)


def test_toxicity_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for labels in (none, one):
        assert {r.predicted for r in toxicity.toxicity(docs, labels).collect()} == {0}
    assert toxicity.toxicity(docs.where("false"), one).count() == 0
