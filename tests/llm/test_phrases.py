import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import phrases
from quarterdeck.llm.common import _BATCH_ROWS, staged
from quarterdeck.llm.phrases import WINDOW
from tests.llm.helpers import AWKWARD, documents, tuples

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def windows(text):
    own = words(text)
    return [own[k : k + WINDOW] for k in range(max(len(own) - WINDOW + 1, min(len(own), 1)))]


def brute_places(docs, items, slop):
    out = []
    for d, t in docs:
        own = words(t)
        for i, text in items:
            for phrase in windows(text):
                for s in range(len(own) - len(phrase) + 1):
                    near = all(w in own[max(s + k - slop, 0) : s + k + slop + 1] for k, w in enumerate(phrase))
                    if near:
                        out.append((d, None if i is None else str(i), s, len(phrase), own[s : s + len(phrase)] == phrase))
    return sorted(out, key=repr)


def brute(docs, items):
    out = []
    for d, t in docs:
        hit, found = set(), set()
        for _, i, s, n, _ in brute_places([(d, t)], items, 0):
            hit |= set(range(s, s + n))
            found |= {i} - {None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(words(t)), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def tables(spark, seed=1):
    rng = random.Random(seed)
    stock = ["a", "b", "The", "ÀÉ", "àé", "x1", "中文", "zz", "q", "rare"]
    docs = [(k, rng.choice([" ", "\n", ", "]).join(rng.choices(stock, [9, 8, 7, 3, 2, 2, 1, 1, 1, 1], k=rng.randint(0, 80)))) for k in range(60)]
    docs += [(d, t if t is None else t[:300]) for d, t in AWKWARD]
    items = []
    for k in range(40):
        own = words(rng.choice(docs)[1])
        at = rng.randrange(max(len(own) - 14, 1))
        items.append((k, " ".join(own[at : at + rng.randint(3, 25)]).upper() + rng.choice(["", " b", " unseen"])))
    items += [(900, None), (901, ""), (902, "..."), (None, "a b"), (903, "zz"), (904, "zz"), (903, "rare q"), (905, "one two three four five six seven")]
    shown = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS shard", "3 AS block", "4 AS words")
    return docs, items, documents(spark, docs, clash=True), shown


@pytest.mark.parametrize("shard_bytes, block_words", [(1 << 20, 1 << 18), (300, 90), (1, 1 << 18)])
def test_contamination_is_brute_force(spark, shard_bytes, block_words):
    docs, items, table, tests = tables(spark)
    found = phrases.contamination(table, tests, shard_bytes, block_words)
    assert found.columns == list(COLUMNS)
    assert tuples(found, *COLUMNS) == brute(docs, items)


@pytest.mark.parametrize("slop, shard_bytes", [(0, 1 << 20), (1, 1 << 20), (2, 400)])
def test_exact_and_proximity_matches_are_brute_force(spark, slop, shard_bytes):
    docs, items, _, tests = tables(spark, 3)
    docs = docs[:40]
    table = documents(spark, docs, clash=True)
    found = phrases.phrase_matches(phrases.build_index(table, shard_bytes), tests, slop)
    assert tuples(found, "doc_id", "item_id", "start", "words", "exact") == brute_places(docs, items, slop)


def test_long_items_are_cut_into_parts(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(400))
    docs = [(1, text), (2, " ".join(text.split(" ")[195:215])), (3, " ".join(text.split(" ")[190:199]))]
    table, tests = documents(spark, docs), spark.createDataFrame([("x,y", text)], "item_id string, text string")
    expected = brute(docs, [("x,y", text)])
    assert tuples(phrases.contamination(table, tests), *COLUMNS) == expected
    parts = [p for p in phrases._parts(iter(tests.toArrow().select(["item_id", "text"]).to_batches()))]
    assert len(parts) == 1
    monkeypatch.setattr(phrases, "_PART_WORDS", 7)
    parts = [p.column(2)[0].as_py() for p in phrases._parts(iter(tests.toArrow().select(["item_id", "text"]).to_batches()))]
    cut = [tuple(p[k : k + WINDOW]) for p in parts for k in range(len(p) - WINDOW + 1)]
    assert cut == [tuple(w.encode() for w in p) for p in windows(text)] and max(map(len, parts)) <= 7 + WINDOW - 1


def test_empty_tables(spark):
    docs, items, table, tests = tables(spark)
    assert phrases.contamination(table.where("false"), tests).count() == 0
    assert tuples(phrases.contamination(table, tests.where("false")), *COLUMNS) == brute(docs, [])
    assert phrases.phrase_matches(phrases.build_index(table), tests.where("false")).count() == 0


def test_index_is_read_in_small_files_and_searched_shard_by_shard(spark):
    rows = [(k, f"word{k} and some more") for k in range(40)]
    index = phrases.build_index(documents(spark, rows).coalesce(1), 1)
    files = [r["count"] for r in index.groupBy(F.input_file_name()).count().collect()]
    assert sum(files) == 40 and max(files) <= phrases._FILE_SHARDS

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    before = spark.conf.get(_BATCH_ROWS)
    seen = staged(index.select("shard").mapInArrow(sizes, "n long"), "sizes", batch_rows=1)
    assert {r.n for r in seen.collect()} == {1} and spark.conf.get(_BATCH_ROWS) == before


def test_places_of_frequent_words_are_held_in_bounded_slices(monkeypatch):
    monkeypatch.setattr(phrases, "_STARTS", 100)
    text, items = "a b " * 500, ["a", "b", "a b", "b a b", "c"] * 8
    batches = [*phrases._index(1 << 20)(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})]))]
    doc_words, terms, ends, positions = (batches[0].column(k)[0] for k in (2, 3, 4, 5))
    shard = phrases.Shard(terms.values, ends.as_py(), positions.as_py(), doc_words.values.to_numpy())
    own = [w.encode() for i in items for w in i.split()]
    known = {w: k for k, w in enumerate(terms.values.to_pylist())}
    size = np.array([len(i.split()) for i in items])
    found = [*shard.find(np.array([known.get(w, -1) for w in own]), np.cumsum(size) - size, size, 0)]
    assert max(len(np.unique(phrase)) for phrase, _, _ in found) == 1
    places = sorted((int(p), int(s)) for phrase, start, _ in found for p, s in zip(phrase, start))
    flat = text.split()
    assert places == [(p, s) for p, i in enumerate(items) for s in range(len(flat)) if flat[s : s + len(i.split())] == i.split()]
