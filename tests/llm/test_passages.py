import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from quarterdeck.llm import paragraphs, spans
from tests.llm.helpers import AWKWARD, SAID, SHARED_IDS, documents, groups_of, prose, tuples


def repeats(seed):
    """Prose with near copies of paragraphs, and one passage put into the middle of several texts."""
    rng = random.Random(seed)
    rows = prose(seed, 40, words=90)
    lines = [line for _, t in rows for line in t.split("\n") if len(line.split()) > 30]
    for k in range(25):
        words = rng.choice(lines).split(" ")
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + k, "Some start.\n" + " ".join(words)))
    passage = "This passage of many words was put into the middle of several other texts here. It has a second sentence that is long enough to be found alone."
    for k in range(5):
        rows.append((200 + k, f"Lead number {k * 7} of its own. {passage} Tail {k} of its own as well."))
    return rows


def brute(rows):
    found = [(d, level, a, b, tuple(w)) for d, t in rows if d is not None for level, a, b, w in paragraphs.passages(t or "")]
    shingles = {w: {w[k : k + 5] for k in range(len(w) - 4)} for *_, w in found}
    long = sorted({f[4] for f in found if f[1] == paragraphs.PARAGRAPH})
    links = [(a, b) for a in long for b in long if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    root = groups_of(links, {f[4] for f in found})
    first, count = {}, {}
    for d, _, a, _, w in found:
        first[root[w]] = min(first.get(root[w], (d, a)), (d, a))
        count[root[w]] = count.get(root[w], 0) + 1
    names = {paragraphs.PARAGRAPH: "paragraph", paragraphs.SENTENCE: "sentence"}
    out = []
    for d, level, a, b, w in found:
        if count[root[w]] > 1:
            keep = first[root[w]]
            out.append((d, names[level], a, b, f"{keep[0]}:{keep[1]}", (d, a) == keep))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "level", "start", "stop", "component_id", "kept")


def test_repeated_passages_are_brute_force(spark):
    rows = repeats(3) + [(1000 + k if d is not None else None, t) for k, (d, t) in enumerate(AWKWARD)]
    assert tuples(paragraphs.repeated_passages(documents(spark, rows, clash=True)), *COLUMNS) == brute(rows)
    assert paragraphs.repeated_passages(documents(spark, [])).count() == 0


def test_chains_join_through_members_that_miss_the_leader(spark):
    """Variants of one paragraph of which neighbours alone are similar enough."""
    words = [f"word{k}" for k in range(60)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words[5 * k] = f"other{k}"
    found = paragraphs.repeated_passages(documents(spark, rows))
    assert tuples(found, *COLUMNS) == brute(rows)


def test_a_sentence_is_not_kept_inside_a_paragraph_that_goes(spark):
    """P' (doc 5) goes as a near copy of P (doc 3); the sentence that only P' holds has to stay in doc 9."""
    stem = " ".join(f"stem{k}" for k in range(60)) + "."
    one, two = (f"{' '.join(f'tail{k}' for k in range(13))} {end}." for end in ("first", "second"))
    rows = [(3, f"{stem} {one}"), (5, f"{stem} {two}"), (9, f"A lead of its own. {two} An end."), (11, f"Another lead. {two} Another end.")]
    found = paragraphs.repeated_passages(documents(spark, rows)).collect()
    assert {r.doc_id: r.kept for r in found if r.level == "paragraph"} == {3: True, 5: False}
    for component in {r.component_id for r in found}:
        assert sum(r.kept for r in found if r.component_id == component and r.level == "paragraph") <= 1
        assert any(r.kept for r in found if r.component_id == component)
    left = {r.doc_id: r.text for r in paragraphs.drop_repeats(documents(spark, rows)).collect()}
    assert left[5] == "" and two in left[9] and two not in left[11] and stem in left[3]


def span_brute(rows):
    """What is left of texts without repeated paragraphs and sentences, over all word positions."""
    words = {d: [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\S+", t)] for d, t in rows}
    first = {}
    for d in sorted(words):
        for k in range(len(words[d]) - 49):
            first.setdefault(tuple(w for *_, w in words[d][k : k + 50]), d)
    out = []
    for d, t in rows:
        gone = set()
        for k in range(len(words[d]) - 49):
            if first[tuple(w for *_, w in words[d][k : k + 50])] < d:
                gone.update(range(words[d][k][0], words[d][k + 49][1]))
        out.append((d, "".join(c for k, c in enumerate(t) if k not in gone)))
    return out


def test_spans_without_sentence_ends_are_brute_force(spark):
    rng, source = random.Random(9), [" ".join(f"wörd{k}x{n}" for n in range(400)) for k in range(6)]
    rows = [(k, s) for k, s in enumerate(source)]
    for k in range(30):
        own = [f"own{k}n{n}" for n in range(120)]
        for size in rng.choices([30, 49, 50, 51, 59, 90, 200], k=2):
            at, words = rng.randrange(200), rng.choice(source).split(" ")
            own[rng.randrange(len(own)) : 0] = ["  ".join(words[at : at + size]).upper().replace("Ö", "ö")]
        rows.append((10 + k, " ".join(own)))
    docs = documents(spark, rows, clash=True)
    left = tuples(paragraphs.drop_repeats(docs), "doc_id", "text")
    assert left == sorted(span_brute(rows), key=repr) and left != sorted(rows, key=repr)
    found = paragraphs.repeated_text(docs).collect()
    assert {r.level for r in found} == {"span"}
    assert all(any(r.kept for r in found if r.component_id == c) for c in {r.component_id for r in found})


def test_passages_of_short_sentences_and_of_scripts_without_blanks_are_found(spark):
    """No sentence has ten words, and a line without blanks is one; what is shared has 60 words and 80 characters."""
    rng = random.Random(4)
    short = " ".join(" ".join(f"w{k}x{n}" for n in range(6 + k % 4)) + "." for k in range(8))
    wide = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(80))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(80))
    lead = " ".join(f"Own {k} lead." for k in range(20))
    rows = [(1, f"Start one. {short} End one."), (2, f"abc{wide}def"), (3, f"x{thai} y"), (4, f"{lead} {short} And so on."), (5, f"中{wide}文 z"), (6, f"ก ข{thai}é")]
    left = {r.doc_id: r.text for r in paragraphs.drop_repeats(documents(spark, rows)).collect()}
    assert [left[k] for k in (1, 2, 3)] == [t for _, t in rows[:3]]
    assert short not in left[4] and left[4].split() == f"{lead} And so on.".split()
    assert left[5].replace("中", "").replace("文", "") == " z" and left[6] == "ก ขé"


def test_passages_give_places_in_the_text():
    text = "Not long.\nThis one has a good ten words and then some more. Short. And this sentence is as long as the first one was."
    for _, a, b, words in paragraphs.passages(text):
        assert text[a:b].encode().lower().split() == words
    assert [p[0] for p in paragraphs.passages(text)] == [paragraphs.PARAGRAPH, paragraphs.SENTENCE, paragraphs.SENTENCE]


def test_bands_find_pairs_at_the_least_similarity():
    """Recall of the bands alone, over pairs with a similarity of just 0.8."""
    rng, hits = random.Random(1), 0
    for trial in range(300):
        words = [b"%d" % rng.randrange(10**9) for _ in range(58)]
        other = words[:48] + [b"%d" % rng.randrange(10**9) for _ in range(6)]
        one, two = paragraphs.band_hashes([words[:54], other])
        sets = [set(paragraphs.sketch(w)[0].tolist()) for w in (words[:54], other)]
        assert 0.75 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) <= 0.81
        hits += bool((one == two).any())
    assert hits >= 0.97 * 300


def test_sketches_never_differ_more_than_the_sets():
    rng = random.Random(2)
    for _ in range(200):
        one = [b"%d" % rng.randrange(200) for _ in range(rng.randint(5, 400))]
        two = [w if rng.random() < 0.9 else b"x%d" % rng.randrange(50) for w in one][: rng.randint(5, 400)]
        (a, x), (b, y) = paragraphs.sketch(one), paragraphs.sketch(two)
        assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_drop_repeats_cuts_all_but_the_earliest(spark):
    rows = repeats(5) + [(1000 + k if d is not None else None, t) for k, (d, t) in enumerate(AWKWARD)]
    docs = documents(spark, rows, clash=True).withColumn("n_chars", F.char_length("text").cast("long"))
    out = paragraphs.drop_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    gone = {}
    for d, _, a, b, _, kept in brute(rows):
        if not kept:
            gone.setdefault(d, set()).update(range(a, b))
    wanted = [(d, t if t is None else "".join(c for k, c in enumerate(t) if k not in gone.get(d, ()))) for d, t in rows]
    assert tuples(out, "doc_id", "text") == sorted(wanted, key=repr)
    assert out.where("n_chars <> char_length(text)").count() == 0


def test_pipeline_stages_work_on_what_is_left(spark, tmp_path):
    rows = repeats(7) + [(500, repeats(7)[3][1] + " x"), (501, None), (502, "")]
    docs = spark.createDataFrame([(d, t, "en", "src", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(d, 0, d % 9 == 0) for d, _ in rows], "doc_id long, quality int, toxic boolean").selectExpr("doc_id", "quality", "cast(toxic as int) toxic")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, left, str(tmp_path))
        assert after.columns == docs.columns, name
        left = spark.createDataFrame(after.collect(), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path))
    whole = corpus_pipeline.run(spark, str(tmp_path))
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in left.collect()}
    assert whole.agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()
    assert set(columns) < set(whole.columns)


def test_rows_that_share_an_id_lose_their_own_passages_only(spark):
    docs = documents(spark, SHARED_IDS, clash=True)
    rows = [t for _, t in SHARED_IDS]
    left = tuples(paragraphs.drop_repeats(docs), "doc_id", "text")
    assert left == sorted([(1, SAID), (7, rows[1].replace(SAID, "")), (7, rows[2]), (None, ""), (None, rows[4]), (8, rows[5])], key=repr)
    for stage in (paragraphs.drop_repeats, paragraphs.repeated_text):
        assert stage(docs.where("false")).count() == 0


def test_texts_laid_end_to_end_hash_as_each_alone():
    """Windows of a batch, cut into slices or not, are those of its texts one by one; null and short texts have none."""
    rng = random.Random(4)
    words = ["Alpha", "bÉta", "x", "wörd", "ไทย", "漢字", "tail."]
    texts = [None, "", "short"] + [rng.choice(" \n\t").join(rng.choice(words) for _ in range(rng.randint(40, 300))) for _ in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]).slice(1)
    own = spans._Texts(batch.column(0))
    assert set(own.text.tolist()).isdisjoint({0, 1})
    for k in range(len(batch)):
        alone = spans._Texts(batch.column(0).slice(k, 1))
        assert own.prints[own.text == k].tolist() == alone.prints.tolist() if len(alone.at) else not (own.text == k).any()
        assert len(alone.at) == max(len(alone.starts) - spans.SPAN_WORDS + 1, 0)


def test_the_driver_gets_each_part_of_a_bitmap_once(spark):
    spots = spark.range(0, 1 << 26, 997).withColumnRenamed("id", "spot").repartition(6)
    marked = spots.repartition(8, F.floor(F.col("spot") / spans._PART_BITS)).mapInArrow(spans._mark, "part int, bits binary")
    assert sorted(r.part for r in marked.select("part").collect()) == list(range(8))
    bits = np.unpackbits(np.frombuffer(spans._bitmap(spots), dtype=np.uint8), bitorder="little")
    assert np.array_equal(np.flatnonzero(bits), np.arange(0, 1 << 26, 997))


def plain_passages(text):
    """Paragraphs and sentences by splitting, ``(level, start, stop, words)``."""
    at = 0
    for line in text.split("\n"):
        if len(line.encode().split()) >= 10:
            yield 0, at, at + len(line), line.encode().lower().split()
            ends = [0, *(m.end() for m in re.finditer(r"(?<=[.!?])[ \t]+", line)), len(line)]
            for a, b in zip(ends, ends[1:]):
                if len(ends) > 2 and len(line[a:b].encode().split()) >= 10:
                    yield 1, at + a, at + b, line[a:b].encode().lower().split()
        at += len(line) + 1


def test_units_of_texts_laid_end_to_end_are_those_of_each_alone():
    rng = random.Random(6)
    bits = ["a", "B", "wörd", "x.", "y!", "é?", "漢字", " ", "\t", "\n", "\r\n", " \x0b", ". ", "… ", "😀", "\xa0", "."]
    texts = ["", "x", ". a b c d e f g h i j. "] + ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.choice([1, 30, 200]))) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(len(texts))]), pa.array([None, *texts])], names=["doc_id", "text"]).slice(1)
    found = [tuple(r.values()) for part in paragraphs._find(iter([batch])) for r in part.to_pylist()]
    wanted = [(d, level, a, b) for d, t in enumerate(texts) for level, a, b, _ in plain_passages(t)]
    assert sorted(r[:4] for r in found) == sorted(wanted) and len(wanted) > 100
    keys = {r[:4]: r[5:7] for r in found}
    words = {(d, level, a, b): tuple(w) for d, t in enumerate(texts) for level, a, b, w in plain_passages(t)}
    assert len(set(keys.values())) == len(set(words.values()))
    own = [r for r in found if r[1] == paragraphs.PARAGRAPH]
    assert paragraphs.band_hashes([list(words[r[:4]]) for r in own]).tolist() == [list(r[7:]) for r in own]


def test_only_bands_that_the_bitmap_names_travel():
    codes, bands = np.arange(50), np.random.default_rng(3).integers(0, 2**62, (50, paragraphs.BANDS))
    bits = np.zeros(spans.BITMAP_BITS // 8, dtype=np.uint8)
    for hash_ in bands[7, :2]:
        spot = int(hash_) & (spans.BITMAP_BITS - 1)
        bits[spot >> 3] |= 1 << (spot & 7)
    batch = pa.RecordBatch.from_arrays([pa.array(codes), *map(pa.array, bands.T)], names=["code", *paragraphs._BAND_NAMES])
    rows = [tuple(r.values()) for b in paragraphs._shared(bits.tobytes())(iter([batch])) for r in b.to_pylist()]
    assert rows == [(7, k, int(bands[7, k])) for k in range(2)]
