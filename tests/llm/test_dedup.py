import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from quarterdeck.llm.common import ROW, discard, freeing, staged, with_row_keys
from quarterdeck.llm.components import components
from quarterdeck.llm.exact_dedup import exact_dedup
from quarterdeck.llm.line_dedup import MIN_CHARS, drop_repeated_lines, line_dedup
from quarterdeck.llm.simhash import close_pairs, fingerprint, keep_one, simhash_components
from tests.llm.helpers import AWKWARD, LONG, SAID, SHARED_IDS, documents, groups_of, own_keys, prose, tuples


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(40)] + [(1000, k) for k in range(900, 960)] + [(5, 5), (None, 3)]
    links += [tuple(rng.sample(range(2000, 2100), 2)) for _ in range(60)] * 2
    found = dict(tuples(components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    real = [(a, b) for a, b in links if a is not None and a != b]
    wanted = groups_of(real, {n for link in real for n in link})
    assert found == {n: root for n, root in wanted.items() if n != root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def exact_brute(rows):
    white = re.compile(r"[\x20\x09-\x0D]")
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(white.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text in rows:
        body = white.sub("", text or "")
        keep = min(groups[body], key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out.append((doc_id, keep, len(groups[body]), doc_id == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("digest", [lambda t: F.sha2(t, 256), lambda t: F.lit("same"), lambda t: F.substring(t, 1, 1)])
def test_exact_dedup_whatever_the_digest(spark, digest):
    rows = AWKWARD + [(100 + k, "copy of many") for k in range(300)] + [(500, "co py of  many ")]
    assert tuples(exact_dedup(documents(spark, rows, clash=True), digest=digest), *EXACT) == exact_brute(rows)


def test_exact_dedup_without_ids(spark):
    rows = [(None, "same"), (None, "s a m e"), (3, "x"), (None, "x  "), (4, "y"), (None, "y")]
    assert tuples(exact_dedup(documents(spark, rows)), *EXACT) == exact_brute(rows)
    assert exact_dedup(documents(spark, [])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def line_brute(rows):
    lines = [(d, k, s.strip(" \t\r\x0b\x0c")) for d, t in rows for k, s in enumerate((t or "").split("\n"))]
    lines = sorted((x for x in lines if x[2]), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    out = []
    for d, k, line in lines:
        for other in lines:
            long = min(len(line), len(other[2])) >= MIN_CHARS
            if other[2] == line or long and abs(len(line) - len(other[2])) < 2 and distance(line, other[2]) <= 1:
                out.append((d, k, other[0], other[1], (other[0], other[1]) == (d, k)))
                break
    return sorted(out, key=repr)


LINES = ("doc_id", "line_no", "keep_doc_id", "keep_line_no", "kept")


def variants(seed):
    """Lines with insertions, deletions and substitutions everywhere, runs of one letter, and chains of edits."""
    rng = random.Random(seed)
    base = ["the quick brown fox jumps over", "a" * 25, "é" * 20 + "中", "exactly twenty chars", "nineteen characters"]
    rows = []
    for k in range(60):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            at, kind = rng.randrange(len(text)), rng.randrange(3)
            text[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice("ax 中")]
        rows.append((rng.randint(0, 20) * 2 + k * 100, "".join(text) + "\n\n" + rng.choice(base)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_is_brute_force(spark, seed):
    rows = variants(seed) + [r for r in AWKWARD if r[1] != LONG]
    assert tuples(line_dedup(documents(spark, rows, clash=True)), *LINES) == line_brute(rows)


def test_line_dedup_of_very_long_and_hot_lines(spark):
    rows = [(1, LONG), (2, LONG[:-1] + "!"), (3, LONG[:30000] + LONG[30001:])] + [(k, f"the same line for everyone {k % 7}") for k in range(10, 200)]
    found = {(r.doc_id): (r.keep_doc_id, r.kept) for r in line_dedup(documents(spark, rows)).collect()}
    assert found[1] == (1, True) and found[2] == (1, False) and found[3] == (1, False)
    assert all(found[k] == (10, k == 10) for k in range(10, 200))
    assert line_dedup(documents(spark, [])).count() == 0


def test_drop_repeated_lines_keeps_documents_and_columns(spark):
    rows = variants(4) + AWKWARD
    docs = documents(spark, rows, clash=True).withColumn("n_chars", F.char_length("text").cast("long"))
    out = drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    keyed, ids = own_keys(rows)
    gone = {(d, k) for d, k, _, _, kept in line_brute(keyed) if not kept}
    wanted = []
    for own, (d, t) in zip(ids, keyed):
        pieces = (t or "").split("\n")
        left = "\n".join(s for k, s in enumerate(pieces) if (d, k) not in gone)
        wanted.append((own, t if t is None or not any((d, k) in gone for k in range(len(pieces))) else left))
    assert tuples(out, "doc_id", "text") == sorted(wanted, key=repr)
    assert out.where("n_chars <> char_length(text)").count() == 0


def fingerprint_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(seed):
    rng, rows = random.Random(seed), []
    for k, text in prose(seed, 40, words=90):
        rows.append((k * 10, text))
        for n in range(rng.randint(0, 3)):
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            rows.append((k * 10 + n + 1, " ".join(words)))
    return rows


def test_simhash_components_are_brute_force(spark):
    rows = near_copies(5) + [r for r in AWKWARD if r[0] != 10] + [(900 + k, "x y") for k in range(200)]
    rows = [(d if d is None or d < 0 else d + 1000 * (r % 2), t) for r, (d, t) in enumerate(rows)]
    codes = {t: fingerprint_brute(t) for _, t in rows}
    assert all(fingerprint(t) == c for t, c in codes.items())
    distinct = sorted(set(codes.values()))
    links = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3]
    root = groups_of(links, distinct)
    least = {}
    for d, t in rows:
        if d is not None:
            r = root[codes[t]]
            least[r] = min(least.get(r, d), d)
    wanted = sorted(((d, f"{codes[t]:016x}", least.get(root[codes[t]])) for d, t in rows), key=repr)
    docs = documents(spark, rows, clash=True)
    assert tuples(simhash_components(docs), "doc_id", "fingerprint", "component_id") == wanted
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    # Of each component the row with the smallest id stays; rows that share or lack one come after all others.
    keyed, ids = own_keys(rows)
    of_id = {(d, f): c for d, f, c in wanted}
    best, stays = {}, []
    for own, (key, t) in zip(ids, keyed):
        root = of_id[own, f"{fingerprint_brute(t):016x}"]
        if root not in best or key < best[root][0]:
            best[root] = (key, own, t)
    assert tuples(kept, "doc_id", "text") == sorted(((own, t) for _, own, t in best.values()), key=repr)
    assert simhash_components(documents(spark, [])).count() == 0


def test_close_pairs_at_every_distance(spark):
    rng = random.Random(7)
    codes = set()
    for _ in range(60):
        code = rng.getrandbits(64)
        codes.add(code)
        for bits in range(1, 6):
            other = code
            for b in rng.sample(range(64), bits):
                other ^= 1 << b
            codes.add(other)
    signed = sorted(c - (1 << 64) if c >> 63 else c for c in codes)
    found = tuples(close_pairs(spark.createDataFrame([(c,) for c in signed], "code long")), "a", "b")
    mask = (1 << 64) - 1
    assert found == sorted(((a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3), key=repr)


def test_rows_that_share_an_id_lose_their_own_text_only(spark):
    docs = documents(spark, SHARED_IDS, clash=True)
    rows = [t for _, t in SHARED_IDS]
    lines = tuples(drop_repeated_lines(docs), "doc_id", "text")
    assert lines == sorted([(1, SAID), (7, rows[1].split("\n")[1]), (7, rows[2]), (None, ""), (None, rows[4]), (8, rows[5])], key=repr)
    # The copy without an id goes, the other rows of 7 and of none stay.
    assert tuples(keep_one(docs), "doc_id", "text") == sorted([r for k, r in enumerate(SHARED_IDS) if k != 3], key=repr)
    for stage in (drop_repeated_lines, keep_one):
        left = stage(docs.where("false"))
        assert left.count() == 0 and left.columns == docs.columns


def test_row_keys_are_one_rows_alone(spark):
    keyed = with_row_keys(documents(spark, SHARED_IDS)).collect()
    keys = [r[ROW] for r in keyed]
    assert len(set(keys)) == len(keys) and all(r[ROW] == r.doc_id for r in keyed if r.doc_id in (1, 8))
    assert all(r[ROW] > 8 for r in keyed if r.doc_id in (7, None))
    assert {r[ROW] for r in with_row_keys(documents(spark, [(5, "a"), (-3, None)])).collect()} == {5, -3}


def test_staged_tables_are_freed(spark):
    """A stage deletes what the one before it left, but not what its own input or anyone else still reads."""
    seen, other = [], staged(spark.range(3), "other")
    first = freeing(lambda s, docs, d: seen.append(staged(docs, "kept")) or seen[-1])
    second = freeing(lambda s, docs, d: docs)
    mine = first(spark, spark.range(5), "")
    assert second(spark, mine, "").count() == 5 and other.count() == 3
    second(spark, other, "")
    with pytest.raises(Exception):
        spark.read.schema(mine.schema).parquet(mine.inputFiles()[0].rsplit("/", 1)[0]).count()
    assert other.count() == 3
    discard(other)
    with pytest.raises(Exception):
        other.count()
