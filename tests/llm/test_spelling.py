import random
import re
import zlib
from collections import Counter

import pytest

from quarterdeck.llm import spelling
from tests.llm.helpers import AWKWARD, documents, prose, tuples

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def vocabulary(rows, least=3):
    seen = Counter()
    for d, t in rows:
        for run in RUN.findall(t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= least}


def one_edit(a, b):
    """By the table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] == 1


def brute(vocab):
    near = {w: [o for o in vocab if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in vocab}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-vocab[o], o), default=None)
        forms[w] = best if best is not None and vocab[best] >= 2 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, vocab[w], len(near[w]), vocab.get(forms[w])))
    return sorted(out, key=repr)


def corpus(seed):
    """Families of words around common ones, ties, chains, accents, long words."""
    rng, rows, letters = random.Random(seed), [], "abcdeéÿ×zZ"
    for _ in range(60):
        word = "".join(rng.choices(letters, k=rng.choice([4, 5, 6, 7, 9, 33, 50])))
        for n in (40, 20, 9, 4, 3):
            rows += [word] * rng.choice([n, 3, 1])
            at = rng.randrange(len(word) + 1)
            word = word[:at] + rng.choice(["", rng.choice(letters)]) + word[at + rng.randint(0, 1) :]
    rows += ["aaaaa"] * 5 + ["aaaaaa"] * 10 + ["aaaaaaa"] * 20 + ["aaaaaaaa"] * 40
    rng.shuffle(rows)
    return [(k, " ".join(rows[k::50]) + ".") for k in range(50)]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_are_brute_force(spark, seed):
    rows = corpus(seed) + AWKWARD + [(500 + d, t) for d, t in prose(seed, 40)]
    found = spelling.spelling_variants(documents(spark, rows, clash=True))
    assert found.columns == list(COLUMNS)
    assert tuples(found, *COLUMNS) == brute(vocabulary(rows))


def test_a_block_beyond_its_bound_is_cut(spark):
    """Hundreds of words that differ in the same place, in parts of a few words."""
    words = [f"stem{a}{b}end" for a in "abcdefghijklmno" for b in "abcdefghijkmé"] + [f"stem{a}end" for a in "abcdefg"]
    rows = [(k, " ".join(w for i, w in enumerate(words) for _ in range(1 + (i * k) % 3))) for k in range(4)]
    table = documents(spark, rows)
    vocab = vocabulary(rows)
    for bound in (10, 100):
        assert tuples(spelling.spelling_variants(table, block_words=bound), *COLUMNS) == brute(vocab)
    keys = spelling._keys(spelling.words(table))
    dealt = spelling._dealt(keys, 10).groupBy("longer", "first", "hole", "low", "high").count()
    assert dealt.agg({"count": "max"}).first()[0] <= 30


def test_blocks_reach_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = corpus(4)
        assert tuples(spelling.spelling_variants(documents(spark, rows)), *COLUMNS) == brute(vocabulary(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_very_long_words_are_compared_in_smaller_tiles(spark):
    base = "abcdefgh" * 25_000
    words = [base, base[:70_000] + base[70_001:], base[:-1] + "é", "x" + base, base[:5] + "z" + base[6:]]
    rows = [(k, " ".join(w for i, w in enumerate(words) for _ in range(3 if i else 9))) for k in range(1)]
    found = {r.word: r for r in spelling.spelling_variants(documents(spark, rows)).collect()}
    kept = vocabulary(rows)
    assert set(found) == set(kept) and len(kept) == 5
    assert found[base].n_near == 4 and all(r.form == base and r.n_near == 1 for w, r in found.items() if w != base)


def test_chains_reach_their_end(spark):
    forms = [(str(k), str(k + 1)) for k in range(40)] + [("x", "40")]
    found = spelling._roots(spark.createDataFrame(forms, "word string, form string"))
    assert {r.root for r in found.collect()} == {"40"} and found.count() == 41


def test_no_words(spark):
    assert spelling.spelling_variants(documents(spark, [])).count() == 0
    assert spelling.spelling_variants(documents(spark, [(1, None), (2, "1 2 3 four")])).count() == 0
