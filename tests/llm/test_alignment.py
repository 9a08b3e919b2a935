import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from quarterdeck.llm import alignment
from quarterdeck.llm.bpe import _byte_letters
from quarterdeck.llm.units import encoder
from tests.llm.helpers import AWKWARD, documents, prose, tuples

PARTS = ["a", "B", " ", "  ", "\n", ".", "'s", "é", "中", "文", "23", "\t", "\x1f", "<|endoftext|>", "<|", "|>", "😀", "▁", "<0x41>", "word", " the", "\x00", "<s>", "ﬁ"]
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def sides(text, first, second, letters):
    """``(id, bytes)`` of both sides by the libraries alone, or nothing."""
    if not text:
        return [], []
    goal = b" " + text.encode()
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    return (a, b) if b"".join(x for _, x in a) == goal == b"".join(x for _, x in b) else ([], [])


def brute(rows):
    first, second = Tokenizer.from_file(public_tokenizers.path(alignment.FIRST)), SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))
    first.encode_special_tokens = True
    letters = {c: k for k, c in enumerate(_byte_letters())}
    texts, counts = [], Counter()
    for d, t in rows:
        a, b = sides(t, first, second, letters)
        ranges = []
        for side in (a, b):
            at, own = 0, []
            for i, spelt in side:
                own.append((i, at, at + len(spelt)))
                at += len(spelt)
            ranges.append(own)
        links = [(i, j) for i, s, e in ranges[0] for j, u, v in ranges[1] if max(s, u) < min(e, v)]
        counts.update(links)
        ends, groups, at = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]}), [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, _, e in own if at < e <= end) for own in ranges))
            at = end
        texts.append((d, len(a), len(b), groups, links))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for d, n_a, n_b, groups, links in texts:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((d, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_bytes", [40, 1 << 20])
def test_alignment_is_brute_force(spark, slice_bytes):
    rng = random.Random(5)
    rows = [(d, t if t is None else t[:3000]) for d, t in AWKWARD]
    rows += [(100 + d, t) for d, t in prose(3, 25, words=30)] + [(300 + k, "".join(rng.choices(PARTS, k=rng.randint(0, 25)))) for k in range(120)]
    found = alignment.aligned_counts(documents(spark, rows, clash=True), slice_bytes=slice_bytes)
    assert found.columns == list(COLUMNS)
    assert tuples(found, *COLUMNS) == brute(rows)


def test_alignment_of_no_rows_and_of_texts_without_tokens(spark):
    assert alignment.aligned_counts(documents(spark, [])).count() == 0
    rows = [(1, None), (2, ""), (None, None), (3, "a ▁ b")]
    assert tuples(alignment.aligned_counts(documents(spark, rows)), *COLUMNS) == brute(rows)


def test_pointers_reach_the_end_of_long_components():
    """Sides that only meet at the end make one chain through all tokens."""
    a, b = np.arange(2, 20001, 2), np.append(np.arange(1, 19999, 2), 20000)
    assert set(alignment.terminals(a, b).tolist()) == {len(a) + len(b) - 1}


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(alignment, "_STRETCH", 50)
    codec, own = encoder(alignment.PieceEncoder, alignment.SECOND, True), SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SECOND))
    rng = random.Random(2)
    texts = ["".join(rng.choices(PARTS + ["  ", " a", "▁ "], k=200)) for _ in range(100)] + [" " * 300, "x" * 300, "ab " * 60, "ab  " * 60]
    ids, counts = alignment._all(codec, pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == own.encode(texts)
