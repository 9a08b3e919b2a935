import hashlib
import random
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarterdeck.llm import bpe, packing, wavelet
from quarterdeck.llm.units import UnitEncoder, encoder
from tests.llm.helpers import AWKWARD, documents, prose, tuples

PARTS = ["a", "B", " ", "  ", "\n", ".", ",", "'s", "'", "é", "É", "J̌", "中", "文", "1", "23", "\t", "\x1c", "\x1f", "<|endoftext|>"]
PARTS += ["<|startoftext|>", "<|", "|>", "😀", "ß", "İ", "word", " the", "Ünd", "\r\n", "...", "!", "́", "ñ", "​", " ", " ", "à "]


@cache
def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


KINDS = [("byte_bpe_50k.json", UnitEncoder, True), ("byte_bpe_50k.json", bpe.ForcedEncoder, True), ("word_bpe_49k.json", UnitEncoder, False)]


def encoded(codec, texts):
    return [x.tolist() for _, ids, ends in codec.encode(pa.array(texts, pa.string())) for x in np.split(ids, ends[:-1])]


@pytest.mark.parametrize("name, kind, leading", KINDS)
def test_encoders_equal_the_library_on_random_mixtures(name, kind, leading):
    rng, codec, own = random.Random(1), encoder(kind, name, leading), library(name)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(3000)] + [None, ""]
    texts += [t for _, t in AWKWARD] + [t for _, t in prose(2, 50)]
    assert encoded(codec, texts) == [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoded(codec, texts[:50]) == [own.encode(t or "", add_special_tokens=False).ids for t in texts[:50]]


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
@pytest.mark.parametrize("name, kind, leading", KINDS)
def test_encoders_equal_the_library_on_any_text(name, kind, leading, text):
    assert encoded(encoder(kind, name, leading), [text]) == [library(name).encode(text, add_special_tokens=False).ids]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("quarterdeck.llm.units.CACHE_BYTES", 100)
    codec = UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"), True)
    own = library("byte_bpe_50k.json")
    for seed in range(3):
        texts = [t for _, t in prose(seed, 10)]
        assert encoded(codec, texts) == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_forced_pairs_stand_in_no_token():
    codec = encoder(bpe.ForcedEncoder, "byte_bpe_50k.json", True)
    for token in codec.token_bytes:
        assert not any(codec.forced[a, b] for a, b in zip(token, token[1:])) or token in {s.encode() for s in codec.specials}


def test_bpe_digests_and_round_trip(spark):
    rows = AWKWARD + [(50, "a<|endoftext|> b"), (51, "x � y")]
    docs, own = documents(spark, rows, clash=True), library("byte_bpe_50k.json")
    wanted = []
    for d, t in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        decoded = own.decode(ids, skip_special_tokens=False)
        wanted.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert tuples(bpe.encoded_digests(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(wanted, key=repr)
    assert tuples(bpe.decode(bpe.encode(docs)), "doc_id", "text") == sorted(((d, t or "") for d, t in rows), key=repr)
    assert bpe.encoded_digests(documents(spark, [])).count() == 0


@pytest.mark.parametrize("size, top", [(0, 1), (1, 1), (63, 2), (64, 300), (5000, 50000), (4097, 3)])
def test_wavelet_matrix_reads_counts_and_finds(size, top):
    ids = np.random.default_rng(size).integers(0, top, size).astype(np.uint16)
    file = wavelet.write_shard([7, None], [size // 2, size - size // 2], ids)
    docs, lengths, matrix = wavelet.read_shard(file)
    assert docs == [7, None] and lengths.tolist() == [size // 2, size - size // 2]
    assert matrix.decode().tolist() == ids.tolist()
    assert matrix.access(np.arange(size)).tolist() == ids.tolist()
    for token in {0, 1, top - 1, top + 70000, *ids[:5].tolist()}:
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert matrix.occurrences(token).tolist() == places.tolist()
        low, high = size // 4, size // 2
        assert matrix.count(token, low, high) == int(((places >= low) & (places < high)).sum())
        assert matrix.occurrences(token, low, high).tolist() == [p for p in places.tolist() if low <= p < high]


@pytest.mark.parametrize("shard_tokens", [1, 50, 1 << 20])
def test_wavelet_shards_keep_order(spark, shard_tokens):
    rows = [r for r in AWKWARD if r[0] is not None] + [(500 + d, t) for d, t in prose(9, 40)] + [(-100, "first")]
    own, at, wanted = library("byte_bpe_50k.json"), 0, []
    for d, t in sorted(rows, key=lambda r: r[0]):
        ids = own.encode(t or "", add_special_tokens=False).ids + [wavelet.END_ID]
        wanted.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = wavelet.round_trip(documents(spark, rows, clash=True), shard_tokens=shard_tokens)
    assert tuples(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(wanted, key=repr)
    assert wavelet.round_trip(documents(spark, [])).count() == 0


@pytest.mark.parametrize("window, shard_docs", [(64, 8), (16, 1024), (2048, 1024)])
def test_packing_places_every_id_once(spark, window, shard_docs):
    rows = [(d, t) for d, t in AWKWARD[:9]] + [(100 + d, t) for d, t in prose(11, 60)]
    own = library("word_bpe_49k.json")
    ids = {d: own.encode(t or "", add_special_tokens=False).ids + [packing.END_ID] for d, t in rows}
    pieces = packing.pack(documents(spark, rows, clash=True), window=window, shard_docs=shard_docs).collect()
    at, sequences = dict.fromkeys(ids, 0), {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == at[p.doc_id] and p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
        at[p.doc_id] += p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert at == {d: len(x) for d, x in ids.items()}
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= window and (end == window or end & (end - 1) == 0)
    assert packing.pack(documents(spark, [])).count() == 0


def test_packing_puts_related_texts_together(spark):
    """Two vocabularies, one window each: neighbours come before whatever is next."""
    rng = random.Random(1)
    sides = [["tiger", "jungle", "river", "monkey", "parrot"], ["engine", "piston", "valve", "gasket", "torque"]]
    shard = []
    own = library("word_bpe_49k.json")
    for k in range(8):
        text = " ".join(rng.choices(sides[k % 2], k=30))
        shard.append((k, 0, np.array(own.encode(text, add_special_tokens=False).ids, dtype=np.uint16), 0))
    size = sum(len(s[2]) for s in shard if s[0] % 2 == 0)
    seen = np.bincount(np.concatenate([np.unique(s[2]) for s in shard]), minlength=49408)
    packer = packing._Packer(0, size, np.log1p((8 - seen + 0.5) / (seen + 0.5)), 30.0)
    packer.pack(shard)
    packer.finish()
    first = {r[0] for r in packer.rows if r[5] == packer.rows[0][5]}
    assert first == {0, 2, 4, 6}


def test_index_scores_are_brute_force_bm25():
    """All terms of a seed, however many, over all remainders of the shard."""
    rng = np.random.default_rng(3)
    rests = [rng.integers(0, 300, n).astype(np.uint16) for n in (1, 7, 400, 90, 90, 250, 30)]
    seen = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=300)
    idf, mean = np.log1p((len(rests) - seen + 0.5) / (seen + 0.5)), sum(map(len, rests)) / len(rests)
    index = packing._Index(rests, idf, mean)
    for seed in [*rests, np.array([299, 299, 0], dtype=np.uint16)]:
        wanted = []
        for rest in rests:
            own = rest.tolist()
            norm = 1.2 * (1 - 0.75 + 0.75 * len(own) / mean)
            wanted.append(sum(idf[t] * own.count(t) * 2.2 / (own.count(t) + norm) for t in set(seed.tolist())))
        assert np.allclose(index.scores(seed), wanted)
