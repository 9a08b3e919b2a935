"""BPE encoding and decoding with forced boundaries.

A merge only ever makes a token of the vocabulary, so between two bytes that stand side by side in no token, every
encoding has a cut. The table of such pairs follows from the vocabulary. It cuts a text in two steps: before blanks and
punctuation, where the pre-tokenizer too always ends a piece, into units, and the pieces of a unit at all other
forced pairs into fragments. Fragments are encoded independently and each distinct one once; their ids are
concatenated. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.units import UnitEncoder, encoder, gather

VOCABULARY = "byte_bpe_50k.json"
_BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_WHITE = "".join(sorted(_BLANKS))
#: The pattern of byte-level pre-tokenization, with the white space of Unicode spelt out.
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_LATIN = regex.compile("[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-ɏ]*")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte.

    Printable bytes of Latin-1 stand for themselves, the others for the letters from U+0100 on, in order.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class ForcedEncoder(UnitEncoder):
    """A ``UnitEncoder`` whose units go through forced cuts instead of the tokenizer's own pipeline."""

    def __init__(self, path: str, leading_space: bool = True):
        super().__init__(path, leading_space)
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        letters = _byte_letters()
        self.letters = np.array([ord(c) for c in letters], dtype=np.uint32)
        of_letter = {c: b for b, c in enumerate(letters)}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(of_letter[c] for c in token)
        for content, i in self.specials.items():
            self.token_bytes[i] = content.encode()
        self.byte_lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.byte_store = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)

        inside = np.zeros((256, 256), dtype=bool)
        for token in vocab:
            spelt = [of_letter[c] for c in token]
            inside[spelt[:-1], spelt[1:]] = True
        self.forced = ~inside
        # Units end where these pairs meet. With a vocabulary in which they are not forced, texts stay whole. A byte
        # that may end a blank beyond ASCII is left out: units end only after other characters, so pre-tokenization decides.
        blanks = {c.encode()[-1] for c in _BLANKS}
        ends = np.array([b for b in range(256) if b not in blanks])
        self.units_forced = bool(self.forced[ends, 0x20].all() and self.forced[ends, 0x0A].all())
        self.bare = Tokenizer.from_file(path)
        self.bare.no_truncation()
        self.bare.no_padding()
        self.bare.normalizer, self.bare.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.Sequence([])
        self.pre_tokenizer = self.tokenizer.pre_tokenizer

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        if self.units_forced:
            return super()._cut(texts)
        return pa.array([""] * len(texts), pa.large_string()), pa.array([True] * len(texts))

    def _pieces(self, unit: str) -> list[str]:
        if _LATIN.fullmatch(unit):
            return _PIECES.findall(unit)
        # Other scripts: the tokenizer's own tables decide what is a letter.
        return [unit[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(unit)]

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, piece_counts = [], np.empty(len(units), dtype=np.int64)
        for k, unit in enumerate(units):
            found = self._pieces(unit)
            piece_counts[k] = len(found)
            pieces += found
        ids, lengths = self._encode_pieces(pieces)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(piece_counts)])])

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        encoded = [p.encode() for p in pieces]
        sizes = np.array([len(p) for p in encoded], dtype=np.int64)
        flat = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        begins = np.zeros(len(flat) + 1, dtype=bool)
        begins[np.cumsum(sizes) - sizes] = True
        begins[1:-1] |= self.forced[flat[:-1], flat[1:]]
        at = np.flatnonzero(begins[: len(flat)])
        # Each byte as its letter, so that fragments are strings of the vocabulary's alphabet.
        spelt = self.letters[flat].tobytes().decode("utf-32-le")
        bounds = [*at.tolist(), len(flat)]
        fragments = pa.array([spelt[a:b] for a, b in zip(bounds, bounds[1:])], pa.large_string()).dictionary_encode()
        ids, lengths = self._encode_fragments(fragments.dictionary.to_pylist())
        which = fragments.indices.to_numpy()
        per_fragment = lengths[which]
        ids = gather(ids, (np.cumsum(lengths) - lengths)[which], per_fragment)
        first = np.searchsorted(at, np.concatenate([[0], np.cumsum(sizes)]))
        return ids, np.diff(np.concatenate([[0], np.cumsum(per_fragment)])[first])

    def _encode_fragments(self, fragments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = [self.separator.join([*fragments[k : k + 2000], ""]) for k in range(0, len(fragments), 2000)]
        encoded = self.bare.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, self.dtype), *(np.asarray(e.ids, dtype=self.dtype) for e in encoded)])
        parted = np.flatnonzero(ids == self.separator_id)
        return np.delete(ids, parted), np.diff(parted, prepend=-1) - 1

    def _encode_whole(self, text: str) -> np.ndarray:
        """Special tokens first, then each stretch between them as one unit."""
        out = []
        pattern = "|".join(regex.escape(c) for c in sorted(self.specials, key=len, reverse=True))
        for stretch in regex.split(f"({pattern})", text):
            if stretch in self.specials:
                out.append(np.array([self.specials[stretch]], dtype=self.dtype))
            elif stretch:
                out.append(self._encode_units([stretch])[0])
        return np.concatenate([np.zeros(0, self.dtype), *out])

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of the decoded text; bytes that are no UTF-8 become replacement characters."""
        spelt = gather(self.byte_store, self.byte_starts[ids], self.byte_lengths[ids]).tobytes()
        return spelt.decode("utf-8", "replace").encode()


def _digests(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ForcedEncoder, name, True)
        for batch in batches:
            for first, ids, ends in bpe.encode(batch.column(1)):
                each = np.split(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(each)),
                        pa.array([len(x) for x in each], pa.int64()),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]),
                        pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in each]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def encoded_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Every whole text is encoded and decoded again. A null text counts as empty, an empty one has no ids; a special
    token's string in a text is that token. Rows may repeat or lack a doc_id; other columns are not read; an empty table
    gives an empty result. ``vocabulary`` names a byte-level file of the tokenizers library, by name or path.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_digests(vocabulary), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ForcedEncoder, name, True)
        for batch in batches:
            for first, ids, ends in bpe.encode(batch.column(1)):
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(ends)), lists], names=["doc_id", "ids"])

    return run


def _texts(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(ForcedEncoder, name, True)
        for batch in batches:
            texts = [None if x is None else bpe.decode(np.asarray(x, dtype=np.int64)).decode() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, ids array<int>)`` of every row; null and empty texts have no ids."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(_ids(vocabulary), "doc_id long, ids array<int>")


def decode(ids: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, text)`` of ``ids(doc_id, ids)``; null ids give a null text."""
    return ids.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(_texts(vocabulary), "doc_id long, text string")
