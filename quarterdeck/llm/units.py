"""Token ids of whole texts from a vocabulary file, with every distinct unit of text encoded once.

A unit is a piece of text between two places where the tokenizer's pre-tokenization ends a piece whatever stands on
either side, so the ids of a text are those of its units one after the other. Arrow finds the units of a batch and
numbers the distinct ones; only those not met before go through the tokenizer. Texts in which the places can't be
told by a plain pattern (runs of blanks, special tokens, combining marks) go through it whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_BYTES = 12 << 20  # of unit text with its offsets; beyond it what was met once is forgotten
_JOINED = 2000  # units handed over in one text
_SLICE_BYTES = 8 << 20  # of text handled at once
_MARK = "\x1f"
#: Letters in every version of Unicode, so that all regex engines agree on them, that stay one letter in lower case.
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; only a name, so tasks find the file on their own machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def gather(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``store`` given by starts and lengths, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return store[:0]
    return store[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class UnitEncoder:
    """Encodes like ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.

    Truncation and padding are off. ``leading_space``: a blank belongs to the word after it (byte-level vocabularies);
    else white space is dropped and case folded (vocabularies with word ends).
    """

    def __init__(self, path: str, leading_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leading_space = leading_space
        self.specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.separator, self.separator_id = next(iter(self.specials.items()))
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._start()

    def _start(self) -> None:
        self.units = pa.array([], pa.large_string())
        self.lengths, self.met_again = np.zeros(0, np.int64), np.zeros(0, bool)
        self.store = np.zeros(0, self.dtype)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def _forget(self) -> None:
        """Drop the units that weren't met again since they came in or were last kept: most of them occur once."""
        kept = self.met_again
        self.store = gather(self.store, self.starts[kept], self.lengths[kept])
        self.units, self.lengths = self.units.filter(pa.array(kept)), self.lengths[kept]
        self.met_again = np.zeros(len(self.lengths), bool)
        if self.units.nbytes > CACHE_BYTES // 2:
            self.units, self.lengths, self.met_again, self.store = self.units[:0], self.lengths[:0], self.met_again[:0], self.store[:0]

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """``texts`` with marks between the units, and which texts have to be encoded whole."""
        whole = pc.match_substring(texts, "<|")
        for content in self.specials:
            if "<|" not in content:
                whole = pc.or_(whole, pc.match_substring(texts, content))
        whole = pc.or_(whole, pc.match_substring(texts, _MARK))
        if self.leading_space:
            whole = pc.or_(whole, pc.match_substring_regex(texts, f"[{_SPACE}] "))
            cut = pc.replace_substring(texts, " ", f"{_MARK} ")
            cut = pc.replace_substring_regex(cut, f"([{_LETTER}])([.,])([{_MARK}\n])", rf"\1{_MARK}\2\3")
            cut = pc.replace_substring_regex(cut, f"([{_LETTER}.,])\n([{_LETTER}])", rf"\1{_MARK}" + "\n" + rf"{_MARK}\2")
        else:
            # Case is folded after composition, so a mark on a capital letter must be left to the tokenizer.
            whole = pc.or_(whole, pc.match_substring_regex(texts, r"[\x{300}-\x{36F}]"))
            cut = pc.replace_substring_regex(pc.ascii_lower(texts), "[ \t\n\r]+", _MARK)
            cut = pc.replace_substring_regex(cut, f"([{_LETTER}])([.,]){_MARK}", rf"\1{_MARK}\2{_MARK}")
        return pc.if_else(whole, "", cut), whole

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, and the length of each. Units hold no special token, so one can part them."""
        joined = [self.separator.join([*units[k : k + _JOINED], ""]) for k in range(0, len(units), _JOINED)]
        encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, dtype=self.dtype) for e in encoded])
        parted = np.flatnonzero(ids == self.separator_id)
        return np.delete(ids, parted), np.diff(parted, prepend=-1) - 1

    def _encode_whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _remember(self, units: pa.Array) -> None:
        ids, lengths = self._encode_units(units.to_pylist())
        self.lengths = np.concatenate([self.lengths, lengths])
        self.met_again = np.concatenate([self.met_again, np.zeros(len(lengths), bool)])
        self.store = np.concatenate([self.store, ids])
        self.units = pa.concat_arrays([self.units, units])

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of the batch: index of the first text, all ids, and the end of each text's ids. Null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        slices = np.cumsum(pc.binary_length(texts).to_numpy()) // _SLICE_BYTES
        firsts = np.flatnonzero(np.diff(slices, prepend=-1)).tolist()
        for first, last in zip(firsts, [*firsts[1:], len(texts)]):
            yield first, *self._encode_slice(texts.slice(first, last - first))
        pa.default_memory_pool().release_unused()

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut, whole = self._cut(texts)
        pieces = pc.split_pattern(cut, _MARK)
        coded = pieces.values.dictionary_encode()
        units = coded.dictionary.cast(pa.large_string())
        if self.units.nbytes > CACHE_BYTES:
            self._forget()
        known = pc.index_in(units, value_set=self.units)
        missing = known.is_null()
        numbers = pc.fill_null(known, -1).to_numpy().astype(np.int64)
        self.met_again[numbers[numbers >= 0]] = True
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = len(self.units) + np.arange(len(new))
            self._remember(units.filter(missing))
        numbers = numbers[coded.indices.to_numpy()]
        lengths = self.lengths[numbers]
        ids = gather(self.store, self.starts[numbers], lengths)
        ends = np.concatenate([[0], np.cumsum(lengths)])[pieces.offsets.to_numpy()[1:]]
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist()
        if odd:
            each = np.split(ids, ends[:-1])
            for k in odd:
                each[k] = self._encode_whole(texts[k].as_py())
            ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
        return ids, ends


_ENCODERS: dict[tuple, UnitEncoder] = {}


def encoder(kind: type[UnitEncoder], name: str, leading_space: bool) -> UnitEncoder:
    """One encoder per worker process and file, kept between tasks."""
    key = (kind.__name__, name)
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(vocabulary(name) if os.sep not in name else name, leading_space)
    return _ENCODERS[key]
