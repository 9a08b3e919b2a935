"""Text standardization as Spark expressions, one projection per call."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s knows ASCII blanks only, so the Unicode separators are named.
SPACE = r"\t\n\x0B\f\r\p{Z}"

# Letters and signs without a decomposition, with their ASCII form.
LATIN_ASCII = {
    "Æ": "AE", "Ð": "D", "Ø": "O", "Þ": "TH", "ß": "ss", "æ": "ae", "ð": "d", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q", "Ł": "L", "ł": "l", "Ŋ": "N",
    "ŋ": "n", "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "ſ": "s", "ƒ": "f", "ẞ": "SS",
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl",
    "\u00a0": " ", "©": "(C)", "«": "<<", "®": "(R)", "»": ">>", "¼": " 1/4", "½": " 1/2",
    "¾": " 3/4", "×": "*", "÷": "/",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-", "−": "-",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"',
    "‹": "<", "›": ">", "․": ".", "‥": "..", "…": "...", "⁄": "/",
}

# Latin letters beyond ASCII, and the full-width forms of ASCII.
_LETTERS = [*range(0x00C0, 0x0250), *range(0x0250, 0x02B0), *range(0x1D6B, 0x1D7A), *range(0x1E00, 0x1F00), *range(0x2C60, 0x2C80)]
_FULL_WIDTH = range(0xFF01, 0xFF5F)
_NAMED = re.compile(r"LATIN (CAPITAL|SMALL) LETTER ([A-Z]{1,2})( WITH .*)")


def _plain(letter: str) -> str | None:
    """ASCII form of a letter: its base letters if it is composed, else the letters that its Unicode name begins with."""
    parts = [c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)]
    plain = "".join(LATIN_ASCII.get(c, c) for c in parts)
    if parts and plain.isascii():
        return plain
    named = _NAMED.fullmatch(unicodedata.name(letter, ""))
    return named and (named[2] if named[1] == "CAPITAL" else named[2].lower())


def _folding_tables() -> tuple[str, str, dict[str, str]]:
    """One-to-one pairs for translate, and the longer replacements, from Unicode decompositions."""
    folded = dict(LATIN_ASCII)
    for letter in map(chr, [*_LETTERS, *_FULL_WIDTH]):
        plain = _plain(letter)
        if plain and letter not in folded:
            folded[letter] = plain
    single = {k: v for k, v in folded.items() if len(v) == 1}
    longer = {k: v for k, v in folded.items() if len(v) > 1}
    return "".join(single), "".join(single.values()), longer


FOLD_FROM, FOLD_TO, FOLD_LONGER = _folding_tables()


@dataclass(frozen=True)
class StandardizeOptions:
    rm_punct: bool = True
    rm_num: bool = False
    rm_space: bool = True
    to_ascii: bool = True
    to_upper: bool = True
    rm_html: bool = False
    trim: bool = True
    rm_special: bool = True


def to_ascii(text: Column, letters_only: bool = False) -> Column:
    """Fold Latin letters and common signs to ASCII. Pure ASCII text skips the character walk.

    ``letters_only`` says that signs and combining marks are gone already.
    """
    folded = F.translate(text, FOLD_FROM, FOLD_TO)
    for sign, plain in FOLD_LONGER.items():
        if not letters_only or sign.isalnum():
            folded = F.replace(folded, F.lit(sign), F.lit(plain))
    if not letters_only:
        folded = F.regexp_replace(folded, r"([A-Za-z0-9])\p{Mn}+", "$1")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)


def trim_all(text: Column) -> Column:
    """Strip Unicode white space at both ends."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def standardize_text(text: Column, options: StandardizeOptions = StandardizeOptions()) -> Column:
    """Standardize in a fixed order: tags, punctuation, numbers, signs, spaces, ASCII, case, trim.

    With punctuation, signs and extra spaces all removed (the default) the three passes are one: whatever
    is not a letter or number ends up as part of a single space.
    """
    o = options
    if o.rm_html:
        text = F.regexp_replace(text, "<[^>]*>", " ")
    if o.rm_punct and o.rm_special and o.rm_space:
        kept = r"\p{L}" if o.rm_num else r"\p{L}\p{N}"
        text = F.regexp_replace(text, f"[^{kept}]+", " ")
    else:
        if o.rm_punct:
            text = F.regexp_replace(text, r"\p{P}", " ")
        if o.rm_num:
            text = F.regexp_replace(text, r"\p{N}", " ")
        if o.rm_special:
            text = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{SPACE}]", " ")
        if o.rm_space:
            text = F.regexp_replace(text, rf"[{SPACE}]+", " ")
    if o.to_ascii:
        text = to_ascii(text, o.rm_punct and o.rm_special)
    if o.to_upper:
        text = F.upper(text)
    if o.trim:
        text = F.trim(text) if o.rm_space else trim_all(text)
    return text


def standardize_string(text: Column) -> Column:
    """Collapse blanks (and pipes, which the class holds too), fold to ASCII, trim."""
    text = F.regexp_replace(text, rf"[{SPACE}|]+", " ")
    return F.trim(to_ascii(text), F.lit(" \t\r\n"))
