"""Token ids as characters.

A token sequence is held as a string with one character per token. Merging a pair is then a
plain string replacement, left to right and without overlap, which Spark has built in, and
the binary order of strings is the order of ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPECIAL_IDS = 5
_OFFSET = 0x100
_SURROGATES, _SURROGATE_COUNT = 0xD800, 0x800


def symbol(token_id: int) -> str:
    """The character that stands for a token id; surrogate code points are skipped."""
    point = token_id + _OFFSET
    return chr(point if point < _SURROGATES else point + _SURROGATE_COUNT)


def symbol_id(character: str) -> int:
    point = ord(character)
    return (point if point < _SURROGATES else point - _SURROGATE_COUNT) - _OFFSET


def _printable(byte: int) -> bool:
    # The byte ranges the published byte-level alphabet shows as they are.
    return 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255


def byte_order() -> list[int]:
    """The 256 bytes in id order: printable ones first, then the rest, each ascending."""
    return sorted(range(256), key=lambda b: (not _printable(b), b))


def byte_characters() -> dict[int, str]:
    """The visible character the byte-level alphabet shows for each byte."""
    hidden = [b for b in range(256) if not _printable(b)]
    shown = {b: chr(b) for b in range(256) if _printable(b)}
    return shown | {b: chr(256 + place) for place, b in enumerate(hidden)}


_BYTES_AS_TEXT = "".join(chr(b) for b in range(256))
_ID_OF_BYTE = {b: SPECIAL_IDS + place for place, b in enumerate(byte_order())}
_BYTE_SYMBOLS = "".join(symbol(_ID_OF_BYTE[b]) for b in range(256))


def byte_symbols(text: Column) -> Column:
    """The UTF-8 bytes of a text, one symbol each."""
    as_latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.translate(as_latin, _BYTES_AS_TEXT, _BYTE_SYMBOLS)


def symbols_of(text: str) -> str:
    """byte_symbols for a Python string."""
    return "".join(_BYTE_SYMBOLS[b] for b in text.encode("utf-8"))


def byte_ids(text: Column) -> Column:
    """The token ids of the UTF-8 bytes of a text."""
    empty = F.array().cast("array<int>")
    each = F.transform(F.split(byte_symbols(text), ""), lambda c: F.ascii(c) - _OFFSET)
    return F.when(text == "", empty).otherwise(each)


def symbol_ids(symbols: Column) -> Column:
    """The ids that a string of symbols stands for."""
    point = lambda c: F.ascii(c)
    skipped = lambda c: F.when(point(c) >= _SURROGATES, _SURROGATE_COUNT).otherwise(0)
    return F.transform(F.split(symbols, ""), lambda c: point(c) - skipped(c) - _OFFSET)


# Ids that have a character of one UTF-16 unit.
NARROW_IDS = 0x10000 - _SURROGATE_COUNT - _OFFSET


def symbol_pairs(symbols: Column, vocab_size: int) -> Column:
    """Neighbouring symbols as two-character strings."""
    if vocab_size <= NARROW_IDS:
        return F.regexp_extract_all(symbols, F.lit("(?s)(?=(..))"), F.lit(1))
    characters = F.split(symbols, "")
    inner = F.greatest(F.size(characters) - 1, F.lit(0))
    return F.zip_with(
        F.slice(characters, F.lit(1), inner),
        F.slice(characters, F.lit(2), inner),
        lambda left, right: F.concat(left, right),
    )


# Replacements chained in generated code; longer chains would make its methods too large.
# A short list is filled up, so that every round runs the code compiled for the first.
_CHAINED_MERGES = 24
_NO_MERGE = ("  ", " ")


def apply_merges(symbols: Column, merges: list[tuple[str, str]]) -> Column:
    """Replace pairs by their merged symbol, in the order of the list."""
    if not merges:
        return symbols
    if len(merges) <= _CHAINED_MERGES:
        for pair, merged in merges + [_NO_MERGE] * (_CHAINED_MERGES - len(merges)):
            symbols = F.replace(symbols, F.lit(pair), F.lit(merged))
        return symbols
    # Symbols are never blanks, so blanks can part the entries of one literal.
    packed = F.split(F.lit(" ".join(pair + merged for pair, merged in merges)), " ")
    return F.aggregate(
        packed,
        symbols,
        lambda text, merge: F.replace(text, F.left(merge, F.lit(2)), F.substring(merge, 3, 1)),
    )
