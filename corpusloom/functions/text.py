"""Text column functions: whitespace, byte symbols and pre-tokenization."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip removes, as a regex class body.
STRIP_CLASS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# The characters a Unicode regex \s matches (no U+001C to U+001F).
SPACE_CLASS = (
    r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# The published byte-level pre-tokenization pattern, \s and \S written out. Letters, which
# begin no other branch, are tried first, and runs that nothing follows give nothing back: the same words.
PRETOKEN_PATTERN = (
    r" ?\p{L}++"
    r"|'(?:s|t|re|ve|m|ll|d)| ?\p{N}++"
    rf"| ?[^{SPACE_CLASS}\p{{L}}\p{{N}}]++"
    rf"|[{SPACE_CLASS}]+(?![^{SPACE_CLASS}])|[{SPACE_CLASS}]++"
)


def _class_members(body: str) -> str:
    """The characters a class body of hex code points and ranges stands for."""
    points = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: chr(int(m.group(1), 16)), body)
    ranges = re.findall(r"(.)-(.)|(.)", points, flags=re.DOTALL)
    return "".join(
        chr(c) for low, high, one in ranges for c in range(ord(low or one), ord(high or one) + 1)
    )


_STRIP_CHARACTERS = _class_members(STRIP_CLASS)


def strip_unicode(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(_STRIP_CHARACTERS))


def not_blank(text: Column) -> Column:
    """True where the text holds a character that is not whitespace; null stays null."""
    return text.rlike(f"[^{STRIP_CLASS}]")


def literal_pattern(tokens: Iterable[str]) -> str:
    """A regex that matches any of the tokens literally, the longest first."""
    ordered = sorted(set(tokens), key=lambda t: (-len(t), t))
    return "|".join("\\Q" + t.replace("\\E", "\\E\\\\E\\Q") + "\\E" for t in ordered)


def pretokenize(text: Column) -> Column:
    """Cut a text into words; joined together they give the text back."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def pretokenize_around(text: Column, specials: Iterable[str]) -> Column:
    """Words of a text in which special tokens stay whole and bound their neighbours."""
    specials = tuple(specials)
    if not specials:
        return pretokenize(text)
    pattern = literal_pattern(specials)
    plain = F.split(text, pattern, -1)
    marks = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    no_words = F.array().cast("array<string>")
    return F.flatten(
        F.zip_with(
            plain,
            marks,
            lambda segment, mark: F.concat(
                pretokenize(segment),
                F.when(mark.isNull(), no_words).otherwise(F.array(mark)),
            ),
        )
    )


def utf8_hex_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a text as two-digit hex symbols."""
    return F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit(".."), F.lit(0))


def adjacent_pairs(symbols: Column) -> Column:
    """The neighbouring pairs of an array, as an array of (left, right) structs."""
    inner = F.greatest(F.size(symbols) - 1, F.lit(0))
    return F.zip_with(
        F.slice(symbols, F.lit(1), inner),
        F.slice(symbols, F.lit(2), inner),
        lambda left, right: F.struct(left.alias("left"), right.alias("right")),
    )
