"""Measures of one text, each computed when it is first asked for.

Words are the runs between the characters U+0020 and U+0009 to U+000D, which is what
`bytes.split` cuts at. All measures read the whole text.
"""

from __future__ import annotations

from collections import Counter
from functools import cached_property

SPACES = " \t\n\x0b\x0c\r"
# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"


class TextView:
    """A text and its lazily computed measures; null counts as the empty text."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """The lines, parted by line feeds, that hold a word."""
        return [x for x in self.text.split("\n") if x.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside any three-word window that occurs at least twice in the text."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:], strict=False))
        counts = Counter(windows)
        if len(counts) == len(windows):
            return 0
        covered = reached = 0
        for at, window in enumerate(windows):
            if counts[window] > 1:
                covered += at + 3 - max(at, reached)
                reached = at + 3
        return covered

    @cached_property
    def letters(self) -> str:
        return "".join(filter(str.isalpha, self.text))

    @cached_property
    def n_letters(self) -> int:
        return len(self.letters)

    @cached_property
    def n_upper(self) -> int:
        return sum(map(str.isupper, self.letters))

    @cached_property
    def n_digits(self) -> int:
        return sum(map(str.isdigit, self.text))

    @cached_property
    def distinct_words(self) -> int:
        return len(set(self.words))

    @cached_property
    def word_ends(self) -> int:
        """Words that end a sentence or a clause."""
        return sum(map(self.text.count, (".", ",", "!", "?", ";", ":")))

    def share(self, part: int, whole: int) -> float:
        return part / whole if whole else 0.0
