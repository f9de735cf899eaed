"""Token ids of long texts from the ids of their chunks, with a memory of chunks seen.

Byte-level pre-tokenization never puts the end of one word and the space before the next into
one piece. So a text may be cut before every space that stands between two characters that are
no white space, and the ids of the parts, joined, are the ids of the text. Chunks repeat, in
one text and across texts; a bounded memory saves most of the merging.

`ChunkMemory` takes one text after the other. `BatchEncoder` takes many at once: their chunks are
made distinct and cut into words and marks as Arrow columns, only words that are new go through
the library one by one, and the ids are put together as arrays.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks in either half of a memory. A full new half becomes the old one, whose chunks come
#: back when they are met again, so that frequent ones stay.
MEMORY_CHUNKS = 300_000
MEMORY_WORDS = 150_000
#: Longer chunks are encoded and forgotten.
MEMORY_CHARS = 48
#: Texts encoded together hold so many bytes, or are one long text.
GROUP_BYTES = 16 << 20
#: Pieces, and ids of them, that a memory of arrays holds before it keeps those of the last group alone.
MEMORY_PIECES = 600_000
MEMORY_IDS = 4_000_000


class LooseSpace(Exception):
    """A text with white space beside a space, which must not be cut there."""


def clean(chunk: str) -> bool:
    """True where the chunk may be parted from its neighbours by single spaces."""
    return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace()


class Memory(dict):
    """A bounded memory of what a function makes of strings."""

    def __init__(self, make: Callable[[str], bytes], limit: int = MEMORY_WORDS) -> None:
        super().__init__()
        self.make = make
        self.limit = limit
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > MEMORY_CHARS:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class ChunkMemory(Memory):
    """From a chunk to the ids of a space and the chunk, as little-endian 32-bit numbers."""

    def __init__(self, encode: Callable[[str], bytes], word: Callable[[str], bytes]) -> None:
        super().__init__(self._after_space, MEMORY_CHUNKS)
        self.encode = encode
        self.word = word
        self.words = Memory(lambda word: self.word(" " + word))
        self.starts = Memory(self.word)
        self.marks = Memory(encode)

    def _after_space(self, chunk: str) -> bytes:
        plain = PLAIN(chunk)
        if plain is not None:
            word, marks = plain.groups()
            return self.words[word] + self.marks[marks] if marks else self.words[word]
        if not clean(chunk):
            raise LooseSpace
        # A single line feed between words is a piece of its own, and the next word starts bare.
        lines = [PLAIN(line) for line in chunk.split("\n")]
        if None in lines:
            return self.encode(" " + chunk)
        (first, marks), *rest = (line.groups() for line in lines)
        out = [self.words[first], self.marks[marks]]
        for word, marks in rest:
            out += (self.marks["\n"], self.starts[word], self.marks[marks])
        return b"".join(out)

    def ids(self, text: str) -> bytes:
        """The ids of a whole text."""
        first, *rest = text.split(" ")
        if not rest or not clean(first):
            return self.encode(text)
        try:
            return self.encode(first) + b"".join(map(self.__getitem__, rest))
        except LooseSpace:
            return self.encode(text)


#: Letters that every version of Unicode has, then punctuation: two pieces at most.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch
LETTERS = "".join(c for c in map(chr, range(256)) if PLAIN(c))
#: Beside the apostrophe, which may begin a piece of its own; after a word, a run of these is one piece.
MARKS = "".join(c for c in string.punctuation if c != "'")


class LibraryEncoder:
    """Ids by the tokenizers library: its pre-tokenizer, then its merges piece by piece."""

    def __init__(self, serialized: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_str(serialized)
        self._pieces = tokenizer.pre_tokenizer.pre_tokenize_str
        self._merge = tokenizer.model.tokenize
        # The library's own characters for the bytes of UTF-8, byte by byte.
        as_is = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._shown = {b: as_is(chr(b))[0][0] for b in range(128)}
        for high in range(0xC2, 0xC4):
            for low in range(0x80, 0xC0):
                shown = as_is(bytes([high, low]).decode())[0][0]
                self._shown |= {high: shown[0], low: shown[1]}
        self._memory = Memory(self._merged)

    def __call__(self, text: str) -> bytes:
        """The ids of any text."""
        return b"".join([self._memory[piece] for piece, _ in self._pieces(text)])

    def word(self, word: str) -> bytes:
        """The ids of a plain word, with or without a space before it, which is one piece."""
        return self._merged(word.encode().decode("latin-1").translate(self._shown))

    def pieces(self, pieces: pa.Array) -> pa.LargeBinaryArray:
        """The ids of pieces that hold no zero byte."""
        if not len(pieces):
            return pa.array([], pa.large_binary())
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), "\0")[0].as_py()
        shown = joined.encode().decode("latin-1").translate(self._shown).split(self._shown[0])
        ids, ends = array("I"), array("q", [0])
        for piece in shown:
            ids.extend([token.id for token in self._merge(piece)] if piece else ())
            ends.append(len(ids))
        return as_values(np.array(ends, dtype=np.int64) * 4, pa.py_buffer(ids))

    def _merged(self, piece: str) -> bytes:
        return array("I", [token.id for token in self._merge(piece)]).tobytes()


def tokenizer_text(path: str) -> str:
    """A tokenizer file's contents, read by the driver; tasks get it by broadcast.

    Its size does not depend on the data: it is the vocabulary of a public tokenizer.
    """
    with open(path, encoding="utf-8") as file:
        return file.read()


def library_memory(serialized: str, store: dict) -> ChunkMemory:
    """The worker's memory for this tokenizer, made on first use."""
    key = ("library", hash(serialized))
    if key not in store:
        encoder = LibraryEncoder(serialized)
        store[key] = ChunkMemory(encoder, encoder.word)
    return store[key]


def as_values(ends: np.ndarray, data: pa.Buffer) -> pa.LargeBinaryArray:
    """Byte strings that stand one after another in a buffer, between the places given."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), data])


def ends_of(values: pa.LargeBinaryArray) -> np.ndarray:
    """Where in their buffer the byte strings begin, and where the last one ends."""
    return np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]


class BatchEncoder:
    """Ids of many texts at once, as little-endian 32-bit numbers; pieces met before are remembered."""

    def __init__(self, encoder: LibraryEncoder) -> None:
        self.encoder = encoder
        self.odd = ChunkMemory(encoder, encoder.word)
        self.known = pa.array([], pa.string())
        self.ids = pa.array([], pa.large_binary())

    def _pieces(self, codes: np.ndarray, pieces: pa.Array) -> pa.LargeBinaryArray:
        """The ids of the pieces that the codes name; remembers new pieces."""
        found = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(pc.is_null(found))
        place = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = np.arange(len(self.known), len(self.known) + len(new))
        known = pa.concat_arrays([self.known, new])
        ids = pa.concat_arrays([self.ids, self.encoder.pieces(new)])
        out = ids.take(pa.array(place[codes]))
        if len(known) > MEMORY_PIECES or len(new) and ends_of(ids)[-1] > 4 * MEMORY_IDS:
            short = pa.array(place[pc.utf8_length(pieces).to_numpy() <= MEMORY_CHARS])
            known, ids = known.take(short), ids.take(short)
        self.known, self.ids = known, ids
        return out

    def _chunks(self, chunks: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
        """The ids of a space and a chunk, in some order; each chunk's place there; which have loose spaces."""
        lines = pc.split_pattern(chunks, "\n")
        first, line = lines.offsets.to_numpy()[:-1].astype(np.int64), lines.flatten()
        word, marks = pc.utf8_rtrim(line, MARKS), pc.utf8_ltrim(line, LETTERS)
        length = [pc.binary_length(x).to_numpy() for x in (line, word, marks)]
        # Letters, then marks, where what is before the marks and what is after the letters make up the line.
        plain = (length[1] > 0) & (length[1] + length[2] == length[0])
        plain = np.logical_and.reduceat(plain, first) if len(first) else plain
        # A space before the chunk's first word; a line feed is a piece of its own, and the next word starts bare.
        starts = np.zeros(len(line), dtype=bool)
        starts[first] = True
        whole = np.repeat(plain, np.diff(np.append(first, len(line))))
        starts, word, marks = starts[whole], word.filter(pa.array(whole)), marks.filter(pa.array(whole))
        feed = pc.if_else(pa.array(starts), "", "\n")
        word = pc.binary_join_element_wise(pc.if_else(pa.array(starts), " ", ""), word, "")
        pieces = pa.concat_arrays([feed, word, marks]).dictionary_encode()
        ids = self._pieces(pieces.indices.to_numpy().reshape(3, -1).T.ravel(), pieces.dictionary)
        ends = ends_of(ids)
        values = [as_values(np.append(ends[:-1][::3][starts], ends[-1]), ids.buffers()[2])]
        place = np.zeros(len(chunks), dtype=np.int64)
        place[plain] = np.arange(int(plain.sum()))
        place[~plain] = np.arange(int(plain.sum()), len(chunks))
        loose, odd = np.zeros(len(chunks), dtype=bool), []
        for at, chunk in zip(np.flatnonzero(~plain).tolist(), chunks.filter(pa.array(~plain)).to_pylist(), strict=True):
            try:
                odd.append(self.odd[chunk])
            except LooseSpace:
                loose[at] = True
                odd.append(b"")
        return pa.concat_arrays([*values, pa.array(odd, pa.large_binary())]), place, loose

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, one after another, and how many each text has; null counts as empty."""
        texts = texts.cast(pa.string()).fill_null("")
        parts = pc.split_pattern(texts, " ")
        first, flat = parts.offsets.to_numpy()[:-1].astype(np.int64), parts.flatten()
        sizes = np.diff(np.append(first, len(flat)))
        # No space stands before a text's first chunk, and a text with loose spaces is not cut.
        heads = pc.list_element(parts, 0).to_pylist()
        whole = np.logical_or.reduceat(pc.binary_length(flat).to_numpy() == 0, first)
        whole |= ~np.fromiter(map(clean, heads), dtype=bool, count=len(heads))
        rest = np.repeat(~whole, sizes)
        rest[first] = False
        coded = flat.filter(pa.array(rest)).dictionary_encode()
        values, place, loose = self._chunks(coded.dictionary)
        codes = coded.indices.to_numpy()
        if loose.any():
            row = np.repeat(np.arange(len(texts)), sizes)[rest]
            whole[row[loose[codes]]] = True
        own = [
            self.encoder(texts[row].as_py() if uncut else head)
            for row, (head, uncut) in enumerate(zip(heads, whole.tolist(), strict=True))
        ]
        values = pa.concat_arrays([values, pa.array([*own, b""], pa.large_binary())])
        wanted = np.full(len(flat), len(values) - 1, dtype=np.int64)
        wanted[rest] = place[codes]
        wanted[np.repeat(whole, sizes)] = len(values) - 1
        wanted[first] = np.arange(len(values) - 1 - len(own), len(values) - 1)
        out = values.take(pa.array(wanted))
        ends = ends_of(out)
        ids = np.frombuffer(out.buffers()[2], dtype=np.uint32) if ends[-1] else np.zeros(0, dtype=np.uint32)
        return ids[: ends[-1] // 4], np.diff(ends[np.append(first, len(flat))]) // 4


def batch_encoder(serialized: str, store: dict) -> BatchEncoder:
    """The worker's encoder of many texts for this tokenizer, made on first use."""
    key = ("batches", hash(serialized))
    if key not in store:
        store[key] = BatchEncoder(LibraryEncoder(serialized))
    return store[key]


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Rows from and to, in order: groups of much the same size, of so many bytes and the rest of a row at most."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(sizes.sum(dtype=np.int64))
    share, row = max(1, total / max(1, -(-total // most))), 0
    while row < len(ends):
        before = int(ends[row - 1]) if row else 0
        last = min(int(np.searchsorted(ends, before + share)), len(ends) - 1)
        # Empty texts after the last one go with it.
        stop = int(np.searchsorted(ends, ends[last], side="right"))
        yield row, stop
        row = stop
