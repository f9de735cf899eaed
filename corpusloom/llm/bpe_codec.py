"""Byte-level BPE encoding and decoding over padded numpy matrices.

Texts are cut into the matches of the pre-tokenization pattern. Pieces that the vocabulary does
not hold as a whole are bucketed by length into matrices with a byte's id in every cell; in each
round every row merges its leftmost pair of minimum rank, looked up in a hash table of pairs,
and rows that have nothing left to merge leave the matrix. Each distinct piece of a batch is
merged once, and a bounded memory keeps pieces and words of earlier batches.

Pieces beyond `MATRIX_BYTES` bytes would make a row too long for a round each; they are merged by
a heap over linked pairs, with the same result.

Defined results: a null or empty text has no ids and decodes to no bytes; texts and pieces of any
length are encoded whole; special tokens inside texts are ordinary text; repeated rows get equal
ids; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable

import numpy as np
import regex

from corpusloom.llm.chunks import MEMORY_CHARS, MEMORY_CHUNKS, PLAIN, clean

MATRIX_BYTES = 1_024
#: Cells of one matrix, at most.
MATRIX_CELLS = 1 << 20
_NONE = np.int32(0x7FFFFFFF)


def read_ranks(path: str) -> bytes:
    """A rank file's contents, read by the driver; its size does not depend on the data."""
    with open(path, "rb") as file:
        return file.read()


class PairTable:
    """Ranks of mergeable pairs in an open-addressed hash table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, dtype=np.int32)
        key, rank = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        slot = self._slots(key)
        while len(key):
            # Of the keys that want an empty slot, one gets it; the others try the next.
            free = np.flatnonzero(self.keys[slot] == -1)
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.ranks[slot[placed]] = rank[placed]
            key, rank, slot = key[~placed], rank[~placed], (slot[~placed] + 1) & self.mask

    def _slots(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, `_NONE` where it cannot be merged; negative ids are padding."""
        out = np.full(left.shape, _NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = left.ravel()[at].astype(np.int64) << 32 | right.ravel()[at]
        slot = self._slots(key)
        flat = out.ravel()
        while len(at):
            there = self.keys[slot]
            hit = there == key
            flat[at[hit]] = self.ranks[slot[hit]]
            going = ~hit & (there != -1)
            at, key, slot = at[going], key[going], (slot[going] + 1) & self.mask
        return flat.reshape(left.shape)


def merge_rows(rows: np.ndarray, pairs: PairTable) -> list[np.ndarray]:
    """Merge every row of ids, padded by -1, to its end; the ids left, row by row."""
    done: list[np.ndarray | None] = [None] * len(rows)
    name = np.arange(len(rows))
    ranks = pairs.find(rows[:, :-1], rows[:, 1:])
    while len(rows):
        at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), dtype=np.int64)
        line = np.arange(len(rows))
        best = ranks[line, at] if ranks.shape[1] else np.full(len(rows), _NONE)
        over = best == _NONE
        if over.any():
            for row, ids in zip(name[over], rows[over], strict=True):
                done[row] = ids[ids >= 0]
            keep = ~over
            rows, ranks, name, at, best = rows[keep], ranks[keep], name[keep], at[keep], best[keep]
            if not len(rows):
                break
            line = np.arange(len(rows))
        rows[line, at] = best
        # Close the gap: cells behind the merged pair move one to the left.
        column = np.arange(rows.shape[1] - 1)
        rows = np.take_along_axis(rows, column + (column > at[:, None]), axis=1)
        if rows.shape[1] < 2:
            ranks = ranks[:, :0]
            continue
        column = np.arange(rows.shape[1] - 1)
        ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
        inside = np.flatnonzero(at < rows.shape[1] - 1)
        ranks[inside, at[inside]] = pairs.find(rows[inside, at[inside]], rows[inside, at[inside] + 1])
        after = np.flatnonzero(at > 0)
        ranks[after, at[after] - 1] = pairs.find(rows[after, at[after] - 1], rows[after, at[after]])
    return done


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for one long piece: a heap of pairs over a linked list of parts."""
    n = len(piece)
    ends = list(range(1, n + 1))
    following = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        right = following[left]
        if right < n and (rank := ranks.get(piece[left : ends[right]])) is not None:
            heapq.heappush(heap, (rank, left, ends[right]))

    for left in range(n - 1):
        offer(left)
    while heap:
        _, left, end = heapq.heappop(heap)
        right = following[left]
        if not alive[left] or right >= n or ends[right] != end:
            continue
        ends[left], alive[right] = end, False
        following[left] = following[right]
        if following[right] < n:
            before[following[right]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [ranks[piece[a : ends[a]]] for a in range(n) if alive[a]]


class Codec:
    """Encodes and decodes batches of texts by one rank file and pattern."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        rows = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.pairs = PairTable(self.ranks)
        self.bytes_of: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.cut = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of each piece, little-endian 32-bit numbers; equal lengths share a matrix."""
        out: dict[str, bytes] = {}
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                out[piece] = rank.to_bytes(4, "little")
            elif len(data) > MATRIX_BYTES:
                out[piece] = np.array(merge_long(data, self.ranks), dtype="<u4").tobytes()
            else:
                width = len(data) if len(data) <= 32 else 1 << (len(data) - 1).bit_length()
                buckets.setdefault(width, []).append((piece, data))
        for width, bucket in buckets.items():
            size = max(1, MATRIX_CELLS // width)
            for low in range(0, len(bucket), size):
                part = bucket[low : low + size]
                flat = np.frombuffer(b"".join([d.ljust(width, b"\0") for _, d in part]), np.uint8)
                rows = self.of_byte[flat.reshape(len(part), width)]
                lengths = np.array([len(d) for _, d in part])
                rows[np.arange(width) >= lengths[:, None]] = -1
                for (piece, _), ids in zip(part, merge_rows(rows, self.pairs), strict=True):
                    out[piece] = ids.astype("<u4").tobytes()
        return out

    def _remember(self, new: dict[str, bytes], kind: str) -> dict[str, bytes]:
        """Add to a memory; when full it becomes the old one."""
        memory = getattr(self, kind)
        if len(memory) + len(new) > MEMORY_CHUNKS:
            setattr(self, f"old_{kind}", memory)
            memory = {}
            setattr(self, kind, memory)
        memory.update({k: v for k, v in new.items() if len(k) <= MEMORY_CHARS})
        return memory

    def _ids_of_pieces(self, cuts: list[list[str]]) -> list[bytes]:
        """The joined ids of each list of pieces; every distinct piece is merged once."""
        wanted = set().union(*cuts)
        found: dict[str, bytes] = {}
        for memory in (self.pieces, self.old_pieces):
            for piece in wanted & memory.keys():
                found[piece] = memory[piece]
            wanted -= found.keys()
        new = self.encode_pieces(wanted)
        found |= new
        self._remember(found, "pieces")
        return [b"".join(map(found.__getitem__, cut)) for cut in cuts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. Words between single spaces are looked up as a whole."""
        split = [(text or "").split(" ") for text in texts]
        wanted: set[str] = set()
        for words in split:
            wanted.update(words[1:])
        found: dict[str, bytes] = {}
        for memory in (self.words, self.old_words):
            for word in wanted & memory.keys():
                found[word] = memory[word]
            wanted -= found.keys()
        plain = {word: PLAIN(word) for word in wanted}
        loose = {word for word, match in plain.items() if match is None and not clean(word)}
        new = [word for word in wanted if word not in loose]
        cuts = []
        for word in new:
            match = plain[word]
            if match is None:
                cuts.append(self.cut(" " + word))
            else:
                letters, marks = match.groups()
                cuts.append([" " + letters, marks] if marks else [" " + letters])
        found |= zip(new, self._ids_of_pieces(cuts), strict=True)
        self._remember(found, "words")
        # The first word has no space before it; a text with loose white space is cut whole.
        whole = [
            not clean(words[0]) or bool(loose and not loose.isdisjoint(words[1:])) for words in split
        ]
        heads = [
            self.cut(text or "") if all_of_it else self.cut(words[0])
            for text, words, all_of_it in zip(texts, split, whole, strict=True)
        ]
        return [
            head if all_of_it else head + b"".join(map(found.__getitem__, words[1:]))
            for head, words, all_of_it in zip(self._ids_of_pieces(heads), split, whole, strict=True)
        ]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids, little-endian 32-bit numbers, stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
