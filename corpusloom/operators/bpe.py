"""Byte-pair training over distinct words, many merges a round.

Words are packed into blocks, so that a task works on arrays of many words at once. The driver
holds the most frequent pairs and a bounded number of distinct chains of symbols, never words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.functions.symbols import SPECIAL_IDS, byte_characters, byte_order
from corpusloom.operators.vocabulary import vocab_from_merges
from corpusloom.session import scratch_path
from corpusloom.sources.tokenizer_store import Tokenizer

_MERGE_SCHEMA = "rank INT, left STRING, right STRING, merged STRING"

# Leading pairs looked at in the first round and at most; later rounds follow what they meet.
_ROUND_PAIRS = 1 << 6
_MOST_PAIRS = 1 << 15
# Symbols of distinct chains that the driver replays in one round.
_CHAIN_SYMBOLS = 1 << 22
# Chains of one batch that a task sends on.
_TASK_CHAINS = 1 << 16
# Pairs whose counts the driver keeps, and how few of them make it count all pairs anew.
_KEPT_PAIRS = 1 << 17
_LEAST_KEPT = 1 << 12
# Symbols of a block of words.
_BLOCK_SYMBOLS = 1 << 18
# Pairs that come to the driver as one row.
_ROW_PAIRS = 1 << 10

_RIGHT = np.uint64(0xFFFFFFFF)
_NO_RANK = np.int32(0x7FFFFFFF)

# A merge: left, right and merged symbol. A bound or an entry of a heap: (-count, pair code).
Merge = tuple[int, int, int]
Bound = tuple[int, int]


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of symbols as one number each; their order is that of left, then right symbol."""
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class PairTable:
    """The place of pairs in a list, looked up for whole arrays of pairs."""

    _FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        top = int(max((codes >> np.uint64(32)).max(), (codes & _RIGHT).max())) + 2 if len(codes) else 2
        self.top = top
        self.lefts, self.rights = np.zeros(top, dtype=bool), np.zeros(top, dtype=bool)
        self.lefts[codes >> np.uint64(32)] = True
        self.rights[codes & _RIGHT] = True
        bits = max(4, int(4 * len(codes) + 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.tables = []
        waiting = np.arange(len(codes))
        for factor in self._FACTORS:
            slots = np.full(1 << bits, -1, dtype=np.int32)
            at = (codes[waiting] * factor) >> self.shift
            slots[at] = waiting
            self.tables.append((factor, slots))
            waiting = waiting[slots[at] != waiting]
        # What finds no slot of its own is looked up by halving; hardly ever any.
        self.rest = waiting[np.argsort(codes[waiting])]

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a pair is in the list, and its places there."""
        last = self.top - 1  # a symbol that no pair has
        maybe = np.flatnonzero(self.lefts[np.minimum(left, last)] & self.rights[np.minimum(right, last)])
        codes = pair_codes(left[maybe], right[maybe])
        index = np.full(len(codes), -1, dtype=np.int32)
        for factor, slots in self.tables:
            found = slots[(codes * factor) >> self.shift]
            met = (found >= 0) & (self.codes[found] == codes) if len(self.codes) else found >= 0
            index[met] = found[met]
        if len(self.rest):
            ordered = self.codes[self.rest]
            place = np.minimum(np.searchsorted(ordered, codes), len(ordered) - 1)
            met = ordered[place] == codes
            index[met] = self.rest[place[met]]
        met = index >= 0
        return maybe[met], index[met]


@dataclass
class Words:
    """Words laid end to end: how often each occurs, its number of symbols, and the symbols."""

    counts: np.ndarray
    sizes: np.ndarray
    symbols: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def take(self, which: np.ndarray) -> Words:
        starts, sizes = self.starts[which], self.sizes[which]
        return Words(self.counts[which], sizes, self.symbols[_ranges(starts, sizes)])

    def places(self, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
        """Where a pair of the table starts, within a word, and the pair's place in the table."""
        if len(self.symbols) < 2:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        at, index = table.find(self.symbols[:-1], self.symbols[1:])
        inside = np.ones(len(self.symbols), dtype=bool)
        inside[np.cumsum(self.sizes) - 1] = False
        return at[inside[at]], index[inside[at]]

    def word_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def pair_sums(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs, each once, and how often it occurs."""
        inside = np.ones(len(self.symbols), dtype=bool)
        inside[np.cumsum(self.sizes) - 1] = False
        at = np.flatnonzero(inside)
        codes, place = np.unique(pair_codes(self.symbols[at], self.symbols[at + 1]), return_inverse=True)
        weight = np.repeat(self.counts, self.sizes)[at]
        return codes, np.bincount(place, weight, len(codes)).astype(np.int64)


def _joined(parts: list[Words]) -> Words:
    if not parts:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))
    return Words(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("counts", "sizes", "symbols")))


def _separate(at: np.ndarray) -> np.ndarray:
    """Of places in a row, every second one from the left: those that do not overlap."""
    if not len(at):
        return np.zeros(0, dtype=bool)
    begins = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
    within = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
    return within % 2 == 0


def merge_words(words: Words, table: PairTable, merged: np.ndarray) -> Words:
    """Words after the merges of the table, in its order, as one merge at a time gives them.

    Every word merges the first of its pairs, everywhere, until it has none. A new symbol is in
    no earlier pair, so that is the order of the merges; words that are done step aside.
    """
    done: list[Words] = []
    while len(words.counts):
        at, rank = words.places(table)
        owner = words.word_of(at)
        first = np.full(len(words.counts), _NO_RANK)
        np.minimum.at(first, owner, rank)
        idle = first == _NO_RANK
        now = rank == first[owner]
        at, rank, owner = at[now], rank[now], owner[now]
        kept = _separate(at)
        at, rank, owner = at[kept], rank[kept], owner[kept]
        symbols = words.symbols.copy()
        symbols[at] = merged[rank]
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        sizes = words.sizes - np.bincount(owner, minlength=len(words.sizes))
        words = Words(words.counts, sizes, symbols[stays])
        if idle.any():
            done.append(words.take(np.flatnonzero(idle)))
            words = words.take(np.flatnonzero(~idle))
    return _joined(done)


def _replace_pair(words: Words, merge: Merge) -> Words:
    """One merge, applied once."""
    table = PairTable(np.array([merge[0] << 32 | merge[1]], dtype=np.uint64))
    at, _ = words.places(table)
    at = at[_separate(at)]
    symbols = words.symbols.copy()
    symbols[at] = merge[2]
    stays = np.ones(len(symbols), dtype=bool)
    stays[at + 1] = False
    sizes = words.sizes - np.bincount(words.word_of(at), minlength=len(words.sizes))
    return Words(words.counts, sizes, symbols[stays])


def chains_of(words: Words, at: np.ndarray) -> Words:
    """The longest stretches whose neighbours all are pairs that start at the given places."""
    begins = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1])) if len(at) else at
    sizes = np.diff(np.append(begins, len(at))) + 1
    starts = at[begins]
    counts = words.counts[words.word_of(starts)]
    return Words(counts, sizes, words.symbols[_ranges(starts, sizes)])


def distinct_chains(chains: Words) -> Words:
    """Equal short chains summed up; those too long for one number are left as they are."""
    bits = int(chains.symbols.max(initial=0)).bit_length() or 1
    starts, out = chains.starts, []
    long = chains.sizes * bits > 64
    for size in np.unique(chains.sizes[~long]):
        at = np.flatnonzero(chains.sizes == size)
        grid = chains.symbols[starts[at][:, None] + np.arange(size)].astype(np.uint64)
        code = np.zeros(len(at), dtype=np.uint64)
        for column in grid.T:
            code = (code << np.uint64(bits)) | column
        _, first, place = np.unique(code, return_index=True, return_inverse=True)
        counts = np.bincount(place, chains.counts[at]).astype(np.int64)
        symbols = grid[first].astype(np.uint32).ravel()
        out.append(Words(counts, np.full(len(first), size), symbols))
    if long.any():
        out.append(chains.take(np.flatnonzero(long)))
    return _joined(out)


class _Replay:
    """The chains of a round as a linked list of symbols, merged one pair at a time."""

    def __init__(self, chains: Words) -> None:
        n = len(chains.symbols)
        self.symbols = chains.symbols.astype(np.int64)
        self.weight = np.repeat(chains.counts, chains.sizes)
        ends, starts = np.cumsum(chains.sizes) - 1, chains.starts
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.after[ends], self.before[starts] = -1, -1
        self.counts: dict[int, int] = {}
        self.places: dict[int, list[np.ndarray]] = {}
        self._add(np.flatnonzero(self.after >= 0))
        self.heap = [(-n, code) for code, n in self.counts.items()]
        heapify(self.heap)

    def _sums(self, at: np.ndarray) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
        """Codes and weights of the pairs that start at these places, and the places by code."""
        codes = (self.symbols[at] << 32) | self.symbols[self.after[at]]
        order = np.argsort(codes, kind="stable")
        codes, at = codes[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(at) else at
        sums = np.add.reduceat(self.weight[at], first) if len(at) else at
        return codes[first].tolist(), sums.tolist(), at, np.append(first, len(at))

    def _add(self, at: np.ndarray) -> list[int]:
        codes, sums, at, bounds = self._sums(at)
        edges = bounds.tolist()
        for k, (code, n) in enumerate(zip(codes, sums, strict=True)):
            self.counts[code] = self.counts.get(code, 0) + n
            self.places.setdefault(code, []).append(at[edges[k] : edges[k + 1]])
        return codes

    def merge(self, code: int, merged: int) -> None:
        left, right = code >> 32, code & 0xFFFFFFFF
        held = self.places.pop(code)
        at = np.unique(np.concatenate(held)) if len(held) > 1 else held[0]
        follows = self.after[at]
        fits = (self.symbols[at] == left) & (follows >= 0) & (self.symbols[follows] == right)
        at, follows = at[fits], follows[fits]
        if left == right:
            # Of places in a row every second one; a place is in a row with the one before it.
            begins = np.flatnonzero(np.concatenate([[True], follows[:-1] != at[1:]]))
            within = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
            at, follows = at[within % 2 == 0], follows[within % 2 == 0]
        beyond, ahead = self.after[follows], self.before[at]
        met = np.unique(np.concatenate([ahead[ahead >= 0], at, follows[beyond >= 0]]))
        codes, sums, _, _ = self._sums(met)
        self.symbols[at], self.symbols[follows] = merged, -1
        self.after[at] = beyond
        self.before[beyond[beyond >= 0]] = at[beyond >= 0]
        for other, n in zip(codes, sums, strict=True):
            left_over = self.counts[other] - n
            if left_over:
                self.counts[other] = left_over
                heappush(self.heap, (-left_over, other))
            else:
                del self.counts[other]
        ahead = self.before[at]
        fresh = self._add(np.unique(np.concatenate([ahead[ahead >= 0], at[beyond >= 0]])))
        for other in fresh:
            heappush(self.heap, (-self.counts[other], other))


def replay_round(
    chains: Words, bound: Bound | None, shown: list[str], known: dict[str, int], settings: Settings
) -> list[Merge]:
    """The next merges, one at a time, as far as the chains of the leading pairs tell them.

    `bound` is the first pair that was not looked at. Each place where two symbols meet is one
    where two symbols of the round's start met; new symbols have larger ids, so a pair is never
    before the pair it comes from. So pairs that also stand outside of chains are not before the
    bound, and those before it have all their places in chains. A merge that spells a known token
    breaks that order, and is the last of its round.
    """
    state, accepted = _Replay(chains), []
    while state.heap and len(shown) < settings.vocab_size:
        entry = heappop(state.heap)
        code = entry[1]
        if state.counts.get(code) != -entry[0]:
            continue
        if -entry[0] < settings.min_frequency or (bound is not None and entry >= bound):
            break
        left, right = code >> 32, code & 0xFFFFFFFF
        spelled = shown[left] + shown[right]
        if spelled in known:
            accepted.append((left, right, known[spelled]))
            break
        merged = len(shown)
        shown.append(spelled)
        known[spelled] = merged
        accepted.append((left, right, merged))
        state.merge(code, merged)
    return accepted


class Leading:
    """The most frequent pairs and their exact counts, in order; what is not here is not before `edge`.

    The count of a pair only falls once its round is over, so a pair that was left out stays
    behind the edge.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, edge: Bound | None = None) -> None:
        order = np.lexsort((codes, -counts))
        self.codes, self.counts, self.edge = codes[order], counts[order], edge
        if len(codes) > _KEPT_PAIRS:
            self.edge = self.entry(_KEPT_PAIRS)
        if self.edge is not None:
            n, code = -self.edge[0], np.uint64(self.edge[1])
            ahead = (self.counts > n) | ((self.counts == n) & (self.codes < code))
            self.codes, self.counts = self.codes[ahead], self.counts[ahead]

    def entry(self, at: int) -> Bound:
        return -int(self.counts[at]), int(self.codes[at])

    def bound(self, n: int) -> Bound | None:
        """The first pair after the first n."""
        return self.entry(n) if n < len(self.codes) else self.edge

    @property
    def spent(self) -> bool:
        """Too few pairs are left, and there are others behind the edge."""
        return self.edge is not None and len(self.codes) < max(1, _LEAST_KEPT)

    def changed(self, codes: np.ndarray, changes: np.ndarray, least: int) -> Leading:
        """With the changes of a round added; pairs that are not here yet are new."""
        both = np.concatenate([self.codes, codes])
        distinct, place = np.unique(both, return_inverse=True)
        sums = np.bincount(place, np.concatenate([self.counts, changes])).astype(np.int64)
        alive = sums >= least
        return Leading(distinct[alive], sums[alive], self.edge)


_BLOCK = "kind int, counts binary, sizes binary, symbols binary, codes binary, changes binary"
_LIVE, _ASIDE, _CHANGES = 0, 1, 2


def _block_rows(rows: list[tuple[int, Words | None, np.ndarray | None, np.ndarray | None]]) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(6)]
    for kind, words, codes, changes in rows:
        given = (None,) * 3 if words is None else (
            words.counts.astype("<i8"), words.sizes.astype("<i4"), words.symbols.astype("<u4")
        )
        pairs = (None, None) if codes is None else (codes.astype("<u8"), changes.astype("<i8"))
        columns[0].append(kind)
        for column, values in zip(columns[1:], [*given, *pairs], strict=True):
            column.append(None if values is None else values.tobytes())
    types = [pa.int32()] + [pa.binary()] * 5
    names = [part.split()[0] for part in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Blocks of words from rows with the columns counts, sizes and symbols."""
    for batch in batches:
        for row in range(batch.num_rows):
            counts, sizes, symbols = (batch.column(c)[row].as_buffer() for c in ("counts", "sizes", "symbols"))
            yield Words(
                np.frombuffer(counts, "<i8"),
                np.frombuffer(sizes, "<i4").astype(np.int64),
                np.frombuffer(symbols, "<u4"),
            )


class _Packer:
    """Collects words until they fill a block."""

    def __init__(self, kind: int) -> None:
        self.kind, self.parts, self.held = kind, [], 0

    def add(self, words: Words, last: bool = False) -> Iterator[pa.RecordBatch]:
        if len(words.counts):
            self.parts.append(words)
            self.held += len(words.symbols)
        if self.held >= _BLOCK_SYMBOLS or (last and self.parts):
            yield _block_rows([(self.kind, _joined(self.parts), None, None)])
            self.parts, self.held = [], 0

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.add(_joined([]), last=True)


def _chain_rows(chains: Words, *more: tuple[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Chains as rows: their symbols as bytes, and how often they occur."""
    ends = np.concatenate([[0], np.cumsum(chains.sizes)])
    for a in range(0, len(chains.counts), _TASK_CHAINS):
        b = min(a + _TASK_CHAINS, len(chains.counts))
        symbols = np.ascontiguousarray(chains.symbols[ends[a] : ends[b]], dtype="<u4")
        offsets = (4 * (ends[a : b + 1] - ends[a])).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(symbols)])
        columns = [binary, pa.array(chains.counts[a:b], pa.int64())]
        names = ["chain", "n"]
        for name, values in more:
            columns.append(values.slice(a, b - a))
            names.append(name)
        yield pa.RecordBatch.from_arrays(columns, names)


def _chain_words(chain: pa.Array, n: pa.Array) -> Words:
    """Rows of chains as words."""
    chain = pa.concat_arrays([chain])  # offsets from 0 on
    _, offsets, values = chain.buffers()
    ends = np.frombuffer(offsets, np.int32, len(chain) + 1, 4 * chain.offset) // 4
    symbols = np.frombuffer(values, "<u4")[ends[0] : ends[-1]] if len(chain) else np.zeros(0, np.uint32)
    return Words(n.to_numpy(zero_copy_only=False), np.diff(ends).astype(np.int64), symbols)


class _Training:
    """Words and pair counts between two rounds.

    Words are live, or set aside: those in which no pair is among the leading ones cannot change
    before the leading pairs are counted anew, so rounds do not read them until then.
    """

    def __init__(self, words: DataFrame, settings: Settings) -> None:
        self.spark, self.settings = words.sparkSession, settings
        self.base = scratch_path(self.spark, "bpe")
        self.written = 0
        self.n_pairs = _ROUND_PAIRS
        # Rounds are bound by computing, not by size: use every core, however small the table.
        self.width = max(
            self.spark.sparkContext.defaultParallelism,
            int(self.spark.conf.get("spark.sql.shuffle.partitions")),
        )
        lookup = np.zeros(256, dtype=np.uint32)
        lookup[byte_order()] = np.arange(SPECIAL_IDS, SPECIAL_IDS + 256)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer = _Packer(_LIVE)
            for batch in batches:
                text = pa.concat_arrays([batch.column(0).cast(pa.binary())])
                if len(text):
                    _, offsets, values = text.buffers()
                    ends = np.frombuffer(offsets, np.int32, len(text) + 1, 4 * text.offset)
                    symbols = lookup[np.frombuffer(values, np.uint8)[ends[0] : ends[-1]]]
                    counts = batch.column(1).to_numpy(zero_copy_only=False)
                    yield from packer.add(Words(counts, np.diff(ends).astype(np.int64), symbols))
            yield from packer.close()

        spread = words.filter("word <> ''").select("word", F.col("n").cast("long").alias("n"))
        spread = spread.repartition(self.width, "word")
        self.live = [self._write(spread.mapInArrow(pack, _BLOCK), _BLOCK)]
        self.aside: list[str] = []
        self.leading = self._count()

    def _write(self, table: DataFrame, schema: str) -> str:
        self.written += 1
        path = f"{self.base}/{self.written}"
        table.write.parquet(path)
        return path

    def _blocks(self, paths: list[str], kind: int) -> DataFrame:
        return self.spark.read.schema(_BLOCK).parquet(*paths).filter(F.col("kind") == kind)

    def _all(self) -> DataFrame:
        live = self._blocks(self.live, _LIVE)
        return live.unionByName(self._blocks(self.aside, _ASIDE)) if self.aside else live

    def _count(self) -> Leading:
        """Count the pairs of all words, and keep the first of them."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for words in _read_blocks(batches):
                codes, sums = words.pair_sums()
                yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(sums)], ["pair", "n"])

        found = self._all().select("counts", "sizes", "symbols").mapInArrow(count, "pair long, n long")
        rows = (
            found.groupBy("pair").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= self.settings.min_frequency)
            .orderBy(F.desc("n"), "pair")
        )
        return Leading(*self._first(rows, _KEPT_PAIRS + 1))

    @staticmethod
    def _first(ordered: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and numbers of the first (pair, number) rows of a sorted table.

        Tasks pack them, as the driver takes a second for some forty thousand single rows.
        Collected, not as Arrow: of a sorted table that reads the first partitions only.
        """

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []

            def row() -> pa.RecordBatch:
                columns = [np.concatenate([b.column(c).to_numpy() for b in held]) for c in range(2)]
                arrays = [pa.array([c.astype("<i8").tobytes()]) for c in columns]
                return pa.RecordBatch.from_arrays(arrays, ["pairs", "numbers"])

            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= _ROW_PAIRS:
                    yield row()
                    held = []
            if any(b.num_rows for b in held):
                yield row()

        packed = ordered.mapInArrow(pack, "pairs binary, numbers binary")
        # The last row of each partition may hold less than a whole one.
        n_rows = 2 * (-(-most // _ROW_PAIRS)) + 16
        while True:
            rows = packed.limit(n_rows).collect()
            pairs, numbers = (np.frombuffer(b"".join(r[c] for r in rows), "<i8") for c in range(2))
            if len(rows) < n_rows or len(pairs) >= most:
                return pairs[:most].view(np.uint64), numbers[:most]
            n_rows *= 2

    def recount(self) -> None:
        """Take back the words set aside and count all pairs."""
        self.leading = self._count()
        if self.aside:
            everything = self._all().withColumn("kind", F.lit(_LIVE))
            self.live, self.aside = [self._write(everything, _BLOCK)], []

    def _chains(self, n_pairs: int) -> DataFrame:
        """The distinct chains of the first pairs over all live words, with their counts."""
        shared = self.spark.sparkContext.broadcast(self.leading.codes[:n_pairs])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = PairTable(shared.value)
            for words in _read_blocks(batches):
                at, _ = words.places(table)
                yield from _chain_rows(distinct_chains(chains_of(words, at)))

        found = self._blocks(self.live, _LIVE).select("counts", "sizes", "symbols").mapInArrow(
            cut, "chain binary, n long"
        )
        summed = found.groupBy("chain").agg(F.sum("n").alias("n"))
        return self.spark.read.schema("chain binary, n long").parquet(self._write(summed, ""))

    def _shorter(self, chains: DataFrame, n_pairs: int) -> tuple[DataFrame, int]:
        """Chains of fewer pairs, cut from the chains of more: as many as the driver can hold.

        All halvings of the number of pairs are looked at in one pass over the chains.
        """
        shared = self.spark.sparkContext.broadcast(self.leading.codes[:n_pairs])
        levels = [n_pairs >> k for k in range(1, n_pairs.bit_length())]

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = PairTable(shared.value)
            for batch in batches:
                if not batch.num_rows:
                    continue
                words = _chain_words(batch.column(0), batch.column(1))
                at, rank = words.places(table)
                for level in levels:
                    found = distinct_chains(chains_of(words, at[rank < level]))
                    named = pa.array(np.full(len(found.counts), level, dtype=np.int32))
                    yield from _chain_rows(found, ("level", named))

        schema = "chain binary, n long, level int"
        found = chains.mapInArrow(cut, schema).groupBy("level", "chain").agg(F.sum("n").alias("n"))
        path = self._write(found.select("chain", "n", "level"), "")
        stored = self.spark.read.schema(schema).parquet(path)
        sizes = stored.groupBy("level").agg(F.sum(F.length("chain") / 4).alias("held")).collect()
        fits = [row["level"] for row in sizes if row["held"] <= _CHAIN_SYMBOLS]
        level = max(fits, default=1)
        return stored.filter(F.col("level") == level).select("chain", "n"), level

    def next_merges(self, shown: list[str], known: dict[str, int]) -> list[Merge]:
        """The merges of a round; fewer pairs are looked at where the driver would hold too much."""
        if self.leading.spent:
            self.recount()
        n_pairs = min(self.n_pairs, len(self.leading.codes))
        if not n_pairs:
            return []
        chains = self._chains(n_pairs)
        held = int(chains.agg(F.sum(F.length("chain"))).first()[0] or 0) // 4
        if held > _CHAIN_SYMBOLS and n_pairs > 1:
            chains, n_pairs = self._shorter(chains, n_pairs)
            self.n_pairs = n_pairs
            held = 0 if n_pairs > 1 else held
        elif held <= _CHAIN_SYMBOLS // 3:
            self.n_pairs = min(_MOST_PAIRS, 2 * self.n_pairs)
        bound = self.leading.bound(n_pairs)
        if n_pairs == 1 and held > _CHAIN_SYMBOLS:
            # The first pair needs no chains: it is the next merge.
            code = self.leading.codes[:1]
            first = Words(self.leading.counts[:1], np.array([2]), np.array([code[0] >> 32, code[0] & _RIGHT]))
            return replay_round(first, bound, shown, known, self.settings)
        rows = chains.toArrow().combine_chunks()
        if not rows.num_rows:
            return []
        columns = [rows.column(c).chunk(0) for c in ("chain", "n")]
        return replay_round(_chain_words(*columns), bound, shown, known, self.settings)

    def merge(self, accepted: list[Merge], before: int) -> None:
        """Apply the round's merges to the live words; symbols from `before` on are new.

        Old pairs of words that change are taken off and new ones added; tasks send what changes
        among the leading pairs, and the new pairs.
        """
        # The last merge may make a symbol that stood before: it is applied after the others.
        rest, last = accepted[:-1], accepted[-1]
        codes = np.array([a << 32 | b for a, b, _ in rest], dtype=np.uint64)
        merged = np.array([m for _, _, m in rest], dtype=np.uint32)
        every = np.array([a << 32 | b for a, b, _ in accepted], dtype=np.uint64)
        shared = self.spark.sparkContext.broadcast((codes, merged, every, self.leading.codes))

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, merged, every, leading = shared.value
            table, met, ahead = PairTable(codes), PairTable(every), PairTable(leading)
            live, aside = _Packer(_LIVE), _Packer(_ASIDE)
            for words in _read_blocks(batches):
                changes = np.zeros(len(words.counts), dtype=bool)
                changes[words.word_of(words.places(met)[0])] = True
                old = words.take(np.flatnonzero(changes))
                new = _replace_pair(merge_words(old, table, merged), last)
                same = words.take(np.flatnonzero(~changes))
                counted = np.zeros(len(same.counts), dtype=bool)
                counted[same.word_of(same.places(ahead)[0])] = True
                yield from live.add(_joined([new, same.take(np.flatnonzero(counted))]))
                yield from aside.add(same.take(np.flatnonzero(~counted)))
                gone, gone_n = old.pair_sums()
                come, come_n = new.pair_sums()
                both, place = np.unique(np.concatenate([gone, come]), return_inverse=True)
                sums = np.bincount(place, np.concatenate([-gone_n, come_n]), len(both)).astype(np.int64)
                fresh = ((both >> np.uint64(32)) >= before) | ((both & _RIGHT) >= before)
                wanted = fresh.copy()
                wanted[ahead.find((both >> np.uint64(32)).astype(np.uint32), (both & _RIGHT).astype(np.uint32))[0]] = True
                wanted &= sums != 0
                if wanted.any():
                    yield _block_rows([(_CHANGES, None, both[wanted], sums[wanted])])
            yield from live.close()
            yield from aside.close()

        blocks = self._blocks(self.live, _LIVE).select("counts", "sizes", "symbols")
        path = self._write(blocks.mapInArrow(apply, _BLOCK), _BLOCK)
        self.live = [path]
        self.aside.append(path)
        if last[2] < before:
            # A symbol that stood before has new neighbours: no bound on counts holds.
            self.recount()
            return

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    arrays = [np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in range(2)]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["pair", "change"])

        edge = self.leading.edge
        least = max(self.settings.min_frequency, -edge[0] if edge else 0)
        changed = (
            self._blocks([path], _CHANGES)
            .select("codes", "changes")
            .mapInArrow(spread, "pair long, change long")
            .groupBy("pair")
            .agg(F.sum("change").alias("change"))
            .filter((F.col("change") < 0) | (F.col("change") >= least))
            .orderBy(F.col("change") >= 0, F.desc("change"), "pair")
        )
        first = self._first(changed, 2 * _KEPT_PAIRS + 2)
        self.leading = self.leading.changed(*first, self.settings.min_frequency)

    def encoded_words(self, shown: list[str]) -> DataFrame:
        """All words with their counts and final ids."""
        byte_of = {character: byte for byte, character in byte_characters().items()}
        n_bytes = np.array([len(t) if k >= SPECIAL_IDS else 0 for k, t in enumerate(shown)], dtype=np.int64)
        spelled = bytes(byte_of[c] for t in shown[SPECIAL_IDS:] for c in t)
        shared = self.spark.sparkContext.broadcast((n_bytes, spelled))

        def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n_bytes, spelled = shared.value
            starts, held = np.cumsum(n_bytes) - n_bytes, np.frombuffer(spelled, np.uint8)
            for words in _read_blocks(batches):
                sizes = n_bytes[words.symbols]
                text = held[_ranges(starts[words.symbols], sizes)]
                ends = np.concatenate([[0], np.cumsum(words.sizes)]).astype(np.int32)
                text_ends = np.concatenate([[0], np.cumsum(sizes)])[ends].astype(np.int32)
                buffers = [None, pa.py_buffer(text_ends), pa.py_buffer(np.ascontiguousarray(text))]
                n = len(words.counts)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(words.symbols.astype(np.int32)))
                columns = [pa.Array.from_buffers(pa.string(), n, buffers), pa.array(words.counts, pa.int64()), ids]
                for a in range(0, n, _TASK_CHAINS):
                    yield pa.RecordBatch.from_arrays([c.slice(a, _TASK_CHAINS) for c in columns], ["word", "n", "ids"])

        blocks = self._all().select("counts", "sizes", "symbols")
        return blocks.mapInArrow(decode, "word string, n long, ids array<int>")


def _learn(words: DataFrame, settings: Settings) -> tuple[list[tuple[str, str, str]], list[str], _Training]:
    """Merges in order, the tokens by id, and the training state at the end."""
    visible = byte_characters()
    shown = [*settings.tokens.trained, *(visible[b] for b in byte_order())]
    known = {token: i for i, token in enumerate(shown)}
    state = _Training(words, settings)
    merges: list[tuple[str, str, str]] = []
    while len(shown) < settings.vocab_size:
        before = len(shown)
        accepted = state.next_merges(shown, known)
        if not accepted:
            break
        merges += [(shown[a], shown[b], shown[m]) for a, b, m in accepted]
        state.merge(accepted, before)
    return merges, shown, state


def _merge_rows(spark: SparkSession, merges: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(
        [(rank, *merge) for rank, merge in enumerate(merges)], _MERGE_SCHEMA
    )


def learn_merges(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Merges by rank, as one merge at a time would give them.

    words(word, n) are distinct. The most frequent pair comes first, ties by the smaller left
    id, then right id. The driver sees only the leading pairs, a bounded number of distinct
    chains of them a round, and the merges.
    """
    return _merge_rows(words.sparkSession, _learn(words, settings)[0])


def train_bpe(words: DataFrame, settings: Settings = Settings()) -> Tokenizer:
    """Train a byte-level tokenizer from counted distinct words(word, n).

    The words' encodings are their symbols at the end of training: nothing is merged again.
    """
    merges, shown, state = _learn(words, settings)
    rows = _merge_rows(words.sparkSession, merges)
    vocab = vocab_from_merges(words.sparkSession, rows, settings.tokens)
    return Tokenizer(vocab, rows, state.encoded_words(shown))
