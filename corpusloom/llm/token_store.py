"""Token-id shards compressed by Re-Pair grammars.

Documents go into shards in ascending doc_id order. In each shard frequent neighbouring ids are
replaced by nonterminals, again and again, until no pair is left that has enough separate places
for a rule; a round replaces its most frequent pairs together, from left to right where they overlap.
Of pairs that meet in a slot of the lookup table one waits for the next round. A shard stores the
rules, how many ids each nonterminal expands to, and what is left of the sequence. The lengths
place every document, so that one is decoded by expanding the few symbols that cover it.

Shards are rows of Parquet files: part and shard (their order), n_tokens, doc_ids, doc_starts
(the places of the documents in the shard) and payload, the encoded sequence. The payload is,
in little-endian unsigned 32-bit numbers: the first nonterminal, the number of rules, the
number of symbols, two symbols per rule, a length per rule; then the low 16 bits of every symbol,
and for each higher bit that some symbol has, from bit 16 on, that bit of all symbols, packed.

Special strings of the vocabulary that stand in a text are ordinary text (encode_special_tokens).

Defined results: a null or empty text holds the end id alone; a null doc_id comes first; rows
with equal doc_id keep one order, that of the files; a long document makes a long shard; an
empty table gives files without shards and an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.chunks import batch_encoder, groups, tokenizer_text
from corpusloom.llm.shared import worker_store

END_ID = 2
#: A shard is closed once it holds so many ids.
SHARD_TOKENS = 1 << 20
#: Pairs replaced together in one round, and the separate places that a rule needs.
ROUND_RULES = 2_048
LEAST_COUNT = 8
#: Slots of the table that pairs are looked up in, as a power of two.
SLOT_BITS = 18

_SCHEMA = (
    "part long, shard long, n_tokens long, doc_ids array<long>, doc_starts array<long>, payload binary"
)


def _frequent_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pair keys that occur often enough, sorted, and how often they do."""
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(first, len(ordered)))
    often = counts >= LEAST_COUNT
    return ordered[first[often]], counts[often]


def _slots(keys: np.ndarray) -> np.ndarray:
    """Slots of a table of hashed keys."""
    kind, width = keys.dtype.type, 8 * keys.dtype.itemsize
    factor, shift = kind(0x9E3779B1 if width == 32 else 0x9E3779B97F4A7C15), kind(width - SLOT_BITS)
    return (keys * factor) >> shift


def _find(keys: np.ndarray, wanted: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key is wanted, and the index of that key; and places whose key may be one of the frequent ones."""
    index = np.full(1 << SLOT_BITS, -2, dtype=np.int16)
    index[_slots(often)] = -1
    # Of two pairs on one slot the later one has it; the other has no places in this round.
    index[_slots(wanted)] = np.arange(len(wanted), dtype=np.int16)
    index = index[_slots(keys)]
    maybe = np.flatnonzero(index >= 0)
    which = index[maybe]
    right = wanted[which] == keys[maybe]
    return maybe[right], which[right], np.flatnonzero(index >= -1)


def _apart(wanted: np.ndarray, step: np.uint32 | np.uint64) -> np.ndarray:
    """Pairs of which no two can overlap, as many as are found by going through the list."""
    low, kept = wanted.dtype.type((1 << int(step)) - 1), []
    lefts: set[int] = set()
    rights: set[int] = set()
    sides = zip((wanted >> step).tolist(), (wanted & low).tolist(), strict=True)
    for at, (left, right) in sorted(enumerate(sides), key=lambda entry: entry[1][0] == entry[1][1]):
        if left not in rights and right not in lefts:
            lefts.add(left)
            rights.add(right)
            kept.append(at)
    return wanted[np.sort(kept)]


def _find_exactly(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key is wanted, and the index of that key; wanted is sorted."""
    which = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
    right = np.flatnonzero(wanted[which] == keys)
    return right, which[right]


def compress(ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The first nonterminal, the rules (pairs of symbols), their lengths, the symbols left.

    Symbols stay at their places, and each place knows the next and the last one in use. A
    replacement makes new pairs only beside it, and makes no other pair more frequent. So a round
    looks only where the last one found a frequent pair or replaced one, which it does until there
    is no such place.
    """
    n = len(ids)
    symbols = np.append(ids, 0).astype(np.uint32)  # a copy, changed in place
    first = int(symbols.max()) + 1
    after = np.arange(1, n + 2)
    before = np.arange(-1, n)
    used = np.ones(n, dtype=bool)
    places = np.arange(max(n - 1, 0))
    rules: list[np.ndarray] = []
    lengths = np.ones(first, dtype=np.int64)
    alone = False
    while len(places):
        narrow = len(lengths) <= 1 << 16
        step = np.uint32(16) if narrow else np.uint64(32)
        left, right = symbols[places], symbols[after[places]]
        keys = ((left if narrow else left.astype(np.uint64)) << step) | right
        often, counts = _frequent_pairs(keys)
        if not len(often):
            break
        if alone:
            wanted = _apart(often, step)
            at, which = _find_exactly(keys, wanted)
            stay, _ = _find_exactly(keys, often)
        else:
            most = len(often) - ROUND_RULES
            wanted = often if most <= 0 else np.sort(often[np.argpartition(counts, most)[most:]])
            at, which, stay = _find(keys, wanted, often)
        # Of places in a row, every second one from the left can be replaced.
        met_at = places[at]
        begins = np.flatnonzero(np.concatenate([[True], after[met_at[:-1]] != met_at[1:]])) if len(at) else at
        within = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        first_of_two = (within & 1) == 0
        at, which = at[first_of_two], which[first_of_two]
        met = np.bincount(which, minlength=len(wanted)) >= LEAST_COUNT
        if not met.any():
            if alone:
                # These pairs meet no rival and still have too few separate places.
                stay = stay[~np.isin(keys[stay], wanted)]
            # Pairs that took each other's places are tried again without their rivals.
            alone, places = True, places[stay]
            continue
        alone = False
        at, which = at[met[which]], which[met[which]]
        place = (len(lengths) - 1 + np.cumsum(met)).astype(np.uint32)
        chosen = wanted[met]
        low = wanted.dtype.type((1 << int(step)) - 1)
        fresh = np.stack([chosen >> step, chosen & low], axis=1).astype(np.uint32)
        rules.append(fresh)
        lengths = np.concatenate([lengths, lengths[fresh[:, 0]] + lengths[fresh[:, 1]]])
        at = places[at]
        gone = after[at]
        symbols[at] = place[which]
        used[gone] = False
        after[at] = after[gone]
        before[after[at]] = at
        look = np.zeros(n + 1, dtype=bool)
        look[places[stay]] = look[at] = look[before[at]] = True
        look[gone] = look[n] = False  # before the first place stands -1, which is n here
        places = np.flatnonzero(look)
        if len(places) and after[places[-1]] == n:
            places = places[:-1]
    table = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.uint32)
    return first, table, lengths[first:], symbols[:n][used]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its size, one span after another."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places))
    return places


def _planes(symbols: int) -> range:
    """The bits beyond 16 that numbers below `symbols` have."""
    return range(16, max(16, (symbols - 1).bit_length()))


def pack_payload(ids: np.ndarray) -> bytes:
    first, rules, lengths, symbols = compress(ids)
    head = np.array([first, len(rules), len(symbols)], dtype="<u4").tobytes()
    parts = [head, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes()]
    parts.append((symbols & 0xFFFF).astype("<u2").tobytes())
    parts += [np.packbits((symbols >> bit) & 1).tobytes() for bit in _planes(first + len(rules))]
    return b"".join(parts)


class Shard:
    """A payload opened for decoding, as a whole or by ranges of ids."""

    def __init__(self, payload: bytes) -> None:
        first, n_rules, n_symbols = (int(x) for x in np.frombuffer(payload, "<u4", 3))
        self.first = first
        self.rules = np.frombuffer(payload, "<u4", 2 * n_rules, 12).reshape(n_rules, 2)
        self.lengths = np.frombuffer(payload, "<u4", n_rules, 12 + 8 * n_rules).astype(np.int64)
        at = 12 + 12 * n_rules
        self.symbols = np.frombuffer(payload, "<u2", n_symbols, at).astype(np.uint32)
        at, size = at + 2 * n_symbols, -(-n_symbols // 8)
        for bit in _planes(first + n_rules):
            plane = np.unpackbits(np.frombuffer(payload, np.uint8, size, at), count=n_symbols)
            self.symbols |= plane.astype(np.uint32) << np.uint32(bit)
            at += size

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        """Replace nonterminals by their pairs until only ids are left."""
        while True:
            inner = symbols >= self.first
            if not inner.any():
                return symbols
            places = np.cumsum(1 + inner) - 1 - inner
            out = np.empty(len(symbols) + int(inner.sum()), dtype=np.uint32)
            out[places] = symbols
            pairs = self.rules[symbols[inner] - self.first]
            out[places[inner]], out[places[inner] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = out

    def all_ids(self) -> np.ndarray:
        """All ids: every rule is expanded once, then copied to where its symbol stands."""
        whole = self._expand(np.arange(self.first, self.first + len(self.rules), dtype=np.uint32))
        pool = np.concatenate([np.arange(self.first, dtype=np.uint32), whole])
        sizes = np.concatenate([np.ones(self.first, dtype=np.int64), self.lengths])
        starts = np.cumsum(sizes) - sizes
        return pool[_spans(starts[self.symbols], sizes[self.symbols])]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from start to stop, expanding only the symbols that cover them."""
        if not hasattr(self, "_ends"):
            size = np.ones(len(self.symbols), dtype=np.int64)
            inner = self.symbols >= self.first
            size[inner] = self.lengths[self.symbols[inner] - self.first]
            self._ends = np.cumsum(size)
        low = int(np.searchsorted(self._ends, start, side="right"))
        high = int(np.searchsorted(self._ends, stop, side="left")) + 1
        begin = int(self._ends[low - 1]) if low else 0
        return self._expand(self.symbols[low:high])[start - begin : stop - begin]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode all documents into shards below the path; `tokenizer` names a tokenizer file."""
    serialized = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = batch_encoder(serialized.value, worker_store())
        part, shard = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        starts: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            payload = pack_payload(np.concatenate(held))
            values = ([part], [shard], [size], [names], [starts], [payload])
            kinds = (
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)],
                ["part", "shard", "n_tokens", "doc_ids", "doc_starts", "payload"],
            )

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for row, stop in groups(texts):
                ids, counts = encoder.encode(texts.slice(row, stop - row))
                ids, low, at = np.insert(ids, np.cumsum(counts), end_id), 0, 0
                for doc_id, count in zip(doc_ids[row:stop], (counts + 1).tolist(), strict=True):
                    names.append(doc_id)
                    starts.append(size)
                    size, at = size + count, at + count
                    if size >= shard_tokens:
                        held.append(ids[low:at])
                        yield close()
                        names, starts, held, size, shard, low = [], [], [], 0, shard + 1, at
                held.append(ids[low:at])
        if names:
            yield close()

    (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "text",
            F.monotonically_increasing_id().alias("row"),
        )
        # The row's place parts equal ids, so that no id fills a partition by itself.
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("doc_id", "text")
        .mapInArrow(encode, _SCHEMA)
        .write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents decoded from the files: doc_id, start, n_tokens, ids_crc32, and ids if wanted."""
    shards = spark.read.schema(_SCHEMA).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, shard, total, names, starts, payload = (
                    batch.column(i)[row].as_py() for i in range(6)
                )
                ids = np.ascontiguousarray(Shard(payload).all_ids(), dtype="<u4")
                raw, ends = memoryview(ids.tobytes()), [*starts[1:], total]
                n = len(names)
                columns = [
                    pa.array([part] * n, pa.int64()),
                    pa.array([shard] * n, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()),
                    pa.array([crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
                ]
                labels = ["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    pieces = [ids[a:b] for a, b in zip(starts, ends, strict=True)]
                    columns.append(pa.array(pieces, pa.list_(pa.int32())))
                    labels.append("ids")
                yield pa.RecordBatch.from_arrays(columns, labels)

    schema = "part long, shard long, doc_id long, place long, n_tokens long, ids_crc32 long"
    documents = shards.mapInArrow(decode, schema + (", ids array<int>" if with_ids else ""))
    sizes = shards.select("part", "shard", "n_tokens")
    # One row per part, then the shards of one part.
    parts_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shards_before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(parts_before), F.lit(0)).alias("part_start")
    )
    firsts = sizes.select(
        "part", "shard", F.coalesce(F.sum("n_tokens").over(shards_before), F.lit(0)).alias("shard_start")
    ).join(parts, "part")
    extra = ["ids"] if with_ids else []
    return documents.join(firsts, ["part", "shard"]).select(
        "doc_id",
        (F.col("part_start") + F.col("shard_start") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *extra,
    )
