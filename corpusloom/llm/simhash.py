"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits in a ring of four segments of 16. Where two fingerprints differ in at
most three bits, some segment starts a chain whose cumulative differences stay within the
proportional budgets 0, 1, 2, 3. Candidates are rows that agree on such a start: the first
segment as a whole, and of the next two, cut into halves, one of five pairs of halves that the
budgets leave equal (32 bits in all, 20 keys a fingerprint). The chain is then checked budget
by budget, and only what survives gets the full comparison.

A key that many fingerprints share is cut again by the same principle over the 32 bits it leaves
open, which bounds a group to the 2^16 values that the rest can take. Within a group links are
followed to components, and each member is written once, beside the first member of its
component there; never all pairs are written, and no link is lost to components.

Defined results: a null, empty or blank text has fingerprint zero and links like any other;
texts of one or two words hash their whole sequence; repeated rows and equal texts share one
fingerprint and one component; a row without doc_id belongs to the component of its
fingerprint and never names it while another row has an id; an empty table gives an empty
result; other columns are not read by the search and pass through the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.shared import stored

SEED = 42
MAX_BITS = 3
#: Fingerprints on one key beyond which the key is cut again.
GROUP_ROWS = 4_096
_HASH_BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text, over its three-word shingles, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < 3:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    left = n = max(1, len(words) - 2)
    ones = np.zeros(64, dtype=np.int64)
    while left:
        size = min(left, _HASH_BLOCK)
        block = np.fromiter(hashed, dtype="<u8", count=size)
        bits = np.unpackbits(block.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        left -= size
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, pinned: bool = False) -> Column:
    """Fingerprints as signed 64-bit numbers with the same bits.

    Pinned ones are computed where they stand in the plan, filters do not pass below them.
    """

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = np.fromiter(map(fingerprint, texts.to_pylist()), dtype=np.uint64, count=len(texts))
        return pa.array(found.view(np.int64), pa.int64())

    return (of.asNondeterministic() if pinned else of)(text)


# Of the four halves after the first segment, the two that a key holds.
_KEPT = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3))


def _turned(values: np.ndarray, start: int, width: int) -> np.ndarray:
    """Four segments of `width` bits, turned so that the given one stands lowest."""
    if start == 0:
        return values
    low, size = np.uint64(start * width), np.uint64(4 * width)
    turned = (values >> low) | (values << (size - low))
    return turned if width == 16 else turned & np.uint64((1 << (4 * width)) - 1)


def _halves(turned: np.ndarray, width: int) -> list[np.ndarray]:
    """The halves of the second and the third segment."""
    half = width // 2
    mask = np.uint64((1 << half) - 1)
    return [(turned >> np.uint64(width + i * half)) & mask for i in range(4)]


def ring_keys(values: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The 20 keys of each value: (number of the key's kind, key)."""
    half, mask = np.uint64(width // 2), np.uint64((1 << width) - 1)
    for start in range(4):
        turned = _turned(values, start, width)
        halves = _halves(turned, width)
        for kind, (x, y) in enumerate(_KEPT):
            number = start * len(_KEPT) + kind
            key = ((turned & mask) << np.uint64(width)) | (halves[x] << half) | halves[y]
            yield number, key | np.uint64(number << (2 * width))


def _open_bits(values: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The 32 bits that a key leaves open: two halves and the fourth segment."""
    out = np.zeros(len(values), dtype=np.uint64)
    for number in np.unique(kinds):
        at = np.flatnonzero(kinds == number)
        turned = _turned(values[at], int(number) // len(_KEPT), 16)
        halves = _halves(turned, 16)
        free = [h for h in range(4) if h not in _KEPT[int(number) % len(_KEPT)]]
        out[at] = (turned >> np.uint64(48)) | (halves[free[0]] << np.uint64(16)) | (
            halves[free[1]] << np.uint64(24)
        )
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for _, key in ring_keys(fp, 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("fp")], ["key", "fp"]
            )


def _cut_hot(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of hot keys get their 20 second keys; the others keep sub -1."""
    for batch in batches:
        key = batch.column("key").to_numpy(zero_copy_only=False)
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        hot = batch.column("n").to_numpy(zero_copy_only=False) > limit
        cold = ~hot
        parts = [(key[cold], np.full(int(cold.sum()), -1, dtype=np.int64), fp[cold])]
        if hot.any():
            rest = _open_bits(fp[hot].view(np.uint64), key[hot] >> 32)
            parts += [(key[hot], sub.view(np.int64), fp[hot]) for _, sub in ring_keys(rest, 8)]
        for columns in parts:
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "sub", "fp"])


def _within(left: np.ndarray, right: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """Places of the pairs that pass the chain budgets and then the full check."""
    differ = left ^ right
    shift = (np.uint64(16) * np.asarray(start, dtype=np.uint64)) & np.uint64(63)
    back = (np.uint64(64) - shift) & np.uint64(63)
    ring = (differ >> shift) | (differ << back)
    at = np.flatnonzero(np.bitwise_count(ring & np.uint64(0xFFFFFFFF)) <= 1)
    at = at[np.bitwise_count(ring[at] & np.uint64(0xFFFFFFFFFFFF)) <= 2]
    return at[np.bitwise_count(ring[at]) <= MAX_BITS]


def _small_groups(key: np.ndarray, group: np.ndarray, fp: np.ndarray, longest: int) -> np.ndarray:
    """For every row the first row of its component within its group."""
    lefts, rights = [], []
    for step in range(1, longest):
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        close = same[_within(fp[same], fp[same + step], (key[same] >> 32) // len(_KEPT))]
        lefts.append(close)
        rights.append(close + step)
    root = np.arange(len(fp))
    left, right = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lefts, rights))
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (before == root).all():
            break
    return root


def _large_group(fp: np.ndarray, start: int) -> np.ndarray:
    """The same for one group of many rows: every search covers the rows not yet reached."""
    root = np.full(len(fp), -1, dtype=np.int64)
    waiting = np.arange(len(fp))
    while len(waiting):
        first, waiting = waiting[0], waiting[1:]
        root[first] = first
        frontier = [first]
        while frontier and len(waiting):
            found = _within(np.full(len(waiting), fp[frontier.pop()]), fp[waiting], start)
            root[waiting[found]] = first
            frontier.extend(waiting[found])
            waiting = np.delete(waiting, found)
    return root


_SMALL = 64


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forest links of each group of rows sorted by (key, sub); a group may span batches."""

    def solve(key: np.ndarray, sub: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
        group = np.cumsum(fresh) - 1
        sizes = np.bincount(group)
        small = sizes[group] <= _SMALL
        root = np.arange(len(fp))
        at = np.flatnonzero(small)
        if len(at):
            root[at] = at[_small_groups(key[at], group[at], fp[at], min(_SMALL, int(sizes.max())))]
        begins = np.flatnonzero(fresh)
        for g in np.flatnonzero(sizes > _SMALL):
            a, b = begins[g], begins[g] + sizes[g]
            root[a:b] = a + _large_group(fp[a:b], int(key[a] >> 32) // len(_KEPT))
        linked = np.flatnonzero(root != np.arange(len(fp)))
        pairs = np.stack([fp[linked].view(np.int64), fp[root[linked]].view(np.int64)], axis=1)
        pairs = np.unique(pairs, axis=0) if len(pairs) else pairs
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))],
            ["a", "b"],
        )

    held: tuple[np.ndarray, ...] = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    for batch in batches:
        new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "sub", "fp")]
        new[2] = new[2].view(np.uint64)
        key, sub, fp = (np.concatenate(x) for x in zip(held, new, strict=True))
        if not len(key):
            continue
        last = (key == key[-1]) & (sub == sub[-1])
        cut = int(np.argmax(last))
        if cut:
            yield solve(key[:cut], sub[:cut], fp[:cut])
        held = (key[cut:], sub[cut:], fp[cut:])
    if len(held[0]):
        yield solve(*held)


def near_links(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pairs (a, b) of fingerprints that links join, enough to connect all that are linked."""
    distinct = prints.select("fp").distinct()
    keys = stored(distinct.mapInArrow(_keyed, "key long, fp long"), "simhash-keys")
    counts = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sized = keys.join(counts, "key")
    cut = partial(_cut_hot, limit=group_rows)
    grouped = (
        sized.mapInArrow(cut, "key long, sub long, fp long")
        .repartition("key", "sub")
        .sortWithinPartitions("key", "sub", "fp")
    )
    return grouped.mapInArrow(_links, "a long, b long")


def _classes(docs: DataFrame, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows (doc_id, fp), and of each fingerprint its root and smallest id."""
    prints = stored(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "simhash")
    roots = components(near_links(prints, group_rows), "simhash-components")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(
        F.min(F.when(F.col("first").isNotNull(), F.struct("first", "fp"))).alias("kept"),
        F.min("fp").alias("lowest"),
    )
    return prints, rooted.join(named, "root").select(
        "fp", F.col("kept.first").alias("component_id"), F.col("kept.fp").alias("kept_fp"), "lowest"
    )


def near_duplicates(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links reach) of every row."""
    prints, classes = _classes(docs, group_rows)
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _left_out(prints: DataFrame, classes: DataFrame, repeated: DataFrame) -> DataFrame:
    """Ids whose rows do not stay as they are: duplicates, and ids that several rows share."""
    gone = (
        prints.filter(F.col("doc_id").isNotNull())
        .join(classes, "fp")
        .filter("doc_id <> component_id")
        .select(F.col("doc_id").alias("__out"))
    )
    return gone.unionByName(repeated.select(F.col("doc_id").alias("__out"))).distinct()


def near_dedup(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row of every component, the one with the smallest doc_id, with all its columns.

    Of several rows with that id the one with the smallest fingerprint stays; rows of other
    components that share the id stay for their own. A component without any doc_id keeps one
    row, of those with its lowest fingerprint.

    Texts meet only the ids to leave out, whose size is known when they do, and their
    fingerprints are not computed again but for rows that share an id or have none.
    """
    prints, classes = _classes(docs, group_rows)
    classes = stored(classes, "simhash-classes")
    ids = prints.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = stored(ids.filter("n > 1").select("doc_id"), "simhash-repeated")
    out = stored(_left_out(prints, classes, repeated), "simhash-left-out")
    named = docs.filter(F.col("doc_id").isNotNull())
    kept = named.join(out, named["doc_id"] == out["__out"], "left_anti")
    # A fingerprint that may differ from call to call is not moved below the join before it.
    own_print = fingerprints(F.col("text"), pinned=True)
    if not repeated.isEmpty():
        several = named.join(
            repeated.select(F.col("doc_id").alias("__shared")), F.col("doc_id") == F.col("__shared"), "left_semi"
        ).withColumn("__fp", own_print)
        keepers = classes.filter("component_id IS NOT NULL AND fp = kept_fp").select(
            F.col("component_id").alias("__keep"), F.col("fp").alias("__print")
        )
        own = (several["doc_id"] == keepers["__keep"]) & (several["__fp"] == keepers["__print"])
        told = several.join(keepers, own, "left_semi").dropDuplicates(["doc_id", "__fp"])
        kept = kept.unionByName(told.drop("__fp"))
    if not prints.filter(F.col("doc_id").isNull()).isEmpty():
        without = docs.filter(F.col("doc_id").isNull()).withColumn("__fp", own_print)
        nameless = classes.filter("component_id IS NULL AND fp = lowest").select(F.col("fp").alias("__keep"))
        found = without.join(nameless, without["__fp"] == nameless["__keep"], "left_semi")
        kept = kept.unionByName(found.dropDuplicates(["__fp"]).drop("__fp"))
    return kept
