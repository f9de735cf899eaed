"""Near-duplicates among embeddings by cosine, over int8 tile products with error bounds.

Equal vectors are one class, met by a digest of their bytes. Classes of one dimension are cut into
tiles by hash; a tile stays in its lane, and visits half of the other lanes in a circle, so
that two tiles meet exactly once. A vector is scaled to length one and rounded to int8 with a scale
of its own; the length of what rounding lost is its error. The product of the rounded vectors is
off by no more than both errors and their product, so a pair whose product plus that bound
stays below the threshold cannot link. Only the other pairs are computed in double precision.

No pair leaves its task. A task sends, for each class, how many vectors link to it, and a forest of
links that joins what the links join: at most one link for each class that visits a lane and each
that stays there. Work grows with the square of the number of distinct vectors, as all of them
are compared; tiles, memory and rows sent are bounded by the tile, whatever the data hold.

Defined results: vectors that are null, empty, zero, or hold a null or a non-finite component link
with nothing and are components of their own; vectors of different dimension never link; equal
vectors always do; repeated rows are vectors one by one; a row without vec_id links like any other,
never names a component and is never kept; rows that share a vec_id get the values of their own
vector; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.permutation_index import usable
from corpusloom.llm.shared import stored, visiting

THRESHOLD = 0.95
#: Distinct vectors of a tile, at most, and bytes of their components, about.
TILE_ROWS = 4_096
TILE_BYTES = 64 << 20
#: A tile travels in rows of at most so many vectors and bytes of components.
PACK_ROWS = 1_024
PACK_BYTES = 4 << 20
#: Rows of a tile multiplied at once, and pairs computed again at once.
STRIP = 512
PAIRS = 1 << 16
KEY_BYTES = 16
#: More than what single precision can lose on products of at most about one.
SLACK = 1e-5
#: Products of so many int8 components are whole numbers that single precision holds exactly.
_EXACT_DIMENSIONS = 1_024


def _keyed(kind: str):
    """Rows of usable vectors with dimension, digest and bytes of the components."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            held = [flat[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)]
            keys = [hashlib.blake2b(v, digest_size=KEY_BYTES).digest() for v in held]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(sizes, pa.int32()),
                    pa.array(keys, pa.binary()),
                    pa.array(held, pa.binary()),
                ],
                ["vec_id", "dim", "key", "vector"],
            )

    return read


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors, int8 codes, the scale of each, and the length of what the codes lose."""
    unit = vectors.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = unit - codes * scale[:, None]
    return unit, codes, scale, np.sqrt((lost * lost).sum(axis=1)) + 1e-12


@dataclass
class Tile:
    """Some classes: keys, number of their vectors, and their vectors in full and in int8."""

    keys: np.ndarray
    counts: np.ndarray
    unit: np.ndarray
    codes: np.ndarray
    scale: np.ndarray
    error: np.ndarray

    @classmethod
    def unpack(cls, rows: list[dict], dim: int, kind: str) -> Tile:
        join = lambda name, dtype: np.frombuffer(b"".join(r[name] for r in rows), dtype)
        vectors = join("vectors", kind).reshape(-1, dim).astype(np.float64)
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)
        vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return cls(
            join("keys", f"V{KEY_BYTES}"),
            join("counts", np.int64),
            vectors,
            join("codes", np.int8).reshape(-1, dim).astype(np.float32),
            join("scales", np.float64).astype(np.float32),
            join("errors", np.float64).astype(np.float32),
        )


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    cuts = range(0, left.shape[1], _EXACT_DIMENSIONS)
    parts = (left[:, c : c + _EXACT_DIMENSIONS] @ right[:, c : c + _EXACT_DIMENSIONS].T for c in cuts)
    total = next(parts)
    for part in parts:
        total += part
    return total


def linked_pairs(
    left: Tile, right: Tile, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs at or above the threshold; with `same`, those with i < j."""
    for first in range(0, len(left.keys), STRIP):
        at = slice(first, first + STRIP)
        bound = _products(left.codes[at], right.codes)
        bound *= right.scale
        bound *= left.scale[at, None]
        # e + f + e f, with the strip's largest e in the last term.
        bound += right.error * (1 + left.error[at].max())
        bound += left.error[at, None]
        maybe = bound >= threshold - SLACK
        if same:
            maybe &= np.arange(len(right.keys)) > np.arange(first, first + len(maybe))[:, None]
        if 8 * np.count_nonzero(maybe) > maybe.size:
            i, j = np.nonzero(maybe & (left.unit[at] @ right.unit.T >= threshold))
            yield i + first, j
            continue
        i, j = np.nonzero(maybe)
        i += first
        for a in range(0, len(i), PAIRS):
            x, y = i[a : a + PAIRS], j[a : a + PAIRS]
            hit = np.einsum("nd,nd->n", left.unit[x], right.unit[y]) >= threshold
            yield x[hit], y[hit]


def lowest_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place that links reach."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
    return root


class Lane:
    """A tile that stays, and what is known so far of its links."""

    def __init__(self, tile: Tile, threshold: float) -> None:
        self.tile, self.threshold = tile, threshold
        self.links = np.zeros(len(tile.keys))
        self.root = np.arange(len(tile.keys))

    def meet(self, other: Tile | None) -> tuple[list, list, list]:
        """Links (a, b) of the forest that a visitor, or the tile itself, adds, and its counts."""
        mine, right = self.tile, other or self.tile
        n, m = len(mine.keys), 0 if other is None else len(right.keys)
        found = list(linked_pairs(mine, right, self.threshold, other is None))
        i = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        j = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        self.links += np.bincount(i, right.counts[j], n)
        theirs = np.bincount(j, mine.counts[i], len(right.keys))
        if other is None:
            self.links += theirs
        top = lowest_linked(n + m, self.root[i], j + n if m else self.root[j])
        merged = np.flatnonzero(top[:n] != np.arange(n))
        visitors = np.flatnonzero(top[n:] != np.arange(n, n + m))
        keys = mine.keys
        a = [*keys[merged], *right.keys[visitors]]
        b = [*keys[top[merged]], *keys[top[n + visitors]]]
        self.root = top[self.root]
        at = np.flatnonzero(theirs) if m else []
        return a, b, [(right.keys[x], int(theirs[x])) for x in at]


def _rows(a: list, b: list, n: list) -> pa.RecordBatch:
    raw = lambda keys: pa.array([None if k is None else k.tobytes() for k in keys], pa.binary())
    return pa.RecordBatch.from_arrays([raw(a), raw(b), pa.array(n, pa.int64())], ["a", "b", "n"])


def _compare(threshold: float, kind: str):
    """Rows sorted by dimension, lane and offset: the tile of a lane first, then its visitors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, staying, lane = None, [], None

        def settle() -> Iterator[pa.RecordBatch]:
            """The tile of the lane is whole: compare it with itself."""
            nonlocal lane
            if lane is None and staying:
                lane = Lane(Tile.unpack(staying, at[0], kind), threshold)
                a, b, _ = lane.meet(None)
                yield _rows(a, b, [None] * len(a))

        def leave() -> Iterator[pa.RecordBatch]:
            yield from settle()
            if lane is not None:
                some = np.flatnonzero(lane.links)
                yield _rows(lane.tile.keys[some], [None] * len(some), lane.links[some].astype(int))

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if (row["dim"], row["lane"]) != at:
                    yield from leave()
                    at, staying, lane = (row["dim"], row["lane"]), [], None
                if row["offset"] == 0:
                    staying.append(row)
                    continue
                yield from settle()
                if lane is not None:
                    a, b, counts = lane.meet(Tile.unpack([row], row["dim"], kind))
                    keys, n = [c[0] for c in counts], [c[1] for c in counts]
                    yield _rows([*a, *keys], [*b, *[None] * len(n)], [*[None] * len(a), *n])
        yield from leave()

    return run


def _packed(kind: str):
    """Rows sorted by dimension and tile, packed: up to PACK_ROWS classes of one tile in a row."""
    size = np.dtype(kind).itemsize

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def flush() -> pa.RecordBatch:
            vectors = np.frombuffer(b"".join(h[2] for h in held), kind).reshape(len(held), -1)
            _, codes, scale, error = quantised(vectors)
            values = (
                b"".join(h[0] for h in held),
                np.array([h[1] for h in held], np.int64).tobytes(),
                vectors.tobytes(),
                codes.tobytes(),
                scale.tobytes(),
                error.tobytes(),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(at, (pa.int32(), pa.int64(), pa.int64()), strict=True)]
                + [pa.array([v], pa.binary()) for v in values],
                ["dim", "tile", "tiles", "keys", "counts", "vectors", "codes", "scales", "errors"],
            )

        names = ("dim", "tile", "tiles", "key", "n", "vector")
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                full = max(1, min(PACK_ROWS, PACK_BYTES // (size * row[0])))
                if held and (row[:3] != at or len(held) >= full):
                    yield flush()
                    held.clear()
                at = row[:3]
                held.append(row[3:])
        if held:
            yield flush()

    return pack


def tile_links(classes: DataFrame, kind: str, threshold: float, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Of classes (key, dim, n, vector): forest links (a, b, null) and numbers of links (a, null, n)."""
    size = np.dtype(kind).itemsize
    rows = F.greatest(F.lit(1), F.least(F.lit(tile_rows), F.expr(f"{TILE_BYTES} div (dim * {size})")))
    sizes = stored(
        classes.groupBy("dim").agg(F.count("*").alias("__n")).select(
            F.col("dim").alias("__dim"), F.ceil(F.col("__n") / rows).alias("tiles")
        ),
        "embedding-tiles",
    )
    lanes = sizes.agg(F.sum("tiles")).first()[0] or 1
    tiled = classes.join(sizes, classes["dim"] == sizes["__dim"]).withColumn(
        "tile", F.pmod(F.xxhash64("key"), F.col("tiles"))
    )
    columns = "dim int, tile long, tiles long, " + ", ".join(
        f"{c} binary" for c in ("keys", "counts", "vectors", "codes", "scales", "errors")
    )
    packs = stored(
        tiled.select("dim", "tile", "tiles", "key", "n", "vector")
        .repartition("dim", "tile")
        .sortWithinPartitions("dim", "tile")
        .mapInArrow(_packed(kind), columns),
        "embedding-packs",
    )
    return (
        visiting(packs)
        .drop("tile", "tiles")
        .repartition(2 * lanes, "dim", "lane")
        .sortWithinPartitions("dim", "lane", "offset")
        .mapInArrow(_compare(threshold, kind), "a binary, b binary, n long")
    )


def near_embeddings(
    embeddings: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind, held = ("<f4", "array<float>") if element == "float" else ("<f8", "array<double>")
    vec_id = F.col("vec_id").cast("long").alias("vec_id")
    fine = usable(F.col("embedding"))
    vectors = embeddings.filter(fine).select(vec_id, F.col("embedding").cast(held).alias("vector"))
    keyed = vectors.mapInArrow(_keyed(kind), "vec_id long, dim int, key binary, vector binary")
    classes = stored(
        keyed.groupBy("key").agg(
            F.min("dim").alias("dim"),
            F.count("*").alias("n"),
            F.min("vec_id").alias("first"),
            F.min("vector").alias("vector"),
        ),
        "embedding-classes",
    )
    found = stored(tile_links(classes, kind, threshold, tile_rows), "embedding-links")
    roots = components(found.filter("b IS NOT NULL").select("a", "b"), "embedding-components")
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("linked"))
    rooted = (
        classes.select("key", "n", "first")
        .join(roots, F.col("key") == roots["node"], "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = (
        rooted.join(names, "root")
        .join(counts, F.col("key") == counts["a"], "left")
        .select("key", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = keyed.select("vec_id", "key").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = embeddings.filter(~fine).select(
        vec_id, F.lit(0).cast("long").alias("n_links"), vec_id.alias("component_id")
    )
    kept: Column = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
