"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. The index is cut into blocks of vectors;
a block posts every vector in the inverted file of each of its pivots, with the pivot's place.
A query reads the files of its own pivots, which gives the induced footrule distance (places
missing count as the prefix length); the block's best by footrule, ties at the border included,
are ranked again by exact distance, and the best of all blocks are the result. With a prefix of
a sixteenth of the pivots a query reads a sixteenth of a block's postings.

The pivots come from a bounded sample; every vector is indexed, and every block is searched. Each
dimension has pivots and blocks of its own; one that the sample missed has no pivots, and its
vectors are all compared. The query set grows with the table, so queries are packed into blocks
as well; a pair of blocks is the unit of work, whose size does not depend on the data, and a block
of queries meets each index block through an equal lane number.

Defined results: vectors that are null, zero, empty, or hold a null or a non-finite component, and
rows without vec_id, take no part; a query finds vectors of its own dimension; ties in distance go
to the smaller vec_id; equal vectors and repeated rows are candidates one by one; a repeated query
id asks once, with the smallest of its vectors; a query with fewer candidates than asked for gets
them all; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import hash_sample, stored

#: Vectors the pivots are chosen from, pivots, and pivots that represent a vector.
PIVOT_SAMPLE = 2_048
PIVOTS = 1_024
PREFIX = 64
BLOCK_ROWS = 8_192
QUERY_ROWS = 512
#: Of a block, the share and the least number of vectors that are compared exactly.
RERANK_SHARE = 0.1
RERANK_LEAST = 256


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Sampled vectors far from each other: each next one is farthest from those chosen."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances, good enough to order pivots."""
    return (left * left).sum(1)[:, None] + (right * right).sum(1)[None] - 2 * left @ right.T


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each vector's nearest pivots in order, ties to the first pivot."""
    return np.argsort(_squares(vectors, pivots), axis=1, kind="stable")[:, :prefix].astype(np.int16)


class IndexBlock:
    """Inverted files of one block: per pivot the rows that hold it, and its place for each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, n_pivots: int) -> None:
        self.ids, self.vectors, self.prefix = ids, vectors, order.shape[1]
        flat = order.ravel()
        posted = np.argsort(flat, kind="stable")
        width = max(1, self.prefix)
        self.rows = posted // width
        self.gains = (width - posted % width).astype(np.int32)
        self.bounds = np.searchsorted(flat[posted], np.arange(n_pivots + 1))

    def overlap(self, order: np.ndarray) -> np.ndarray:
        """For every row, how much a query's order shortens the footrule distance."""
        if not len(order):
            return np.zeros(len(self.ids))
        files = [slice(self.bounds[pivot], self.bounds[pivot + 1]) for pivot in order]
        rows = np.concatenate([self.rows[f] for f in files])
        gains = np.concatenate([self.gains[f] for f in files])
        most = np.repeat(self.prefix - np.arange(len(order)), [f.stop - f.start for f in files])
        return np.bincount(rows, np.minimum(gains, most), len(self.ids))

    def search(self, query: np.ndarray, order: np.ndarray, self_id: int, k: int) -> list[tuple[float, int]]:
        gain = self.overlap(order)
        gain[self.ids == self_id] = -1
        n = len(gain)
        wanted = max(RERANK_LEAST, int(np.ceil(RERANK_SHARE * n)))
        border = np.partition(gain, n - wanted)[n - wanted] if wanted < n else 0
        at = np.flatnonzero(gain >= max(border, 0))
        score = np.sqrt(((self.vectors[at] - query) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[at], score))[:k]
        return list(zip(score[best].tolist(), self.ids[at][best].tolist(), strict=True))


def _blocks(rows: int, pivots: dict[int, np.ndarray], prefix: int):
    """Pack vectors of one dimension into rows of ids, vectors and permutations, as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def flush(dim: int) -> pa.RecordBatch:
            ids, vectors = held.pop(dim)
            now = np.concatenate(vectors).reshape(len(ids), dim)
            near = pivots.get(dim, np.zeros((0, dim)))
            order = permutations(now, near, prefix)
            values = (np.array(ids, np.int64).tobytes(), now.tobytes(), order.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32())] + [pa.array([v], pa.binary()) for v in values],
                ["dim", "ids", "vectors", "orders"],
            )

        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_pylist()
            start = 0
            for vec_id, dim in zip(batch.column("vec_id").to_pylist(), sizes, strict=True):
                ids, vectors = held.setdefault(dim, ([], []))
                ids.append(vec_id)
                vectors.append(flat[start : start + dim])
                start += dim
                if len(ids) >= rows:
                    yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return pack


def _orders(packed: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(packed, np.int16)
    return flat.reshape(n, len(flat) // n)


def _pivots(sample: list, n: int) -> dict[int, np.ndarray]:
    """Pivots of each dimension that the sample holds."""
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row["vector"]), []).append(row["vector"])
    return {dim: choose_pivots(np.array(vectors), n) for dim, vectors in by_dim.items()}


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 10,
    n_pivots: int = PIVOTS,
    prefix: int = PREFIX,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for every query row."""
    spark = embeddings.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    fine = embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        is_query.alias("asks"),
    )
    # Gathered by a task: collected as it is, every task would send its own best to the driver.
    sample = hash_sample(fine, "vec_id", PIVOT_SAMPLE).coalesce(1).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    pivots = _pivots(sample, n_pivots)
    columns = "dim int, ids binary, vectors binary, orders binary"
    index = stored(
        fine.select("vec_id", "vector").mapInArrow(_blocks(block_rows, pivots, prefix), columns),
        "permutation-index",
    )
    asked = fine.filter("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = asked.mapInArrow(_blocks(QUERY_ROWS, pivots, prefix), columns)
    # Two blocks meet in the lane of the index block; a lane holds a few index blocks at most.
    lanes = max(1, index.count())
    lane = F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int").alias("lane")
    left = index.select("dim", lane, "ids", "vectors", "orders")
    right = queries.select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "vectors", "orders")],
    )
    names = ["dim", "ids", "vectors", "orders", "q_ids", "q_vectors", "q_orders"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, vectors, orders, q_ids, q_vectors, q_orders = (
                    batch.column(name)[row].as_py() for name in names
                )
                if ids != last:
                    last, keys = ids, np.frombuffer(ids, np.int64)
                    block = IndexBlock(
                        keys,
                        np.frombuffer(vectors).reshape(len(keys), dim),
                        _orders(orders, len(keys)),
                        len(pivots.get(dim, ())),
                    )
                asking = np.frombuffer(q_ids, np.int64)
                points = np.frombuffer(q_vectors).reshape(len(asking), dim)
                ways = _orders(q_orders, len(asking))
                found = [
                    (int(q), v, s)
                    for q, point, way in zip(asking, points, ways, strict=True)
                    for s, v in block.search(point, way, int(q), k)
                ]
                arrays = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    # A row holds two blocks; the session's bound on the bytes of a batch keeps few of them in one.
    hits = left.join(right, ["dim", "lane"]).select(*names).mapInArrow(
        search, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
