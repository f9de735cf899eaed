"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two in n, whole
sequences of the full width first. Every piece is a sequence of its own, so no sequence crosses
documents and none needs padding; sequences of equal length form one bucket, and sequence ids
run through the buckets one after another, longest first.

Special strings of the vocabulary that stand in a text are ordinary text (encode_special_tokens).

Defined results: a null or empty text has the end id alone, one piece of length one; texts of
any length are cut whole; a row without doc_id is packed like any other, its pieces have a null
doc_id; repeated rows are packed one by one; an empty table gives an empty result; only doc_id
and text are read, whatever other columns there are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.chunks import library_memory, tokenizer_text
from corpusloom.llm.shared import stored, worker_store

WIDTH = 2_048
END_ID = 1

_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long"
)


def piece_lengths(n: int, width: int = WIDTH) -> Iterator[int]:
    """Lengths that add up to n: full widths, then falling powers of two; width is one itself."""
    for _ in range(n // width):
        yield width
    rest = n % width
    while rest:
        length = 1 << (rest.bit_length() - 1)
        yield length
        rest -= length


def cut_documents(
    docs: DataFrame, tokenizer: str, width: int = WIDTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece, numbered within its length and the task that cut it.

    `tokenizer` is the path of a tokenizer file; with_ids adds the ids themselves.
    """
    serialized = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = library_memory(serialized.value, worker_store())
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            ids = []
            for doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                tokens = (memory.ids(text) if text else b"") + end
                n, start = len(tokens) // 4, 0
                for length in piece_lengths(n, width):
                    piece = tokens[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, crc32(piece), n, seen[length])
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    if with_ids:
                        ids.append(memoryview(piece).cast("I").tolist())
                    seen[length] += 1
                    start += length
            arrays = [pa.array(c, pa.int64()) for c in columns]
            arrays.insert(5, pa.array([part] * len(columns[0]), pa.int64()))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = _SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, width: int = WIDTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces with their sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequence ids have no gaps. They come from counts per task and length, so that the pieces
    themselves are neither sorted nor shuffled.
    """
    pieces = stored(cut_documents(docs, tokenizer, width, end_id, with_ids), "packing")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # At most one row for each of the powers of two up to the width.
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n")).select(
        "length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("bucket_start")
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        .join(buckets, "length")
        .select("length", "part", (F.col("bucket_start") + F.col("before")).alias("first"))
    )
    extra = ["ids"] if with_ids else []
    return pieces.join(starts, ["length", "part"]).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *extra,
    )
