"""The byte-level BPE codec as Spark columns."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe_codec import Codec, read_ranks
from corpusloom.llm.shared import worker_store

#: Texts encoded together; bounds the distinct pieces a task holds at a time.
BATCH_CHARS = 1 << 23


def _codec(ranks: Broadcast, pattern: str) -> Codec:
    """The worker's codec, made on first use."""
    store, key = worker_store(), ("codec", hash(ranks.value), pattern)
    if key not in store:
        store[key] = Codec(ranks.value, pattern)
    return store[key]


def _in_turns(codec: Codec, texts: list[str | None]) -> list[bytes]:
    out: list[bytes] = []
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS:
            out += codec.encode(held)
            held, size = [], 0
    return out + codec.encode(held)


def encode_column(text: Column, rank_file: str, pattern: str, df: DataFrame) -> Column:
    """Ids of a text as an array<int>."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        ids = _in_turns(_codec(ranks, pattern), texts.to_pylist())
        return pa.array([memoryview(x).cast("I").tolist() for x in ids], pa.list_(pa.int32()))

    return encode(text)


def decode_column(ids: Column, rank_file: str, pattern: str, df: DataFrame) -> Column:
    """The bytes of an array<int> of ids, as binary; null counts as no ids."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        table = _codec(ranks, pattern).bytes_of
        rows = (x or () for x in lists.to_pylist())
        return pa.array([b"".join(map(table.__getitem__, ids)) for ids in rows], pa.binary())

    return decode(ids)


def round_trip(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them.

    Encoding and decoding happen in one pass, so that ids do not leave the task.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_file))

    @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pa.Array) -> pa.Array:
        codec = _codec(ranks, pattern)
        encoded = _in_turns(codec, texts.to_pylist())
        return pa.StructArray.from_arrays(
            [
                pa.array([len(x) // 4 for x in encoded], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in encoded]),
                pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in encoded]),
            ],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return docs.select("doc_id", digest("text").alias("digest")).select("doc_id", "digest.*")
