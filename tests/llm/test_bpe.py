import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import bpe_codec, bpe_columns
from corpusloom.llm.queries import RANKS, llm_queries
from corpusloom.llm.shared import table

CODEC = bpe_codec.Codec(bpe_codec.read_ranks(RANKS), public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={}
)


def ids_of(text):
    return np.frombuffer(CODEC.encode([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcéñ日 \n\t'.,1２\x1c\x85\xa0　😀ZsthonrE", max_size=60))
def test_equals_tiktoken(text):
    assert ids_of(text) == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode([text])[0]) == text.encode()


def test_long_pieces_and_long_texts():
    rng = np.random.default_rng(0)
    letters = "".join(rng.choice(list("etaoinshrdlu"), 6_000))
    for text in (letters, letters[:700], "a" * 3_000, "!?" * 900, letters[:40] * 50, "word " * 30_000):
        assert ids_of(text) == REFERENCE.encode_ordinary(text)


def test_full_memories_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe_codec, "MEMORY_CHUNKS", 5)
    codec = bpe_codec.Codec(bpe_codec.read_ranks(RANKS), public_tokenizers.PATTERN)
    texts = [" ".join(f"wort{i}x{j}" for i in range(9)) for j in range(6)] * 2
    for text, ids in zip(texts, [codec.encode([t])[0] for t in texts], strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode_ordinary(text)


def digest(text):
    ids = np.array(REFERENCE.encode_ordinary(text or ""), dtype="<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_edges(edge_docs, edge_texts, no_docs):
    rows = bpe_columns.round_trip(edge_docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r[0] or 0, *r[1:]) for r in rows) == sorted((i or 0, *digest(t)) for i, t in edge_texts)
    assert bpe_columns.round_trip(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_columns(edge_docs):
    pattern = public_tokenizers.PATTERN
    ids = bpe_columns.encode_column(F.col("text"), RANKS, pattern, edge_docs)
    coded = edge_docs.select("text", ids.alias("ids"))
    back = coded.select("text", "ids", bpe_columns.decode_column(F.col("ids"), RANKS, pattern, coded).alias("b"))
    for r in back.collect():
        assert bytes(r["b"]).decode() == (r["text"] or "")
        assert r["ids"] == REFERENCE.encode_ordinary(r["text"] or "")


def test_whole_table(spark, small):
    got = {r[0]: tuple(r)[1:] for r in llm_queries()["op10_bpe"](spark, small).collect()}
    rows = table(spark, small, "documents").select("doc_id", "text").collect()
    assert got == {r["doc_id"]: digest(r["text"]) for r in rows}
