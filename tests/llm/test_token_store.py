from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import chunks, token_store
from corpusloom.llm.queries import TOKENIZER, llm_queries
from corpusloom.llm.shared import table
from corpusloom.session import scratch_path


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: np.array(
        [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4"
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_grammar_round_trip(values, a, b):
    ids = np.array(values * 5, dtype="<u4")
    shard = token_store.Shard(token_store.pack_payload(ids))
    assert (shard.all_ids() == ids).all()
    low, high = sorted((min(a, len(ids)), min(b, len(ids))))
    if high > low:
        assert (shard.ids(low, high) == ids[low:high]).all()


def test_grammar_compresses_and_handles_large_ids():
    ids = np.array([70_000, 3, 99_999, 3] * 2_000, dtype="<u4")
    payload = token_store.pack_payload(ids)
    assert len(payload) < ids.nbytes / 20
    assert (token_store.Shard(payload).all_ids() == ids).all()


def slow_expand(symbol, first, rules):
    return [symbol] if symbol < first else [i for s in rules[symbol - first] for i in slow_expand(s, first, rules)]


def test_rules_go_on_until_no_pair_is_frequent():
    """No cap on rounds, rules or expansion: a passage repeated often becomes a few symbols."""
    rng = np.random.default_rng(1)
    ids = np.tile(rng.integers(0, 50_000, 700), 600).astype("<u4")
    first, rules, lengths, symbols = token_store.compress(ids)
    assert len(symbols) < 200 and lengths.max() > 10_000
    expanded = [i for s in symbols.tolist() for i in slow_expand(s, first, rules.tolist())]
    assert expanded == ids.tolist()
    for rule, length in zip(rules.tolist(), lengths.tolist(), strict=True):
        assert length == sum(1 if s < first else int(lengths[s - first]) for s in rule)
    mixed = rng.zipf(1.3, 60_000).clip(max=9_000).astype("<u4")
    _, _, _, left = token_store.compress(mixed)
    pairs, last = Counter(), {}
    for at, pair in enumerate(zip(left[:-1].tolist(), left[1:].tolist(), strict=True)):
        if last.get(pair, -2) < at - 1:
            pairs[pair] += 1
            last[pair] = at
    assert max(pairs.values()) < token_store.LEAST_COUNT


def test_symbols_beyond_sixteen_bits():
    rng = np.random.default_rng(2)
    ids = np.concatenate([np.repeat(rng.integers(0, 70_000, (3_000, 2)), 9, axis=0).ravel(), [65_535, 65_536, 131_071]])
    shard = token_store.Shard(token_store.pack_payload(ids.astype("<u4")))
    assert (shard.all_ids() == ids).all() and shard.first > 1 << 16


def test_edges(spark, edge_docs, edge_texts):
    encode, path = library(), scratch_path(spark, "test-tokens")
    token_store.write_tokens(edge_docs, path, TOKENIZER, shard_tokens=50)
    rows = token_store.read_tokens(spark, path, with_ids=True).collect()
    assert len(rows) == len(edge_texts)
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10]
    texts, at = dict(edge_texts), 0
    for r in rows:
        ids = encode(texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc32(ids.tobytes()))
        assert r["ids"] == ids.tolist()
        at += len(ids)


def test_random_access(spark, edge_docs):
    path = scratch_path(spark, "test-tokens")
    token_store.write_tokens(edge_docs, path, TOKENIZER)
    for row in spark.read.parquet(path).collect():
        shard = token_store.Shard(bytes(row["payload"]))
        whole = shard.all_ids()
        for start, stop in zip(row["doc_starts"], [*row["doc_starts"][1:], row["n_tokens"]], strict=True):
            assert (shard.ids(start, stop) == whole[start:stop]).all()


def test_whole_table(spark, small):
    encode, at = library(), 0
    rows = {r["doc_id"]: r for r in llm_queries()["op7_token_store"](spark, small).collect()}
    for r in table(spark, small, "documents").select("doc_id", "text").orderBy("doc_id").collect():
        ids, got = encode(r["text"]), rows[r["doc_id"]]
        assert (got["start"], got["n_tokens"], got["ids_crc32"]) == (at, len(ids), crc32(ids.tobytes()))
        at += len(ids)


def test_empty(spark, no_docs):
    path = scratch_path(spark, "test-tokens")
    token_store.write_tokens(no_docs, path, TOKENIZER)
    assert token_store.read_tokens(spark, path).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b", "x \n y", "it's 'll", "foo  bar baz", "é x日 12"])
def test_chunked_ids_equal_the_library(text):
    from corpusloom.llm.chunks import library_memory, tokenizer_text

    memory = library_memory(tokenizer_text(TOKENIZER), {})
    assert np.frombuffer(memory.ids(text), "<u4").tolist() == library()(text)[:-1].tolist()


ODD_TEXTS = [
    None, "", " ", "\n", "word", "a  b", "x \n y", "x\ny z", "x\n\ny z", "end.\nNext line,\nand one",
    "it's 'll a'b don't", "über Öl ß ª µ × é日", "m5.x@y.com (242) 555-1832", "chie*** thou.&&&\nUng%%% ?!.. _a_ __",
    "<|endoftext|> a<|endoftext|>b", "a\x00b \x85 c\xa0 \u3000 d", " lead", "trail ", "tab\tbed \x1cx y\x1c z",
    "x" * 3_000 + " y", "half, and half.\nOf it",
]


@pytest.mark.parametrize("memory", [0, 600_000])
def test_many_texts_at_once_equal_the_library(monkeypatch, memory):
    """Whatever stands together, and whether pieces are still remembered or not."""
    monkeypatch.setattr(chunks, "MEMORY_PIECES", memory)
    encoder, encode = chunks.BatchEncoder(chunks.LibraryEncoder(chunks.tokenizer_text(TOKENIZER))), library()
    for texts in (ODD_TEXTS, ODD_TEXTS[::-1], ["one"], [None, ""], ODD_TEXTS[3:7]):
        for kind in (pa.string(), pa.large_string()):
            ids, counts = encoder.encode(pa.array([*texts, "cut off"], kind).slice(0, len(texts)))
            pieces = np.split(ids, np.cumsum(counts)[:-1])
            assert [p.tolist() for p in pieces] == [encode(t)[:-1].tolist() for t in texts]


def test_words_and_marks_take_no_step_each():
    """Only words not met before go through the library one by one, those of lines and before marks too."""
    encoder = chunks.BatchEncoder(chunks.LibraryEncoder(chunks.tokenizer_text(TOKENIZER)))
    encoder.odd, met, merge = None, [], encoder.encoder._merge
    encoder.encoder._merge = lambda piece: met.append(piece) or merge(piece)
    texts = pa.array(["Some words, some word.\nSome more words### for über Öl"] * 500)
    first = encoder.encode(texts)
    assert 0 < len(met) < 20
    met.clear()
    again = encoder.encode(texts)
    assert not met
    assert (first[0] == again[0]).all() and (first[1] == again[1]).all()


def test_groups_cover_all_rows():
    texts = pa.array(["x" * n for n in (5, 0, 30, 4, 4, 4)] + [None])
    assert list(chunks.groups(texts, 10)) == [(0, 3), (3, 7)]
    assert list(chunks.groups(texts, 51)) == [(0, 7)]
    assert list(chunks.groups(texts.slice(0, 0), 10)) == []
    empty = pa.array(["", None, ""])
    assert list(chunks.groups(empty, 10)) == [(0, 3)]


def test_rounds_look_only_where_pairs_are_frequent(monkeypatch):
    """The whole sequence is looked at once; looking at it again and again was most of the work."""
    looked, count = [], token_store._frequent_pairs
    monkeypatch.setattr(token_store, "_frequent_pairs", lambda keys: looked.append(len(keys)) or count(keys))
    ids = np.random.default_rng(3).zipf(1.3, 200_000).clip(max=9_000).astype("<u4")
    assert (token_store.Shard(token_store.pack_payload(ids)).all_ids() == ids).all()
    assert looked[0] == len(ids) - 1 and sum(looked) < 2 * len(ids)
