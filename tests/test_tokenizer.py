"""Tokenizer training and encoding against brute force and a public tokenizer library."""

import json
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks.queries import _words
from corpusloom.config import Settings, SpecialTokens
from corpusloom.functions import symbols, text
from corpusloom.operators import bpe, encoding, vocabulary
from corpusloom.plans.jobs import is_instruct_ready
from corpusloom.sources.tokenizer_store import (
    Tokenizer,
    load_tokenizer,
    save_tokenizer,
    select_tokenizer_path,
)

TOKENS = SpecialTokens()


def brute_force_merges(words, vocab_size):
    """One merge at a time over Python lists of token strings and their ids."""
    visible = symbols.byte_characters()
    ids = {token: i for i, token in enumerate(TOKENS.trained)}
    ids |= {visible[b]: 5 + i for i, b in enumerate(symbols.byte_order())}
    state = [([visible[b] for b in w.encode()], n) for w, n in words]
    merges = []
    while len(ids) < vocab_size:
        counts = Counter()
        for tokens, n in state:
            for pair in zip(tokens, tokens[1:]):
                counts[pair] += n
        ranked = [p for p in counts if counts[p] >= 2]
        if not ranked:
            break
        best = min(ranked, key=lambda p: (-counts[p], ids[p[0]], ids[p[1]]))
        spelled = best[0] + best[1]
        ids.setdefault(spelled, len(ids))
        merges.append((*best, spelled))
        for tokens, _ in state:
            i = 0
            while i < len(tokens) - 1:
                if (tokens[i], tokens[i + 1]) == best:
                    tokens[i : i + 2] = [spelled]
                i += 1
    return merges


def learned(spark, words, vocab_size):
    frame = spark.createDataFrame(words, "word STRING, n BIGINT")
    rows = bpe.learn_merges(frame, Settings(vocab_size=vocab_size)).orderBy("rank").collect()
    return [(r["left"], r["right"], r["merged"]) for r in rows]


@pytest.mark.parametrize("seed", range(4))
def test_merges_equal_one_at_a_time(spark, seed):
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "abcdeé "
    words = {"".join(rng.choices(letters, k=rng.randint(1, 12))): rng.randint(1, 9) for _ in range(60)}
    words["a" * 37] = 3
    got = learned(spark, list(words.items()), 261 + 40)
    assert got == brute_force_merges(list(words.items()), 261 + 40)


def test_merge_of_a_known_token_keeps_its_id(spark):
    words = [("abc", 10), ("bc", 20), ("ab", 25), ("xabc", 3), ("abcx", 2), ("aab", 5)]
    got = learned(spark, words, 261 + 40)
    assert got == brute_force_merges(words, 261 + 40)


@pytest.mark.parametrize("held", [8, 60, 1 << 20])
@pytest.mark.parametrize("seed", range(2))
def test_merges_do_not_depend_on_the_rounds(spark, monkeypatch, seed, held):
    """Rounds of few pairs, and chains beyond what the driver holds, give the same merges."""
    monkeypatch.setattr(bpe, "_ROUND_PAIRS", 4)
    monkeypatch.setattr(bpe, "_CHAIN_SYMBOLS", held)
    monkeypatch.setattr(bpe, "_TASK_CHAINS", 3)
    rng = random.Random(seed)
    words = {"".join(rng.choices("abcd", k=rng.randint(1, 9))): rng.randint(1, 9) for _ in range(60)}
    words |= {"a" * 37: 3, "abc": 10, "bc": 20, "ab": 25}
    got = learned(spark, list(words.items()), 261 + 25)
    assert got == brute_force_merges(list(words.items()), 261 + 25)


@pytest.mark.parametrize(("kept", "least", "merges"), [(40, 12, 30), (9, 3, 15), (1, 0, 5)])
def test_merges_do_not_depend_on_the_pairs_kept(spark, monkeypatch, kept, least, merges):
    """Pairs left out are counted anew in time, and words set aside come back."""
    monkeypatch.setattr(bpe, "_KEPT_PAIRS", kept)
    monkeypatch.setattr(bpe, "_LEAST_KEPT", least)
    rng = random.Random(kept)
    words = {"".join(rng.choices("abcdefgh", k=rng.randint(1, 9))): rng.randint(1, 9) for _ in range(90)}
    words |= {"a" * 21: 3, "abc": 10, "bc": 20, "ab": 25, "zq": 2, "y": 4}
    got = learned(spark, list(words.items()), 261 + merges)
    assert got == brute_force_merges(list(words.items()), 261 + merges)


def test_pairs_come_to_the_driver_packed(spark, monkeypatch):
    monkeypatch.setattr(bpe, "_ROW_PAIRS", 64)
    rng = random.Random(5)
    words = [("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=8)), 2) for _ in range(600)]
    words = sorted(dict(words).items())
    collect, sizes = type(spark.range(0)).collect, []

    def counted(frame):
        rows = collect(frame)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(type(spark.range(0)), "collect", counted)
    state = bpe._Training(spark.createDataFrame(words, "word STRING, n BIGINT"), Settings())
    monkeypatch.undo()
    every = Counter(pair for w, n in words for pair in zip(w, w[1:]) for _ in range(n))
    assert sorted(state.leading.counts.tolist()) == sorted(every.values())
    assert len(every) > 1_000 and max(sizes) < 100


@pytest.mark.parametrize("most", [1, 700, 2_000])
def test_the_first_pairs_come_in_order_also_from_many_small_partitions(spark, monkeypatch, most):
    monkeypatch.setattr(bpe, "_ROW_PAIRS", 1_000)
    rows = spark.range(1_500, numPartitions=200).select("id", (F.col("id") * 2).alias("n"))
    codes, numbers = bpe._Training._first(rows, most)
    assert codes.tolist() == list(range(min(most, 1_500)))
    assert numbers.tolist() == [2 * i for i in range(min(most, 1_500))]


def test_words_are_those_of_the_published_pattern(spark):
    space = text.SPACE_CLASS
    published = (
        r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
        rf"| ?[^{space}\p{{L}}\p{{N}}]+|[{space}]+(?![^{space}])|[{space}]+"
    )
    rng = random.Random(3)
    signs = [" "] * 6 + list("stdlrvem'a\u00e91\u0663.,\n\t\u00a0\u3000\x1c\x85\u200b\U0001f600")
    rows = [("".join(rng.choices(signs, k=rng.randrange(60))),) for _ in range(2_000)]
    cut = spark.createDataFrame(rows, "text STRING").select(
        text.pretokenize(F.col("text")).alias("now"),
        F.regexp_extract_all("text", F.lit(published), F.lit(0)).alias("published"),
    )
    assert cut.filter("now <> published").count() == 0


def test_counted_texts_use_every_core(spark, data):
    plan = _words(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[doc_id#\d+L?\], {spark.sparkContext.defaultParallelism}\b", plan)


def test_words_come_back_with_their_final_ids(spark):
    words = {"naïve": 7, "nave": 5, " wave": 4, "日本語": 3, "x": 9, "q" * 300: 2, "日": 3}
    frame = spark.createDataFrame(list(words.items()), "word STRING, n BIGINT")
    tokenizer = bpe.train_bpe(frame, Settings(vocab_size=261 + 12))
    shown = {r["id"]: r["token"] for r in tokenizer.vocab.collect()}
    byte_of = {c: b for b, c in symbols.byte_characters().items()}
    rows = tokenizer.word_tokens.collect()
    assert {r["word"]: r["n"] for r in rows} == words
    for r in rows:
        assert bytes(byte_of[c] for i in r["ids"] for c in shown[i]).decode() == r["word"]
    merges = [(r["left"], r["right"], r["merged"]) for r in tokenizer.merges.orderBy("rank").collect()]
    table = encoding.merge_table(merges, {token: i for i, token in shown.items()})
    for r in rows:
        replayed = encoding.replay_merges(symbols.symbols_of(r["word"]), table)
        assert r["ids"] == [symbols.symbol_id(c) for c in replayed]


def test_a_pair_table_finds_pairs_whose_slots_collide():
    rng = np.random.default_rng(1)
    codes = bpe.pair_codes(rng.integers(0, 900, 30_000), rng.integers(0, 900, 30_000))
    held = np.unique(codes)[::3]
    rng.shuffle(held)
    table = bpe.PairTable(held)
    left, right = rng.integers(0, 1_200, 50_000).astype(np.uint32), rng.integers(0, 1_200, 50_000).astype(np.uint32)
    at, index = table.find(left, right)
    where = {int(code): i for i, code in enumerate(held)}
    asked = bpe.pair_codes(left, right).tolist()
    assert dict(zip(at.tolist(), index.tolist(), strict=True)) == {
        i: where[code] for i, code in enumerate(asked) if code in where
    }


def test_long_words_are_not_remembered():
    table = encoding.merge_table([("a", "b", "ab")], {"a": 70, "b": 71, "ab": 300})
    memory = encoding.WordMemory(table, {})
    for i in range(200):
        assert len(memory.ids(f"{i:04d}" + "x" * 10_000)) == 10_004
    assert not memory.held
    assert memory.ids("abc") is memory.ids("abc") and len(memory.held) == 1


def test_given_words_are_bounded_in_bytes(spark):
    rows = [(f"word{i:05d}", 10_000 - i, [i, i + 1]) for i in range(2_000)] + [("y" * 10_000, 99_999, [1] * 10_000)]
    frame = spark.createDataFrame(rows, "word STRING, n BIGINT, ids ARRAY<INT>")
    head = encoding.frequent_words(frame, most_bytes=17 * 100)
    assert list(head) == [f"word{i:05d}" for i in range(100)]
    assert head["word00007"].tolist() == [7, 8]


def test_registered_query_learns_every_merge_of_the_library(spark, data):
    """The query as registered, over a vocabulary of several thousand merges."""
    tokenizers = pytest.importorskip("tokenizers")
    _, raw = texts(spark, data)
    peer = tokenizers.ByteLevelBPETokenizer()
    peer.train_from_iterator(
        raw,
        vocab_size=Settings().vocab_size,
        min_frequency=2,
        special_tokens=list(TOKENS.trained),
        show_progress=False,
    )
    rows = queries()["bpe_train"](spark, data).orderBy("rank").collect()
    wanted = json.loads(peer._tokenizer.to_str())["model"]["merges"]
    assert len(rows) > 5_000
    assert [[r["left"], r["right"]] for r in rows] == [list(pair) for pair in wanted]
    model = peer._tokenizer.model
    encoded = {r["word"]: r["ids"] for r in queries()["word_tokens"](spark, data).collect()}
    for word in random.Random(2).sample(sorted(encoded), 2_000):
        assert encoded[word] == " ".join(str(t.id) for t in model.tokenize(as_shown(word)))


def as_shown(word):
    visible = symbols.byte_characters()
    return "".join(visible[b] for b in word.encode())


def test_training_stops_without_frequent_pairs(spark):
    assert learned(spark, [("ab", 1), ("cd", 1)], 400) == []


def test_vocab_counts_a_token_once(spark):
    merges = spark.createDataFrame(
        [(0, "a", "b", "ab"), (1, "b", "c", "bc"), (2, "ab", "c", "abc"), (3, "a", "bc", "abc")],
        "rank INT, left STRING, right STRING, merged STRING",
    )
    rows = vocabulary.vocab_from_merges(spark, merges).filter("id > 260").orderBy("id").collect()
    assert [(r["id"], r["token"]) for r in rows] == [(261, "ab"), (262, "bc"), (263, "abc")]


def test_a_long_word_is_merged_in_time():
    rng = random.Random(4)
    word = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    ids = {c: 10 + i for i, c in enumerate("abcdefgh")}
    merges = [(a, b, a + b) for a in "abcd" for b in "efgh"]
    ids |= {m[2]: 100 + i for i, m in enumerate(merges)}
    table = encoding.merge_table(merges, ids)
    started = time.process_time()
    out = encoding.replay_merges("".join(symbols.symbol(ids[c]) for c in word), table)
    assert time.process_time() - started < 5
    spelled = {v: k for k, v in ids.items()}
    assert "".join(spelled[symbols.symbol_id(c)] for c in out) == word


def test_wide_and_narrow_pairs_agree(spark):
    far = "".join(symbols.symbol(i) for i in (70_000, 5, 65_000, 70_000))
    frame = spark.createDataFrame([("abcd",), ("a",), ("",), ("aaa",)], "symbols STRING")
    above = spark.createDataFrame([(far,)], "symbols STRING")
    (row,) = above.select(symbols.symbol_pairs(F.col("symbols"), 80_000).alias("p")).collect()
    assert row["p"] == [far[i : i + 2] for i in range(3)]
    narrow = symbols.symbol_pairs(F.col("symbols"), 1000)
    wide = symbols.symbol_pairs(F.col("symbols"), symbols.NARROW_IDS + 1)
    for row in frame.select(narrow.alias("a"), wide.alias("b")).collect():
        assert row["a"] == row["b"]


def test_symbols_keep_id_order():
    every = [symbols.symbol(i) for i in range(70_000)]
    assert [symbols.symbol_id(c) for c in every] == list(range(70_000))
    assert [c.encode() for c in every] == sorted(c.encode() for c in every)


def texts(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    return documents, [r["text"] for r in documents.orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def trained(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counted = vocabulary.word_counts(documents.select("doc_id", "text"))
    settings = Settings(vocab_size=261 + 100)
    return bpe.train_bpe(counted, settings)


@pytest.fixture(scope="module")
def library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    peer = tokenizers.ByteLevelBPETokenizer()
    peer.train_from_iterator(
        [r["text"] for r in rows],
        vocab_size=261 + 100,
        min_frequency=2,
        special_tokens=list(TOKENS.trained),
        show_progress=False,
    )
    peer.add_special_tokens(list(TOKENS.extra))
    return peer


def test_vocabulary_equals_library(spark, trained, library):
    vocab = vocabulary.configure_vocab(trained.vocab, True)
    ours = {r["token"]: r["id"] for r in vocab.collect()}
    assert ours == library.get_vocab()


def test_encoding_equals_library(spark, data, trained, library):
    rng = random.Random(1)
    _, raw = texts(spark, data)
    marks = list(TOKENS.trained + TOKENS.extra)
    mixed = []
    for value in raw[:120]:
        cut = rng.randint(0, len(value))
        mixed.append(f"<s>{value[:cut]}{rng.choice(marks)}  {rng.choice(marks)} {value[cut:]}</s>")
    mixed += ["", " ", "<s></s>", "a <s> b", "  <|end|>\n\n<|bot|>", "<<s>>!<|user|", "日本 é\x00\x1c x"]
    frame = spark.createDataFrame(list(enumerate(mixed)), "i INT, text STRING")
    vocab = vocabulary.configure_vocab(trained.vocab, True)
    rows = encoding.encode(frame, vocab, trained.merges).orderBy("i").collect()
    assert [list(r["ids"]) for r in rows] == [library.encode(v).ids for v in mixed]


def test_word_tokens_spell_their_words(spark, trained):
    vocab = {r["id"]: r["token"] for r in trained.vocab.collect()}
    byte_of = {c: b for b, c in symbols.byte_characters().items()}
    for row in trained.word_tokens.limit(500).collect():
        spelled = "".join(vocab[i] for i in row["ids"])
        assert bytes(byte_of[c] for c in spelled).decode() == row["word"]


def test_byte_encoding_is_bpe_without_merges(spark, data):
    documents, _ = texts(spark, data)
    ids = encoding.byte_special_ids(TOKENS, True)
    vocab = vocabulary.configure_vocab(vocabulary.base_vocab(spark), True)
    merges = spark.createDataFrame([], "rank INT, left STRING, right STRING, merged STRING")
    wrapped = documents.withColumn("text", F.concat(F.lit("<s>"), "text", F.lit("<|end|></s>")))
    both = encoding.encode(wrapped, vocab, merges).withColumn(
        "native", encoding.encode_bytes(F.col("text"), ids)
    )
    assert both.filter("ids <> native").count() == 0


def test_encoded_null_stays_null(spark, trained):
    frame = spark.createDataFrame([(None,), ("a",)], "text STRING")
    rows = encoding.encode(frame, trained.vocab, trained.merges).collect()
    assert [r["ids"] is None for r in rows] == [True, False]


def test_extend_keeps_known_ids(spark):
    vocab = vocabulary.base_vocab(spark)
    grown = vocabulary.extend_vocab(vocab, TOKENS.for_phase(True)).collect()
    ids = {r["token"]: r["id"] for r in grown}
    assert [ids[t] for t in TOKENS.trained] == [0, 1, 2, 3, 4]
    assert [ids[t] for t in TOKENS.extra] == [261, 262, 263]
    assert len(grown) == 264
    again = vocabulary.extend_vocab(spark.createDataFrame(grown), TOKENS.for_phase(True))
    assert again.count() == 264
    assert vocabulary.configure_vocab(vocab, False).count() == 261
    assert vocabulary.configure_vocab(vocab, True, ready=True).count() == 261


def test_audit_with_empty_extras(spark):
    vocabs = spark.createDataFrame([("a", "x")], "tokenizer STRING, token STRING")
    templates = spark.createDataFrame([("a", "t")], "tokenizer STRING, chat_template STRING")
    row = vocabulary.instruct_audit(vocabs, templates, []).first()
    assert (row["ready"], row["outcome"]) == (False, "template without tokens")


def test_ready_tokenizer(spark):
    merges = spark.createDataFrame([], "rank INT, left STRING, right STRING, merged STRING")
    base = vocabulary.base_vocab(spark)
    grown = Tokenizer(vocabulary.configure_vocab(base, True), merges)
    assert is_instruct_ready(grown, True, Settings())
    assert not is_instruct_ready(grown, False, Settings())
    assert not is_instruct_ready(Tokenizer(base, merges), True, Settings())


def test_store_roundtrip(spark, trained, tmp_path):
    save_tokenizer(trained, str(tmp_path / "tok"))
    loaded = load_tokenizer(spark, str(tmp_path / "tok"))
    assert loaded.vocab.exceptAll(trained.vocab).count() == 0
    assert loaded.merges.exceptAll(trained.merges).count() == 0
    assert loaded.word_tokens.count() == trained.word_tokens.count()


def test_tokenizer_selection():
    assert select_tokenizer_path("own", "own-it", None, False, False) == "own"
    assert select_tokenizer_path("own", "own-it", "given", True, False) == "given"
    assert select_tokenizer_path("own", "own-it", "given", False, True) == "own"
    assert select_tokenizer_path("own", "own-it", "given", True, True) == "own-it"


def test_new_words_of_a_batch_are_merged_together(monkeypatch):
    draw = random.Random(5)
    letters = [symbols.symbol_id(c) for c in symbols.symbols_of("abcd é")]
    merges, held = {}, list(letters)
    while len(merges) < 400:
        pair = symbols.symbol(draw.choice(held)) + symbols.symbol(draw.choice(held[-60:] + letters))
        if pair not in merges:
            held.append(261 + len(merges))
            merges[pair] = (len(merges), symbols.symbol(held[-1]))
    words = ["".join(draw.choice("abcd é") for _ in range(draw.randint(1, 30))) for _ in range(3000)] + ["aaaaa", "aa"]
    expected = {w: [symbols.symbol_id(c) for c in encoding.replay_merges(symbols.symbols_of(w), merges)] for w in words}
    memory = encoding.WordMemory(merges, {})
    memory.learn([words, None])
    monkeypatch.setattr(encoding, "replay_merges", None)  # nothing is left to merge one by one
    assert {w: list(memory.ids(w)) for w in words} == expected
