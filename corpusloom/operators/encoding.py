"""Encode texts to token ids; truncate, pad, mask and label them for training."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import Settings, SpecialTokens
from corpusloom.functions.symbols import (
    SPECIAL_IDS,
    byte_order,
    symbol,
    symbol_id,
    symbols_of,
)
from corpusloom.functions.text import pretokenize_around
from corpusloom.operators.bpe import PairTable, Words, merge_words, pair_codes

BATCH_KEYS = ("epoch", "rank", "batch_no")

# Words an encoding task remembers, and how long they are at most; the memory is emptied when full.
_REMEMBERED_WORDS = 1 << 17
_REMEMBERED_LENGTH = 48
# New words merged at once.
_LEARNED_AT_ONCE = 1 << 14
#: Words, and bytes of words and ids, that go to the tasks already encoded.
_HEAD_WORDS = 1 << 16
HEAD_BYTES = 8 << 20

_BYTE_IDS = np.zeros(256, dtype=np.uint32)
_BYTE_IDS[byte_order()] = np.arange(SPECIAL_IDS, SPECIAL_IDS + 256)


def merge_table(
    merges: list[tuple[str, str, str]], ids: dict[str, int]
) -> dict[str, tuple[int, str]]:
    """Symbol pair -> (rank, merged symbol); a repeated pair keeps its first rank."""
    table: dict[str, tuple[int, str]] = {}
    for rank, (left, right, merged) in enumerate(merges):
        table.setdefault(symbol(ids[left]) + symbol(ids[right]), (rank, symbol(ids[merged])))
    return table


def replay_merges(symbols: str, table: dict[str, tuple[int, str]]) -> str:
    """Merge the pair of the lowest rank, everywhere, until no pair is in the table.

    A heap of pairs over linked symbols, lowest rank and then leftmost first, so that a word
    of n symbols takes n log n steps.
    """
    n = len(symbols)
    held: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (table[pair][0], at, pair)
        for at in range(n - 1)
        if (pair := symbols[at : at + 2]) in table
    ]
    heapify(heap)
    while heap:
        _, at, pair = heappop(heap)
        right = after[at]
        if right >= n or held[at] != pair[0] or held[right] != pair[1]:
            continue
        held[at], held[right] = table[pair][1], None
        after[at] = after[right]
        if after[at] < n:
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] < n:
                fresh = held[left] + held[after[left]]
                if fresh in table:
                    heappush(heap, (table[fresh][0], left, fresh))
    return "".join(c for c in held if c is not None)


class WordMemory:
    """The ids of words: given ones, and those merged before.

    Long words are merged anew each time, so that what is remembered is bounded in bytes: at most
    _REMEMBERED_WORDS words of _REMEMBERED_LENGTH characters, some 64 MB.
    """

    def __init__(self, merges: dict[str, tuple[int, str]], given: dict[str, array]) -> None:
        self.merges, self.given = merges, given
        self.held: dict[str, array] = {}
        pairs = [(symbol_id(pair[0]), symbol_id(pair[1]), symbol_id(m)) for pair, (_, m) in merges.items()]
        # A merge into a symbol that an earlier merge takes depends on the place: word by word then.
        self.together = all(a < m > b for a, b, m in pairs) and all(
            x[2] < y[2] for x, y in zip(pairs, pairs[1:])
        )
        if pairs and self.together:
            left, right, merged = (np.array(c, dtype=np.uint32) for c in zip(*pairs, strict=True))
            self.table, self.merged = PairTable(pair_codes(left, right)), merged

    def learn(self, texts: Iterable[Sequence[str] | None]) -> None:
        """Merge the words of texts that are not known yet, all at once, as arrays."""
        if not (self.merges and self.together):
            return
        fresh = {w for words in texts if words is not None for w in words}
        fresh = [w for w in fresh if len(w) <= _REMEMBERED_LENGTH and w not in self.given and w not in self.held]
        for first in range(0, len(fresh), _LEARNED_AT_ONCE):
            some = [w.encode() for w in fresh[first : first + _LEARNED_AT_ONCE]]
            sizes = np.array([len(w) for w in some], dtype=np.int64)
            laid = Words(np.arange(len(some)), sizes, _BYTE_IDS[np.frombuffer(b"".join(some), np.uint8)])
            done = merge_words(laid, self.table, self.merged)
            ends, ids = np.cumsum(done.sizes).tolist(), array("i", done.symbols.astype("i4").tobytes())
            if len(self.held) + len(some) > _REMEMBERED_WORDS:
                self.held.clear()
            start = 0
            for which, end in zip((done.counts + first).tolist(), ends, strict=True):
                self.held[fresh[which]] = ids[start:end]
                start = end

    def ids(self, word: str) -> array:
        found = self.given.get(word)
        if found is None:
            found = self.held.get(word)
        if found is None:
            found = array("i", map(symbol_id, replay_merges(symbols_of(word), self.merges)))
            if len(word) <= _REMEMBERED_LENGTH:
                if len(self.held) >= _REMEMBERED_WORDS:
                    self.held.clear()
                self.held[word] = found
        return found


def frequent_words(word_tokens: DataFrame, most_bytes: int = HEAD_BYTES) -> dict[str, array]:
    """The most frequent words of word_tokens(word, n, ids) with their ids, bounded in bytes."""
    rows = (
        word_tokens.filter(F.length("word") <= _REMEMBERED_LENGTH)
        .orderBy(F.desc("n"), "word")
        .select("word", "ids")
        .limit(_HEAD_WORDS)
        .toArrow()
    )
    head: dict[str, array] = {}
    for word, ids in zip(rows.column("word").to_pylist(), rows.column("ids").to_pylist(), strict=True):
        most_bytes -= len(word.encode()) + 4 * len(ids)
        if most_bytes < 0:
            break
        head[word] = array("i", ids)
    return head


def _id_lookup(
    vocab: DataFrame, merges: DataFrame, word_tokens: DataFrame | None = None
) -> Callable[[Column], Column]:
    """A column function from arrays of words to arrays of ids.

    The vocabulary and the merges go to the tasks, at most vocab_size rows of both, and the head
    of the words already encoded, at most HEAD_BYTES.
    """
    spark = vocab.sparkSession
    rows = vocab.select("id", "token", "special").collect()
    ranked = merges.orderBy("rank").select("left", "right", "merged").collect()
    ids = {row["token"]: row["id"] for row in rows}
    table = merge_table([tuple(row) for row in ranked], ids)
    given = {} if word_tokens is None else frequent_words(word_tokens)
    given |= {row["token"]: array("i", [row["id"]]) for row in rows if row["special"]}
    shared = spark.sparkContext.broadcast((table, given))

    @F.pandas_udf("array<int>")
    def lookup(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory = WordMemory(*shared.value)
        for texts in batches:
            memory.learn(texts)
            out: list[array | None] = []
            for words in texts:
                encoded = array("i")
                for word in words if words is not None else ():
                    encoded += memory.ids(word)
                out.append(encoded if words is not None else None)
            yield pd.Series(out, dtype=object)

    return lookup


def encode(
    df: DataFrame,
    vocab: DataFrame,
    merges: DataFrame,
    text: str = "text",
    word_tokens: DataFrame | None = None,
) -> DataFrame:
    """Add the token ids of whole texts. Special tokens in a text are matched first.

    Texts are cut into words by generated code; tasks map words to ids and remember them,
    so a frequent word is merged once per task, or not at all where word_tokens(word, n, ids)
    of the same merges are given. No shuffle, and no begin or end token is added: those are
    part of the prepared text.
    """
    specials = [r["token"] for r in vocab.filter("special").select("token").collect()]
    words = pretokenize_around(F.col(text), specials)
    return df.withColumn("ids", _id_lookup(vocab, merges, word_tokens)(words))


def encode_words(words: DataFrame, vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """The encoding of counted distinct words: (word, n, ids)."""
    return words.withColumn("ids", _id_lookup(vocab, merges)(F.array("word")))


def encode_bytes(text: Column, special_ids: dict[str, int]) -> Column:
    """Token ids under a tokenizer without merges: Arrow tasks look up all bytes of a batch at once.

    Special tokens are matched first, the longest first, within a text.
    """
    ids = {token.encode(): i for token, i in special_ids.items()}
    marks = re.compile(b"|".join(re.escape(t) for t in sorted(ids, key=lambda t: (-len(t), t))))
    lookup = _BYTE_IDS.astype(np.int32)

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        missing = texts.is_null()
        filled = pa.concat_arrays([texts.fill_null(b"")])  # offsets from 0 on
        _, offsets, held = filled.buffers()
        ends = np.frombuffer(offsets, np.int32, len(filled) + 1, 4 * filled.offset) if len(filled) else np.zeros(1, int)
        data = held.to_pybytes()[ends[0] : ends[-1]] if held is not None else b""
        ends = ends - ends[0]
        values, stays = lookup[np.frombuffer(data, np.uint8)], np.ones(len(data), dtype=bool)
        bounds = ends.tolist()
        for start, end in zip(bounds, bounds[1:]):
            for mark in marks.finditer(data, start, end) if ids else ():
                values[mark.start()] = ids[mark.group()]
                stays[mark.start() + 1 : mark.end()] = False
        kept = np.concatenate([[0], np.cumsum(stays)]).astype(np.int32)[ends]
        return pa.ListArray.from_arrays(pa.array(kept), pa.array(values[stays]), mask=missing)

    return encoded(text.cast("binary"))


def byte_special_ids(tokens: SpecialTokens, instruct: bool) -> dict[str, int]:
    """Ids of the specials in a tokenizer without merges, extra tokens after the bytes."""
    ids = {token: place for place, token in enumerate(tokens.trained)}
    if instruct:
        ids |= {t: SPECIAL_IDS + len(byte_order()) + i for i, t in enumerate(tokens.extra)}
    return ids


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def pad_lengths(layout: DataFrame, pad_multiple: int) -> DataFrame:
    """Add pad_to: the longest n_ids of the batch, rounded up. Takes slim rows without ids."""
    longest = F.max("n_ids").over(Window.partitionBy(*BATCH_KEYS))
    return layout.withColumn(
        "pad_to", (F.ceil(longest / pad_multiple) * pad_multiple).cast("int")
    )


def mask_labels(ids: Column, bot_id: int, end_id: int, ignore: int) -> Column:
    """Labels that keep only what stands between a bot marker and the next end marker.

    The row is cut at its end markers; in each piece everything up to and including the
    first bot marker is ignored, and all of it where there is none. Linear in the row.
    """
    places = F.transform(ids, lambda x, i: F.when(x == end_id, i))
    ends = F.filter(places, lambda i: i.isNotNull())
    starts = F.concat(F.array(F.lit(-1)), ends)
    stops = F.concat(ends, F.array(F.size(ids)))
    pieces = F.zip_with(
        starts, stops, lambda start, stop: F.slice(ids, start + 2, stop - start - 1)
    )

    def labelled(piece: Column) -> Column:
        bot = F.array_position(piece, F.lit(bot_id)).cast("int")
        masked = F.when(bot == 0, F.size(piece)).otherwise(bot)
        kept = F.slice(piece, masked + 1, F.size(piece) - masked)
        closing = F.array(F.lit(ignore))
        return F.concat(F.array_repeat(F.lit(ignore), masked), kept, closing)

    # Every piece closes with one label for its end marker; the last piece has none.
    return F.slice(F.flatten(F.transform(pieces, labelled)), F.lit(1), F.size(ids))


@dataclass(frozen=True)
class CollateIds:
    """Ids that collation needs; the markers are used in the instruct phase only."""

    pad: int
    bot: int | None = None
    end: int | None = None


def collate(
    encoded: DataFrame,
    layout: DataFrame,
    keys: Sequence[str],
    ids: CollateIds,
    settings: Settings = Settings(),
    instruct: bool = False,
    together: Sequence[Column] = (),
) -> DataFrame:
    """One row per example of each epoch: input_ids, attention_mask and labels.

    The padded length is found on slim rows (keys and lengths); the id arrays are then
    shuffled once, to meet their layout row, which is the side a hash table is built of.
    Rows that belong `together` are brought there as bare ids, before masks and labels are
    made. Pass encoded(*keys, ids, ..) as a stored table, as it is read twice; its further
    columns are carried along.
    """
    keys = list(keys)
    cut = encoded.withColumn("ids", truncate(F.col("ids"), settings.max_length))
    lengths = cut.select(*keys, F.size("ids").alias("n_ids"))
    sized = pad_lengths(layout.join(lengths, keys), settings.pad_multiple)
    fill = F.col("pad_to") - F.col("n_ids")
    met = cut.join(sized.hint("shuffle_hash"), keys)
    rows = (met.repartition(*together) if together else met).withColumns(
        {
            "input_ids": F.concat("ids", F.array_repeat(F.lit(ids.pad), fill)),
            "attention_mask": F.concat(
                F.array_repeat(F.lit(1), F.col("n_ids")), F.array_repeat(F.lit(0), fill)
            ),
        }
    )
    if instruct:
        labels = mask_labels(F.col("input_ids"), ids.bot, ids.end, settings.ignore_label)
    else:
        labels = F.col("input_ids")
    return rows.withColumn("labels", labels).drop("ids")


def supervision_stats(
    batches: DataFrame, by: Sequence[str], settings: Settings = Settings()
) -> DataFrame:
    """Tokens, pads and supervised labels per group, from collated rows.

    Every row is reduced to three numbers before the shuffle.
    """
    kept = F.size(F.filter("labels", lambda label: label != settings.ignore_label))
    reduced = batches.select(
        *by,
        F.col("n_ids").cast("bigint").alias("n_ids"),
        (F.col("pad_to") - F.col("n_ids")).cast("bigint").alias("n_pad"),
        kept.cast("bigint").alias("n_kept"),
    )
    return reduced.groupBy(*by).agg(
        F.count("*").alias("n_examples"),
        F.sum("n_ids").alias("n_tokens"),
        F.sum("n_pad").alias("n_pads"),
        F.sum("n_kept").alias("n_kept"),
        F.round(F.sum("n_kept") / F.sum(F.col("n_ids") + F.col("n_pad")), 9).alias("kept_share"),
    )
