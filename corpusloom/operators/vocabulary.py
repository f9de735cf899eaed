"""Word, byte and pair counts, and operations on vocabulary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.config import SpecialTokens
from corpusloom.functions.symbols import (
    SPECIAL_IDS,
    byte_characters,
    byte_order,
)
from corpusloom.functions.text import adjacent_pairs, pretokenize, utf8_hex_bytes
from corpusloom.operators.prepare import drop_blank


def word_counts(corpus: DataFrame, *by: str) -> DataFrame:
    """How often each word occurs in the raw, not blank texts of a corpus.

    Words are counted inside each task first, so a frequent word crosses the shuffle once
    per task.
    """
    words = drop_blank(corpus).select(*by, F.explode(pretokenize(F.col("text"))).alias("word"))
    return words.groupBy(*by, "word").agg(F.count("*").alias("n"))


def byte_words(words: DataFrame) -> DataFrame:
    """Words with the array of their UTF-8 bytes, as hex symbols."""
    return words.withColumn("symbols", utf8_hex_bytes(F.col("word")))


def byte_histogram(words: DataFrame) -> DataFrame:
    """Occurrences of each byte in a corpus, from its counted words.

    The bytes are exploded where they are made: a column of them would let the optimizer put
    a filter on it below the word count, where it runs once per occurrence.
    """
    return (
        words.select(F.explode(utf8_hex_bytes(F.col("word"))).alias("byte"), "n")
        .groupBy("byte")
        .agg(F.sum("n").alias("n"))
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """Occurrences of neighbouring symbols (left, right), weighted by the word counts."""
    return (
        words.select(F.explode(adjacent_pairs(F.col("symbols"))).alias("pair"), "n")
        .groupBy("pair.left", "pair.right")
        .agg(F.sum("n").alias("n"))
    )


def pair_merges(counts: DataFrame, at_most: int | None = None) -> DataFrame:
    """Merges that join single bytes, the most frequent pairs first: a vocabulary without training.

    counts(left, right, n) are those of pair_counts over bytes, 65,536 at most, so one window over
    them is small. Ties go to the smaller left byte, then right byte.
    """
    shown = byte_characters()
    visible = F.create_map(*[F.lit(x) for b, c in shown.items() for x in (f"{b:02X}", c)])
    order = Window.orderBy(F.desc("n"), "left", "right")
    ranked = counts.filter("n > 1").withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked if at_most is None else ranked.filter(F.col("rank") < at_most)
    return ranked.select(
        "rank",
        F.element_at(visible, F.col("left")).alias("left"),
        F.element_at(visible, F.col("right")).alias("right"),
    ).withColumn("merged", F.concat("left", "right"))


def base_vocab(spark: SparkSession, tokens: SpecialTokens = SpecialTokens()) -> DataFrame:
    """The trained specials and the 256 bytes: ids 0 to 260."""
    shown = byte_characters()
    rows = [(i, token, True) for i, token in enumerate(tokens.trained)]
    rows += [(SPECIAL_IDS + i, shown[b], False) for i, b in enumerate(byte_order())]
    return spark.createDataFrame(rows, "id INT, token STRING, special BOOLEAN")


def base_size(tokens: SpecialTokens = SpecialTokens()) -> int:
    """Ids that every trained vocabulary begins with."""
    return len(tokens.trained) + len(byte_order())


def vocab_from_merges(
    spark: SparkSession, merges: DataFrame, tokens: SpecialTokens = SpecialTokens()
) -> DataFrame:
    """Ids: specials, then bytes, then merged tokens by the rank of their first merge.

    merges has at most vocab_size rows, so one window over all of it is small.
    """
    base = base_vocab(spark, tokens)
    first = merges.groupBy(F.col("merged").alias("token")).agg(F.min("rank").alias("rank"))
    offset = SPECIAL_IDS + 256 - 1
    merged = first.select(
        (F.row_number().over(Window.orderBy("rank")) + offset).alias("id"),
        "token",
        F.lit(False).alias("special"),
    )
    return base.unionByName(merged)


def extend_vocab(vocab: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Append special tokens in order; one already present keeps its id.

    Specials are a handful and the vocabulary is bounded, so ids come from a small window.
    """
    spark = vocab.sparkSession
    wanted = spark.createDataFrame(
        [(place, token) for place, token in enumerate(dict.fromkeys(specials))],
        "ord INT, token STRING",
    )
    present = wanted.join(vocab, "token", "left_semi").select("token", F.lit(True).alias("named"))
    kept = vocab.join(F.broadcast(present), "token", "left").select(
        "id", "token", (F.col("special") | F.coalesce("named", F.lit(False))).alias("special")
    )
    top = vocab.agg(F.max("id").alias("top")).scalar()
    new = wanted.join(vocab, "token", "left_anti").select(
        (top + F.row_number().over(Window.orderBy("ord"))).cast("int").alias("id"),
        "token",
        F.lit(True).alias("special"),
    )
    return kept.unionByName(new)


def configure_vocab(
    vocab: DataFrame,
    instruct: bool,
    tokens: SpecialTokens = SpecialTokens(),
    ready: bool = False,
) -> DataFrame:
    """Add the phase's special tokens; left as it is when already ready for instruction."""
    return vocab if instruct and ready else extend_vocab(vocab, tokens.for_phase(instruct))


def token_ids(vocab: DataFrame, tokens: DataFrame) -> DataFrame:
    """The ids of tokens(name, token). The vocabulary is bounded; Spark sizes the join."""
    return tokens.join(vocab.select("id", "token"), "token").select("name", "token", "id")


def instruct_audit(
    vocabs: DataFrame, templates: DataFrame, extra: Sequence[str]
) -> DataFrame:
    """Which tokenizers are ready for instruction tuning.

    vocabs(tokenizer, token), templates(tokenizer, chat_template). A tokenizer is ready when
    it has a template and every extra token; an empty list of extra tokens counts as missing.
    """
    wanted = len(set(extra))
    found = (
        vocabs.filter(F.col("token").isin(*extra) if wanted else F.lit(False))
        .groupBy("tokenizer")
        .agg(F.countDistinct("token").alias("n_found"))
    )
    has_template = F.col("chat_template").isNotNull()
    has_tokens = (F.coalesce("n_found", F.lit(0)) == wanted) & F.lit(wanted > 0)
    return templates.join(found, "tokenizer", "left").select(
        "tokenizer",
        has_template.alias("has_template"),
        has_tokens.alias("has_tokens"),
        (has_template & has_tokens).alias("ready"),
        F.when(has_template & has_tokens, "ready")
        .when(has_template, "template without tokens")
        .when(has_tokens, "tokens without template")
        .otherwise("not configured")
        .alias("outcome"),
    )
