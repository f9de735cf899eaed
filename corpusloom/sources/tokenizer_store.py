"""Tokenizer artefacts as Parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import snapshots

_TABLES = ("vocab", "merges", "word_tokens")


@dataclass(frozen=True)
class Tokenizer:
    """vocab(id, token, special), merges(rank, left, right, merged), word_tokens(word, n, ids).

    vocab and merges hold at most vocab_size rows. word_tokens grows with the corpus.
    """

    vocab: DataFrame
    merges: DataFrame
    word_tokens: DataFrame | None = None


def save_tokenizer(tokenizer: Tokenizer, path: str) -> None:
    """Write all tables as one version; without word_tokens its table is empty.

    A save that dies leaves the tokenizer before it whole.
    """
    spark = tokenizer.vocab.sparkSession

    def write(folder: str) -> None:
        for name in _TABLES:
            table = getattr(tokenizer, name)
            if table is None:
                table = spark.createDataFrame([], "word STRING, n BIGINT, ids ARRAY<INT>")
            table.write.parquet(f"{folder}/{name}")

    snapshots.save(spark, path, write)


def load_tokenizer(spark: SparkSession, path: str, with_words: bool = True) -> Tokenizer:
    """The newest tokenizer; all its tables are of one version, also where a new one is saved."""
    found = snapshots.newest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no tokenizer below {path}")
    return Tokenizer(
        spark.read.parquet(f"{found}/vocab"),
        spark.read.parquet(f"{found}/merges"),
        spark.read.parquet(f"{found}/word_tokens") if with_words else None,
    )


def select_tokenizer_path(
    own: str, own_instruct: str, override: str | None, instruct: bool, resume: bool
) -> str:
    """The override on a fresh run, else the run's own tokenizer.

    A resumed instruct run reads the tokenizer its own instruct phase wrote.
    """
    if override and not resume:
        return override
    return own_instruct if instruct and resume else own


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Size of a vocabulary with and without its special tokens."""
    return vocab.agg(
        F.count("*").alias("n_tokens"), F.count_if(~F.col("special")).alias("n_plain")
    )
