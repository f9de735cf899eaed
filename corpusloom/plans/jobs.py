"""The three jobs of a run, linked by tables: tokenizer, preparation, batches.

Each job only reads tables and publishes its own output as a whole, so it can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.operators.bpe import train_bpe
from corpusloom.operators.encoding import CollateIds, collate, encode
from corpusloom.operators.layout import training_layout
from corpusloom.operators.prepare import (
    KEPT,
    REJECT_REASONS,
    Processor,
    empty_batches,
    split_rows,
)
from corpusloom.operators.vocabulary import configure_vocab, instruct_audit, word_counts
from corpusloom.plans.steps import plan_of_counts, plan_summary, require_steps
from corpusloom.session import scratch_path
from corpusloom.sources.tables import (
    INSTRUCT,
    PRETRAIN,
    DatasetPaths,
    needs_training,
    publish_prepared,
    read_prepared,
    scan,
    scan_corpus,
    stage_prepared,
)
from corpusloom.sources.tokenizer_store import (
    Tokenizer,
    load_tokenizer,
    save_tokenizer,
    select_tokenizer_path,
)

# Micro-batches kept together in one output file.
_FILE_BATCHES = 4096


def is_instruct_ready(tokenizer: Tokenizer, has_template: bool, settings: Settings) -> bool:
    """Whether a tokenizer already has a chat template and all extra tokens."""
    vocabs = tokenizer.vocab.select(F.lit("own").alias("tokenizer"), "token")
    template = F.lit("template") if has_template else F.lit(None).cast("string")
    templates = tokenizer.vocab.limit(1).select(
        F.lit("own").alias("tokenizer"), template.alias("chat_template")
    )
    return instruct_audit(vocabs, templates, settings.tokens.extra).first()["ready"]


def tokenizer_job(
    spark: SparkSession,
    paths: DatasetPaths,
    target: str,
    instruct: bool = False,
    resume: bool = False,
    override: str | None = None,
    own: str | None = None,
    own_instruct: str | None = None,
    has_template: bool = False,
    settings: Settings = Settings(),
) -> None:
    """Train a tokenizer on a fresh pretraining run, else load one; then add the specials."""
    if needs_training(instruct, resume, override):
        counted = scratch_path(spark, "word-counts")
        word_counts(scan_corpus(spark, paths)).write.parquet(counted)
        tokenizer = train_bpe(spark.read.parquet(counted), settings)
    else:
        source = select_tokenizer_path(own, own_instruct, override, instruct, resume)
        tokenizer = load_tokenizer(spark, source, with_words=False)
    ready = instruct and is_instruct_ready(tokenizer, has_template, settings)
    vocab = configure_vocab(tokenizer.vocab, instruct, settings.tokens, ready)
    save_tokenizer(Tokenizer(vocab, tokenizer.merges, tokenizer.word_tokens), target)


@dataclass(frozen=True)
class Preparation:
    """What a preparation wrote, and whether its plan has update steps."""

    n_examples: int
    n_chars: int
    rejected: dict[str, int]
    plan_status: str


def prepare_job(
    spark: SparkSession,
    paths: DatasetPaths,
    target: str,
    instruct: bool = False,
    keys: Sequence[str] = ("doc_id",),
    processor: str | Processor = "default",
    guard_batches: bool = False,
    settings: Settings = Settings(),
) -> Preparation:
    """Format the phase's dataset and write kept and rejected rows: one stage, one pass.

    Counts are taken while the rows are written. With guard_batches the job fails, and leaves
    the last version of the phase, where a formatting batch, in key order, has no row that
    survives; that reads the keys of the rows just written, not the texts.
    """
    phase = INSTRUCT if instruct else PRETRAIN
    rows = split_rows(scan(spark, paths, instruct, *keys), processor, instruct, settings.tokens)
    kept, seen = F.col("status") == KEPT, Observation()
    counted = rows.withColumn("phase", F.lit(phase)).observe(
        seen,
        F.count_if(kept).alias("n_examples"),
        F.coalesce(F.sum(F.when(kept, F.length("text")).cast("bigint")), F.lit(0)).alias("n_chars"),
        *[F.count_if(F.col("reject_reason") == reason).alias(reason) for reason in REJECT_REASONS],
    )
    staged = stage_prepared(counted, target)
    found = dict(seen.get)
    if guard_batches and found["n_examples"] + sum(found[r] for r in REJECT_REASONS):
        written = spark.read.parquet(staged).select(*keys, "status")
        empty_batches(written, list(keys), settings.format_batch, kept, strict=True)
    publish_prepared(spark, staged, target)
    counts = spark.createDataFrame([(phase, found["n_examples"])], "phase STRING, n_examples BIGINT")
    return Preparation(
        found["n_examples"],
        found["n_chars"],
        {reason: found[reason] for reason in REJECT_REASONS},
        plan_of_counts(counts, settings).first()["status"],
    )


def batch_job(
    spark: SparkSession,
    prepared_path: str,
    tokenizer_path: str,
    target: str,
    epochs: int,
    instruct: bool = False,
    keys: Sequence[str] = ("doc_id",),
    settings: Settings = Settings(),
) -> DataFrame:
    """Encode, lay out and collate the prepared texts; returns the written batches.

    Encoded texts are written once, as collation reads their lengths and then their ids.
    Batches are written per epoch and rank, in blocks of consecutive batches, so the number
    of files follows the data and not the number of tasks.
    """
    keys = list(keys)
    phase = INSTRUCT if instruct else PRETRAIN
    prepared = read_prepared(spark, prepared_path, phase)
    require_steps(plan_summary(prepared, settings))
    tokenizer = load_tokenizer(spark, tokenizer_path)
    known = {
        row["token"]: row["id"]
        for row in tokenizer.vocab.filter("special").select("token", "id").collect()
    }
    tokens = settings.tokens
    ids = CollateIds(known[tokens.pad], known.get(tokens.bot_marker), known.get(tokens.end_marker))
    encoded_path = scratch_path(spark, "encoded")
    encoded = encode(
        prepared.select(*keys, "text"), tokenizer.vocab, tokenizer.merges, word_tokens=tokenizer.word_tokens
    )
    encoded.select(*keys, "ids").write.parquet(encoded_path)
    encoded = spark.read.parquet(encoded_path)
    layout = training_layout(prepared.select(*keys), keys, epochs, settings)
    block = F.expr(f"batch_no div {_FILE_BATCHES}")
    together = [F.col("epoch"), F.col("rank"), block]
    batches = collate(encoded, layout, keys, ids, settings, instruct, together)
    batches.sortWithinPartitions("epoch", "rank", "batch_no", "pos").write.mode("overwrite").partitionBy("epoch", "rank").parquet(target)
    return spark.read.parquet(target)
