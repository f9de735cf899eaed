"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Settings, SpecialTokens
from corpusloom.functions import chat, formats, text
from corpusloom.operators import bpe, encoding, layout, positions, prepare, telemetry, vocabulary
from corpusloom.plans import steps
from corpusloom.session import apply_session_conf, scratch_path
from corpusloom.sources import run_state, tables, tokenizer_store, views
from corpusloom.streaming.abort import stream_abort as run_stream_abort
from corpusloom.streaming.keyed_abort import stream_abort_keyed as run_stream_abort_keyed
from corpusloom.streaming.prepare import read_stream_rejects
from corpusloom.streaming.prepare import stream_prepare as run_stream_prepare

Query = Callable[[SparkSession, str], DataFrame]

TOKENS = SpecialTokens()
SETTINGS = Settings(world_size=3, epochs=2.5, vocab_size=293)
EPOCHS = 3
SHAPE = telemetry.RunShape(
    batches_per_epoch=15, accumulation=2, logging_steps=3, total_steps=21
)
NONFINITE_LIMIT = 3
BUDGET_MINUTES = 20_160.0
JSON_SQL = (
    "CASE WHEN schema_of_variant(try_variant_get(try_parse_json(text), '$.content', 'variant'))"
    " = 'STRING' THEN concat(bos, try_variant_get(try_parse_json(text), '$.content', 'string'), eos)"
    " ELSE cast(cast('x' || length(text) AS INT) AS STRING) END"
)
AUDIT_WORDS = (" heitachte", " inthe", " para")
CUSTOM_SQL = "CASE WHEN contains(text, '\n') THEN concat(bos, replace(text, '\n', ' '), eos) END"

#: The queries that train a tokenizer learn the operator's own vocabulary. Their SQL repeats all
#: words for every merge, so it is held against SETTINGS.
FULL = replace(SETTINGS, vocab_size=Settings().vocab_size)

_QUERIES: dict[str, Query] = {}
_FULL_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(apply_session_conf(spark), folder)

    _QUERIES[function.__name__] = run
    return function


def _training_query(function: Callable[[SparkSession, str, Settings], DataFrame]) -> Callable:
    """A query that trains a tokenizer: with the full vocabulary, and with that of its SQL."""

    def run(settings: Settings) -> Query:
        return lambda spark, folder: function(apply_session_conf(spark), folder, settings)

    _QUERIES[function.__name__] = run(SETTINGS)
    _FULL_QUERIES[function.__name__] = run(FULL)
    return function


def _long(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


#: Numbers from 0 on up to here are spelled once and looked up.
_SPELLED = 1 << 16


def _spelled(arrays: pa.Array) -> pa.Array:
    """Arrays of numbers as arrays of texts; where all are few small ones, each is spelled once."""
    least, most = pc.min_max(arrays.values).as_py().values()
    if arrays.null_count or least is None or least < 0 or most >= min(_SPELLED, len(arrays.values)):
        return arrays.cast(pa.list_(pa.string()))
    words = pa.array(range(most + 1)).cast(pa.string()).take(arrays.values)
    return pa.ListArray.from_arrays(arrays.offsets, words)


def _numbers(array: str | Column) -> Column:
    """An array of numbers as one text, so that every engine compares it alike; made by Arrow."""

    @F.arrow_udf("string")
    def joined(arrays: pa.Array) -> pa.Array:
        return pc.binary_join(_spelled(arrays), " ")

    return joined(array)


def _dialogue(conversation: Column) -> Column:
    """A conversation as one text, roles and contents parted by control characters."""
    return F.array_join(
        F.transform(
            conversation, lambda m: F.concat(m["role"], F.lit("\x02"), m["content"])
        ),
        "\x03",
    )


def _width(spark: SparkSession) -> int:
    """Partitions of texts that cost more than their shuffle; left open, adaptive execution joins them to a few."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


# Sources and sinks


def _phase_texts(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """Both raw datasets with their phase, under one key."""
    pretrain = tables.scan(
        spark, tables.DatasetPaths(f"{folder}/documents.parquet", ""), False, "doc_id"
    )
    # Work per text outweighs its shuffle, and the given file is a single split.
    pretrain = pretrain.repartition(_width(spark), "doc_id") if heavy else pretrain
    instruct = views.chat_texts(spark, folder)
    return pretrain.select(
        F.lit(tables.PRETRAIN).alias("phase"),
        F.col("doc_id").alias("key"),
        "text",
    ).unionByName(
        instruct.select(
            F.lit(tables.INSTRUCT).alias("phase"),
            F.col("conv_id").alias("key"),
            "text",
        )
    )


def _prepared(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    instruct = F.col("phase") == tables.INSTRUCT
    return prepare.prepare(_phase_texts(spark, folder, heavy), "default", instruct, TOKENS)


@_query
def scan_phase(spark: SparkSession, folder: str) -> DataFrame:
    return _phase_texts(spark, folder)


def _documents_source(folder: str) -> str:
    """The documents as the source of a stream: a pattern meets one file as well as a folder of files."""
    return f"{folder}/documents[.]parquet"


@_query
def stream_prepare(spark: SparkSession, folder: str) -> DataFrame:
    schema = views.table(spark, folder, "documents").schema
    base = scratch_path(spark, "stream-prepare")
    run_stream_prepare(
        spark,
        _documents_source(folder),
        schema,
        f"{base}/rows",
        f"{base}/checkpoint",
        processor="strip_wrap",
    )
    return spark.read.parquet(f"{base}/rows").select("doc_id", "text")


@_query
def prepare_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "prepared")
    tables.write_prepared(_prepared(spark, folder), path)
    return tables.read_prepared(spark, path).select("phase", "key", "text")


@_query
def prepared_report(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare.prepare(views.dirty_texts(spark, folder), "wrap", False, TOKENS)
    return tables.prepared_report(prepared, "source", "lang")


@_query
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """Examples of both phases, and the size of the vocabulary they are trained with."""
    return tables.run_report(_prepared(spark, folder), _pair_vocab(spark, folder))


@_training_query
def vocab_roundtrip(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    path = scratch_path(spark, "tokenizer")
    tokenizer_store.save_tokenizer(_tokenizer(spark, folder, settings), path)
    loaded = tokenizer_store.load_tokenizer(spark, path)
    return loaded.vocab.select(_long("id"), "token", "special")


def _custom_key(number: Column) -> Column:
    """The state key that some users chose."""
    chosen = F.concat(F.lit("custom-"), number.cast("string"))
    return F.when(number % 14 == 7, chosen)


def _state_history(spark: SparkSession, folder: str) -> DataFrame:
    """States of every run at the end of every epoch, the later ones upserted into the first.

    The engine stamps them; some stamps are then lost or overwritten, for the guard to find.
    """
    progress = (
        telemetry.with_steps(views.metrics(spark, folder), SHAPE)
        .filter("closes")
        .groupBy("run_id", "epoch")
        .agg(F.max("step").alias("global_step"), F.max("ts_us").alias("updated_at"))
        .withColumns(
            {
                "owner": F.concat(F.lit("run-"), F.col("run_id").cast("string")),
                "completed": F.col("global_step") >= SHAPE.total_steps,
            }
        )
    )
    number = F.regexp_extract("owner", "[0-9]+", 0).cast("bigint")
    path = scratch_path(spark, "run-state")
    for part in (F.col("epoch") == 0, F.col("epoch") > 0):
        run_state.update_state(run_state.stamp_state(progress.filter(part), _custom_key(number)), path)
    known = run_state.read_state(spark, path)
    owner = F.regexp_extract("stamped_owner", "[0-9]+", 0).cast("bigint")
    stamp = (
        F.when(owner % 7 == 0, F.lit(None).cast("string"))
        .when(owner % 7 == 1, F.lit("run-other"))
        .otherwise(F.col("stamped_owner"))
    )
    return known.withColumn("stamped_owner", stamp)


@_query
def run_state_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = run_state.latest_state(_state_history(spark, folder))
    return latest.select(
        "state_key",
        F.coalesce("stamped_owner", F.lit("none")).alias("stamped_owner"),
        _long("global_step"),
        "completed",
        _long("updated_at"),
    )


@_query
def run_state_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Every user against the states; users without an event have no state yet."""
    customers = views.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    users = views.table(spark, folder, "events").select(F.col("user_id").alias("id"))
    owner = F.concat(F.lit("run-"), F.col("id").cast("string"))
    expected = (
        users.union(customers)
        .distinct()
        .select(
            owner.alias("owner"),
            run_state.state_key(owner, _custom_key(F.col("id"))).alias("state_key"),
            (F.col("id") % 14 == 7).alias("custom"),
        )
    )
    state = run_state.latest_state(_state_history(spark, folder))
    return run_state.guard_state(expected, state).select(
        "owner", "verdict", _long("resume_step")
    )


@_query
def run_state_close(spark: SparkSession, folder: str) -> DataFrame:
    """States left once finished instruct runs are removed."""
    finished = (
        telemetry.run_summary(views.metrics(spark, folder), SHAPE)
        .withColumn("owner", F.concat(F.lit("run-"), F.col("run_id").cast("string")))
        .select(
            run_state.state_key(F.col("owner"), _custom_key(F.col("run_id"))).alias("state_key"),
            (F.col("run_id") % 2 == 1).alias("instruct"),
            (F.col("global_step") >= SHAPE.total_steps).alias("completed"),
            (F.col("run_id") % 3 == 0).alias("custom"),
        )
    )
    state = run_state.latest_state(_state_history(spark, folder))
    return run_state.close_states(state, finished).select("state_key", _long("global_step"))


# Filters and quarantine


@_query
def filter_blank(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_blank(views.dirty_texts(spark, folder)).select("doc_id", "text")


@_query
def drop_null_results(spark: SparkSession, folder: str) -> DataFrame:
    """A processor that gives an empty string for a number and null where nothing is found."""
    rule = (
        "CASE WHEN get_json_object(text, '$.content') = '5' THEN ''"
        " ELSE concat(bos, get_json_object(text, '$.content'), eos) END"
    )
    processed = prepare.sql_processor(rule)(views.json_texts(spark, folder), F.lit(False), TOKENS)
    return prepare.drop_null_results(processed).select("doc_id", "result")


@_query
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Reject reasons of a native, a SQL and a Python processor over the same rows.

    All three read JSON. The SQL one casts to a wrong type on the way where content is no
    string, the Python one returns what is no text: neither fails the job.
    """
    both = views.json_texts(spark, folder).unionByName(views.dirty_texts(spark, folder))
    processors = {
        "native": "json_content",
        "sql": JSON_SQL,
        "python": prepare.python_processor(_json_in_python),
    }
    out = None
    for name, processor in processors.items():
        counts = (
            prepare.quarantine(both, processor, False, TOKENS)
            .groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("outcome"), "lang")
            .agg(F.count("*").alias("n"))
            .select(F.lit(name).alias("processor"), "outcome", "lang", "n")
        )
        out = counts if out is None else out.unionByName(counts)
    return out


@_query
def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What a preparation leaves beside the prepared rows: rejected rows and their reasons."""
    both = views.json_texts(spark, folder).unionByName(views.dirty_texts(spark, folder))
    path = scratch_path(spark, "prepared")
    rows = prepare.split_rows(both, JSON_SQL, False, TOKENS)
    tables.write_prepared(rows.withColumn("phase", F.lit(tables.PRETRAIN)), path)
    return tables.read_rejected(spark, path).select("phase", "doc_id", "lang", "reject_reason")


@_query
def stream_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that a stream rejects: texts of one line."""
    base = scratch_path(spark, "stream-rejected")
    run_stream_prepare(
        spark,
        _documents_source(folder),
        views.table(spark, folder, "documents").schema,
        f"{base}/rows",
        f"{base}/checkpoint",
        processor=CUSTOM_SQL,
    )
    return read_stream_rejects(spark, f"{base}/rows").select("batch", "doc_id", "text", "reject_reason")


@_query
def empty_batches(spark: SparkSession, folder: str) -> DataFrame:
    survived = F.coalesce(text.not_blank(F.col("text")), F.lit(False))
    return prepare.empty_batches(
        views.dirty_texts(spark, folder), ["doc_id"], SETTINGS.format_batch, survived
    ).select(_long("batch_no"), "n_rows", "n_valid")


# Formatting


@_query
def strip_unicode(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("\u3000\t "), F.col("text"), F.lit(" \n\u001c\u00a0"))
    return views.raw_texts(spark, folder).select(
        "doc_id", text.strip_unicode(padded).alias("stripped")
    )


@_query
def format_pretrain(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare(views.dirty_texts(spark, folder), "wrap", False, TOKENS).select(
        "doc_id", "text"
    )


@_query
def format_strip_wrap(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare(views.dirty_texts(spark, folder), "strip_wrap", False, TOKENS).select(
        "doc_id", "text"
    )


@_query
def format_json(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare(views.json_texts(spark, folder), "json_content", False, TOKENS).select(
        "doc_id", "text"
    )


@_query
def split_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = chat.split_marker(F.col("text"), TOKENS.end_marker)
    return views.chat_texts(spark, folder).select(
        "conv_id", F.posexplode(parts).alias("part_no", "part")
    ).select("conv_id", _long("part_no"), "part")


@_query
def parse_conversation(spark: SparkSession, folder: str) -> DataFrame:
    return views.chat_texts(spark, folder).select(
        "conv_id",
        _dialogue(chat.parse_conversation(F.col("text"), TOKENS)).alias("dialogue"),
    )


@_query
def render_chat(spark: SparkSession, folder: str) -> DataFrame:
    rendered = chat.render_chat(F.col("conversation"), TOKENS)
    return (
        views.conversations(spark, folder)
        .select("conv_id", rendered.alias("prompt"))
        .filter(F.col("prompt").isNotNull())
    )


@_query
def chat_role_audit(spark: SparkSession, folder: str) -> DataFrame:
    valid = chat.valid_alternation(F.col("conversation"))
    return (
        views.conversations(spark, folder)
        .select("conv_id", F.size("conversation").alias("n"), valid.alias("valid"))
        .groupBy("conv_id")
        .agg(F.sum("n").alias("n_messages"), F.bool_and("valid").alias("valid"))
    )


@_query
def format_instruct(spark: SparkSession, folder: str) -> DataFrame:
    """Marked chats become prompts, texts without markers are wrapped."""
    return prepare.prepare(_phase_texts(spark, folder), "default", True, TOKENS).select(
        "phase", "key", "text"
    )


@_query
def format_line_chat(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare(views.raw_texts(spark, folder), "line_chat", True, TOKENS).select(
        "doc_id", "text"
    )


# Vocabulary


def _words(spark: SparkSession, folder: str, *by: str) -> DataFrame:
    corpus = views.raw_texts(spark, folder).repartition(_width(spark), "doc_id").select(*by, "text")
    return vocabulary.word_counts(corpus, *by)


def _tokenizer(
    spark: SparkSession, folder: str, settings: Settings
) -> tokenizer_store.Tokenizer:
    # Training and the encoding of the words each read the counts.
    path = scratch_path(spark, "word-counts")
    _words(spark, folder).write.parquet(path)
    return bpe.train_bpe(spark.read.parquet(path), settings)


@_query
def pretokenize(spark: SparkSession, folder: str) -> DataFrame:
    words = text.pretokenize(F.col("text"))
    return views.raw_texts(spark, folder).select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        F.array_join(words, "\x03").alias("words"),
    )


@_query
def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.word_counts(views.dirty_texts(spark, folder))


@_query
def byte_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.byte_histogram(_words(spark, folder))


@_query
def bpe_pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.pair_counts(vocabulary.byte_words(_words(spark, folder)))


@_training_query
def bpe_train(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    return bpe.learn_merges(_words(spark, folder), settings).select(
        _long("rank"), "left", "right", "merged"
    )


@_query
def bpe_first_merges(spark: SparkSession, folder: str) -> DataFrame:
    """The first merges of the whole training; they do not depend on how many follow."""
    merges = bpe.learn_merges(_words(spark, folder), FULL)
    first = SETTINGS.vocab_size - vocabulary.base_size(SETTINGS.tokens)
    return merges.filter(F.col("rank") < first).select(_long("rank"), "left", "right", "merged")


def _pair_vocab(spark: SparkSession, folder: str) -> DataFrame:
    """The vocabulary of all byte pairs that occur twice, by how often they do."""
    path = scratch_path(spark, "pair-merges")
    counts = vocabulary.pair_counts(vocabulary.byte_words(_words(spark, folder)))
    vocabulary.pair_merges(counts).write.parquet(path)
    return vocabulary.vocab_from_merges(spark, spark.read.parquet(path), TOKENS)


@_query
def pair_vocab_layout(spark: SparkSession, folder: str) -> DataFrame:
    return _pair_vocab(spark, folder).select(_long("id"), "token", "special")


@_query
def pair_vocab_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _sizes_by_stage(_pair_vocab(spark, folder))


@_query
def pair_extend_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.extend_vocab(_pair_vocab(spark, folder), TOKENS.for_phase(True)).select(
        _long("id"), "token", "special"
    )


@_query
def pair_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of all words of the documents that are one token of the pair vocabulary."""
    vocab = vocabulary.extend_vocab(_pair_vocab(spark, folder), TOKENS.for_phase(True))
    plain = _words(spark, folder).filter(F.col("word").rlike("^[A-Za-z]+$")).select(
        F.col("word").alias("name"), F.col("word").alias("token")
    )
    return vocabulary.token_ids(vocab, plain).select("name", "token", _long("id"))


@_training_query
def vocab_layout(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    return _tokenizer(spark, folder, settings).vocab.select(_long("id"), "token", "special")


def _sizes_by_stage(vocab: DataFrame) -> DataFrame:
    """Vocabulary size before and after the specials of each phase."""
    out = tokenizer_store.vocab_size(vocab).withColumn("stage", F.lit("trained"))
    for phase in (tables.PRETRAIN, tables.INSTRUCT):
        grown = vocabulary.configure_vocab(vocab, phase == tables.INSTRUCT, TOKENS)
        out = out.unionByName(
            tokenizer_store.vocab_size(grown).withColumn("stage", F.lit(phase))
        )
    return out.select("stage", "n_tokens", "n_plain")


@_training_query
def vocab_sizes(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """Vocabulary size before and after the specials of each phase."""
    return _sizes_by_stage(_tokenizer(spark, folder, settings).vocab)


@_training_query
def extend_vocab(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    vocab = _tokenizer(spark, folder, settings).vocab
    return vocabulary.extend_vocab(vocab, TOKENS.for_phase(True)).select(
        _long("id"), "token", "special"
    )


@_training_query
def token_ids(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """The ids of the roles, and of every plain word of the documents that is one token."""
    path = scratch_path(spark, "word-counts")
    _words(spark, folder).write.parquet(path)
    words = spark.read.parquet(path)
    vocab = vocabulary.extend_vocab(
        bpe.train_bpe(words, settings).vocab, TOKENS.for_phase(True)
    )
    plain = words.filter(F.col("word").rlike("^[A-Za-z]+$")).select(
        F.col("word").alias("name"), F.col("word").alias("token")
    )
    # The roles whose ids are looked up.
    wanted = spark.createDataFrame(
        [
            ("user", TOKENS.user_marker),
            ("assistant", TOKENS.bot_marker),
            ("bot", TOKENS.bot_marker),
            ("end", TOKENS.end_marker),
        ],
        "name STRING, token STRING",
    )
    return vocabulary.token_ids(vocab, wanted.unionByName(plain)).select(
        "name", "token", _long("id")
    )


@_query
def instruct_audit(spark: SparkSession, folder: str) -> DataFrame:
    """One tokenizer per source, whose tokens are the words of its documents.

    The extra tokens asked for are words of different languages, so that the verdict depends
    on the texts; templates are given to some sources.
    """
    names = views.raw_texts(spark, folder).select(F.col("source").alias("tokenizer")).distinct()
    number = F.regexp_extract("tokenizer", "[0-9]+", 0).cast("int")
    vocabs = _words(spark, folder, "source").select(
        F.col("source").alias("tokenizer"), F.col("word").alias("token")
    )
    templates = names.select(
        "tokenizer", F.when(number % 4 < 2, F.lit("template")).alias("chat_template")
    )
    return vocabulary.instruct_audit(vocabs, templates, AUDIT_WORDS)


# Encoding and collation


def _byte_encoded(spark: SparkSession, folder: str, instruct: bool) -> DataFrame:
    """Prepared texts of a phase under the tokenizer without merges."""
    ids = encoding.byte_special_ids(TOKENS, instruct)
    phase = tables.INSTRUCT if instruct else tables.PRETRAIN
    return (
        _prepared(spark, folder, heavy=True)
        .filter(F.col("phase") == phase)
        .select("phase", "key", encoding.encode_bytes(F.col("text"), ids).alias("ids"))
    )


def _layout(examples: DataFrame) -> DataFrame:
    return layout.training_layout(examples, ["key"], EPOCHS, SETTINGS)


def _batches(spark: SparkSession, folder: str, instruct: bool) -> DataFrame:
    path = scratch_path(spark, "encoded")
    # Collation cuts the ids at max_length: none beyond it are stored.
    cut = encoding.truncate(F.col("ids"), SETTINGS.max_length)
    _byte_encoded(spark, folder, instruct).withColumn("ids", cut).write.parquet(path)
    encoded = spark.read.parquet(path)
    ids = encoding.byte_special_ids(TOKENS, True)
    markers = encoding.CollateIds(ids[TOKENS.pad], ids[TOKENS.bot_marker], ids[TOKENS.end_marker])
    return encoding.collate(
        encoded, _layout(encoded.select("key")), ["key"], markers, SETTINGS, instruct
    )


_BATCH_COLUMNS = ("key", "epoch", "rank", "batch_no")


@_query
def encode_bytes(spark: SparkSession, folder: str) -> DataFrame:
    both = _byte_encoded(spark, folder, False).unionByName(_byte_encoded(spark, folder, True))
    return both.select("phase", "key", _numbers("ids").alias("ids"))


@_training_query
def encode_bpe(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    tokenizer = _tokenizer(spark, folder, settings)
    vocab = vocabulary.configure_vocab(tokenizer.vocab, True, TOKENS)
    encoded = encoding.encode(
        _prepared(spark, folder, heavy=True), vocab, tokenizer.merges, word_tokens=tokenizer.word_tokens
    )
    return encoded.select(
        "phase", "key", F.size("ids").cast("bigint").alias("n_ids"),
        _numbers("ids").alias("ids"),
    )


@_training_query
def word_tokens(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """The encoding of every distinct training word under the trained tokenizer."""
    return _tokenizer(spark, folder, settings).word_tokens.select("word", "n", _numbers("ids").alias("ids"))


@_query
def truncate_ids(spark: SparkSession, folder: str) -> DataFrame:
    cut = encoding.truncate(F.col("ids"), SETTINGS.max_length)
    return _byte_encoded(spark, folder, False).select(
        "key", F.size(cut).cast("bigint").alias("n_ids"), _numbers(cut).alias("ids")
    )


@_query
def pad_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _batches(spark, folder, False).select(
        *[_long(c) for c in _BATCH_COLUMNS],
        _long("n_ids"),
        _long("pad_to"),
        F.md5(_numbers("input_ids")).alias("input_ids"),
        F.md5(_numbers("attention_mask")).alias("attention_mask"),
    )


@_query
def labels_pretrain(spark: SparkSession, folder: str) -> DataFrame:
    return _batches(spark, folder, False).select(
        *[_long(c) for c in _BATCH_COLUMNS], F.md5(_numbers("labels")).alias("labels")
    )


@_query
def mask_user_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return _batches(spark, folder, True).select(
        *[_long(c) for c in _BATCH_COLUMNS], _numbers("labels").alias("labels")
    )


@_query
def supervision_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = encoding.supervision_stats(
        _batches(spark, folder, True), ["epoch", "rank", "batch_no"], SETTINGS
    )
    return stats.select(
        _long("epoch"), _long("rank"), _long("batch_no"), "n_examples", "n_tokens", "n_pads",
        "n_kept", "kept_share",
    )


# Layout and plan


def _doc_keys(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_blank(views.dirty_texts(spark, folder)).select("doc_id")


@_query
def epoch_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return layout.epoch_shuffle(
        _doc_keys(spark, folder), ["doc_id"], EPOCHS, SETTINGS.seed
    ).select("doc_id", _long("epoch"), _long("perm_pos"), _long("n_examples"))


@_query
def shard_layout(spark: SparkSession, folder: str) -> DataFrame:
    shuffled = layout.epoch_shuffle(_doc_keys(spark, folder), ["doc_id"], EPOCHS, SETTINGS.seed)
    return layout.shard(shuffled, SETTINGS.world_size).select(
        "doc_id", _long("epoch"), _long("rank"), _long("pos")
    )


@_query
def micro_batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = layout.training_layout(_doc_keys(spark, folder), ["doc_id"], EPOCHS, SETTINGS)
    return rows.groupBy("epoch", "rank", "batch_no").agg(
        F.count("*").alias("n_rows"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).select(_long("epoch"), _long("rank"), _long("batch_no"), "n_rows", "low", "high")


@_query
def batch_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Formatting and corpus batches of the documents, in input order."""
    return positions.ordinals(_doc_keys(spark, folder), ["doc_id"], "pos").select(
        "doc_id",
        F.expr(f"pos div {SETTINGS.format_batch}").alias("format_batch"),
        F.expr(f"pos div {SETTINGS.corpus_batch}").alias("corpus_batch"),
    )


def _plan_summary(spark: SparkSession, folder: str) -> DataFrame:
    return steps.plan_summary(_prepared(spark, folder), SETTINGS)


@_query
def step_plan(spark: SparkSession, folder: str) -> DataFrame:
    return steps.step_plan(_plan_summary(spark, folder), SETTINGS).select(
        "phase", _long("step"), _long("epoch"), _long("first_batch"), _long("last_batch")
    )


@_query
def assign_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The update step of every micro-batch of the shuffled layout."""
    rows = [
        _layout(_prepared(spark, folder).filter(F.col("phase") == phase)).withColumn(
            "phase", F.lit(phase)
        )
        for phase in (tables.PRETRAIN, tables.INSTRUCT)
    ]
    stepped = steps.assign_step(
        rows[0].unionByName(rows[1]), _plan_summary(spark, folder), SETTINGS
    )
    return stepped.select(
        "phase", "key", _long("epoch"), _long("rank"), _long("batch_no"),
        _long("step"), "closes",
    )


@_query
def plan_guard(spark: SparkSession, folder: str) -> DataFrame:
    """The plan status of every source and language, some too small for a step."""
    few = Settings(world_size=4, batch_size=4)
    labelled = prepare.drop_blank(views.dirty_texts(spark, folder)).withColumn(
        "phase", F.concat_ws("/", "source", "lang")
    )
    return steps.plan_summary(labelled, few).select(
        "phase", "n_examples", _long("n_batches"), "status"
    )


def _resumed_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs whose state is their own, or that have none yet: (owner, phase, global_step)."""
    number = F.col("user_id")
    owner = F.concat(F.lit("run-"), number.cast("string"))
    expected = (
        views.table(spark, folder, "events")
        .select(number)
        .distinct()
        .select(
            owner.alias("owner"),
            run_state.state_key(owner, _custom_key(number)).alias("state_key"),
            (number % 14 == 7).alias("custom"),
        )
    )
    state = run_state.latest_state(_state_history(spark, folder))
    parity = F.regexp_extract("owner", "[0-9]+", 0).cast("bigint") % 2
    return (
        run_state.guard_state(expected, state)
        .filter(F.col("verdict").isin("new", "ours"))
        .select(
            "owner",
            F.when(parity == 1, tables.INSTRUCT).otherwise(tables.PRETRAIN).alias("phase"),
            F.col("resume_step").alias("global_step"),
        )
    )


@_query
def resume_plan(spark: SparkSession, folder: str) -> DataFrame:
    runs = _resumed_runs(spark, folder)
    return steps.resume_plan(_plan_summary(spark, folder), runs).select(
        "owner", "phase", _long("global_step"), _long("epoch"), _long("batch_no"),
        _long("next_step"), _long("steps_left"),
    )


@_query
def remaining_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The plan rows that every resumed run still has to take."""
    runs = _resumed_runs(spark, folder)
    return steps.remaining_steps(_plan_summary(spark, folder), runs, SETTINGS).select(
        "owner", "phase", _long("step"), _long("epoch"), _long("first_batch"), _long("last_batch")
    )


@_query
def lr_plan(spark: SparkSession, folder: str) -> DataFrame:
    settings = Settings(world_size=3, epochs=2.5, warmup_steps=10, learning_rate=1.0)
    plan = steps.step_plan(_plan_summary(spark, folder), settings)
    return steps.with_learning_rate(plan, settings).select(
        "phase", _long("step"), F.round("lr", 9).alias("lr"), F.round("next_lr", 9).alias("next_lr")
    )


@_query
def token_budget(spark: SparkSession, folder: str) -> DataFrame:
    kept = F.size(F.filter("labels", lambda x: x != SETTINGS.ignore_label)).alias("n_kept")
    sized = _batches(spark, folder, True).select(
        "phase", "epoch", "rank", "batch_no", "n_ids", "pad_to", kept
    )
    return steps.token_budget(sized, _plan_summary(spark, folder), SETTINGS).select(
        "phase", _long("epoch"), _long("step"), "n_examples", _long("effective_batch"),
        "n_tokens", "n_padded", "n_kept",
    )


@_query
def token_budget_rollup(spark: SparkSession, folder: str) -> DataFrame:
    kept = F.size(F.filter("labels", lambda x: x != SETTINGS.ignore_label)).alias("n_kept")
    sized = _batches(spark, folder, True).select(
        "phase", "epoch", "rank", "batch_no", "n_ids", "pad_to", kept
    )
    return steps.token_budget_rollup(sized, _plan_summary(spark, folder), SETTINGS).select(
        "level", "phase", _long("epoch"), _long("step"), _long("rank"), "n_examples",
        _long("effective_batch"), "n_tokens", "n_padded", "n_kept",
    )


# Telemetry


@_query
def finite_loss(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.finite_losses(views.metrics(spark, folder)).select(
        "run_id", _long("micro"), "loss"
    )


@_query
def nonfinite_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.nonfinite_streaks(views.metrics(spark, folder), SETTINGS).select(
        "run_id", _long("micro"), _long("streak")
    )


@_query
def abort_points(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.abort_points(
        views.metrics(spark, folder), NONFINITE_LIMIT, SETTINGS
    ).select("run_id", _long("abort_micro"), _long("streak"))


@_query
def before_abort(spark: SparkSession, folder: str) -> DataFrame:
    metrics = views.metrics(spark, folder)
    aborts = telemetry.abort_points(metrics, NONFINITE_LIMIT, SETTINGS)
    return telemetry.before_abort(metrics, aborts).groupBy("run_id").agg(
        F.count("*").alias("n_micro"), F.max("micro").alias("last_micro")
    )


def _metrics_files(spark: SparkSession, folder: str, path: str) -> None:
    """The metrics log in three files, each one trigger, in order of micro-batches."""
    log = views.metrics(spark, folder)
    for low, high in ((0, 20), (20, 41), (41, None)):
        part = log.filter(F.col("micro") >= low)
        part = part if high is None else part.filter(F.col("micro") < high)
        part.coalesce(1).write.mode("append").parquet(path)


@_query
def stream_abort_keyed(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "stream-abort-keyed")
    _metrics_files(spark, folder, f"{base}/metrics")
    alerts = run_stream_abort_keyed(
        spark, f"{base}/metrics", f"{base}/run", NONFINITE_LIMIT, files_per_trigger=1
    )
    return alerts.select("run_id", "abort_micro", "streak")


@_query
def stream_abort(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "stream-abort")
    _metrics_files(spark, folder, f"{base}/metrics")
    alerts = run_stream_abort(
        spark, f"{base}/metrics", f"{base}/run", NONFINITE_LIMIT, SETTINGS, files_per_trigger=1
    )
    return alerts.select("run_id", _long("abort_micro"), _long("streak"))


@_query
def log_windows(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.log_windows(views.metrics(spark, folder), SHAPE).select(
        "run_id", _long("step"), F.round("mean_loss", 9).alias("mean_loss"), "n_finite"
    )


@_query
def throughput(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.throughput(views.metrics(spark, folder), SHAPE, SETTINGS).select(
        "run_id",
        _long("step"),
        F.round("elapsed", 6).alias("elapsed"),
        F.round("steps_per_second", 9).alias("steps_per_second"),
        F.round("samples_per_second", 9).alias("samples_per_second"),
    )


@_query
def metrics_report(spark: SparkSession, folder: str) -> DataFrame:
    small = views.metrics(spark, folder).withColumn("loss", F.col("loss") / 10_000)
    return telemetry.metrics_report(small, SHAPE, replace(SETTINGS, report_every_windows=2)).select(
        "run_id", _long("step"), "report"
    )


@_query
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.run_summary(views.metrics(spark, folder), SHAPE).select(
        "run_id", "n_micro", "n_finite", _long("global_step"),
        F.round("training_loss", 9).alias("training_loss"),
        F.round("mean_micro_loss", 9).alias("mean_micro_loss"),
    )


@_query
def epoch_times(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.epoch_times(views.metrics(spark, folder), SHAPE).select(
        "run_id", _long("epoch"), "n_micro", F.round("minutes", 6).alias("minutes")
    )


def _stops(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.stop_points(views.metrics(spark, folder), SHAPE, BUDGET_MINUTES)


@_query
def stop_points(spark: SparkSession, folder: str) -> DataFrame:
    return _stops(spark, folder).select(
        "run_id",
        F.coalesce("stop_step", F.lit(-1)).cast("bigint").alias("stop_step"),
        _long("last_step"),
        F.round("remaining_minutes", 6).alias("remaining_minutes"),
    )


@_query
def run_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.run_verdicts(_stops(spark, folder), SHAPE.total_steps).select(
        "run_id", _long("final_step"), "stopped_early", "completed"
    )


@_query
def next_phase(spark: SparkSession, folder: str) -> DataFrame:
    runs = telemetry.run_verdicts(_stops(spark, folder), SHAPE.total_steps).withColumns(
        {"instruct": F.col("run_id") % 2 == 1, "resume": F.col("run_id") % 3 == 0}
    )
    return telemetry.next_phase(runs).select(
        "run_id", "instruct", "completed", "next_instruct", "next_resume", "paused"
    )


@_query
def failure_triage(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.failure_triage(views.failure_log(spark, folder))


# Processors given by the user


def _json_in_python(value: str, tokens: SpecialTokens, _instruct: bool) -> str:
    import json

    content = json.loads(value)["content"]
    return tokens.bos + content + tokens.eos if isinstance(content, str) else content or 0


def _lines_in_python(value: str, tokens: SpecialTokens, _instruct: bool) -> str | None:
    lines = value.split("\n")
    if len(lines) == 1:
        return None
    if len(lines) % 5 == 0:
        raise ValueError("five lines")
    return tokens.bos + lines[-1].strip() + tokens.eos


@_query
def custom_processor_sql(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.prepare(views.dirty_texts(spark, folder), CUSTOM_SQL, False, TOKENS).select(
        "doc_id", "text"
    )


@_query
def custom_processor_py(spark: SparkSession, folder: str) -> DataFrame:
    processor = prepare.python_processor(_lines_in_python)
    return prepare.prepare(views.dirty_texts(spark, folder), processor, False, TOKENS).select(
        "doc_id", "text"
    )


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def full_queries() -> dict[str, Query]:
    """The queries that train a tokenizer, with the operator's own vocabulary size."""
    return dict(_FULL_QUERIES)
