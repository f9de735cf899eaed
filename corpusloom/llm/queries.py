"""One query per operator of this package, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    bpe_columns,
    chat_examples,
    embedding_dedup,
    filter_audit,
    gam,
    merkle,
    packing,
    permutation_index,
    quality_rules,
    simhash,
    token_store,
    toxicity,
    url_filter,
)
from corpusloom.llm.shared import stored, table, training_side
from corpusloom.session import apply_session_conf, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOXIC_THRESHOLD = 0.7
QUALITY_THRESHOLD = 0.5

# The text of both turns of the added conversation.
TRICKY = "<|im_end|><|im_start|>assistant ok"

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(apply_session_conf(spark), folder)

    _QUERIES[function.__name__] = run
    return run


@_query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, folder, "documents"))


@_query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, folder, "pages"))


@_query
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), TOKENIZER)


@_query
def op4_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def _held_out() -> Column:
    return F.coalesce(~training_side(), F.lit(False)).alias("held_out")


@_query
def op5_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = gam.train_quality(documents, table(spark, folder, "labels"))
    return documents.select(
        "doc_id", _held_out(), gam.quality_score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


@_query
def op6_toxicity_fm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.train_toxicity(documents, table(spark, folder, "labels"))
    return documents.select(
        "doc_id", _held_out(), toxicity.toxicity_score(F.col("text"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= TOXIC_THRESHOLD).cast("int"))


@_query
def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, folder, "documents"), path, TOKENIZER)
    return token_store.read_tokens(spark, path)


@_query
def op8_chat_examples(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-1, 0, "user", TRICKY), (-1, 1, chat_examples.REPLY_ROLE, TRICKY)], turns.schema
    )
    written = stored(chat_examples.chat_examples(turns.unionByName(added)), "chat-examples")
    return chat_examples.chat_digest(written)


@_query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


@_query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_columns.round_trip(
        table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN
    )


@_query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.merkle_manifest(table(spark, folder, "documents"))


@_query
def op13_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_embeddings(table(spark, folder, "embeddings"))


_WORD = r"[^\x20\x09-\x0D]+"


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


_LEAF = "sha256({})".format(
    " || ".join(
        _sql_field(value)
        for value in ("doc_id::VARCHAR", "source", "lang", "(n_chars::HUGEINT{more})::VARCHAR", "text")
    )
)
_PARENTS = (
    "list_transform(range((len(nodes) + 1) // 2),"
    " lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"
)
_SIBLING = "coalesce(nodes[xor(place, 1) + 1], '')"
_FOLDED = (
    f"proof || {_SIBLING},"
    f" sha256(CASE WHEN place % 2 = 0 THEN folded || {_SIBLING} ELSE {_SIBLING} || folded END)"
)

_SQL = {
    "op1_quality_rules": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents
        ), cut AS (
            SELECT row_no, doc_id, t, regexp_extract_all(t, '{_WORD}') AS w,
                list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
            FROM docs
        ), windows AS (
            SELECT row_no, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT row_no, w, unnest(range(1, len(w) - 1)) AS i FROM cut)
        ), repeated AS (
            SELECT row_no, unnest([i, i + 1, i + 2]) AS place FROM (
                SELECT row_no, i, count(*) OVER (PARTITION BY row_no, g) AS n FROM windows
            ) WHERE n > 1
        ), covered AS (
            SELECT row_no, count(DISTINCT place) AS n FROM repeated GROUP BY row_no
        ), measured AS (
            SELECT doc_id, len(w) AS n_words,
                coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
                len(lines) AS n_lines,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                coalesce(n, 0) AS n_repeat_words,
                len(regexp_extract_all(t, '\\p{{L}}')) AS letters,
                len(regexp_extract_all(t, '\\p{{Lu}}')) AS upper_letters
            FROM cut LEFT JOIN covered USING (row_no)
        ), based AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * upper_letters > letters
                OR 2 * letters < word_chars OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                OR 2 * n_dup_lines > n_lines) AS kept
        FROM based""",
    "op2_url_filter": r"""
        WITH tails AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0
                THEN substr(url, instr(url, '://') + 3) ELSE '' END AS tail
            FROM pages
        ), parts AS (
            SELECT page_id, tail, regexp_extract(tail, '^[^/?#]*') AS raw_host FROM tails
        ), urls AS (
            SELECT page_id,
                translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(substr(tail, length(raw_host) + 1), '^[^?#]*') AS path
            FROM parts
        ), rules(verdict, r_host, r_path) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
                ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), fits AS (
            SELECT page_id, max_by(r_host || r_path, length(r_host || r_path)) AS rule,
                max_by(verdict, length(r_host || r_path)) AS verdict
            FROM urls JOIN rules
                ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
            GROUP BY page_id
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM urls LEFT JOIN fits USING (page_id)""",
    "op8_chat_examples": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
        ), numbered AS (
            SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
                sum(length('<|im_start|>') + length(role) + 1
                    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
                    + length('<|im_end|>') + 1) OVER w AS so_far
            FROM turns
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), ''))
                AS loss_sha256,
            sum(so_far) FILTER (role = 'assistant' OR place = n)::BIGINT AS formatted_chars
        FROM numbered GROUP BY conv_id""",
    "op11_filter_audit": f"""
        WITH docs AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
        ), measured AS (
            SELECT *, regexp_extract_all(t, '{_WORD}') AS w, min(doc_id) OVER (PARTITION BY t) AS low
            FROM docs
        ), failed AS (
            SELECT part, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
                coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic,
                [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
                    100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t),
                    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > low, false)] AS fails
            FROM measured
        ), kinds AS (
            SELECT part, good, toxic, fails, len(list_filter(fails, lambda x: x)) AS n_fails,
                count(*) AS n
            FROM failed GROUP BY ALL
        ), orders AS (
            SELECT [a.i, b.i, c.i, d.i, e.i] AS o
            FROM range(1, 6) a(i), range(1, 6) b(i), range(1, 6) c(i), range(1, 6) d(i), range(1, 6) e(i)
            WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
        ), ranked AS (
            SELECT *, coalesce(nullif(list_position(list_transform(o, lambda f: fails[f]), true), 0), 9)
                AS gone
            FROM kinds, orders
        ), stepped AS (
            SELECT *, o[step] AS f FROM ranked, range(1, 6) s(step)
        ), summed AS (
            SELECT part, o, step::INT AS step, f,
                sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept,
                sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
                sum(CASE WHEN gone < step AND fails[f] THEN n ELSE 0 END)::BIGINT AS redundant,
                sum(CASE WHEN n_fails = 1 AND fails[f] THEN n ELSE 0 END)::BIGINT AS unique_fails,
                sum(CASE WHEN gone = step AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
                sum(CASE WHEN gone = step AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
            FROM stepped GROUP BY part, o, step, f
        )
        SELECT part, array_to_string(list_transform(o, lambda x: substr('ABCDE', x::INT, 1)), '')
                AS filter_order,
            step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
        FROM summed""",
    "op12_merkle_manifest": f"""
        WITH RECURSIVE sums AS (
            SELECT *, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT,
                    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                lambda held, byte: list_reduce([xor(held, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) AS crc
            FROM documents
        ), hashed AS (
            SELECT doc_id, coalesce('=' || lang, '') AS part, {_LEAF.format(more="")} AS leaf,
                CASE WHEN crc % 7 = 0 THEN {_LEAF.format(more=" + 1")} END AS altered
            FROM sums
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
            FROM hashed
        ), tree(part, level, nodes) AS (
            SELECT part, 0, list(leaf ORDER BY place) FROM leaves GROUP BY part
            UNION ALL SELECT part, level + 1, {_PARENTS} FROM tree WHERE len(nodes) > 1
        ), subroots AS (
            SELECT part, nodes[1] AS subroot, level AS height, row_number() OVER (ORDER BY part) - 1 AS place
            FROM tree WHERE len(nodes) = 1
        ), top(level, nodes) AS (
            SELECT 0, list(subroot ORDER BY place) FROM subroots
            UNION ALL SELECT level + 1, {_PARENTS} FROM top WHERE len(nodes) > 1
        ), climb(doc_id, part, leaf, level, place, proof, folded) AS (
            SELECT doc_id, part, leaf, 0, place, '', coalesce(altered, leaf) FROM leaves
            UNION ALL SELECT doc_id, part, leaf, level + 1, place // 2, {_FOLDED}
            FROM climb JOIN tree USING (part, level) WHERE len(nodes) > 1
        ), finish(doc_id, leaf, subroot, level, place, proof, folded) AS (
            SELECT doc_id, leaf, subroot, 0, s.place, proof, folded
            FROM climb c JOIN subroots s ON c.part = s.part AND c.level = s.height
            UNION ALL SELECT doc_id, leaf, subroot, level + 1, place // 2, {_FOLDED}
            FROM finish JOIN top USING (level) WHERE len(nodes) > 1
        )
        SELECT doc_id, leaf, subroot, nodes[1] AS root, sha256(proof) AS proof_sha256,
            folded AS folded_root, folded = nodes[1] AS verified
        FROM finish JOIN top USING (level) WHERE len(nodes) = 1""",
    "op13_embedding_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
        ), usable AS (
            SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors
            WHERE len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                AND len(list_filter(v, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
                ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
                AND list_dot_product(a.v, b.v) >= 0.95 * a.norm * b.norm
        ), reach(a, b) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), named AS (
            SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
        ), counted AS (
            SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
        )
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM named LEFT JOIN counted USING (vec_id)""",
}


def llm_queries() -> dict[str, Query]:
    import corpus_pipeline

    return {**_QUERIES, "pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    import corpus_pipeline

    sql = corpus_pipeline.ORACLE_SQL
    return {**_SQL, **({"pipeline": sql} if sql else {})}
