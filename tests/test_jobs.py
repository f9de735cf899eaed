"""Sources, streams, run state and the jobs end to end."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.config import Settings, SpecialTokens
from corpusloom.functions import symbols
from corpusloom.operators.prepare import prepare
from corpusloom.plans import jobs
from corpusloom.sources import run_state, tables, views
from corpusloom.sources.tokenizer_store import Tokenizer, load_tokenizer, save_tokenizer
from corpusloom.streaming.prepare import stream_prepare

TOKENS = SpecialTokens()


def paths(data):
    return tables.DatasetPaths(f"{data}/documents.parquet", f"{data}/documents.parquet")


def test_scan_prunes_columns(spark, data):
    plan = tables.scan(spark, paths(data), False)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string>" in plan


def test_scan_needs_a_text_column(spark, data):
    with pytest.raises(AnalysisException):
        tables.scan(spark, tables.DatasetPaths(f"{data}/events.parquet", ""), False)


def test_training_is_for_fresh_pretraining_only():
    assert tables.needs_training(False, False, None)
    assert not tables.needs_training(True, False, None)
    assert not tables.needs_training(False, True, None)
    assert not tables.needs_training(False, False, "given")


def test_preparation_does_not_shuffle(spark, data):
    out = prepare(views.dirty_texts(spark, data), "default", True, TOKENS)
    assert "Exchange" not in out._jdf.queryExecution().toString()


def test_stream_equals_batch_over_several_files(spark, data, tmp_path):
    frame = views.dirty_texts(spark, data).select("doc_id", "text")
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    frame.filter("doc_id < 120").repartition(3).write.parquet(source)
    stream_prepare(spark, source, frame.schema, target, marks, "wrap", files_per_trigger=1)
    frame.filter("doc_id >= 120").write.mode("append").parquet(source)
    stream_prepare(spark, source, frame.schema, target, marks, "wrap")
    got = spark.read.parquet(target)
    batch = prepare(frame, "wrap", False, TOKENS)
    assert got.count() == batch.count()
    assert got.select("doc_id", "text").exceptAll(batch.select("doc_id", "text")).count() == 0


def test_a_long_conversation_is_one_text(spark, tmp_path):
    turns = [(1, 0, "system", "be brief")]
    turns += [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(1, 1001)]
    turns += [(2, 0, "user", "a"), (2, 1, "assistant", "b")]
    spark.createDataFrame(turns, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    rows = {r["conv_id"]: r["text"] for r in views.chat_texts(spark, str(tmp_path), TOKENS).collect()}
    assert len(rows) == 2
    prompts = prepare(
        spark.createDataFrame(list(rows.items()), "conv_id BIGINT, text STRING"), "default", True, TOKENS
    )
    got = {r["conv_id"]: r["text"] for r in prompts.collect()}
    # The plain loop over the parts between end markers, two by two.
    parts = rows[1].split("<|end|>")
    wanted = "<s>"
    for i in range(0, len(parts) - 1, 2):
        wanted += f"<|user|>\n{parts[i].replace('<|user|>', '').strip()}<|end|>\n"
        wanted += f"<|bot|>\n{parts[i + 1].replace('<|bot|>', '').strip()}<|end|>\n</s>"
    assert got[1] == wanted
    assert wanted.count("<|user|>") == 500 and "be brief\nt1" in wanted


def state(spark, rows):
    return spark.createDataFrame(
        rows, "state_key STRING, stamped_owner STRING, global_step BIGINT, completed BOOLEAN, updated_at BIGINT"
    )


def test_state_upsert_guard_and_close(spark, tmp_path):
    old = state(spark, [("k1", "a", 5, False, 1), ("k2", "b", 7, False, 1), ("k3", None, 1, False, 1)])
    new = state(spark, [("k1", "a", 9, True, 2), ("k4", "d", 2, True, 2)])
    run_state.write_state(run_state.upsert_state(old, new), str(tmp_path / "state"))
    table = run_state.read_state(spark, str(tmp_path / "state"))
    assert {r["state_key"]: r["global_step"] for r in table.collect()} == {"k1": 9, "k2": 7, "k3": 1, "k4": 2}
    expected = spark.createDataFrame(
        [("a", "k1", False), ("x", "k2", False), ("x", "k3", False), ("n", "k9", False), ("y", "k4", True)],
        "owner STRING, state_key STRING, custom BOOLEAN",
    )
    guarded = run_state.guard_state(expected, table)
    got = {(r["owner"], r["state_key"]): (r["verdict"], r["resume_step"]) for r in guarded.collect()}
    assert got == {
        ("a", "k1"): ("ours", 9), ("x", "k2"): ("foreign", 7), ("x", "k3"): ("missing", 1),
        ("n", "k9"): ("new", 0), ("y", "k4"): ("ours", 2),
    }
    with pytest.raises(RuntimeError):
        run_state.require_ours(guarded)
    assert run_state.require_ours(guarded.filter(F.col("owner") == "a")).count() == 1
    finished = spark.createDataFrame(
        [("k1", True, True, False), ("k2", False, True, False), ("k4", True, True, True)],
        "state_key STRING, instruct BOOLEAN, completed BOOLEAN, custom BOOLEAN",
    )
    left = run_state.close_states(table, finished)
    assert {r["state_key"] for r in left.collect()} == {"k2", "k3", "k4"}


def test_state_key_is_the_hash_unless_chosen(spark):
    import hashlib

    frame = spark.createDataFrame([("a/b", None), ("a/b", "mine")], "owner STRING, custom STRING")
    rows = frame.select(run_state.state_key(F.col("owner"), F.col("custom")).alias("k")).collect()
    assert [r["k"] for r in rows] == [hashlib.sha256(b"a/b").hexdigest(), "mine"]


def test_jobs_end_to_end(spark, data, tmp_path):
    settings = Settings(vocab_size=300, world_size=2, max_length=256)
    tok, chat_tok, ready, batches = (str(tmp_path / n) for n in ("tok", "chat-tok", "ready", "out"))
    jobs.tokenizer_job(spark, paths(data), tok, settings=settings)
    jobs.prepare_job(spark, paths(data), ready, settings=settings)
    out = jobs.batch_job(spark, ready, tok, batches, 1, settings=settings)
    assert out.count() == 200
    assert out.filter("size(input_ids) % 8 <> 0 OR size(input_ids) <> size(labels)").count() == 0
    vocab = {r["id"]: r["token"] for r in load_tokenizer(spark, tok).vocab.collect()}
    byte_of = {c: b for b, c in symbols.byte_characters().items()}
    text = {r["doc_id"]: r["text"] for r in tables.read_prepared(spark, ready, "pretrain").collect()}
    whole = [r for r in out.collect() if r["n_ids"] < 256]
    assert whole
    for row in whole[:20]:
        ids = list(row["input_ids"])[: row["n_ids"]]
        assert (ids[0], ids[-1]) == (0, 2)
        spelled = "".join(vocab[i] for i in ids[1:-1])
        assert "<s>" + bytes(byte_of[c] for c in spelled).decode() + "</s>" == text[row["doc_id"]]
    jobs.tokenizer_job(spark, paths(data), chat_tok, instruct=True, own=tok, settings=settings)
    grown = {r["token"]: r["id"] for r in load_tokenizer(spark, chat_tok, False).vocab.collect()}
    assert [grown[t] for t in TOKENS.extra] == [300, 301, 302]


def test_prepare_job_can_refuse_an_empty_batch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(
        [(i, " " if i < 100 else "a") for i in range(150)], "doc_id BIGINT, text STRING"
    ).write.parquet(source)
    where = tables.DatasetPaths(source, source)
    with pytest.raises(ValueError):
        jobs.prepare_job(spark, where, target, guard_batches=True)
    jobs.prepare_job(spark, where, target)
    assert tables.read_prepared(spark, target).count() == 50


def test_checkpoints_go_below_the_warehouse_unless_named():
    made = []

    class Context:
        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def setCheckpointDir(path):
            made.append(path)

    class Conf:
        known = {"spark.sql.warehouse.dir": "store://warehouse/"}

        @classmethod
        def get(cls, key, *default):
            return cls.known.get(key, *default)

    class Session:
        sparkContext, conf = Context, Conf

    assert session.checkpoint_root(Session) == "store://warehouse/_scratch"
    Conf.known["spark.checkpoint.dir"] = "store://shared"
    assert session.checkpoint_root(Session) == "store://shared"
    assert made == ["store://warehouse/_scratch", "store://shared"]


def test_scratch_on_the_drivers_own_disk_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        known = {"spark.sql.warehouse.dir": "file:/home/somebody/spark-warehouse"}

        @classmethod
        def get(cls, key, *default):
            return cls.known.get(key, *default)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session)
    Context.master = "local-cluster[3,2,1024]"
    Context.setCheckpointDir = staticmethod(lambda path: None)
    assert session.checkpoint_root(Session).endswith("/_scratch")


def test_two_phases_in_one_target(spark, data, tmp_path):
    target = str(tmp_path / "prepared")
    jobs.prepare_job(spark, paths(data), target)
    jobs.prepare_job(spark, paths(data), target, instruct=True)
    jobs.prepare_job(spark, paths(data), target)
    counts = {r["phase"]: r["count"] for r in tables.read_prepared(spark, target).groupBy("phase").count().collect()}
    assert counts == {"pretrain": 200, "instruct": 200}


def test_a_failed_write_leaves_the_last_state(spark, tmp_path):
    path = str(tmp_path / "state")
    run_state.write_state(state(spark, [("k", "a", 1, False, 1)]), path)
    broken = state(spark, [("k", "a", 2, False, 2)]).withColumn(
        "global_step", F.expr("global_step / (global_step - 2)").cast("bigint")
    )
    with pytest.raises(Exception):
        run_state.write_state(broken, path)
    table = run_state.read_state(spark, path)
    assert [r["global_step"] for r in table.collect()] == [1]
    run_state.write_state(run_state.upsert_state(table, state(spark, [("k", "a", 3, True, 3)])), path)
    assert [r["global_step"] for r in run_state.read_state(spark, path).collect()] == [3]


def test_states_are_stamped_by_the_engine(spark):
    progress = spark.createDataFrame(
        [("a", 3, False, 1, None), ("b", 4, True, 2, "mine")],
        "owner STRING, global_step BIGINT, completed BOOLEAN, updated_at BIGINT, chosen STRING",
    )
    rows = run_state.stamp_state(progress, F.col("chosen")).collect()
    assert [r["stamped_owner"] for r in rows] == ["a", "b"]
    assert rows[1]["state_key"] == "mine" and len(rows[0]["state_key"]) == 64


def test_special_tokens_from_json():
    tokens = SpecialTokens.from_json('{"bos_token": "[B]", "additional_special_tokens": ["<x>"]}')
    assert (tokens.bos, tokens.eos, tokens.extra) == ("[B]", "</s>", ("<x>",))
    assert (tokens.user_marker, tokens.bot_marker, tokens.end_marker) == ("<x>", None, None)


def test_few_extra_tokens_wrap_every_text(spark):
    frame = spark.createDataFrame([("a<|end|>b<|end|>",)], "text STRING")
    out = prepare(frame, "default", True, SpecialTokens(extra=()))
    assert [r["text"] for r in out.collect()] == ["<s>a<|end|>b<|end|></s>"]


def test_saving_without_words_leaves_no_old_ones(spark, tmp_path):
    vocab = spark.createDataFrame([(0, "a", False)], "id INT, token STRING, special BOOLEAN")
    merges = spark.createDataFrame([], "rank INT, left STRING, right STRING, merged STRING")
    words = spark.createDataFrame([("a", 1, [0])], "word STRING, n BIGINT, ids ARRAY<INT>")
    path = str(tmp_path / "tokenizer")
    save_tokenizer(Tokenizer(vocab, merges, words), path)
    assert load_tokenizer(spark, path).word_tokens.count() == 1
    save_tokenizer(Tokenizer(vocab, merges), path)
    assert load_tokenizer(spark, path).word_tokens.count() == 0
