"""Versions of stored tables: torn saves, readers that stay, and writers at once."""

import pytest
from pyspark.sql import functions as F

from corpusloom.config import Settings, SpecialTokens
from corpusloom.operators import prepare
from corpusloom.plans import jobs
from corpusloom.sources import run_state, snapshots, tables
from corpusloom.sources.tokenizer_store import Tokenizer, load_tokenizer, save_tokenizer
from corpusloom.streaming.prepare import read_stream_rejects, stream_prepare

MERGES = "rank INT, left STRING, right STRING, merged STRING"


def tokenizer(spark, token, merged="ab"):
    vocab = spark.createDataFrame([(0, token, False)], "id INT, token STRING, special BOOLEAN")
    return Tokenizer(vocab, spark.createDataFrame([(0, "a", "b", merged)], MERGES))


def failing(df):
    """The rows, but reading them fails."""
    return df.withColumn("rank", F.raise_error(F.lit("disk full")).cast("int"))


def test_a_torn_save_leaves_the_old_tokenizer_whole(spark, tmp_path):
    path = str(tmp_path / "tokenizer")
    save_tokenizer(tokenizer(spark, "old"), path)
    new = tokenizer(spark, "new")
    with pytest.raises(Exception, match="disk full"):
        save_tokenizer(Tokenizer(new.vocab, failing(new.merges)), path)
    loaded = load_tokenizer(spark, path)
    assert loaded.vocab.first()["token"] == "old" and loaded.merges.first()["merged"] == "ab"
    save_tokenizer(new, path)
    assert load_tokenizer(spark, path).vocab.first()["token"] == "new"


def test_a_loaded_tokenizer_stays_of_one_version(spark, tmp_path):
    path = str(tmp_path / "tokenizer")
    save_tokenizer(tokenizer(spark, "one", "one"), path)
    loaded = load_tokenizer(spark, path)
    save_tokenizer(tokenizer(spark, "two", "two"), path)
    assert (loaded.vocab.first()["token"], loaded.merges.first()["merged"]) == ("one", "one")
    with pytest.raises(FileNotFoundError):
        load_tokenizer(spark, str(tmp_path / "nowhere"))


def state(spark, rows):
    return spark.createDataFrame(
        rows, "state_key STRING, stamped_owner STRING, global_step BIGINT, completed BOOLEAN, updated_at BIGINT"
    )


def steps(spark, path):
    return {r["state_key"]: r["global_step"] for r in run_state.read_state(spark, path).collect()}


def test_two_writers_from_one_version_both_survive(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    run_state.update_state(state(spark, [("a", "o", 1, False, 1), ("b", "o", 1, False, 1)]), path)
    publish, raced = snapshots.publish, []

    def late(session, staged, base, number):
        """Before the first writer publishes, another one does."""
        if not raced:
            raced.append(number)
            run_state.update_state(state(spark, [("b", "o", 5, False, 2), ("c", "o", 7, False, 2)]), path)
        return publish(session, staged, base, number)

    monkeypatch.setattr(snapshots, "publish", late)
    run_state.update_state(state(spark, [("a", "o", 4, False, 2)]), path)
    assert raced == [1] and snapshots.versions(spark, path) == [0, 1, 2]
    assert steps(spark, path) == {"a": 4, "b": 5, "c": 7}


def test_a_number_is_published_once(spark, tmp_path):
    base = str(tmp_path / "table")
    first, second = snapshots.staging_path(base), snapshots.staging_path(base)
    spark.range(1).write.parquet(first)
    spark.range(2).write.parquet(second)
    assert snapshots.publish(spark, first, base, 3) and not snapshots.publish(spark, second, base, 3)
    assert snapshots.newest(spark, base) == f"{base}/v3" and spark.read.parquet(f"{base}/v3").count() == 1
    assert snapshots.newest(spark, str(tmp_path / "none")) is None


TEXTS = [(0, "one"), (1, None), (2, "  "), (3, "three\nlines"), (4, "four"), (5, "")]


def source(spark, tmp_path, rows=TEXTS):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.mode("overwrite").parquet(path)
    return tables.DatasetPaths(path, path)


def picky(text, tokens, instruct):
    if text == "four":
        raise ValueError("no")
    return None if "\n" in text else tokens.bos + text


def test_prepare_job_keeps_rejects_and_counts_while_writing(spark, tmp_path):
    target, calls = str(tmp_path / "out"), spark.sparkContext.accumulator(0)

    def counted(text, tokens, instruct):
        calls.add(1)
        return picky(text, tokens, instruct)

    done = jobs.prepare_job(
        spark, source(spark, tmp_path), target, processor=prepare.python_processor(counted),
        settings=Settings(batch_size=1, accumulation=1),
    )
    assert calls.value == 3  # one call for each text that is not blank
    assert done == jobs.Preparation(1, 6, {"blank": 3, "error": 1, "null_result": 1}, "ok")
    assert [(r["doc_id"], r["text"]) for r in tables.read_prepared(spark, target).collect()] == [(0, "<s>one")]
    rejected = {r["doc_id"]: (r["text"], r["reject_reason"], r["error"]) for r in tables.read_rejected(spark, target).collect()}
    assert rejected == {
        1: (None, "blank", None), 2: ("  ", "blank", None), 5: ("", "blank", None),
        3: ("three\nlines", "null_result", None), 4: ("four", "error", "ValueError: no"),
    }


def test_a_phase_is_replaced_with_its_rejects(spark, tmp_path):
    target = str(tmp_path / "out")
    jobs.prepare_job(spark, source(spark, tmp_path), target)
    jobs.prepare_job(spark, source(spark, tmp_path, [(9, "all good")]), target)
    assert tables.read_rejected(spark, target).count() == 0
    assert [r["doc_id"] for r in tables.read_prepared(spark, target, "pretrain").collect()] == [9]


def test_a_torn_preparation_leaves_the_phase(spark, tmp_path):
    target = str(tmp_path / "out")
    jobs.prepare_job(spark, source(spark, tmp_path), target)
    before = tables.read_prepared(spark, target)

    def fails(df, instruct, tokens):
        bad = F.when(F.col("text") == "four", F.raise_error(F.lit("lost"))).otherwise(F.col("text"))
        return df.withColumn("result", bad.cast("string")).withColumn("error", F.lit(None).cast("string"))

    with pytest.raises(Exception, match="lost"):
        jobs.prepare_job(spark, source(spark, tmp_path), target, processor=fails)
    with pytest.raises(ValueError):
        jobs.prepare_job(spark, source(spark, tmp_path, [(i, " ") for i in range(3)]), target, guard_batches=True)
    assert sorted(r["doc_id"] for r in tables.read_prepared(spark, target).collect()) == [0, 3, 4]
    assert before.count() == 3


def test_an_empty_dataset_has_no_plan(spark, tmp_path):
    target = str(tmp_path / "out")
    done = jobs.prepare_job(spark, source(spark, tmp_path, []), target, guard_batches=True)
    assert (done.n_examples, done.plan_status) == (0, "empty")


def test_stream_rejects_are_kept_once(spark, tmp_path):
    target, schema = str(tmp_path / "rows"), "doc_id BIGINT, text STRING"
    where = source(spark, tmp_path).pretrain
    frame = spark.read.parquet(where)
    ask = dict(processor=prepare.python_processor(picky), tokens=SpecialTokens())
    stream_prepare(spark, where, frame.schema, target, str(tmp_path / "marks"), **ask)
    spark.createDataFrame([(10, "ten"), (11, " ")], schema).write.mode("append").parquet(where)
    stream_prepare(spark, where, frame.schema, target, str(tmp_path / "marks"), **ask)
    # The last trigger runs again, as after a driver that died before the checkpoint was written.
    commits = sorted((tmp_path / "marks" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (tmp_path / "marks" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    stream_prepare(spark, where, frame.schema, target, str(tmp_path / "marks"), **ask)
    assert sorted(r["doc_id"] for r in spark.read.parquet(target).collect()) == [0, 10]
    rejects = {(r["batch"], r["doc_id"]): r["reject_reason"] for r in read_stream_rejects(spark, target).collect()}
    assert rejects == {
        (0, 1): "blank", (0, 2): "blank", (0, 5): "blank", (0, 3): "null_result", (0, 4): "error", (1, 11): "blank",
    }
    assert read_stream_rejects(spark, target).count() == 6
