"""Collation, layout, plans and positions."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.queries import _prepared, _spelled, all_queries
from corpusloom.config import Settings, SpecialTokens
from corpusloom.functions.symbols import byte_order
from corpusloom.operators import encoding, layout, positions
from corpusloom.plans import steps

BOT, END = 7, 9
TOKENS = SpecialTokens()


def reference_mask(ids):
    out, inside = [], False
    for token in ids:
        keep = inside and token != END
        out.append(token if keep else -100)
        inside = (inside or token == BOT) and not (inside and token == END)
    return out


def masked(spark, rows):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i INT, ids ARRAY<INT>")
    labels = encoding.mask_labels(F.col("ids"), BOT, END, -100)
    out = frame.select("i", labels.alias("labels")).orderBy("i").collect()
    return [list(r["labels"]) for r in out]


def test_mask_golden(spark):
    rows = [[1, BOT, 2, 3, END, 4, BOT, 5], [BOT, 2, BOT, 3, END], [1, END, 2], [], [END], [BOT]]
    assert masked(spark, rows) == [
        [-100, -100, 2, 3, -100, -100, -100, 5],
        [-100, 2, BOT, 3, -100],
        [-100, -100, -100],
        [],
        [-100],
        [-100],
    ]


def test_mask_equals_state_machine(spark):
    rng = random.Random(3)
    rows = [[rng.choice([1, 2, BOT, END]) for _ in range(rng.randint(0, 25))] for _ in range(3000)]
    assert masked(spark, rows) == [reference_mask(r) for r in rows]


def test_collate_pads_to_longest_of_batch(spark):
    encoded = spark.createDataFrame(
        [(0, [7, 8, 9]), (1, list(range(10, 19))), (2, [5] * 30)], "k BIGINT, ids ARRAY<INT>"
    )
    plan = spark.createDataFrame(
        [(0, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 1)], "k BIGINT, epoch INT, rank INT, batch_no BIGINT"
    )
    settings = Settings(max_length=20)
    out = encoding.collate(encoded, plan, ["k"], encoding.CollateIds(pad=1), settings)
    rows = {r["k"]: r for r in out.collect()}
    assert [rows[k]["pad_to"] for k in range(3)] == [16, 16, 24]
    assert list(rows[0]["input_ids"]) == [7, 8, 9] + [1] * 13
    assert list(rows[0]["labels"]) == [7, 8, 9] + [1] * 13
    assert list(rows[0]["attention_mask"]) == [1] * 3 + [0] * 13
    assert list(rows[2]["input_ids"]) == [5] * 20 + [1] * 4


def test_instruct_labels_keep_pads_after_an_open_answer(spark):
    encoded = spark.createDataFrame([(0, [2, BOT, 3])], "k BIGINT, ids ARRAY<INT>")
    plan = spark.createDataFrame([(0, 0, 0, 0)], "k BIGINT, epoch INT, rank INT, batch_no BIGINT")
    ids = encoding.CollateIds(pad=1, bot=BOT, end=END)
    row = encoding.collate(encoded, plan, ["k"], ids, instruct=True).first()
    assert list(row["labels"]) == [-100, -100, 3, 1, 1, 1, 1, 1]


@pytest.mark.parametrize("world, size", [(1, 4), (3, 4), (7, 2)])
def test_layout_partitions_the_examples(spark, world, size):
    total = 101
    settings = Settings(world_size=world, batch_size=size)
    rows = layout.training_layout(spark.range(total).toDF("k"), ["k"], 2, settings).collect()
    orders = []
    for epoch in (0, 1):
        mine = [r for r in rows if r["epoch"] == epoch]
        assert len(mine) == total // world * world == len({r["k"] for r in mine})
        assert set(Counter(r["rank"] for r in mine).values()) == {total // world}
        for r in mine:
            assert (r["rank"], r["pos"]) == (r["perm_pos"] % world, r["perm_pos"] // world)
            assert r["batch_no"] == r["pos"] // size
        assert sorted(r["perm_pos"] for r in mine) == list(range(len(mine)))
        orders.append([r["k"] for r in sorted(mine, key=lambda r: r["perm_pos"])])
    assert orders[0] != orders[1] and orders[0] != sorted(orders[0])
    again = layout.training_layout(spark.range(total).toDF("k").repartition(5), ["k"], 2, settings)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_ordinals_with_a_hot_group(spark):
    rows = [(0, i * 7919 % 6000, i) for i in range(4000)] + [(i % 50 + 1, i, i) for i in range(500)]
    rows += [(None, 5 - i, i) for i in range(4)]
    random.Random(5).shuffle(rows)
    frame = spark.createDataFrame(rows, "g INT, t INT, i INT").repartition(8)
    out = positions.ordinals(frame, ["t", "i"], "pos", by=["g"]).collect()
    groups = defaultdict(list)
    for r in out:
        groups[r["g"]].append(r)
    assert sum(map(len, groups.values())) == len(rows)
    for members in groups.values():
        ordered = sorted(members, key=lambda r: (r["t"], r["i"]))
        assert [r["pos"] for r in ordered] == list(range(len(ordered)))


def test_batch_numbers_follow_the_order(spark):
    frame = spark.range(1050).select((F.col("id") * 17 % 1050 * 3).alias("k")).repartition(6)
    rows = positions.batch_numbers(frame, ["k"], 100).collect()
    assert all(r["batch_no"] == r["k"] // 3 // 100 for r in rows)


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_max_over_blocks(spark, inclusive):
    rng = random.Random(11)
    rows = [(g, i, rng.choice([None, rng.randint(0, 99)])) for g in (1, 2) for i in range(60 * g)]
    frame = spark.createDataFrame(rows, "g INT, i BIGINT, v INT")
    out = positions.running_max(frame, ["g"], "i", F.col("v"), "top", 7, inclusive).collect()
    assert len(out) == len(rows)
    for r in out:
        limit = r["i"] + (1 if inclusive else 0)
        seen = [v for g, i, v in rows if g == r["g"] and i < limit and v is not None]
        assert r["top"] == (max(seen) if seen else None)


def prepared(spark, count, phase="pretrain"):
    return spark.range(count).select(F.lit(phase).alias("phase"))


def test_plan_golden(spark):
    settings = Settings(world_size=1, batch_size=1, accumulation=2, epochs=2.5)
    row = steps.plan_summary(prepared(spark, 5), settings).first()
    assert (row["n_batches"], row["per_epoch"], row["total_steps"]) == (5, 2, 5)
    plan = steps.step_plan(steps.plan_summary(prepared(spark, 5), settings), settings)
    rows = [(r["step"], r["epoch"], r["first_batch"], r["last_batch"]) for r in plan.orderBy("step").collect()]
    assert rows == [(1, 0, 0, 1), (2, 0, 2, 3), (3, 1, 0, 1), (4, 1, 2, 3), (5, 2, 0, 1)]


def test_plan_spreads_over_blocks(spark):
    settings = Settings(world_size=1, batch_size=1, accumulation=1, epochs=50.0)
    plan = steps.step_plan(steps.plan_summary(prepared(spark, 4000), settings), settings)
    row = plan.agg(F.count("*"), F.min("step"), F.max("step"), F.countDistinct("step")).first()
    assert tuple(row) == (200_000, 1, 200_000, 200_000)


def test_plan_guard(spark):
    settings = Settings(world_size=4, batch_size=4)
    statuses = {3: "empty", 16: "no_step", 32: "ok"}
    for count, status in statuses.items():
        summary = steps.plan_summary(prepared(spark, count), settings)
        assert summary.first()["status"] == status
        if status != "ok":
            with pytest.raises(ValueError):
                steps.require_steps(summary)
    with pytest.raises(ValueError):
        steps.require_steps(steps.plan_summary(prepared(spark, 0), settings))


def test_resume_golden(spark):
    settings = Settings(world_size=1, batch_size=1, accumulation=2, epochs=2.5)
    summary = steps.plan_summary(prepared(spark, 5), settings)
    state = spark.createDataFrame([("a", "pretrain", 3)], "owner STRING, phase STRING, global_step BIGINT")
    row = steps.resume_plan(summary, state).first()
    assert (row["epoch"], row["batch_no"], row["next_step"], row["steps_left"]) == (1, 0, 4, 2)


def test_remaining_steps_are_those_of_the_plan(spark):
    settings = Settings(world_size=1, batch_size=1, accumulation=2, epochs=2.5)
    summary = steps.plan_summary(prepared(spark, 50), settings)
    states = spark.createDataFrame(
        [("a", "pretrain", 3), ("b", "pretrain", 0), ("c", "pretrain", 10_000)],
        "owner STRING, phase STRING, global_step BIGINT",
    )
    plan = {r["step"]: (r["epoch"], r["first_batch"], r["last_batch"]) for r in steps.step_plan(summary, settings).collect()}
    got = {}
    for r in steps.remaining_steps(summary, states, settings).collect():
        got.setdefault(r["owner"], {})[r["step"]] = (r["epoch"], r["first_batch"], r["last_batch"])
    assert got == {"a": {s: v for s, v in plan.items() if s > 3}, "b": plan}


def test_remaining_steps_of_packed_runs(spark, monkeypatch):
    for name, value in (("_PACK_RUNS", 4), ("_PACK_STEPS", 16), ("_PACKS", 8), ("_STEP_BLOCK", 8)):
        monkeypatch.setattr(steps, name, value)
    totals = {"pretrain": (20, 50), "instruct": (7, 33), "none": (1, 1)}
    summary = spark.createDataFrame(
        [(p, e, t, "ok" if p != "none" else "no_step") for p, (e, t) in totals.items()],
        "phase STRING, per_epoch BIGINT, total_steps BIGINT, status STRING",
    )
    rng = random.Random(3)
    rows = [(f"run-{i}", rng.choice(["pretrain", "instruct", "none"]), rng.randrange(60)) for i in range(300)]
    rows += [("twice", "pretrain", 31)] * 2 + [("twice", "instruct", 5), (None, "pretrain", 15), ("gone", None, 1), ("x", "instruct", None)]
    states = spark.createDataFrame(rows, "owner STRING, phase STRING, global_step BIGINT")
    wanted = Counter(
        (owner, phase, s, (s - 1) // totals[phase][0], (s - 1) % totals[phase][0] * 2, (s - 1) % totals[phase][0] * 2 + 1)
        for owner, phase, done in rows
        if phase in ("pretrain", "instruct") and done is not None
        for s in range(done + 1, totals[phase][1] + 1)
    )
    left = steps.remaining_steps(summary, states, Settings(accumulation=2))
    assert Counter(tuple(r) for r in left.collect()) == wanted
    assert steps.remaining_steps(summary, states.limit(0), Settings(accumulation=2)).count() == 0


def test_remaining_steps_take_little_space(spark, tmp_path):
    """Runs times steps are many rows: a file of them holds them in a fraction of a byte each."""
    summary = spark.createDataFrame(
        [("pretrain", 4_000, 10_000, "ok")], "phase STRING, per_epoch BIGINT, total_steps BIGINT, status STRING"
    )
    states = spark.range(1_024).select(
        F.concat(F.lit("run-"), "id").alias("owner"), F.lit("pretrain").alias("phase"), (F.col("id") % 22).alias("global_step")
    )
    steps.remaining_steps(summary, states).write.parquet(str(tmp_path / "left"))
    rows = spark.read.parquet(str(tmp_path / "left")).count()
    assert rows == sum(10_000 - i % 22 for i in range(1_024))
    size = sum(p.stat().st_size for p in (tmp_path / "left").glob("*.parquet"))
    assert size < 0.75 * rows, size / rows


def test_collate_carries_columns_and_keeps_rows_together(spark):
    encoded = spark.createDataFrame([(i, [i], "p") for i in range(40)], "k BIGINT, ids ARRAY<INT>, phase STRING")
    plan = spark.createDataFrame(
        [(i, e, 0, i // 4) for i in range(40) for e in range(2)], "k BIGINT, epoch INT, rank INT, batch_no BIGINT"
    )
    out = encoding.collate(
        encoded, plan, ["k"], encoding.CollateIds(pad=1), together=[F.col("epoch"), F.col("rank")]
    )
    rows = out.withColumn("part", F.spark_partition_id()).collect()
    assert len(rows) == 80 and {r["phase"] for r in rows} == {"p"}
    assert len({(r["epoch"], r["part"]) for r in rows}) == 2


@pytest.mark.parametrize(
    "warmup, expected",
    [(0, [1, 0.853553391, 0.5, 0.146446609, 0]), (2, [0, 0.5, 1, 0.5, 0])],
)
def test_learning_rate_golden(spark, warmup, expected):
    settings = Settings(learning_rate=1.0, warmup_steps=warmup)
    rate = steps.learning_rate(F.col("id"), F.lit(4), settings)
    rows = spark.range(5).select("id", rate.alias("lr")).orderBy("id").collect()
    assert [round(r["lr"], 9) for r in rows] == pytest.approx(expected)


def test_leftover_batches_count_for_the_next_epoch(spark):
    settings = Settings(world_size=1, batch_size=1, accumulation=2, epochs=2.0)
    rows = layout.training_layout(spark.range(5).toDF("k"), ["k"], 2, settings).withColumn(
        "phase", F.lit("pretrain")
    )
    summary = steps.plan_summary(prepared(spark, 5), settings)
    out = steps.assign_step(rows, summary, settings).collect()
    got = sorted((r["epoch"], r["batch_no"], r["step"], r["closes"]) for r in out)
    assert got == [
        (0, 0, 1, False), (0, 1, 1, True), (0, 2, 2, False), (0, 3, 2, True), (0, 4, 3, False),
        (1, 0, 3, False), (1, 1, 3, True), (1, 2, 4, False), (1, 3, 4, True),
    ]
    assert math.isclose(len(out), 9)


def test_steps_are_made_by_many_tasks(spark):
    settings = Settings(world_size=1, batch_size=1, accumulation=2, epochs=2.5)
    states = spark.range(64).select(
        F.concat(F.lit("run-"), F.col("id").cast("string")).alias("owner"),
        F.lit("pretrain").alias("phase"),
        F.lit(0).cast("bigint").alias("global_step"),
    )
    left = steps.remaining_steps(steps.plan_summary(prepared(spark, 50), settings), states, settings)
    parts = left.groupBy(F.spark_partition_id().alias("part")).agg(F.countDistinct("owner").alias("n")).collect()
    assert len(parts) > 4 and sum(r["n"] for r in parts) == 64


def test_bytes_of_texts_are_looked_up_by_batch(spark):
    ids = encoding.byte_special_ids(TOKENS, True)
    texts = [(0, "<s>a<|bot|>é</s>"), (1, None), (2, ""), (3, "<s"), (4, "s></s><|end|><|end|"), (5, "<s><s>")]
    frame = spark.createDataFrame(texts, "k INT, text STRING").repartition(1)
    out = frame.select("k", encoding.encode_bytes(F.col("text"), ids).alias("ids"))
    byte = {b: 5 + place for place, b in enumerate(byte_order())}
    plain = lambda text: [byte[b] for b in text.encode()]
    assert {r["k"]: r["ids"] for r in out.collect()} == {
        0: [ids["<s>"], *plain("a"), ids["<|bot|>"], *plain("é"), ids["</s>"]], 1: None, 2: [], 3: plain("<s"),
        4: [*plain("s>"), ids["</s>"], ids["<|end|>"], *plain("<|end|")], 5: [ids["<s>"]] * 2,
    }
    assert "lambda" not in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["pad_batches", "labels_pretrain"])
def test_pretraining_batches_run_no_lambda(spark, data, name):
    assert "lambda" not in all_queries()[name](spark, data)._jdf.queryExecution().toString()


def test_heavy_texts_use_every_core(spark, data):
    plan = _prepared(spark, data, heavy=True)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"RepartitionByExpression \[doc_id#\d+L?\], {spark.sparkContext.defaultParallelism}\b", plan)


def test_small_numbers_are_spelled_once():
    rows = [[[1, 2, 3], [], [0, 261, 261]] * 99, [[1, None, 2], None] * 9, [[-100, 5]] * 3, [[70_000]], [[]], [None], []]
    for row in rows:
        whole = pa.array(row, pa.list_(pa.int32()))
        for some in (whole, whole[1:], whole[1:3]):
            assert _spelled(some).to_pylist() == some.cast(pa.list_(pa.string())).to_pylist()
