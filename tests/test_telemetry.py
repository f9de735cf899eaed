"""Run analytics: golden rows, and runs that hold most of the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.operators import telemetry
from corpusloom.streaming.abort import METRICS_SCHEMA, stream_abort

NAN, INF = float("nan"), float("inf")
SMALL_BLOCKS = Settings(block_rows=16)


def log(spark, runs, second=1_000_000):
    rows = [
        (run, micro, micro * second, float(loss))
        for run, losses in runs.items()
        for micro, loss in enumerate(losses)
    ]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def shape(accumulation=1, every=2, epoch=1000, total=100):
    return telemetry.RunShape(epoch, accumulation, every, total)


def test_streaks_and_abort(spark):
    frame = log(spark, {1: [1, NAN, NAN, 2, NAN, NAN, INF]})
    rows = telemetry.nonfinite_streaks(frame).orderBy("micro").collect()
    assert [r["streak"] for r in rows] == [0, 1, 2, 0, 1, 2, 3]
    row = telemetry.abort_points(frame, 3).first()
    assert (row["abort_micro"], row["streak"]) == (6, 3)
    assert telemetry.abort_points(frame, 4).count() == 0


def brute_streaks(losses):
    out, streak = [], 0
    for loss in losses:
        streak = 0 if math.isfinite(loss) else streak + 1
        out.append(streak)
    return out


def test_streaks_of_a_hot_run(spark):
    rng = random.Random(9)
    runs = {7: [rng.choice([1.0, NAN, NAN, NAN, INF]) for _ in range(2000)]}
    runs[7][300:420] = [NAN] * 120
    runs |= {run: [rng.choice([2.0, NAN]) for _ in range(20)] for run in range(8, 40)}
    out = telemetry.nonfinite_streaks(log(spark, runs), SMALL_BLOCKS).collect()
    got = {(r["run_id"], r["micro"]): r["streak"] for r in out}
    wanted = {(run, i): s for run, v in runs.items() for i, s in enumerate(brute_streaks(v))}
    assert got == wanted


def test_log_windows_golden(spark):
    frame = log(spark, {1: [1, 3, NAN, NAN, 5, NAN]})
    rows = telemetry.throughput(frame, shape(), Settings()).orderBy("step").collect()
    assert [(r["step"], r["mean_loss"]) for r in rows] == [(2, 2.0), (6, 5.0)]
    assert [r["elapsed"] for r in rows] == [1.0, 4.0]
    assert rows[1]["steps_per_second"] == 0.5
    assert rows[1]["samples_per_second"] == 0.5 * 4 * 1 * 2


def test_unfinished_window_is_silent(spark):
    frame = log(spark, {1: [1, 3, 8]})
    assert [r["step"] for r in telemetry.log_windows(frame, shape()).collect()] == [2]


def test_no_elapsed_time_gives_no_speed(spark):
    frame = log(spark, {1: [1, 3, 5, 7]}, second=0)
    rows = telemetry.throughput(frame, shape(), Settings()).collect()
    assert [r["steps_per_second"] for r in rows] == [0.0, 0.0]


def reference_windows(losses, run_shape):
    """The training loop's log lines, walked one micro-batch at a time."""
    total, count, step, out = 0.0, 0, 0, []
    for micro, loss in enumerate(losses):
        if math.isfinite(loss):
            total, count = total + loss, count + 1
        if (micro % run_shape.batches_per_epoch + 1) % run_shape.accumulation == 0:
            step += 1
            if step % run_shape.logging_steps == 0 and count:
                out.append((step, round(total / count, 9)))
                total, count = 0.0, 0
    return out, step


@pytest.mark.parametrize("epoch, accumulation, every", [(7, 2, 3), (10, 3, 2), (5, 5, 1), (9, 4, 4)])
def test_windows_equal_the_loop(spark, epoch, accumulation, every):
    rng = random.Random(epoch)
    losses = [rng.choice([rng.randint(1, 900) / 100, NAN]) for _ in range(100)]
    run_shape = telemetry.RunShape(epoch, accumulation, every, 1000)
    rows = telemetry.log_windows(log(spark, {3: losses}), run_shape).orderBy("step").collect()
    wanted, last = reference_windows(losses, run_shape)
    assert [(r["step"], round(r["mean_loss"], 9)) for r in rows] == wanted
    assert telemetry.run_summary(log(spark, {3: losses}), run_shape).first()["global_step"] == last


def test_throughput_of_a_hot_run(spark):
    runs = {1: [1.0] * 3000, 2: [1.0] * 10}
    frame = log(spark, runs)
    plain = telemetry.throughput(frame, shape(), Settings())
    blocked = telemetry.throughput(frame, shape(), SMALL_BLOCKS)
    assert blocked.exceptAll(plain).count() == 0
    assert blocked.count() == 1505


def test_summary_golden(spark):
    row = telemetry.run_summary(log(spark, {1: [1, 3, 5, 7]}), shape(accumulation=2)).first()
    assert (row["training_loss"], row["mean_micro_loss"], row["global_step"]) == (8.0, 4.0, 2)


@pytest.mark.parametrize("losses", [[1e30, 4.0, 1e30, -1e30], [4e-10] * 4, [0.1] * 2500])
def test_any_finite_loss_is_summed_as_by_the_loop(spark, losses):
    run_shape = shape(accumulation=2, every=1, total=5000)
    rows = telemetry.log_windows(log(spark, {1: losses}), run_shape).orderBy("step").collect()
    assert [r["mean_loss"] for r in rows] == [
        (0.0 + a + b) / 2 for a, b in zip(losses[::2], losses[1::2], strict=True)
    ]
    row = telemetry.run_summary(log(spark, {1: losses}), run_shape).first()
    assert row["mean_micro_loss"] == pytest.approx(math.fsum(losses) / len(losses), rel=1e-9)
    assert row["training_loss"] == pytest.approx(math.fsum(losses) / (len(losses) // 2), rel=1e-9)


def test_report_has_step_metrics_and_speed(spark):
    frame = log(spark, {1: [0.5] * 10})
    row = telemetry.metrics_report(frame, shape(every=1, total=10), Settings()).first()
    lines = row["report"].split("\n")
    assert lines[0] == f"Step {row['step']}/10"
    assert lines[1].startswith("loss: 0.5000 | learning_rate: ")
    assert lines[2] == "Speed: 8.00 samples/s | 1.00 steps/s"


def test_summary_without_a_step(spark):
    row = telemetry.run_summary(log(spark, {1: [NAN]}), shape(accumulation=2)).first()
    assert (row["training_loss"], row["mean_micro_loss"], row["global_step"]) == (0.0, None, 0)


def test_stop_and_verdict(spark):
    minute = 60_000_000
    frame = log(spark, {1: [1.0] * 35, 2: [1.0] * 5, 3: [1.0] * 10}, second=minute)
    stops = telemetry.stop_points(frame, shape(total=10), budget_minutes=15)
    got = {r["run_id"]: (r["stop_step"], r["last_step"], r["remaining_minutes"]) for r in stops.collect()}
    assert got == {1: (20, 35, 0.0), 2: (None, 5, 11.0), 3: (None, 10, 6.0)}
    verdicts = {
        total: {
            r["run_id"]: (r["final_step"], r["stopped_early"], r["completed"])
            for r in telemetry.run_verdicts(stops, total).collect()
        }
        for total in (10, 20)
    }
    assert verdicts[10] == {1: (10, False, True), 2: (5, False, False), 3: (10, False, True)}
    assert verdicts[20] == {1: (20, True, False), 2: (5, False, False), 3: (10, False, False)}


def test_next_phase_golden(spark):
    rows = [
        (1, False, True, True), (2, True, True, True), (3, False, False, False),
        (4, True, False, False), (5, True, True, False), (6, False, True, False),
    ]
    frame = spark.createDataFrame(rows, "run_id INT, instruct BOOLEAN, resume BOOLEAN, completed BOOLEAN")
    got = {
        r["run_id"]: (r["next_instruct"], r["next_resume"], r["paused"])
        for r in telemetry.next_phase(frame).collect()
    }
    assert got == {
        1: (True, False, False), 2: (True, True, True), 3: (False, True, False),
        4: (True, True, False), 5: (True, True, False), 6: (False, True, False),
    }


def test_triage_golden(spark):
    messages = [("Connection RESET by peer",), ("value error",), ("read TimeOut",)]
    rows = telemetry.failure_triage(spark.createDataFrame(messages, "message STRING")).collect()
    assert {r["message"]: r["recoverable"] for r in rows} == {
        "Connection RESET by peer": True, "value error": False, "read TimeOut": True,
    }


def test_stream_equals_batch_with_carried_streaks(spark, tmp_path):
    rng = random.Random(21)
    runs = {run: [rng.choice([1.0, NAN, NAN]) for _ in range(90)] for run in range(12)}
    runs[5] = [1.0] * 3 + [NAN] * 87
    runs[6] = [NAN] * 90
    runs[7] = [1.0] * 90
    frame = log(spark, runs)
    for low in range(0, 90, 15):
        part = frame.filter(F.col("micro").between(low, low + 14)).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    alerts = stream_abort(
        spark, str(tmp_path / "in"), str(tmp_path / "run"), 12, SMALL_BLOCKS, files_per_trigger=1
    )
    wanted = telemetry.abort_points(frame, 12)
    assert sorted(map(tuple, alerts.select("run_id", "abort_micro", "streak").collect())) == sorted(
        map(tuple, wanted.collect())
    )


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    frame = log(spark, {1: [1.0] + [NAN] * 9})
    source, folder = str(tmp_path / "in"), str(tmp_path / "run")
    frame.filter("micro < 5").coalesce(1).write.mode("append").parquet(source)
    assert stream_abort(spark, source, folder, 6).count() == 0
    frame.filter("micro >= 5").coalesce(1).write.mode("append").parquet(source)
    rows = stream_abort(spark, source, folder, 6).collect()
    assert [(r["run_id"], r["abort_micro"], r["streak"]) for r in rows] == [(1, 6, 6)]
    assert stream_abort(spark, source, folder, 6).count() == 1
