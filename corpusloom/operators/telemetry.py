"""Analytics over the metrics of training runs.

metrics(run_id, micro, ts_us, loss): one row per micro-batch, micro counting from 0 without
gaps, ts_us in microseconds. One run may hold any share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.functions.formats import format_fixed, format_metrics
from corpusloom.operators.positions import running_max
from corpusloom.plans.steps import learning_rate

# Micro-batches whose losses are summed in one piece, in their order; a longer run is the sum
# of its pieces, in their order. So a sum has the same bits however the rows are spread.
_SUM_BLOCK = 1024


def _ordered_sum(place: Column, value: Column) -> Column:
    """An aggregate: the non-null values added as doubles by ascending place; null for none."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(place.alias("at"), value.alias("value")))))
    added = F.aggregate(pairs, F.lit(0.0), lambda total, pair: total + pair["value"])
    return F.when(F.size(pairs) > 0, added)


@dataclass(frozen=True)
class RunShape:
    """How micro-batches make steps: an epoch's batches, their accumulation, the total."""

    batches_per_epoch: int
    accumulation: int
    logging_steps: int
    total_steps: int

    @property
    def steps_per_epoch(self) -> int:
        return max(1, self.batches_per_epoch // self.accumulation)


def is_finite(loss: Column) -> Column:
    return loss.isNotNull() & ~F.isnan(loss) & (F.abs(loss) < float("inf"))


def finite_losses(metrics: DataFrame) -> DataFrame:
    """Rows whose loss is a number; NaN, infinity and null are left out."""
    return metrics.filter(is_finite(F.col("loss")))


def with_steps(metrics: DataFrame, shape: RunShape) -> DataFrame:
    """Add epoch, step and closes: the step a micro-batch belongs to, and whether it ends it.

    A leftover at the end of an epoch belongs to the next epoch's first step.
    """
    place = f"(micro % {shape.batches_per_epoch})"
    return metrics.withColumns(
        {
            "epoch": F.expr(f"micro div {shape.batches_per_epoch}"),
            "step": F.expr(
                f"(micro div {shape.batches_per_epoch}) * {shape.steps_per_epoch}"
                f" + {place} div {shape.accumulation} + 1"
            ),
            "closes": F.expr(f"({place} + 1) % {shape.accumulation} = 0"),
        }
    )


def nonfinite_streaks(metrics: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add streak: how many losses in a row, up to this one, were not finite."""
    last_finite = F.when(is_finite(F.col("loss")), F.col("micro"))
    marked = running_max(
        metrics, ["run_id"], "micro", last_finite, "__last", settings.block_rows, inclusive=True
    )
    return marked.withColumn(
        "streak", F.col("micro") - F.coalesce("__last", F.lit(-1).cast("bigint"))
    ).drop("__last")


def abort_points(
    metrics: DataFrame, limit: int, settings: Settings = Settings()
) -> DataFrame:
    """The micro-batch at which each unstable run aborts: (run_id, abort_micro, streak)."""
    return (
        nonfinite_streaks(metrics, settings)
        .filter(F.col("streak") >= limit)
        .groupBy("run_id")
        .agg(F.min("micro").alias("abort_micro"), F.min_by("streak", "micro").alias("streak"))
    )


def before_abort(metrics: DataFrame, aborts: DataFrame) -> DataFrame:
    """Rows that still count: those up to the abort point of their run."""
    # A hot run is split by the adaptive skew join; the abort side has one row per run.
    return (
        metrics.join(aborts.select("run_id", "abort_micro"), "run_id", "left")
        .filter(F.col("abort_micro").isNull() | (F.col("micro") <= F.col("abort_micro")))
        .drop("abort_micro")
    )


def log_windows(metrics: DataFrame, shape: RunShape) -> DataFrame:
    """Mean loss per log window of logging_steps steps: window, step, mean_loss, end_us.

    A window without a finite loss, or one the run never reached the end of, gives no row.
    """
    every = shape.logging_steps
    finite = is_finite(F.col("loss"))
    closing = F.col("closes") & (F.col("step") % every == 0)
    return (
        with_steps(metrics, shape)
        .withColumn("window", F.expr(f"(step - 1) div {every}"))
        .groupBy("run_id", "window")
        .agg(
            F.max(F.when(closing, F.col("ts_us"))).alias("end_us"),
            _ordered_sum(F.col("micro"), F.when(finite, F.col("loss"))).alias("__sum"),
            F.count(F.when(finite, 1)).alias("n_finite"),
        )
        .filter((F.col("n_finite") > 0) & F.col("end_us").isNotNull())
        .select(
            "run_id",
            "window",
            ((F.col("window") + 1) * every).alias("step"),
            (F.col("__sum") / F.col("n_finite")).alias("mean_loss"),
            "n_finite",
            "end_us",
        )
    )


def run_starts(metrics: DataFrame) -> DataFrame:
    """The first time stamp of each run."""
    return metrics.groupBy("run_id").agg(F.min("ts_us").alias("start_us"))


def throughput(
    metrics: DataFrame, shape: RunShape, settings: Settings = Settings()
) -> DataFrame:
    """Steps and samples per second of each emitted log window.

    Time runs from the previous emitted window, so a silent one adds to the next; the first
    window is timed from the start of its run.
    """
    windows = log_windows(metrics, shape)
    previous = running_max(
        windows, ["run_id"], "window", F.col("end_us"), "__before", settings.block_rows,
        inclusive=False,
    )
    elapsed = (
        F.col("end_us") - F.coalesce("__before", "start_us")
    ) / F.lit(1_000_000.0)
    rate = F.when(F.col("elapsed") > 0, F.lit(float(shape.logging_steps)) / F.col("elapsed"))
    per_step = settings.batch_size * settings.world_size * settings.accumulation
    return (
        previous.join(run_starts(metrics), "run_id")
        .withColumn("elapsed", elapsed)
        .withColumn("steps_per_second", F.coalesce(rate, F.lit(0.0)))
        .withColumn("samples_per_second", F.col("steps_per_second") * per_step)
        .drop("__before", "start_us")
    )


def metrics_report(
    metrics: DataFrame, shape: RunShape, settings: Settings = Settings()
) -> DataFrame:
    """The periodic report: every fifth log window as a step, a metrics and a speed line."""
    rate = learning_rate(F.col("step"), F.lit(shape.total_steps), settings)
    values = format_metrics(
        {"loss": F.col("mean_loss"), "learning_rate": rate}, {"step": F.col("step")}
    )
    place = F.concat(F.lit("Step "), F.col("step").cast("string"), F.lit(f"/{shape.total_steps}"))
    speed = F.concat(
        F.lit("Speed: "),
        format_fixed("samples_per_second"),
        F.lit(" samples/s | "),
        format_fixed("steps_per_second"),
        F.lit(" steps/s"),
    )
    line = F.concat_ws("\n", place, values, speed)
    each = shape.logging_steps * settings.report_every_windows
    return (
        throughput(metrics, shape, settings)
        .filter(F.col("step") % each == 0)
        .select("run_id", "step", line.alias("report"))
    )


def run_summary(metrics: DataFrame, shape: RunShape) -> DataFrame:
    """Totals per run. training_loss divides micro losses by update steps, as logged."""
    finite = is_finite(F.col("loss"))
    return (
        with_steps(metrics, shape)
        .withColumn("__block", F.expr(f"micro div {_SUM_BLOCK}"))
        .groupBy("run_id", "__block")
        .agg(
            F.count("*").alias("n_micro"),
            F.count(F.when(finite, 1)).alias("n_finite"),
            F.max(F.when(F.col("closes"), F.col("step"))).alias("last_step"),
            _ordered_sum(F.col("micro"), F.when(finite, F.col("loss"))).alias("__part"),
        )
        .groupBy("run_id")
        .agg(
            F.sum("n_micro").alias("n_micro"),
            F.sum("n_finite").alias("n_finite"),
            F.coalesce(F.max("last_step"), F.lit(0)).alias("global_step"),
            _ordered_sum(F.col("__block"), F.col("__part")).alias("__sum"),
        )
        .withColumns(
            {
                "training_loss": F.coalesce("__sum", F.lit(0.0))
                / F.greatest(F.lit(1), F.col("global_step")),
                "mean_micro_loss": F.col("__sum") / F.col("n_finite"),
            }
        )
        .drop("__sum")
    )


def epoch_times(metrics: DataFrame, shape: RunShape) -> DataFrame:
    """Minutes between the first and the last micro-batch of each epoch of each run."""
    span = F.max("ts_us") - F.min("ts_us")
    return (
        with_steps(metrics, shape)
        .groupBy("run_id", "epoch")
        .agg(F.count("*").alias("n_micro"), (span / 60_000_000.0).alias("minutes"))
    )


def stop_points(
    metrics: DataFrame, shape: RunShape, budget_minutes: float, check_every: int = 10
) -> DataFrame:
    """The step at which each run's time budget stops it, and the minutes that remain.

    The clock is read at steps that are multiples of check_every. stop_step is null where
    the budget lasted; remaining_minutes is measured at the last step of the run.
    """
    stepped = with_steps(metrics, shape)
    closing_us = F.when(F.col("closes"), F.col("ts_us"))
    runs = stepped.groupBy("run_id").agg(
        F.min("ts_us").alias("start_us"),
        F.max(closing_us).alias("last_us"),
        F.coalesce(F.max(F.when(F.col("closes"), F.col("step"))), F.lit(0)).alias("last_step"),
    )
    # Only the steps at which the clock is read meet the starts. The join is an inner one
    # with the steps on its left, the form whose hot keys the adaptive skew join can split.
    checks = stepped.filter(F.col("closes") & (F.col("step") % check_every == 0))
    stopped = (
        checks.select("run_id", "step", "ts_us")
        .join(runs.select("run_id", "start_us"), "run_id")
        .filter((F.col("ts_us") - F.col("start_us")) / 60_000_000.0 >= budget_minutes)
        .groupBy("run_id")
        .agg(F.min("step").alias("stop_step"))
    )
    used = (F.coalesce("last_us", "start_us") - F.col("start_us")) / 60_000_000.0
    return runs.join(stopped, "run_id", "left").select(
        "run_id",
        "stop_step",
        "last_step",
        F.greatest(F.lit(0.0), F.lit(float(budget_minutes)) - used).alias("remaining_minutes"),
    )


def run_verdicts(stops: DataFrame, total_steps: int) -> DataFrame:
    """Whether each run completed: it reached the total and was not stopped before or at it."""
    reached = F.least("last_step", F.coalesce("stop_step", "last_step"), F.lit(total_steps))
    stopped = F.coalesce(F.col("stop_step") <= F.col("final_step"), F.lit(False))
    return stops.select(
        "run_id", "stop_step", reached.alias("final_step")
    ).select(
        "run_id",
        "final_step",
        stopped.alias("stopped_early"),
        (~stopped & (F.col("final_step") >= total_steps)).alias("completed"),
    )


def next_phase(runs: DataFrame) -> DataFrame:
    """What each run does next: runs(run_id, instruct, resume, completed, ..).

    A finished pretraining hands over to instruction tuning, a finished instruction tuning
    pauses, an unfinished fresh run is marked for resumption, any other stays as it is.
    """
    handed_over = F.col("completed") & ~F.col("instruct")
    return runs.withColumns(
        {
            "next_instruct": F.col("instruct") | handed_over,
            "next_resume": F.when(handed_over, F.lit(False)).otherwise(
                F.col("resume") | ~F.col("completed")
            ),
            "paused": F.col("completed") & F.col("instruct"),
        }
    )


# Words that mark an error message as recoverable.
RECOVERABLE_WORDS = ("timeout", "max", "requests", "reset", "refused", "broken")


def failure_triage(log: DataFrame) -> DataFrame:
    """Failures per message, and whether a restart can be expected to help."""
    pattern = "|".join(RECOVERABLE_WORDS)
    return (
        log.groupBy("message")
        .agg(F.count("*").alias("n"))
        .withColumn("recoverable", F.lower("message").rlike(pattern))
    )
