"""Alerts for unstable runs while their metrics stream in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import Settings
from corpusloom.operators.telemetry import is_finite, nonfinite_streaks

METRICS_SCHEMA = "run_id BIGINT, micro BIGINT, ts_us BIGINT, loss DOUBLE"

# Triggers after which the states of all runs are written together.
_FULL_STATE_EVERY = 16

_STATE_SCHEMA = "run_id BIGINT, last_finite BIGINT, aborted BOOLEAN"


def _carry_streaks(batch: DataFrame, state: DataFrame, settings: Settings) -> DataFrame:
    """Streaks inside the batch, lengthened by the streak the run came with.

    streak is exact where the batch holds a finite loss of the run before the row: there it
    is short. Otherwise the row continues the streak since the last finite loss on record.
    """
    first = batch.groupBy("run_id").agg(F.min("micro").alias("first_micro"))
    known = first.join(state, "run_id", "left").select(
        "run_id",
        "first_micro",
        F.coalesce("last_finite", F.lit(-1).cast("bigint")).alias("last_finite"),
        F.coalesce("aborted", F.lit(False)).alias("aborted"),
    )
    inside = nonfinite_streaks(batch, settings).join(known, "run_id")
    unbroken = F.col("micro") - F.col("streak") < F.col("first_micro")
    return inside.withColumn(
        "streak",
        F.when(unbroken, F.col("micro") - F.col("last_finite")).otherwise(F.col("streak")),
    )


def _advance(batch: DataFrame, alerts: DataFrame) -> DataFrame:
    finite = F.when(is_finite(F.col("loss")), F.col("micro"))
    seen = batch.groupBy("run_id").agg(F.max(finite).alias("last_finite"))
    flagged = alerts.select("run_id", F.lit(True).alias("aborted"))
    return seen.join(flagged, "run_id", "left").withColumn(
        "aborted", F.coalesce("aborted", F.lit(False))
    )


def _newest(states: DataFrame) -> DataFrame:
    return states.groupBy("run_id").agg(
        F.max("last_finite").alias("last_finite"), F.max("aborted").alias("aborted")
    )


def stream_abort(
    spark: SparkSession,
    source: str,
    folder: str,
    limit: int,
    settings: Settings = Settings(),
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Read new metrics files and return the alerts of all triggers so far.

    State is one small row per run. A trigger writes those of its own runs only; every
    sixteenth writes all, and earlier ones are not read any more. A trigger that is run again
    overwrites its own state and alerts, so each alert is given once. Rows of a
    run must reach the stream in order from trigger to trigger; inside one they are sorted
    by the operator, in blocks, so a run may hold any share of the trigger.
    """

    def version(name: str, number: int) -> str:
        return f"{folder}/{name}/trigger={number}"

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch = batch.persist()
        first = max(0, number - 1) // _FULL_STATE_EVERY * _FULL_STATE_EVERY
        written = [version("state", k) for k in range(first, number)]
        if written:
            state = _newest(session.read.schema(_STATE_SCHEMA).parquet(*written))
        else:
            state = session.createDataFrame([], _STATE_SCHEMA)
        fresh = (
            _carry_streaks(batch, state, settings)
            .filter((F.col("streak") >= limit) & ~F.col("aborted"))
            .groupBy("run_id")
            .agg(F.min("micro").alias("abort_micro"), F.min_by("streak", "micro").alias("streak"))
        )
        fresh.write.mode("overwrite").parquet(version("alerts", number))
        alerts = session.read.parquet(version("alerts", number))
        update = _advance(batch, alerts)
        if number and number % _FULL_STATE_EVERY == 0:
            update = _newest(state.unionByName(update))
        update.write.mode("overwrite").parquet(version("state", number))
        batch.unpersist()

    reader = spark.readStream.schema(METRICS_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    (
        reader.parquet(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{folder}/alerts").drop("trigger")
