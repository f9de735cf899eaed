"""Incremental preparation of a growing text dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import SpecialTokens
from corpusloom.operators.prepare import KEPT, REJECTED, Processor, split_rows
from corpusloom.sources import snapshots


def rejected_path(target: str) -> str:
    """Where a stream leaves the rows that it rejects, unless told otherwise."""
    return f"{target.rstrip('/')}_rejected"


def stream_prepare(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    processor: str | Processor = "default",
    instruct: bool | Column = False,
    tokens: SpecialTokens = SpecialTokens(),
    file_pattern: str | None = None,
    files_per_trigger: int | None = None,
    rejected: str | None = None,
) -> None:
    """Prepare all files not yet seen; returns when done.

    The same expressions as in batch, so the result is the same rows. Files already in the
    checkpoint are not read again. A trigger writes its rows once, kept and rejected ones apart,
    and moves them to the folder batch=<its number> of the target and of `rejected`; a trigger
    that is run again leaves the folders that are there.
    """
    homes = {KEPT: target.rstrip("/"), REJECTED: (rejected or rejected_path(target)).rstrip("/")}

    def handle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        goals = {status: f"{home}/batch={number}" for status, home in homes.items()}
        staged = snapshots.staging_path(homes[KEPT])
        rows = split_rows(batch, processor, instruct, tokens)
        rows.write.partitionBy("status").parquet(staged)
        for status, goal in goals.items():
            part = f"{staged}/status={status}"
            if f"status={status}" not in snapshots.folders(session, staged):
                # No row of this kind: a file without rows still has the columns.
                session.createDataFrame([], rows.drop("status").schema).write.parquet(part)
            snapshots.move(session, part, goal)

    reader = spark.readStream.schema(schema)
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    (
        reader.parquet(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_stream_rejects(spark: SparkSession, target: str) -> DataFrame:
    """The rows a stream rejected: raw text, reject_reason, error, and the batch."""
    return spark.read.parquet(rejected_path(target)).withColumn("batch", F.col("batch").cast("bigint"))
