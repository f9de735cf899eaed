"""Alerts for unstable runs from a state per run that the engine keeps.

Rows are reduced where they are read: a stretch of consecutive micro-batches of a run becomes one
row, so that a run which holds most of a trigger sends a few rows to the task of its state. The
state of a run is its last finite micro-batch and whether it was alerted for; a trigger reads and
writes the states of its own runs only. `streaming.abort` does the same without a state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusloom.streaming.abort import METRICS_SCHEMA

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_STRETCH = "run_id BIGINT, first BIGINT, last BIGINT, lead BIGINT, last_finite BIGINT, hit BIGINT"
_ALERT = "run_id BIGINT, abort_micro BIGINT, streak BIGINT"


def stretches(run: np.ndarray, micro: np.ndarray, loss: np.ndarray, limit: int) -> list[np.ndarray]:
    """Rows reduced to stretches of consecutive micro-batches of one run, as columns.

    first and last micro-batch; lead, how many losses are not finite before the first finite
    one; the last finite micro-batch, or -1; hit, where a streak that begins behind a finite loss
    of the stretch reaches the limit, or -1.
    """
    order = np.lexsort((micro, run))
    run, micro, bad = run[order], micro[order], ~np.isfinite(loss[order])
    begins = np.flatnonzero(
        np.concatenate([[True], (run[1:] != run[:-1]) | (micro[1:] != micro[:-1] + 1)])
    )
    ends = np.append(begins[1:], len(run))
    out = [run[begins], micro[begins], micro[ends - 1]]
    out += [np.full(len(begins), -1, dtype=np.int64) for _ in range(3)]
    for k, (a, b) in enumerate(zip(begins, ends, strict=True)):
        fine = np.flatnonzero(~bad[a:b])
        out[3][k] = fine[0] if len(fine) else b - a
        if len(fine):
            out[4][k] = micro[a + fine[-1]]
            # The gap behind each finite loss, up to the next one or the end.
            gaps = np.append(fine[1:], b - a) - fine - 1
            long = np.flatnonzero(gaps >= limit)
            if len(long):
                out[5][k] = micro[a + fine[long[0]]] + limit
    return out


def _reduced(limit: int):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _STRETCH.split(", ")]
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("run_id", "micro", "loss")]
                found = stretches(*columns, limit)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

    return reduce


class AbortState(StatefulProcessor):
    """The state of one run, moved on by its stretches in order."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("run", "last_finite BIGINT, alerted BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last_finite, alerted = self.known.get() if self.known.exists() else (-1, False)
        parts = pd.concat(list(rows)).sort_values("first")
        for part in parts.itertuples(index=False):
            # The streak that came with the run goes on through the lead of the stretch.
            reached = max(part.first, last_finite + self.limit)
            hit, since = (reached, last_finite) if reached < part.first + part.lead else (part.hit, part.hit - self.limit)
            if hit >= 0 and not alerted:
                alerted = True
                yield pd.DataFrame({"run_id": [key[0]], "abort_micro": [hit], "streak": [hit - since]})
            last_finite = max(last_finite, part.last_finite)
        self.known.update((int(last_finite), bool(alerted)))

    def close(self) -> None:
        pass


def stream_abort_keyed(
    spark: SparkSession, source: str, folder: str, limit: int, files_per_trigger: int | None = None
) -> DataFrame:
    """Read new metrics files and return the alerts of all triggers so far, one for a run.

    Rows of a run must reach the stream in order from trigger to trigger; inside one they are
    sorted. Alerts are written by the engine's file sink, so a trigger that is run again gives
    none twice.
    """
    reader = spark.readStream.schema(METRICS_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        (
            reader.parquet(source)
            .select("run_id", "micro", "loss")
            .filter("run_id IS NOT NULL AND micro IS NOT NULL AND loss IS NOT NULL")
            .mapInArrow(_reduced(limit), _STRETCH)
            .groupBy("run_id")
            .transformWithStateInPandas(AbortState(limit), _ALERT, "Append", "None")
            .writeStream.format("parquet")
            .option("path", f"{folder}/alerts")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    finally:
        spark.conf.set(_PROVIDER, before)
    return spark.read.schema(_ALERT).parquet(f"{folder}/alerts")
