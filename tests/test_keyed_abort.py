"""Abort alerts from a state per run, against the batch operator."""

import random

import numpy as np
import pytest

from corpusloom.operators import telemetry
from corpusloom.streaming.abort import METRICS_SCHEMA
from corpusloom.streaming.keyed_abort import stream_abort_keyed, stretches

NAN, INF = float("nan"), float("inf")


def log(spark, runs):
    rows = [(run, m, m * 1_000, float(x)) for run, losses in runs.items() for m, x in enumerate(losses)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def alerts(frame):
    return sorted((r["run_id"], r["abort_micro"], r["streak"]) for r in frame.collect())


@pytest.mark.parametrize("seed", range(40))
def test_stretches_equal_a_plain_loop(seed):
    rng = random.Random(seed)
    rows = [(run, m, rng.choice([1.0, NAN, -INF])) for run in range(3) for m in range(30) if rng.random() < 0.85]
    rng.shuffle(rows)
    limit, got = rng.randint(1, 4), {}
    columns = [np.array(c) for c in zip(*rows, strict=True)]
    for run, first, last, lead, last_finite, hit in zip(*stretches(*columns, limit), strict=True):
        got[run, first] = (last, lead, last_finite, hit)
    losses, wanted = {(r, m): x for r, m, x in rows}, {}
    for run, m in sorted(losses):
        if (run, m - 1) not in losses:
            start, lead, finite, hit = m, 0, -1, -1
        if np.isfinite(losses[run, m]):
            finite = m
        elif finite < 0:
            lead += 1
        elif m - finite == limit and hit < 0:
            hit = m
        wanted[run, start] = (m, lead, finite, hit)
    assert got == wanted


def test_stream_equals_batch_and_goes_on_after_a_stop(spark, tmp_path):
    rng = random.Random(5)
    runs = {run: [rng.choice([1.0, NAN, INF, NAN, NAN, -INF]) for _ in range(90)] for run in range(12)}
    runs |= {20: [1.0] * 40 + [NAN] * 50, 21: [NAN] * 90, 22: [1.0] * 90, 23: [NAN] * 11 + [1.0] + [NAN] * 78}
    frame, source, folder = log(spark, runs), str(tmp_path / "in"), str(tmp_path / "run")
    wanted = alerts(telemetry.abort_points(frame, 12))
    seen = []
    for at, low in enumerate(range(0, 90, 15)):
        part = frame.filter(f"micro BETWEEN {low} AND {low + 14}").coalesce(1)
        part.write.mode("append").parquet(source)
        if at % 3 == 2:  # a new start of the query, over three files
            seen.append(alerts(stream_abort_keyed(spark, source, folder, 12, files_per_trigger=1)))
    assert seen[-1] == wanted and set(seen[0]) <= set(wanted) and len(seen[0]) < len(wanted)
    assert alerts(stream_abort_keyed(spark, source, folder, 12)) == wanted
