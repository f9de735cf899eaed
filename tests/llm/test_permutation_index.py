import math
import time

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import permutation_index
from corpusloom.llm.queries import llm_queries
from corpusloom.llm.shared import table


def brute(rows, asks, k):
    good = [
        (i, np.array(v, dtype=np.float64)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, a in good:
        if asks(q):
            near = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in good if i != q)[:k]
            out[q] = near
    return out


def recall(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()]
    wanted = brute(rows, lambda q: q % 100 == 0, 10)
    got = {}
    for r in llm_queries()["op4_permutation_index"](spark, folder).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == wanted.keys()
    hits = 0
    for q, near in wanted.items():
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, len(near) + 1))
        assert [f[1:][::-1] for f in found] == sorted(f[1:][::-1] for f in found)
        vectors = dict(rows)
        for _, v, s in found:
            exact = np.linalg.norm(np.array(vectors[q], np.float64) - np.array(vectors[v], np.float64))
            assert abs(s - exact) < 1e-12
        hits += len({f[1] for f in found} & {i for _, i in near})
    return hits / sum(map(len, wanted.values()))


def test_recall(spark):
    assert recall(spark, "/root/testdata/sf0.01") >= 0.95
    assert recall(spark, "/root/testdata/sf0.1") >= 0.9


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2.0, 3) for i, v in rows],
        "vec_id long, embedding array<float>, lane int, score double, rank int",
    )


def test_unusable_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (100, [1.0, 0.5]), (200, [0.0, 0.0]),
    ]
    found = permutation_index.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert got == brute(rows, lambda q: q % 100 == 0, 10)
    assert [i for _, i in got[0]] == [100, 1, 2]


def test_many_equal_vectors_give_the_smallest_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(3000)]
    found = permutation_index.nearest(vectors(spark, rows), F.col("vec_id") == 1000).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in found) == [(i + 1, i) for i in range(10)]


def test_empty(spark):
    found = permutation_index.nearest(vectors(spark, []), F.col("vec_id") % 100 == 0)
    assert found.count() == 0 and found.columns == ["query_id", "rank", "vec_id", "score"]


def nearest_ids(points, asks, k=10):
    squares = (points * points).sum(axis=1)
    out = {}
    for q in asks:
        gap = squares + squares[q] - 2 * points @ points[q]
        gap[q] = np.inf
        out[q] = set(np.argpartition(gap, k)[:k].tolist())
    return out


def test_recall_over_many_blocks(spark):
    """20,000 vectors without clusters, the hardest kind, in ten blocks at least."""
    points = np.random.default_rng(4).normal(size=(20_000, 64))
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)
    frame = vectors(spark, list(enumerate(points.tolist()))).repartition(4)
    found = permutation_index.nearest(frame, F.col("vec_id") % 200 == 0, block_rows=2_000).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    wanted = nearest_ids(points, range(0, 20_000, 200))
    assert got.keys() == wanted.keys()
    assert sum(len(got[q] & wanted[q]) for q in wanted) / (10 * len(wanted)) >= 0.9


def test_a_search_costs_less_than_a_scan_of_its_block():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(permutation_index.BLOCK_ROWS, 64))
    pivots = permutation_index.choose_pivots(points[:2_048], permutation_index.PIVOTS)
    order = permutation_index.permutations(points, pivots, permutation_index.PREFIX)
    block = permutation_index.IndexBlock(np.arange(len(points)), points, order, len(pivots))

    def scan(q):
        score = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        return np.lexsort((np.arange(len(points)), score))[:11]

    times = []
    for ask in (lambda q: block.search(points[q], order[q], q, 10), scan):
        ask(0)
        started = time.process_time()
        for q in range(60):
            ask(q)
        times.append(time.process_time() - started)
    assert times[0] < times[1]


def test_every_dimension_is_searched_by_itself(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "PIVOT_SAMPLE", 40)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5 if i % 3 else 2).astype(np.float32).tolist()) for i in range(600)]
    rows += [(10_000, [1.0, 2.0, 3.0]), (10_001, [1.0, 2.0, 4.0]), (10_100, [2.0, 2.0, 3.0]), (10_200, [5.0])]
    found = permutation_index.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    size, hits, total = {i: len(v) for i, v in rows}, 0, 0
    for q in (i for i, _ in rows if i % 100 == 0):
        alike = {i: np.array(v) for i, v in rows if size[i] == size[q]}
        near = sorted((i for i in alike if i != q), key=lambda i: (((alike[i] - alike[q]) ** 2).sum(), i))[:10]
        assert len(got.get(q, [])) == len(near) and all(size[i] == size[q] for i in got.get(q, []))
        hits, total = hits + len(set(near) & set(got.get(q, []))), total + len(near)
    assert hits / total >= 0.9 and got[10_000] == [10_001, 10_100] and 10_200 not in got


def test_a_repeated_query_id_asks_with_its_smallest_vector(spark):
    rows = [(0, [9.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [9.0, 1.0])]
    found = permutation_index.nearest(vectors(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [
        (1, 1, 1.0), (2, 2, float(np.sqrt(65.0))),
    ]


def test_the_driver_gets_the_sample_only(spark, monkeypatch):
    """Also where all rows share an id: the tasks' own best rows, as many from each, go to a task."""
    frame = vectors(spark, [(100, [float(i), 1.0]) for i in range(400)]).repartition(8)
    monkeypatch.setattr(permutation_index, "PIVOT_SAMPLE", 20)
    plans, collect = [], type(frame).collect

    def noted(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)

    monkeypatch.setattr(type(frame), "collect", noted)
    permutation_index.nearest(frame, F.col("vec_id") % 100 == 0)
    sampled = [plan for plan in plans if "TakeOrderedAndProject" in plan]
    assert len(sampled) == 1 and "Coalesce 1" in sampled[0].split("TakeOrderedAndProject")[0]
