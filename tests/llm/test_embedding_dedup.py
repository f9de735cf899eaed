import numpy as np
import pytest

from checks.compare import compare
from corpusloom.llm import embedding_dedup as dedup
from corpusloom.llm.queries import llm_oracles, llm_queries


def slow(rows, threshold=0.95):
    """rows of (vec_id, vector) to (vec_id, n_links, component_id, kept), by all pairs."""
    fine = lambda v: v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    at = [i for i, (_, v) in enumerate(rows) if fine(v)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in at}
    near = lambda i, j: len(unit[i]) == len(unit[j]) and (rows[i][1] == rows[j][1] or unit[i] @ unit[j] >= threshold)
    links = {i: [j for j in at if j != i and near(i, j)] if i in unit else [] for i in range(len(rows))}
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, waiting = {i}, [i]
        while waiting:
            for j in links[waiting.pop()]:
                if j not in seen:
                    seen.add(j)
                    waiting.append(j)
        first = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, len(links[i]), first, vec_id is not None and vec_id == first))
    return sorted(out, key=str)


def run(spark, rows, kind="float", **options):
    frame = spark.createDataFrame(
        [(i, v, 3, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, key string"
    )
    return sorted(map(tuple, dedup.near_embeddings(frame, **options).collect()), key=str)


def clustered(n, dim, spread, seed, kind=np.float32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 9), dim))
    vectors = centres[rng.integers(len(centres), size=n)] + spread * rng.normal(size=(n, dim))
    return [(i, v) for i, v in enumerate((vectors * rng.uniform(0.01, 50, (n, 1))).astype(kind).tolist())]


@pytest.mark.parametrize("tile_rows", [dedup.TILE_ROWS, 40, 7])
def test_equals_all_pairs(spark, tile_rows):
    # Around the threshold, and copies of a third of the rows in one group.
    rows = clustered(300, 24, 0.23, 3)
    rows += [(1_000 + i, rows[0][1]) for i in range(150)]
    assert run(spark, rows, tile_rows=tile_rows) == slow(rows)


def test_doubles_and_other_dimensions(spark):
    rows = clustered(90, 3, 0.1, 5, np.float64)
    rows += [(500 + i, v) for i, v in clustered(60, 1, 0.1, 6, np.float64)]
    rows += [(700, [1e300, 1e300]), (701, [1e-300, 1e-300]), (702, [1e300, -1e300]), (703, [5e-324, 0.0])]
    assert run(spark, rows, "double", tile_rows=16) == slow([
        (i, (np.array(v) / np.abs(v).max()).tolist()) for i, v in rows
    ])


def test_defined_results(spark):
    rows = [(5, None), (4, []), (3, [0.0, 0.0]), (2, [1.0, None]), (1, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [0.0, 1.0]), (None, [1.0, 0.0]), (None, None), (9, [2.0, 0.01])]
    assert run(spark, rows) == slow(rows)
    assert run(spark, []) == []


def test_bound_holds_for_every_pair():
    rng = np.random.default_rng(11)
    for dim in (1, 2, 64, 3_000):
        vectors = rng.normal(size=(120, dim)) * rng.exponential(size=(120, dim)) ** 3
        unit, codes, scale, error = dedup.quantised(vectors)
        product = (codes.astype(int) @ codes.astype(int).T) * scale[:, None] * scale
        bound = error[:, None] + error + error[:, None] * error
        assert (np.abs(unit @ unit.T - product) <= bound + 1e-12).all()
        single = dedup._products(codes.astype(np.float32), codes.astype(np.float32))
        assert np.abs(single * scale[:, None] * scale - product).max() < dedup.SLACK / 10


@pytest.mark.parametrize("threshold", [0.3, 0.95])
def test_dense_and_sparse_strips_agree(threshold):
    vectors = np.array([v for _, v in clustered(700, 16, 0.3, 8)])
    unit, codes, scale, error = dedup.quantised(vectors)
    tile = dedup.Tile(np.zeros(700, "V16"), np.ones(700, int), unit, codes.astype(np.float32), scale, error)
    pairs = [p for i, j in dedup.linked_pairs(tile, tile, threshold, True) for p in zip(i, j, strict=True)]
    wanted = np.argwhere(np.triu(unit @ unit.T >= threshold, 1))
    assert sorted(pairs) == sorted(map(tuple, wanted))


def test_lowest_linked():
    left, right = np.array([3, 5, 1, 8, 9]), np.array([5, 1, 7, 9, 4])
    assert dedup.lowest_linked(10, left, right).tolist() == [0, 1, 2, 1, 4, 1, 6, 1, 4, 4]
    chain = np.arange(999)
    assert not dedup.lowest_linked(1_000, chain + 1, chain).any()


def test_query_equals_sql(spark, small):
    name = "op13_embedding_dedup"
    ok, note = compare(spark, small, llm_queries()[name], llm_oracles()[name])
    assert ok, note
