import hashlib
import zlib

import pytest

from checks.compare import compare
from corpusloom.llm import merkle
from corpusloom.llm.queries import llm_oracles, llm_queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row
    fields = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def slow_tree(nodes, k):
    """Root, and per leaf the list of (siblings on the left, on the right) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + k] for i in range(0, len(nodes), k)]
        for leaf, place in enumerate(at):
            run, slot = runs[place // k], place % k
            paths[leaf].append((run[:slot], run[slot + 1 :]))
        nodes, at = [H(*run) for run in runs], [place // k for place in at]
    return nodes[0], paths


def slow_manifest(rows, k=2):
    """rows of (doc_id, source, lang, n_chars, text)."""
    parts = {}
    for row in rows:
        parts.setdefault("" if row[2] is None else "=" + row[2], []).append(row)
    names = sorted(parts, key=str.encode)
    trees = {}
    for name in names:
        first = lambda r: (r[0] is not None, r[0] or 0, slow_leaf(r))
        parts[name].sort(key=first)
        trees[name] = slow_tree([slow_leaf(r) for r in parts[name]], k)
    root, tops = slow_tree([trees[name][0] for name in names], k)
    out = []
    for name, top in zip(names, tops, strict=True):
        for row, path in zip(parts[name], trees[name][1], strict=True):
            whole = path + top
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = slow_leaf(row, 1) if tampered else slow_leaf(row)
            for left, right in whole:
                folded = H(*left, folded, *right)
            proof = H(*[s for left, right in whole for s in left + right])
            out.append((row[0], slow_leaf(row), trees[name][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def make(spark, rows):
    schema = "doc_id long, source string, lang string, n_chars long, text string, part long, place string, level int"
    return spark.createDataFrame([(*r, 1, "x", 9) for r in rows], schema)


def rows_of(n, langs=("en", "fr", None, "é", "")):
    return [(i * 3 % n, f"s{i % 4}" if i % 5 else None, langs[i * i % len(langs)], i if i % 6 else None,
             None if i % 11 == 0 else "text é " * (i % 3)) for i in range(n)]


@pytest.mark.parametrize(("fanout", "subtree"), [(2, 1_024), (2, 4), (3, 9), (5, 2)])
def test_manifest_equals_brute_force(spark, fanout, subtree):
    rows = rows_of(83) + [(1 << 60, "s", "en", (1 << 63) - 1, "big"), (14, "s", "alone", 1, "x" * 50_000)]
    rows += [(5, "s", "en", 1, "again"), (5, "s", "en", 1, "again"), (None, "s", "en", 1, "no id")]
    got = merkle.merkle_manifest(make(spark, rows), fanout, subtree)
    assert sorted(map(tuple, got.collect()), key=str) == slow_manifest(rows, fanout)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows(spark, n):
    rows = [(7 * i, None, "en", 4, "text") for i in range(n)]
    got = sorted(map(tuple, merkle.merkle_manifest(make(spark, rows)).collect()), key=str)
    assert got == slow_manifest(rows)
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == H("")


def test_empty_table(spark):
    got = merkle.merkle_manifest(make(spark, []))
    assert got.count() == 0 and got.columns[0] == "doc_id"


def test_tampering_is_found_exactly(spark, small):
    rows = llm_queries()["op12_merkle_manifest"](spark, small).collect()
    caught = {r["doc_id"] for r in rows if not r["verified"]}
    assert caught == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0}


def test_query_equals_sql(spark, small):
    name = "op12_merkle_manifest"
    ok, note = compare(spark, small, llm_queries()[name], llm_oracles()[name])
    assert ok, note
