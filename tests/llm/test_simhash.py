import random
import re

import xxhash

from corpusloom.llm import components, simhash
from corpusloom.llm.queries import llm_queries
from corpusloom.llm.shared import table


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """rows of (doc_id, fingerprint) to the smallest id of each fingerprint's component."""
    prints = sorted({fp for _, fp in rows})
    root = {fp: fp for fp in prints}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                root[top(a)] = top(b)
    first = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            first[top(fp)] = min(doc_id, first.get(top(fp), doc_id))
    return {fp: first.get(top(fp)) for fp in prints}


def unsigned(x):
    return x % (1 << 64)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(edge_texts):
    for _, text in edge_texts:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(long) == slow_fingerprint(long)


def check_links(spark, values, group_rows):
    prints = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "doc_id long, fp long")
    links = simhash.near_links(prints, group_rows)
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    got, wanted = {}, slow_components(list(enumerate(values)))
    for v in values:
        got.setdefault(found.get(signed(v), signed(v)), set()).add(v)
    by_root = {}
    for v in values:
        by_root.setdefault(wanted[v], set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, by_root.values()))


def test_links_equal_brute_force(spark):
    rng = random.Random(7)
    values = set()
    for _ in range(60):
        seed = rng.getrandbits(64)
        values.add(seed)
        for _ in range(12):
            values.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    # One crowded corner, whose members agree in their high bits.
    values |= {0xABCDEF << 40 | rng.getrandbits(12) << 3 for _ in range(300)}
    for group_rows in (4_096, 3):
        check_links(spark, sorted(values), group_rows)


def test_every_three_bit_pattern_is_found():
    """A key is shared, and its chain viable, for all ways to differ in up to three bits."""
    import numpy as np

    rng = random.Random(9)
    for _ in range(2_000):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 3)))
        pair = np.array([a, b], dtype=np.uint64)
        shared = [number for number, key in simhash.ring_keys(pair, 16) if key[0] == key[1]]
        assert any(len(simhash._within(pair[:1], pair[1:], n // 5)) for n in shared)
        for number, key in simhash.ring_keys(pair, 16):
            if key[0] == key[1]:
                rest = simhash._open_bits(pair, np.array([number, number]))
                assert any(k[0] == k[1] for _, k in simhash.ring_keys(rest, 8))


def test_edges(edge_docs, edge_texts, no_docs):
    rows = [tuple(r) for r in simhash.near_duplicates(edge_docs).collect()]
    wanted = [(i, slow_fingerprint(t)) for i, t in edge_texts]
    first = slow_components(wanted)
    key = lambda r: (r[0] or 0, r[1], r[2] or 0)
    assert sorted(((i, unsigned(fp), c) for i, fp, c in rows), key=key) == sorted(
        ((i, fp, first[fp]) for i, fp in wanted), key=key
    )
    kept = simhash.near_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 4, 5, 6, 8, 9, 10]
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.near_dedup(no_docs).count() == 0


def test_rows_without_any_id(make_docs):
    docs = make_docs([(None, "one text of words"), (None, "one text of words"), (None, "another one here now")])
    assert simhash.near_dedup(docs).count() == 2


def test_rows_that_share_an_id_stay_for_their_components(make_docs):
    one, two, far = ("first text about rivers and hills", "other words on machines and steel", "a third one of ships")
    docs = make_docs([(7, one), (7, two), (7, two), (8, one), (9, far), (6, far)])
    kept = [(r["doc_id"], r["text"]) for r in simhash.near_dedup(docs).collect()]
    assert sorted(kept) == sorted([(7, one), (7, two), (6, far)])


def test_texts_meet_once_and_are_fingerprinted_once(spark, small):
    """Unique ids: the plan over texts has no Python, and one exchange of them at most."""
    docs = table(spark, small, "documents")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, most in (("10m", 0), ("-1", 1)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            plan = simhash.near_dedup(docs)._jdf.queryExecution().sparkPlan().toString()
            executed = simhash.near_dedup(docs)._jdf.queryExecution().executedPlan().toString()
            assert "ArrowEvalPython" not in plan
            # With the threshold off, both sides of the one join are dealt out by hash.
            assert executed.count("Exchange hashpartitioning") == 2 * most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_whole_table(spark, small):
    docs = [(r[0], slow_fingerprint(r[1])) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    first = slow_components(docs)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in llm_queries()["op9_simhash"](spark, small).collect()}
    assert got == {i: (f"{fp:016x}", first[fp]) for i, fp in docs}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 905), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, 905: 900}
    assert components.components(links.limit(0)).count() == 0
