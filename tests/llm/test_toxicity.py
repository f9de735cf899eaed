import re
import zlib

import numpy as np

from corpusloom.llm import toxicity
from corpusloom.llm.queries import llm_queries
from corpusloom.llm.shared import table


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = {r["doc_id"]: r for r in llm_queries()["op6_toxicity_fm"](spark, folder).collect()}
    assert len(scored) == table(spark, folder, "documents").count()
    labels = [
        r for r in table(spark, folder, "labels").collect()
        if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
    ]
    toxic = [scored[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 1]
    clean = [scored[r["doc_id"]]["predicted"] for r in labels if r["toxic"] == 0]
    assert sum(toxic) / len(toxic) >= 0.85
    assert sum(clean) / len(clean) <= 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in scored.values())


def test_pairs_carry_what_single_terms_cannot():
    """Two terms that are harmless alone and count only together."""
    rng = np.random.default_rng(3)
    docs, y = [], []
    for _ in range(1200):
        a, b = rng.random(2) < 0.5
        docs.append(np.array([t for t, on in ((0, a), (1, b)) if on], dtype=np.int64))
        y.append(float(a != b))
    model = toxicity.fit_machine(docs, np.array(y), np.array([10, 20]), steps=600)
    right = [(model.score(d) > 0.5) == (t > 0.5) for d, t in zip(docs, y, strict=True)]
    assert sum(right) / len(right) > 0.99
    assert abs(float(model.latent[0] @ model.latent[1])) > 1.0


def test_score_equals_the_pairwise_sum():
    rng = np.random.default_rng(5)
    model = toxicity.FactorizationMachine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    active = [0, 2, 5]
    margin = 0.3 + sum(model.linear[i] for i in active)
    margin += sum(model.latent[i] @ model.latent[j] for i in active for j in active if i < j)
    assert abs(model.score(np.array(active)) - 1 / (1 + np.exp(-margin))) < 1e-12


def test_edges_and_no_labels(spark, edge_docs, edge_texts, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, toxic int, terms string")
    model = toxicity.train_toxicity(edge_docs, nothing)
    scores = edge_docs.select(toxicity.toxicity_score(edge_docs["text"], model).alias("s")).collect()
    assert len(scores) == len(edge_texts) and {r["s"] for r in scores} == {0.5}
    assert no_docs.select(toxicity.toxicity_score(no_docs["text"], model)).count() == 0
    odd = spark.createDataFrame([(4, 1), (9, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(edge_docs, odd)
    assert all(0 <= r[0] <= 1 for r in edge_docs.select(toxicity.toxicity_score(edge_docs["text"], model)).collect())


def slow_terms(text):
    """The terms of a text by plain counting."""
    mask, met = (1 << toxicity.BUCKET_BITS) - 1, {}
    for word in set(re.findall(r"[^\W_]+", text.lower())):
        for data in ["=" + word] + ["^" + word[:k] for k in (4, 5, 6, 7, 8) if len(word) >= k]:
            bucket = zlib.crc32(data.encode()) & mask
            met[bucket] = met.get(bucket, 0) + 1
    return sorted(4 * b + level for b, n in met.items() for level in (1, 2, 3) if n >= level)


def test_terms_equal_plain_counting():
    for text in ("", "One word", "walker walking walked WALK walks", "a_b 12 é日 wörter wörtern"):
        packed = b"".join(map(toxicity.buckets, toxicity.words(text)))
        assert toxicity.terms(packed).tolist() == slow_terms(text)


def pair_rows(seed=2):
    """Texts in which `lorn` and `vask` are harmless alone, and toxic together."""
    rng, rows = np.random.default_rng(seed), []
    filler = [f"filler{i}" for i in range(400)]
    kinds = [("lorn", 0)] * 300 + [("vask", 0)] * 300 + [("lorn vask", 1)] * 40
    kinds += [("", 0)] * 320 + [("grumt", 1)] * 40
    for at, (said, label) in enumerate(kinds):
        words = [*rng.choice(filler, 30), *said.split()]
        rng.shuffle(words)
        rows.append((at, " ".join(words), label))
    return rows


def test_training_finds_a_pair_that_tells_only_together(spark):
    rows = pair_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    own = {w: 4 * toxicity.word_bucket(w) + 1 for w in ("lorn", "vask", "grumt", "filler7")}
    assert own["lorn"] in model.terms and own["vask"] in model.terms
    assert own["grumt"] in model.terms and own["filler7"] not in model.terms
    asked = ["lorn", "vask", "lorn vask", "nothing here", "grumt"]
    frame = spark.createDataFrame([(t,) for t in asked], "text string")
    scores = {r["text"]: r["s"] for r in frame.select("text", toxicity.toxicity_score(frame["text"], model).alias("s")).collect()}
    assert scores["lorn vask"] > 0.7 and scores["grumt"] > 0.7
    assert max(scores["lorn"], scores["vask"], scores["nothing here"]) < 0.3


def test_pairs_equal_plain_counting(spark, monkeypatch):
    """The words found in blocks of three are those of a loop over all pairs."""
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 3)
    rng, rows = np.random.default_rng(6), []
    for _ in range(240):
        held = {int(w) for w in np.flatnonzero(rng.random(14) < 0.35)}
        toxic = int({2, 5} <= held and rng.random() < 0.9 or {7, 11} <= held and rng.random() < 0.8)
        rows.append((toxic, sorted(held)))
    rows += rows[:50]
    frame = spark.createDataFrame(rows, "label int, words array<int>")
    got = {r["word"] for r in toxicity.pair_words(frame).collect()}
    docs = [(y, set(ws)) for y, ws in {(y, tuple(ws)) for y, ws in rows}]
    share = sum(y for y, _ in docs) / len(docs)

    def chance(words):
        met = [y for y, ws in docs if words <= ws]
        return float(toxicity.excess(np.array(sum(met)), np.array(len(met)), share)), sum(met)

    often = [w for w in range(14) if chance({w})[1] >= toxicity.LEAST_PAIR_DOCS]
    least = np.log(len(often) * (len(often) - 1) // 2 / toxicity.PAIR_CHANCE)
    wanted = set()
    for a in often:
        for b in often:
            together, hits = chance({a, b})
            if a < b and hits >= toxicity.LEAST_PAIR_DOCS and together >= least:
                if together >= 2 * max(chance({a})[0], chance({b})[0]):
                    wanted |= {a, b}
    assert got == wanted and wanted


def test_a_repeated_labelled_document_is_fitted_to_once(spark):
    rows = pair_rows()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    frame = lambda r: spark.createDataFrame([(i, t) for i, t, _ in r], "doc_id long, text string")
    once, again = (toxicity.train_toxicity(frame(r), labels) for r in (rows, rows + rows[:200]))
    assert once.name == again.name
