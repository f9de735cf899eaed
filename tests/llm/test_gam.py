import zlib

import numpy as np

from corpusloom.llm import gam
from corpusloom.llm.queries import llm_queries
from corpusloom.llm.shared import table


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark, small):
    scored = {r["doc_id"]: r for r in llm_queries()["op5_quality_gam"](spark, small).collect()}
    assert len(scored) == table(spark, small, "documents").count()
    labels = [r for r in table(spark, small, "labels").collect() if held_out(r["doc_id"])]
    right = [scored[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert sum(right) / len(right) >= 0.97
    for doc_id, row in scored.items():
        assert row["held_out"] == held_out(doc_id)
        assert 0.0 <= row["score"] <= 1.0 and row["predicted"] == int(row["score"] >= 0.5)


def test_held_out_labels_are_not_learned_from(spark, small):
    documents, labels = table(spark, small, "documents"), table(spark, small, "labels")
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(cast(doc_id AS string)) % 3 = 1, 1 - quality, quality) AS quality"
    )
    first, second = gam.train_quality(documents, labels), gam.train_quality(documents, flipped)
    x = gam.feature_matrix(["some text of words.", "", "### $$$"])
    assert (first.scores(x) == second.scores(x)).all()


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone = gam.fit_gam(x, y, n_pairs=0)
    paired = gam.fit_gam(x, y, n_pairs=2, pair_rounds=40)
    right = lambda m: ((m.scores(x) > 0.5) == (y > 0.5)).mean()
    assert right(alone) < 0.65 and right(paired) > 0.9


def test_shallow_tree_finds_the_step():
    gradient, weight = np.array([1.0, 1, 1, -5, -5, 1]), np.ones(6)
    tree = gam.shallow_tree(gradient, weight, leaves=3, ridge=0.0)
    assert np.allclose(tree, gradient)


def test_edges_and_no_labels(spark, edge_docs, edge_texts, no_docs):
    nothing = spark.createDataFrame([], "doc_id long, quality int, label string")
    model = gam.train_quality(edge_docs, nothing)
    scores = edge_docs.select("doc_id", gam.quality_score(edge_docs["text"], model).alias("s")).collect()
    assert len(scores) == len(edge_texts) and {r["s"] for r in scores} == {0.5}
    odd = spark.createDataFrame(
        [(4, 1), (4, 0), (9, 0), (None, 1), (5, None), (404, 1)], "doc_id long, quality int"
    )
    model = gam.train_quality(edge_docs, odd)
    scores = [r[0] for r in edge_docs.select(gam.quality_score(edge_docs["text"], model)).collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert no_docs.select(gam.quality_score(no_docs["text"], model)).count() == 0
    kept = gam.classifier_filter(edge_docs, model, 0.0)
    assert kept.columns == edge_docs.columns and kept.count() == len(edge_texts)


def test_score_equals_a_plain_sum_of_looked_up_tables():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 4)).round(2)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = gam.fit_gam(x, y)
    for row, score in zip(x, model.scores(x), strict=True):
        place = lambda cuts, value: sum(1 for c in cuts if c <= value)
        total = model.intercept
        for cuts, table, value in zip(model.cuts, model.tables, row, strict=True):
            total += table[place(cuts, value)]
        for a, b, table in model.pairs:
            total += table[place(model.coarse[a], row[a])][place(model.coarse[b], row[b])]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-9


def test_a_repeated_labelled_document_is_fitted_to_once(spark):
    docs = [(i, f"text number {i} of some words, " * (i % 9 + 1)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    x = gam.feature_matrix([t for _, t in docs])
    once = gam.train_quality(frame(docs), labels).scores(x)
    assert (gam.train_quality(frame(docs + docs[:30] * 3), labels).scores(x) == once).all()
