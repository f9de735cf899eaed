import corpus_pipeline
from corpusloom.llm import gam
from corpusloom.llm.features import TextView
from corpusloom.llm.queries import TOKENIZER
from corpusloom.llm.shared import table
from tests.llm.test_packing import check, library
from tests.llm.test_simhash import slow_components, slow_fingerprint


def test_stages_equal_brute_force(spark, small):
    documents = table(spark, small, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    wanted = [r for r in rows if not any(rule.rejects(TextView(r[1])) for rule in corpus_pipeline.RULES)]
    model = gam.train_quality(documents, table(spark, small, "labels"))
    scores = model.scores(gam.feature_matrix([t for _, t in wanted]))
    wanted = [r for r, s in zip(wanted, scores, strict=True) if s >= 0.5]
    prints = [(i, slow_fingerprint(t)) for i, t in wanted]
    first = slow_components(prints)
    kept = {i for i, fp in prints if first[fp] == i}
    wanted = [r for r in wanted if r[0] in kept]
    pieces = corpus_pipeline.run(spark, small).collect()
    assert {p["doc_id"] for p in pieces} == kept and len(kept) > 100
    check(pieces, wanted, library())


def test_filtering_stages_return_documents(spark, edge_docs, no_docs, small):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (edge_docs, no_docs):
            assert stage(spark, docs, small).columns == docs.columns
            stage(spark, docs, small).collect()
    assert TOKENIZER == corpus_pipeline.TOKENIZER


def test_clean_documents_stay(spark, small):
    """Documents of good quality pass the rules and the classifier."""
    documents = table(spark, small, "documents")
    ruled = corpus_pipeline.quality_stage(spark, documents, small)
    kept = corpus_pipeline.classifier_stage(spark, ruled, small)
    good = table(spark, small, "labels").filter("quality = 1").join(documents, "doc_id")
    assert good.join(kept, "doc_id", "left_anti").count() <= 0.01 * good.count()
