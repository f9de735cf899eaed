import re
from itertools import permutations

from checks.compare import compare
from corpusloom.llm import quality_rules
from corpusloom.llm.features import TextView
from corpusloom.llm.queries import llm_oracles, llm_queries


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(covered),
    )


def test_equals_sql(spark, small):
    name = "op1_quality_rules"
    ok, note = compare(spark, small, llm_queries()[name], llm_oracles()[name])
    assert ok, note


def test_edges(edge_docs, edge_texts):
    rows = quality_rules.quality_report(edge_docs).collect()
    assert len(rows) == len(edge_texts)
    got = sorted((r["doc_id"] or 0, *r[1:6]) for r in rows)
    assert got == sorted((i or 0, *by_hand(t)) for i, t in edge_texts)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["base_failed"] and not by_id[1]["kept"]
    assert by_id[9]["base_failed"]


def test_empty_table(no_docs):
    assert quality_rules.quality_report(no_docs).count() == 0
    assert quality_rules.quality_filter(no_docs).columns == no_docs.columns


def test_order_never_changes_a_verdict():
    texts = ["a b c", "WORDS " * 60, "x## " * 60, " ".join(f"word{i}" for i in range(80)), "a\n" * 9]
    rules = quality_rules.RULES[:4]
    for text in texts:
        verdicts = {
            quality_rules.first_broken(TextView(text), order) is None for order in permutations(rules)
        }
        assert len(verdicts) == 1


def test_order_follows_worth(make_docs):
    docs = make_docs([(i, "SHOUTED WORDS " * 40) for i in range(20)])
    estimates = quality_rules.estimate_rules(docs)
    ordered = quality_rules.order_rules(estimates)
    worth = {e.rule.name: e.worth for e in estimates}
    assert [worth[r.name] for r in ordered] == sorted(worth.values(), reverse=True)
    assert worth["few_words"] > 0 or worth["shouting"] > 0


def test_filter_keeps_columns_and_good_rows(make_docs):
    good = " ".join(f"word{i} of, prose" for i in range(40))
    docs = make_docs([(1, good), (1, good), (2, "short"), (3, None)])
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1, 1]


def test_clean_labels_survive(spark, small):
    """No document of good quality is lost to the rules beyond the base."""
    from corpusloom.llm.shared import table

    report = quality_rules.quality_report(table(spark, small, "documents"))
    labels = table(spark, small, "labels").filter("quality = 1")
    lost = report.filter("NOT base_failed AND NOT kept").join(labels, "doc_id")
    assert lost.count() == 0
