import itertools
import re
from collections import Counter

import pytest

from checks.compare import compare
from corpusloom.llm import filter_audit
from corpusloom.llm.queries import llm_oracles, llm_queries


def slow_failures(rows):
    """Per row of (doc_id, text, lang) the letters of the filters it fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None
            and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
        }
        out.append({name for name, failed in fails.items() if failed})
    return out


def slow_audit(rows, good, toxic):
    """The audit by running every order over every document."""
    fails = slow_failures(rows)
    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        docs = [(r[0], f) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = list(docs)
            for step, letter in enumerate(order, 1):
                gone = [d for d in alive if letter in d[1]]
                alive = [d for d in alive if letter not in d[1]]
                shapley[letter] += len(gone)
                failing = sum(letter in f for _, f in docs)
                out[part, order, step] = [
                    len(alive),
                    len(gone),
                    failing - len(gone),
                    sum(f == {letter} for _, f in docs),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def as_dict(frame):
    return {(r[0], r[1], r[2]): list(r[3:]) for r in frame.collect()}


def run(spark, rows, labels):
    docs = spark.createDataFrame(
        [(i, t, lang, 7, "x") for i, t, lang in rows],
        "doc_id long, text string, lang string, part long, mask string",
    )
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return as_dict(filter_audit.filter_audit(docs, marked))


LONG = " ".join(f"word{i}" for i in range(120))


def test_audit_equals_every_order_run(spark):
    texts = [None, "", "few words", LONG, LONG, LONG + " #", "A B " * 80, "same " * 200, LONG.upper(), "é" * 9]
    rows = [(i, texts[i % len(texts)], (None, "", "en", "fr", "l'ét|")[i % 5]) for i in range(60)]
    rows += [(3, LONG, "en"), (3, LONG, "en"), (None, LONG, "en"), (None, LONG, "en"), (None, None, None)]
    rows += [(-4, LONG, "only one")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)]
    labels += [(8, 1, 0), (8, 0, 1), (None, 1, 1), (5, None, 1), (7, None, None), (999, 1, 1)]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    assert run(spark, rows, labels) == slow_audit(rows, good, toxic)


def test_one_text_held_by_a_third_of_all_rows(spark):
    rows = [(i, LONG if i % 3 else f"{LONG} {i}", "en" if i % 2 else "de") for i in range(3_000)]
    got = run(spark, rows, [])
    removed = {part: got[part, "EABCD", 1][1] for part in ("en", "de")}
    assert removed == {"en": 999, "de": 1_000} and got["en", "ABCDE", 5][0] == 501


def test_long_text_and_empty_table(spark, no_docs):
    assert filter_audit.failures_of(b"") == 1
    assert filter_audit.failures_of(b"w " * 500_000) == 2
    assert filter_audit.failures_of("Ä".encode() * 2 + b"A" * 1) == 1 | 4
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(no_docs, labels).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, folder):
    name = "op11_filter_audit"
    ok, note = compare(spark, folder, llm_queries()[name], llm_oracles()[name])
    assert ok, note
