"""Quality rules as a short-circuit cascade.

Every rule's cost and selectivity are estimated on a sample of texts; the rules then run in
order of rejections per second, and a text leaves the cascade at the first rule it breaks.
The order changes how long a verdict takes, never the verdict.

Defined results: a null text counts as empty and breaks `few_words`; texts of any length are
judged whole; repeated rows are judged one by one; an empty table gives an empty result;
other columns of the input pass through unread, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.features import TextView


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextView], bool]
    base: bool = False


RULES = (
    Rule("few_words", lambda v: v.n_words < 50, base=True),
    Rule("repeats", lambda v: 100 * v.n_repeat_words > 50 * v.n_words, base=True),
    Rule("symbols", lambda v: 10 * v.n_symbols > 3 * v.n_words),
    Rule("shouting", lambda v: 2 * v.n_upper > v.n_letters),
    Rule("few_letters", lambda v: 2 * v.n_letters < v.word_chars),
    Rule("word_length", lambda v: not 2 * v.n_words <= v.word_chars <= 15 * v.n_words),
    Rule("dup_lines", lambda v: 2 * v.n_dup_lines > len(v.lines)),
)

#: Texts in the sample, and the length above which a text is left out of the sample only.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Estimate:
    """What one rule did on the sample: seconds and rejections per text."""

    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def estimate_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> list[Estimate]:
    """Time every rule alone on the sample; a rule pays for the measures it asks for.

    The sample is a few short rows taken from the first partitions. It only orders the
    rules, so that its bias costs time at most.
    """
    rows = (
        docs.select(F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.length("text") <= SAMPLE_CHARS)
        .limit(sample_rows)
        .collect()
    )
    out = []
    for rule in rules:
        started = time.process_time()
        hits = sum(rule.rejects(TextView(row["text"])) for row in rows)
        spent = time.process_time() - started
        n = max(len(rows), 1)
        out.append(Estimate(rule, spent / n, hits / n))
    return out


def order_rules(estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejections per second, highest first; ties keep the given order."""
    return [e.rule for e in sorted(estimates, key=lambda e: -e.worth)]


def first_broken(view: TextView, rules: Sequence[Rule]) -> str | None:
    """The first rule of the order that rejects the text; later rules are not evaluated."""
    return next((rule.name for rule in rules if rule.rejects(view)), None)


def kept_by_rules(text: Column, rules: Sequence[Rule]) -> Column:
    """True for texts that pass every rule, in the given order."""
    rules = tuple(rules)

    @F.arrow_udf("boolean")
    def judge(texts: pa.Array) -> pa.Array:
        views = map(TextView, texts.to_pylist())
        return pa.array([first_broken(v, rules) is None for v in views], pa.bool_())

    return judge(text)


def quality_filter(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows whose text passes the cascade, with all their columns."""
    ordered = order_rules(estimate_rules(docs, rules))
    return docs.filter(kept_by_rules(F.col("text"), ordered))


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measures and verdict of every row: doc_id, measures, base_failed, kept.

    Measures are wanted of all rows here, so the cascade only saves what the rules beyond
    the base ask for in addition.
    """
    ordered = order_rules(estimate_rules(docs, rules))
    base = tuple(rule for rule in ordered if rule.base)
    rest = tuple(rule for rule in ordered if not rule.base)

    @F.arrow_udf(f"struct<{MEASURES.replace(' ', ':').replace(',:', ',')},base_failed:boolean,kept:boolean>")
    def judge(texts: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in range(7)]
        for view in map(TextView, texts.to_pylist()):
            failed = first_broken(view, base) is not None
            kept = not failed and first_broken(view, rest) is None
            row = (
                view.n_words, view.word_chars, view.n_symbols, view.n_dup_lines,
                view.n_repeat_words, failed, kept,
            )
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
        arrays += [pa.array(c, pa.bool_()) for c in columns[5:]]
        return pa.StructArray.from_arrays(arrays, [*names, "base_failed", "kept"])

    return docs.select("doc_id", judge("text").alias("judged")).select("doc_id", "judged.*")
