"""From raw documents to packed sequences: rules, classifier, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as
the next stage's docs. The first three return the columns of documents; the last returns the
pieces of every document that is left.

Defined results: a null text counts as the empty text, which the rules reject for its few words;
texts of any length are judged, compared and packed whole; equal rows and rows that share a
doc_id are judged one by one, and of near duplicates one row stays, the one with the smallest
doc_id, a row without doc_id only where no other of its group has one; an empty table gives an
empty table in every stage; columns beyond those of documents pass through the first three stages
under their own names, also where those clash with names that the operators use, and are not in
the result of the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import gam, packing, quality_rules, simhash
from corpusloom.llm.shared import stored, table
from corpusloom.session import apply_session_conf

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUALITY_THRESHOLD = 0.5

#: The rules of the operator, but short clean texts stay: only texts of hardly a word are too short.
LEAST_WORDS = 5
RULES = (
    quality_rules.Rule("hardly_a_word", lambda view: view.n_words < LEAST_WORDS),
    *(rule for rule in quality_rules.RULES if rule.name != "few_words"),
)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    apply_session_conf(spark)
    return quality_rules.quality_filter(docs, RULES)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier holds good; it learns from the labelled rows of all documents."""
    apply_session_conf(spark)
    model = gam.train_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return gam.classifier_filter(docs, model, QUALITY_THRESHOLD)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest doc_id."""
    apply_session_conf(spark)
    return simhash.near_dedup(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of power-of-two lengths, each a sequence."""
    apply_session_conf(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_stage),
    ("quality classifier", classifier_stage),
    ("near duplicates", dedup_stage),
    ("packing", packing_stage),
]

# Fingerprints by XXH64 and a fitted classifier are beyond SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    apply_session_conf(spark)
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
