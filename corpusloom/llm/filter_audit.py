"""How filters overlap: what each removes first, late, alone, in every order they can run in.

A document is reduced to the set of filters it fails, and documents of one part, set and label to
a weight. Per part, the sets stand as a matrix of masks (0 where a filter fails, out of reach
elsewhere) and the orders as the inverse permutations (place of each filter). Their min-plus
product is the step at which a set of failures is removed in an order; weights are scattered
over these steps, and a failure at a later place than the removal is redundant.

Texts are read once and never shuffled: equal texts meet by their SHA-256. Rows of one text are
counted per part, mask and label before they meet, so a text of any number of copies is a few
rows. A part is at most 2^filters masks times four labels.

Defined results: a null text is the empty text (which fails A, and B to D never); a row without
doc_id counts, has no labels, and neither fails E nor makes others fail it; rows of one doc_id
and text do not make each other fail E; of several label rows of a document any that says 1
counts; null and empty lang are one part, the empty string; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
_COPY = 1 << FILTERS.index("E")

# The bounds of the filters, and the characters that D looks for.
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: In UTF-8 every code point has one byte outside of these.
_CONTINUED = bytes(range(0x80, 0xC0))


def failures_of(text: bytes) -> int:
    """The filters A to D that a text in UTF-8 fails, one bit each."""
    words = text.split()
    n = len(words)
    points = len(text.translate(None, _CONTINUED))
    upper = len(text) - len(text.translate(None, _UPPER))
    return (
        (n < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * n) << 1
        | (100 * upper > MOST_UPPER_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def text_failures(text: Column) -> Column:
    """A struct of the mask of failures A to D and the SHA-256 of the text."""

    @F.arrow_udf("mask int, digest binary")
    def of(texts: pa.Array) -> pa.Array:
        held = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        masks = pa.array([failures_of(t) for t in held], pa.int32())
        digests = pa.array([hashlib.sha256(t).digest() for t in held], pa.binary())
        return pa.StructArray.from_arrays([masks, digests], ["mask", "digest"])

    return of(text)


def failure_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents (n) per part, mask of failures, good and toxic label."""
    slim = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        text_failures(F.col("text")).alias("found"),
    ).select("doc_id", "part", "found.mask", "found.digest")
    says = lambda c: F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False))
    flags = (
        labels.filter("quality = 1 OR toxic = 1")
        .groupBy("doc_id")
        .agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    )
    kind = ["part", "mask", "good", "toxic"]
    # The join leaves rows by doc_id, so the count after it needs no shuffle of its own.
    rows = (
        slim.join(flags, "doc_id", "left")
        .na.fill(False, ["good", "toxic"])
        .groupBy("doc_id", "digest", *kind)
        .agg(F.count("*").alias("n"))
    )
    texts = rows.groupBy("digest", *kind).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min("doc_id").alias("low"),
        F.min_by("n", "doc_id").alias("low_n"),
    )
    # One row per kind of a text: as many as parts and labels, whatever its copies.
    first = F.min("low").over(Window.partitionBy("digest"))
    copies = F.col("n") - F.col("nameless") - F.when(F.col("low") == first, F.col("low_n")).otherwise(0)
    split = texts.withColumn("copies", F.coalesce(copies, F.lit(0))).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
                F.struct(F.col("mask").bitwiseOR(F.lit(_COPY)).alias("mask"), F.col("copies").alias("n")),
            )
        ).alias("of"),
    )
    return split.groupBy("part", "of.mask", "good", "toxic").agg(F.sum("of.n").alias("n"))


def removal_steps(masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: per set of failures and order the step of removal, beyond the last if none."""
    n = places.shape[1]
    reach = np.where((masks[:, None] >> np.arange(n)) & 1, 0, n + 1)
    return np.minimum((reach[:, None, :] + places[None]).min(axis=2), n + 1)


_SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def audit_part(weights: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, from its weights per mask and label."""
    n = len(FILTERS)
    orders = np.array(list(permutations(range(n))))
    places = np.argsort(orders, axis=1) + 1
    masks = weights["mask"].to_numpy(np.int64)
    count = weights["n"].to_numpy(np.int64)
    steps = removal_steps(masks, places)
    fails = ((masks[:, None] >> np.arange(n)) & 1).astype(bool)
    at = np.broadcast_to(np.arange(len(orders)), steps.shape)

    def scattered(weight: np.ndarray) -> np.ndarray:
        total = np.zeros((len(orders), n + 2), dtype=np.int64)
        np.add.at(total, (at, steps), np.broadcast_to(weight[:, None], steps.shape))
        return total[:, 1 : n + 1]

    removed = scattered(count)
    late = fails[:, None, :] & (places[None] > steps[:, :, None])
    redundant = np.einsum("c,cof->of", count, late.astype(np.int64))
    alone = count @ (fails & (fails.sum(axis=1) == 1)[:, None])
    shapley = np.take_along_axis(removed, places - 1, axis=1).sum(axis=0)
    by_step = {
        "kept": count.sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": np.take_along_axis(redundant, orders, axis=1),
        "unique_fails": alone[orders],
        "good_lost": scattered(count * weights["good"].to_numpy(bool)),
        "toxic_lost": scattered(count * weights["toxic"].to_numpy(bool)),
        "shapley": shapley[orders],
    }
    return pd.DataFrame(
        {
            "part": weights["part"].iloc[0],
            "filter_order": np.repeat(["".join(FILTERS[f] for f in order) for order in orders], n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            **{name: values.reshape(-1) for name, values in by_step.items()},
        }
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    weights = failure_weights(docs, labels)
    # A part is bounded: the masks of its weights times the labels.
    return weights.groupBy("part").applyInPandas(audit_part, _SCHEMA)
