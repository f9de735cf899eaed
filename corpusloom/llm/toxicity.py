"""Toxicity scores by a factorization machine over hashed terms.

Terms are a text's distinct lower-cased words and their beginnings of four to eight letters,
hashed into buckets. A beginning counts by how many distinct words share it: one, two, or three
and more are three terms. Presence counts, not frequency, so that a few words weigh alike in
long and short texts. Every term has a linear weight and a latent vector, whose products add
weight to pairs of terms that no single weight has.

Terms are screened first: those whose presence goes with the label, by a chi-squared statistic
over the sample, take part; the statistic is summed by Spark over the sample's terms. Words that
tell nothing alone take part where two of them together do: all pairs of words are counted, by
products of blocks of word-by-document matrices, and a pair counts where its documents are
labelled more often than chance would give among all pairs that were looked at, and than either
word's own are. The number of terms has no bound but that of the sample.

Fitting takes a bounded sample (`FIT_ROWS`), scoring covers every row and whole texts. Defined
results: a null, empty or wordless text has no terms and gets the score of the intercept; without
labelled rows that is 0.5; repeated rows get equal scores; an empty table gives an empty result;
only doc_id, text and the label are read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.chunks import Memory
from corpusloom.llm.shared import labelled_sample, stored, visiting, worker_store

#: Labelled documents that a model is fitted to, at most.
FIT_ROWS = 12_000
BUCKET_BITS = 22
PREFIXES = (4, 5, 6, 7, 8)
#: A term takes part from this chi-squared statistic and so many documents on.
LEAST_CHI2 = 20.0
LEAST_DOCS = 3
#: Labelled documents that a pair of words must share; how rarely chance may give one of all pairs.
LEAST_PAIR_DOCS = 8
PAIR_CHANCE = 0.01
#: Words of a block; two blocks meet in a task.
BLOCK_WORDS = 1_024

_WORDS = re.compile(r"[^\W_]+").findall


def words(text: str | None) -> set[str]:
    return set(_WORDS(text.lower())) if text else set()


def _hashed(word: str) -> list[int]:
    """The hashed buckets of one word, itself and its beginnings."""
    mask, n = (1 << BUCKET_BITS) - 1, len(word)
    data = [b"=" + word.encode()]
    data += [b"^" + word[:k].encode() for k in PREFIXES if n >= k]
    return [crc32(x) & mask for x in data]


def buckets(word: str) -> bytes:
    """The hashed buckets of one word as packed numbers."""
    return array("i", _hashed(word)).tobytes()


def word_bucket(word: str) -> int:
    """The bucket of the word itself, without its beginnings."""
    return _hashed(word)[0]


def terms(packed: bytes) -> np.ndarray:
    """The terms of a text from the buckets of its words: a bucket and how often it is met."""
    bucket, n = np.unique(np.frombuffer(packed, "<i4"), return_counts=True)
    levels = [4 * bucket[n >= level].astype(np.int64) + level for level in (1, 2, 3)]
    return np.sort(np.concatenate(levels))


@dataclass(frozen=True)
class FactorizationMachine:
    """Weights of the chosen terms (ascending), and one latent vector for each."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    latent: np.ndarray

    @property
    def name(self) -> str:
        parts = (self.terms, self.linear, self.latent)
        return hashlib.sha256(b"".join(x.tobytes() for x in parts)).hexdigest()

    def active(self, packed: bytes) -> np.ndarray:
        """The places of a text's terms among the chosen ones."""
        found = terms(packed)
        return np.flatnonzero(np.isin(self.terms, found, assume_unique=True))

    def margin(self, active: np.ndarray) -> float:
        rows = self.latent[active]
        total = rows.sum(axis=0)
        pairs = 0.5 * (total @ total - (rows * rows).sum())
        return float(self.bias + self.linear[active].sum() + pairs)

    def score(self, active: np.ndarray) -> float:
        """The probability of the label for a set of active terms."""
        return float(1.0 / (1.0 + np.exp(-np.clip(self.margin(active), -30, 30))))


def fit_machine(
    docs: list[np.ndarray],
    y: np.ndarray,
    chosen: np.ndarray,
    factors: int = 4,
    steps: int = 120,
    rate: float = 0.1,
    ridge: float = 2e-5,
) -> FactorizationMachine:
    """Fit by full-batch Adam on the log loss; docs hold the active terms of each document."""
    n_terms = len(chosen)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    bias = float(np.log(share / (1 - share)))
    latent = np.random.default_rng(0).normal(0, 0.05, (n_terms, factors))
    linear = np.zeros(n_terms)
    if not len(y) or not n_terms or y.min() == y.max():
        return FactorizationMachine(chosen, bias, linear, latent * 0)
    term = np.concatenate(docs).astype(np.int64)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])

    def by_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, values, len(docs))

    def by_term(values: np.ndarray) -> np.ndarray:
        return np.bincount(term, values, n_terms)

    moments = [np.zeros(1), np.zeros(1), linear * 0, linear * 0, latent * 0, latent * 0]
    for step in range(1, steps + 1):
        entries = latent[term]
        sums = np.stack([by_row(entries[:, k]) for k in range(factors)], axis=1)
        squares = by_row((entries * entries).sum(axis=1))
        margin = bias + by_row(linear[term]) + 0.5 * ((sums * sums).sum(axis=1) - squares)
        slope = (1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
        pull = slope[row]
        gradients = [
            np.array([slope.sum()]),
            by_term(pull) + ridge * linear,
            np.stack(
                [by_term(pull * (sums[row, k] - entries[:, k])) for k in range(factors)], axis=1
            ) + ridge * latent,
        ]
        moved = []
        for i, g in enumerate(gradients):
            moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * g
            moments[2 * i + 1] = 0.999 * moments[2 * i + 1] + 0.001 * g * g
            mean, spread = moments[2 * i] / (1 - 0.9**step), moments[2 * i + 1] / (1 - 0.999**step)
            moved.append(rate * mean / (np.sqrt(spread) + 1e-8))
        bias -= float(moved[0][0])
        linear, latent = linear - moved[1], latent - moved[2]
    return FactorizationMachine(chosen, bias, linear, latent)


def excess(hits: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """How far `hits` of n documents lie above a share: -log of the chance, by Chernoff's bound."""
    hits, n = hits.astype(np.float64), n.astype(np.float64)
    rate = np.clip(hits / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    spread = rate * np.log(rate / share) + (1 - rate) * np.log((1 - rate) / (1 - share))
    return np.where(rate > share, n * spread, 0.0)


@dataclass
class _Words:
    """A block of words: their buckets, and a matrix of the documents that hold them."""

    buckets: np.ndarray
    held: np.ndarray
    own: np.ndarray

    @classmethod
    def unpack(cls, row: dict, toxic: np.ndarray) -> _Words:
        words, sizes, places = (np.frombuffer(row[c], "<i4") for c in ("words", "sizes", "places"))
        held = np.zeros((len(toxic), len(words)), dtype=np.float32)
        held[places, np.repeat(np.arange(len(words)), sizes)] = 1
        return cls(words, held, excess(held[toxic].sum(axis=0), held.sum(axis=0), toxic.mean()))

    def telling(self, other: _Words, toxic: np.ndarray, least: float) -> np.ndarray:
        """Buckets of words that tell together with a word of the other block, and not alone."""
        hits = self.held[toxic].T @ other.held[toxic]
        if not (hits >= LEAST_PAIR_DOCS).any():
            return np.zeros(0, np.int32)
        together = excess(hits, self.held.T @ other.held, toxic.mean())
        alone = np.maximum(self.own[:, None], other.own)
        i, j = np.nonzero((hits >= LEAST_PAIR_DOCS) & (together >= least) & (together >= 2 * alone))
        apart = self.buckets[i] != other.buckets[j]
        return np.unique(np.concatenate([self.buckets[i[apart]], other.buckets[j[apart]]]))


def pair_words(sample: DataFrame) -> DataFrame:
    """Buckets (word) of the words of sample(label, words) that tell in pairs.

    Documents of equal words count once. Postings are at most as long as the sample, and a block
    of them is the unit of work; of two blocks one visits the other.
    """
    spark = sample.sparkSession
    distinct = sample.select("label", F.sort_array("words").alias("words")).distinct()
    numbered = stored(
        distinct.withColumn("place", F.row_number().over(Window.orderBy("words", "label")) - 1),
        "toxicity-places",
    )
    marks = numbered.select("place", "label").orderBy("place").collect()  # as many as the sample
    toxic = np.array([row["label"] > 0 for row in marks], dtype=bool)
    if not toxic.any() or toxic.all():
        return spark.createDataFrame([], "word int")
    postings = stored(
        numbered.select("place", "label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("hits"), F.collect_list("place").alias("places"))
        .filter(F.col("hits") >= LEAST_PAIR_DOCS),
        "toxicity-postings",
    )
    n_words = postings.count()
    tiles = max(1, -(-n_words // BLOCK_WORDS))
    least = float(np.log(max(1, n_words * (n_words - 1) // 2) / PAIR_CHANCE))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each block; rows come sorted by it."""
        at, words, places = None, [], []

        def flush() -> pa.RecordBatch:
            values = (words, [len(p) for p in places], [x for p in places for x in p])
            columns = [pa.array([np.array(v, "<i4").tobytes()], pa.binary()) for v in values]
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), *columns], ["tile", "words", "sizes", "places"]
            )

        for batch in batches:
            for tile, word, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tile != at and words:
                    yield flush()
                    words, places = [], []
                at = tile
                words.append(word)
                places.append(held)
        if words:
            yield flush()

    packs = stored(
        postings.withColumn("tile", F.pmod(F.xxhash64("word"), F.lit(tiles)))
        .select("tile", "word", "places")
        .repartition("tile")
        .sortWithinPartitions("tile", "word")
        .mapInArrow(pack, "tile long, words binary, sizes binary, places binary"),
        "toxicity-blocks",
    )
    marked = spark.sparkContext.broadcast(toxic)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by lane and offset: the block of a lane first, then its visitors."""
        labels, at, staying = marked.value, None, None
        for batch in batches:
            for row in batch.to_pylist():
                block = _Words.unpack(row, labels)
                if row["offset"] == 0:
                    at, staying = row["lane"], block
                elif row["lane"] != at:
                    continue  # no word fell into the block that stays in this lane
                found = staying.telling(block, labels, least)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], ["word"])

    visits = visiting(packs.withColumn("tiles", F.lit(tiles).cast("long")))
    met = visits.repartition(2 * tiles, "lane").sortWithinPartitions("lane", "offset")
    return met.mapInArrow(compare, "word int").distinct()


def train_toxicity(
    documents: DataFrame, labels: DataFrame, limit: int = FIT_ROWS, label: str = "toxic"
) -> FactorizationMachine:
    """Screen the terms, then fit to the labelled training documents."""

    @F.arrow_udf("terms array<int>, words array<int>")
    def hashed(texts: pa.Array) -> pa.Array:
        found = [words(t) for t in texts.to_pylist()]
        every = [terms(b"".join(map(buckets, w))).astype(np.int32) for w in found]
        whole = [sorted(set(map(word_bucket, w))) for w in found]
        kind = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array(every, kind), pa.array(whole, kind)], ["terms", "words"])

    sample = stored(
        labelled_sample(documents, labels, label, limit)
        .select("doc_id", F.least("label", F.lit(1)).alias("label"), hashed("text").alias("found"))
        .select("doc_id", "label", "found.terms", "found.words"),
        "toxicity-sample",
    )
    totals = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    n, n_toxic = int(totals[0]), int(totals[1])
    a, both = F.col("toxic"), F.col("docs")
    expected = both * (n_toxic / max(n, 1))
    spread = F.greatest(expected * (1 - both / max(n, 1)) * (1 - n_toxic / max(n, 1)), F.lit(1e-9))
    single = (
        sample.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("docs"), F.sum("label").alias("toxic"))
        .filter(both >= LEAST_DOCS)
        .withColumn("chi2", (a - expected) * (a - expected) / spread)
        .filter(F.col("chi2") >= LEAST_CHI2)
        .select("term")
    )
    # Presence of a word is the first level of its bucket.
    paired = pair_words(sample.select("label", "words")).select((4 * F.col("word") + 1).alias("term"))
    found = single.unionByName(paired).distinct()
    chosen = np.array(sorted(r["term"] for r in found.collect()), dtype=np.int64)
    known = set(chosen.tolist())

    @F.arrow_udf("array<int>")
    def screened(lists: pa.Array) -> pa.Array:
        rows = [[t for t in x or () if t in known] for x in lists.to_pylist()]
        return pa.array(rows, pa.list_(pa.int32()))

    rows = sample.select("doc_id", "label", screened("terms").alias("terms")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    docs = [np.searchsorted(chosen, np.array(r["terms"], dtype=np.int64)) for r in rows]
    return fit_machine(docs, np.array([r["label"] for r in rows], dtype=np.float64), chosen)


def toxicity_score(text: Column, model: FactorizationMachine) -> Column:
    """The probability of the label, a double between 0 and 1."""

    name, relevant = model.name, frozenset((model.terms // 4).tolist())

    def relevant_buckets(word: str) -> bytes:
        own = relevant.intersection(found := _hashed(word))
        return array("i", [b for b in found if b in own]).tobytes() if own else b""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        # One memory, of the last model: its words mean nothing to another one.
        store = worker_store()
        if store.get("toxicity", ("",))[0] != name:
            store["toxicity"] = (name, Memory(relevant_buckets))
        memory = store["toxicity"][1]
        none = model.score(np.zeros(0, dtype=np.int64))
        out = []
        for text in texts.to_pylist():
            packed = b"".join(map(memory.__getitem__, words(text)))
            out.append(model.score(model.active(packed)) if packed else none)
        return pa.array(out, pa.float64())

    return score(text)
