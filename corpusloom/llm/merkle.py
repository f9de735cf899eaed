"""Merkle manifest of a dataset: one tree per language, one tree over their roots.

Each level of a tree is a table of nodes (part, place). It meets itself by an equi-join on the
computed place of the sibling: place XOR 1 where two nodes make a parent, the other slots of the
run otherwise. Rows of slot zero then emit the parents. Levels are written one by one, and
every level is a fraction of the one below.

For the proofs, nodes of a band of levels meet by the subtree they belong to: a group is one
subtree of at most about a thousand leaves, which passes the path of its top node down. So a proof
is put together where it is used, and what is shuffled is every node once, not every proof.

Defined results: leaves stand in ascending doc_id, rows without doc_id first, rows of one doc_id
by their digest; equal rows are leaves one by one; a null field is hashed as "-", an empty text as
"0:"; a null language is a part of its own before all others; a row without doc_id is never
tampered with; one row is leaf, subroot and root at once and has an empty proof; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.shared import stored
from corpusloom.operators.positions import ordinals
from corpusloom.session import scratch_path

#: Nodes that make a parent, and the leaves of a subtree that proofs are made in.
FANOUT = 2
SUBTREE = 1_024
TAMPER_EVERY = 7

_NODES = "part string, place long, n long, digest string, doc_id long, altered string, others string"


def field(value: Column) -> Column:
    """A field as it is hashed: "-" for null, else its bytes in UTF-8, a colon, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(n_chars: Column) -> Column:
    """SHA-256 over the fields of a document, in lowercase hexadecimal digits."""
    names = ("doc_id", "source", "lang")
    return F.sha2(F.concat(*[field(F.col(c)) for c in names], field(n_chars), field(F.col("text"))), 256)


def manifest_leaves(docs: DataFrame) -> DataFrame:
    """part, doc_id, digest and, of documents to tamper with, the altered digest."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(F.col("n_chars")).alias("digest"),
        F.when(chosen, leaf_digest(one_more)).alias("altered"),
    )


def _levels(most: int, fanout: int) -> int:
    """Levels of a tree of so many leaves, its root's level included."""
    levels = 1
    while most > 1:
        most, levels = -(-most // fanout), levels + 1
    return levels


def _beside_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Each node with the digests of the other nodes of its run, in their order."""
    place, siblings, joined = F.col("place"), [], nodes
    for offset in range(1, fanout):
        if fanout == 2:
            wanted = place.bitwiseXOR(F.lit(1))
        else:
            slot = place % fanout
            wanted = place - slot + (slot + offset) % fanout
        other = nodes.select(
            F.col("part").alias("__part"),
            F.col("place").alias(f"__place_{offset}"),
            F.col("digest").alias(f"__digest_{offset}"),
        )
        met = (joined["part"] == other["__part"]) & (wanted == other[f"__place_{offset}"])
        joined = joined.join(other, met, "left").drop("__part")
        siblings.append(F.struct(wanted.alias("at"), F.col(f"__digest_{offset}").alias("digest")))
    if fanout == 2:
        others = F.coalesce("__digest_1", F.lit(""))
    else:
        in_order = F.array_sort(F.array(*siblings))
        others = F.array_join(F.transform(in_order, lambda s: s["digest"]), "")
    return joined.withColumn("others", others).select(*nodes.columns, "others")


def build_tree(leaves: DataFrame, fanout: int = FANOUT) -> tuple[str, int]:
    """Write all levels of the trees over leaves (part, place, digest, doc_id, altered).

    The places of a part are 0, 1, and so on. Gives the folder with a table per level, and the
    number of levels. A level holds the nodes of all trees that reach it; a root has n = 1.
    """
    spark = leaves.sparkSession
    base = scratch_path(spark, "merkle")
    sizes = stored(leaves.groupBy("part").agg(F.count("*").alias("n")), "merkle-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    nodes = leaves.join(sizes, "part").select("part", "place", "n", "digest", "doc_id", "altered")
    levels = _levels(most, fanout)
    for level in range(levels):
        path = f"{base}/level={level}"
        _beside_siblings(nodes, fanout).write.parquet(path)
        below = spark.read.schema(_NODES).parquet(path)
        nodes = below.filter((F.col("n") > 1) & (F.col("place") % fanout == 0)).select(
            "part",
            F.expr(f"place div {fanout}").alias("place"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            F.sha2(F.concat("digest", "others"), 256).alias("digest"),
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("string").alias("altered"),
        )
    return base, levels


def _node_table(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(f"{_NODES}, level int").parquet(base)


def tree_roots(spark: SparkSession, base: str) -> DataFrame:
    """part and digest of the root of every tree."""
    return _node_table(spark, base).filter("n = 1").select("part", "digest", "level")


def _pass_down(lowest: int, fanout: int):
    """Paths of a subtree's nodes on its lowest level, from the path its top node came with."""

    def solve(group: pa.Table) -> pa.Table:
        level, place, path, others = (
            group.column(c).to_pylist() for c in ("level", "place", "path", "others")
        )
        known = {(level[i], place[i]): path[i] for i in range(len(path)) if path[i] is not None}
        for i in sorted(range(len(level)), key=level.__getitem__, reverse=True):
            at = (level[i], place[i])
            if at not in known:
                up = known[level[i] + 1, place[i] // fanout]
                known[at] = f"{place[i] % fanout}:{others[i]};{up}"
        subroot = next(filter(None, group.column("subroot").to_pylist()))
        keep = pc.and_(pc.equal(group.column("level"), lowest), pc.is_valid(group.column("digest")))
        out = group.filter(keep).select(["part", "place", "digest", "doc_id", "altered"])
        paths = pa.array([known[lowest, p] for p in out.column("place").to_pylist()], pa.string())
        return out.append_column("path", paths).append_column(
            "subroot", pa.array([subroot] * len(paths), pa.string())
        )

    return solve


def leaf_paths(
    spark: SparkSession, base: str, levels: int, tops: DataFrame, fanout: int = FANOUT, subtree: int = SUBTREE
) -> DataFrame:
    """The leaves with subroot and path: per level the slot and the siblings, up to the last root.

    `tops` has part and path, which is what follows on the root of that part.
    """
    band = max(1, _levels(subtree, fanout) - 1)
    nodes = _node_table(spark, base)
    roots = nodes.filter("n = 1").join(tops, "part").select(
        "part", "place", "level", "path", F.col("digest").alias("subroot")
    )
    slim = "part string, place long, digest string, doc_id long, altered string, path string, subroot string"
    above = None
    for number in reversed(range(-(-levels // band))):
        low, high = number * band, (number + 1) * band
        # The root of a tree starts a path, any other node has siblings or at least a parent.
        within = nodes.filter((F.col("level") >= low) & (F.col("level") < high)).select(
            "part", "place", "level", "digest", "doc_id", "altered", "others",
            F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("subroot"),
        )
        starts = roots.filter((F.col("level") >= low) & (F.col("level") < high))
        if above is not None:
            starts = starts.unionByName(
                above.select("part", "place", F.lit(high).alias("level"), "path", "subroot")
            )
        starts = starts.select(
            "part", "place", "level", F.lit(None).cast("string").alias("digest"),
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("altered"),
            F.lit("").alias("others"), "path", "subroot",
        )
        block = F.expr(f"place div cast(pow({fanout}, {high} - level) as bigint)")
        above = (
            within.unionByName(starts)
            .withColumn("block", block)
            .groupBy("part", "block")
            .applyInArrow(_pass_down(low, fanout), slim)
        )
        if number:
            above = stored(above, f"merkle-paths-{number}")
    return above


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(path: str, digest: str) -> tuple[str, str]:
    """The digest of all siblings of a path, and the root that a leaf's digest leads to."""
    siblings = []
    for step in path.split(";")[:-1]:
        slot, others = step.split(":")
        siblings.append(others)
        at = 64 * int(slot)
        digest = _digest(others[:at] + digest + others[at:])
    return _digest("".join(siblings)), digest


def proofs(path: Column, digest: Column) -> Column:
    """A struct of proof_sha256 and folded_root."""

    @F.arrow_udf("proof_sha256 string, folded_root string")
    def of(paths: pa.Array, digests: pa.Array) -> pa.Array:
        found = list(map(fold, paths.to_pylist(), digests.to_pylist()))
        sides = [pa.array([pair[i] for pair in found], pa.string()) for i in range(2)]
        return pa.StructArray.from_arrays(sides, ["proof_sha256", "folded_root"])

    return of(path, digest)


def merkle_manifest(docs: DataFrame, fanout: int = FANOUT, subtree: int = SUBTREE) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document."""
    spark = docs.sparkSession
    # Stored, as a digest reads a whole text; the number sets rows apart that are equal in all.
    leaves = stored(manifest_leaves(docs), "merkle-leaves").withColumn(
        "copy", F.monotonically_increasing_id()
    )
    placed = ordinals(leaves, ["doc_id", "digest", "copy"], "place", by=["part"])
    base, levels = build_tree(placed, fanout)
    subroots = ordinals(tree_roots(spark, base).select("part", "digest"), ["part"], "place").select(
        F.lit("").alias("part"),
        "place",
        "digest",
        F.lit(None).cast("long").alias("doc_id"),
        F.col("part").alias("altered"),
    )
    # Stored, as a part known to be constant would make joins on it products.
    top_base, top_levels = build_tree(stored(subroots, "merkle-subroots"), fanout)
    found = tree_roots(spark, top_base).first()
    nothing = spark.createDataFrame([("", "")], "part string, path string")
    tops = leaf_paths(spark, top_base, top_levels, nothing, fanout, subtree).select(
        F.col("altered").alias("part"), "path"
    )
    root = F.lit(found["digest"] if found else None).cast("string")
    return (
        leaf_paths(spark, base, levels, stored(tops, "merkle-tops"), fanout, subtree)
        .withColumn("proof", proofs(F.col("path"), F.coalesce("altered", "digest")))
        .select(
            "doc_id",
            F.col("digest").alias("leaf"),
            "subroot",
            root.alias("root"),
            "proof.proof_sha256",
            "proof.folded_root",
            (F.col("proof.folded_root") == root).alias("verified"),
        )
    )
