"""What several operators of this package need."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once below the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs the tasks it was running, not the stages before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def visiting(packs: DataFrame) -> DataFrame:
    """Rows of tiles sent to the lanes they visit, so that every two tiles meet in one lane.

    packs(tile, tiles, ..): tile from 0, tiles is how many there are. A tile stays in its own lane
    (offset 0) and visits half of the others in a circle; of two that face each other one does.
    """
    half = F.expr("(tiles - if(tiles % 2 = 0 AND 2 * tile >= tiles, 1, 0)) div 2")
    return packs.withColumn("offset", F.explode(F.sequence(F.lit(0).cast("long"), half))).withColumn(
        "lane", F.pmod(F.col("tile") + F.col("offset"), F.col("tiles"))
    )


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker and is shared by its tasks.

    Functions travel to the workers by value, so they have no module of their own to keep
    a memory in. Only memories of results are kept here, never anything a result depends on.
    """
    name = "_corpusloom_worker_store"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def training_side() -> Column:
    """True for the documents whose labels may be learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def hash_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most `limit` rows, those with the smallest hash of the key.

    Where there are many more, all but a few times the limit are left out by their hash before
    anything is ordered, so that what tasks send on does not grow with their number.
    """
    hashed, parts = F.xxhash64(key), 1 << 30
    n = df.count()
    if n > 8 * limit:
        df = df.filter(F.pmod(hashed, F.lit(parts)) < max(1, parts * 4 * limit // n))
    return df.orderBy(F.pmod(hashed, F.lit(parts)), key).limit(limit)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, limit: int
) -> DataFrame:
    """At most `limit` labelled training documents (doc_id, label, text), spread by hash.

    The bound is on what a model is fitted to; scores cover all rows. Of several labels of
    one document the largest counts, of several texts the one with the smallest hash; rows
    without document id or label are left out.
    The chosen ids are bounded by `limit`, which is what makes their broadcast safe.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & training_side())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = hash_sample(usable, "doc_id", limit)
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    first = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text")))
    return found.groupBy("doc_id", "label").agg(first.alias("text"))
