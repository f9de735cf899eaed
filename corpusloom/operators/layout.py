"""Where each example goes: shuffled position, shard, micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import Settings

# Hex digits of the shuffle key that name a bucket: 65,536 buckets of equal expected size.
_BUCKET_DIGITS = 4


def epoch_shuffle(
    examples: DataFrame, keys: Sequence[str], epochs: int, seed: int = 42
) -> DataFrame:
    """One row per example and epoch with its place in that epoch's permutation.

    The order is that of a hash of seed + epoch and the example key: the same on every
    worker and run. Unique keys hash evenly, so each window holds one small bucket; bucket
    offsets come from a table of at most 65,536 rows per epoch. Columns: *keys, epoch,
    perm_pos, n_examples. Pass key columns only.
    """
    keys = list(keys)
    mixed = F.md5(F.concat_ws("-", (F.lit(seed) + F.col("epoch")).cast("string"), *keys))
    keyed = (
        examples.select(*keys)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("__key", mixed)
        .withColumn("__bucket", F.left("__key", F.lit(_BUCKET_DIGITS)))
    )
    by_epoch = Window.partitionBy("epoch")
    earlier = by_epoch.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("epoch", "__bucket")
        .agg(F.count("*").alias("__n"))
        .select(
            "epoch",
            "__bucket",
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"),
            F.sum("__n").over(by_epoch).alias("n_examples"),
        )
    )
    inside = Window.partitionBy("epoch", "__bucket").orderBy("__key", *keys)
    return keyed.join(offsets, ["epoch", "__bucket"]).select(
        *keys,
        "epoch",
        (F.col("__offset") + F.row_number().over(inside) - 1).alias("perm_pos"),
        "n_examples",
    )


def shard(shuffled: DataFrame, world_size: int) -> DataFrame:
    """Equal shards: the tail that does not fill all ranks is dropped, ranks alternate."""
    full = F.expr(f"n_examples div {int(world_size)}") * world_size
    return shuffled.filter(F.col("perm_pos") < full).withColumns(
        {
            "rank": F.pmod(F.col("perm_pos"), F.lit(world_size)).cast("int"),
            "pos": F.expr(f"perm_pos div {int(world_size)}"),
        }
    )


def micro_batches(sharded: DataFrame, batch_size: int) -> DataFrame:
    """Micro-batch number inside the rank; a short last batch stays."""
    return sharded.withColumn("batch_no", F.expr(f"pos div {int(batch_size)}"))


def training_layout(
    examples: DataFrame, keys: Sequence[str], epochs: int, settings: Settings = Settings()
) -> DataFrame:
    """layout(*keys, epoch, perm_pos, rank, pos, batch_no)."""
    shuffled = epoch_shuffle(examples, keys, epochs, settings.seed)
    return micro_batches(shard(shuffled, settings.world_size), settings.batch_size).drop(
        "n_examples"
    )
