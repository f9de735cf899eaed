"""Global positions and running values without a single-task window.

A group may hold any share of the rows, so no window here spans a whole group: rows are cut
into blocks, every block is reduced to one small row, and the reduced rows carry the running
value from block to block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import scratch_path

_LOCAL_BITS = 33


def ordinals(df: DataFrame, order: Sequence[str], name: str, by: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based position of each row, within its group, in the given order.

    One range shuffle on the full sort key spreads a hot group over many partitions.
    The row number inside a partition is pinned by a scratch table, as the sampled bounds of
    a range shuffle may differ when it is computed again. Pass slim rows, without texts.
    """
    by, path = list(by), scratch_path(df.sparkSession, "ordinals")
    numbered = df.orderBy(*by, *order).withColumn("__row", F.monotonically_increasing_id())
    numbered.write.parquet(path)
    pinned = df.sparkSession.read.schema(numbered.schema).parquet(path)
    placed = pinned.withColumn("__part", F.shiftrightunsigned("__row", _LOCAL_BITS))
    counts = placed.groupBy(*by, "__part").agg(
        F.count("*").alias("__n"), F.min("__row").alias("__first")
    )
    # One row per partition and group: partitions plus groups in all.
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"__by_{c}") for c in by],
        F.col("__part").alias("__by___part"),
        (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    condition = F.lit(True)
    for key in [*by, "__part"]:
        condition = condition & placed[key].eqNullSafe(starts[f"__by_{key}"])
    return placed.join(starts, condition).select(
        *df.columns, (F.col("__row") + F.col("__shift")).alias(name)
    )


def batch_numbers(df: DataFrame, order: Sequence[str], size: int, name: str = "batch_no") -> DataFrame:
    """Number rows into consecutive batches of a size; the last one may be short."""
    return ordinals(df, order, "__pos").select(
        *df.columns, F.expr(f"__pos div {int(size)}").alias(name)
    )


def running_max(
    df: DataFrame,
    by: Sequence[str],
    position: str,
    value: Column,
    name: str,
    block_rows: int,
    inclusive: bool,
) -> DataFrame:
    """Add the largest value seen so far in the group, in order of an integer position.

    Blocks are ranges of block_rows positions, so a window holds at most one block.
    The join and the window use the same keys and share one shuffle; keys are not null.
    """
    by = list(by)
    keys = [*by, "__block"]
    blocked = df.withColumn("__value", value).withColumn(
        "__block", F.expr(f"{position} div {int(block_rows)}")
    )
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*keys)
        .agg(F.max("__value").alias("__top"))
        .select(*keys, F.max("__top").over(earlier).alias("__carry"))
    )
    local = (
        Window.partitionBy(*keys)
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    here = F.max("__value").over(local)
    later = F.when(here.isNull() | (F.col("__carry") > here), F.col("__carry")).otherwise(here)
    return blocked.join(carried, keys).select(*df.columns, later.alias(name))
