"""Global row positions without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from basketry.session import materialise, shared_folder

_LOW_BITS = (1 << 33) - 1


def global_position(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add the 0-based position of every row in the given total order.

    The rows are range sorted, checkpointed so that their partitions stay as they are, and
    numbered from the partition offsets.  The numbered table is written once, so that its
    size is known wherever it is joined.
    """
    shared_folder(df.sparkSession)
    fixed = (df.orderBy(*order)
             .withColumn("_row", F.monotonically_increasing_id())
             .withColumn("_part", F.shiftright("_row", 33))
             .checkpoint())
    # One row per sorted partition: bounded by the shuffle partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    numbered = (fixed.join(F.broadcast(offsets), "_part")
                .withColumn(name, F.col("_offset") + F.col("_row").bitwiseAND(F.lit(_LOW_BITS)))
                .drop("_row", "_part", "_offset"))
    return materialise(numbered, "positions")
