"""Keyed replace without a MERGE statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key.

    Both sides have unique keys and the same columns.  A replaced row keeps its
    first ``created_at`` where there is one.
    """
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key]
    joined = o.join(n, same, "full")
    fresh = F.col("n._new").isNotNull()

    def pick(c: str):
        if c == "created_at":
            return F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)
        return F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return joined.select(*[pick(c) for c in old.columns])
