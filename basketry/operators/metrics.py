"""Ranking metrics per user and their summary."""

from __future__ import annotations

from math import log2

from pyspark.sql import DataFrame, functions as F

K_VALUES = (5, 10, 20)


def ranking_metrics(recommendations: DataFrame, truth: DataFrame,
                    k_values=K_VALUES) -> DataFrame:
    """One row per user, metric and k.

    ``recommendations`` has user_id, item_id, rank (unique items per user);
    ``truth`` has user_id, item_id.  Users without truth, or without a list,
    are left out.  Precision divides by min(k, list length).  All k are folded
    into one aggregation.
    """
    relevant = truth.select("user_id", "item_id").distinct()
    totals = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    marked = recommendations.select("user_id", "item_id", "rank").join(
        relevant.withColumn("hit", F.lit(1)), ["user_id", "item_id"], "left")
    hit, rank = F.col("hit").isNotNull(), F.col("rank")
    gain = F.lit(1.0) / F.log2(rank + 1)
    parts = [F.count(F.lit(1)).alias("n_listed"), F.min(F.when(hit, rank)).alias("first_hit")]
    for k in k_values:
        within = hit & (rank <= k)
        parts += [F.count_if(within).alias(f"hits_{k}"),
                  F.coalesce(F.sum(F.when(within, gain)), F.lit(0.0)).alias(f"dcg_{k}")]
    per_user = marked.groupBy("user_id").agg(*parts).join(totals, "user_id")

    def entry(metric: str, k, value):
        return F.struct(F.lit(metric).alias("metric"), F.lit(k).cast("int").alias("k"),
                        value.cast("double").alias("value"))

    rows = []
    for k in k_values:
        hits, found = F.col(f"hits_{k}"), F.col(f"hits_{k}") > 0
        ideal, best = [], 0.0
        for i in range(1, k + 1):
            best += 1.0 / log2(i + 1)
            ideal.append(F.lit(best))
        ideal_gain = F.element_at(F.array(*ideal), F.least(F.col("n_relevant"), F.lit(k)).cast("int"))
        rows += [entry("precision", k, hits / F.least(F.lit(k), F.col("n_listed"))),
                 entry("recall", k, hits / F.col("n_relevant")),
                 entry("ndcg", k, F.col(f"dcg_{k}") / ideal_gain),
                 entry("hit_rate", k, F.when(found, 1.0).otherwise(0.0))]
    rows.append(entry("mrr", None, F.coalesce(F.lit(1.0) / F.col("first_hit"), F.lit(0.0))))
    return per_user.select("user_id", F.inline(F.array(*rows)))


def summarise_metrics(per_user: DataFrame) -> DataFrame:
    """Mean, population deviation, minimum and maximum per metric."""
    return (per_user.groupBy("metric", "k")
            .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                 F.min("value").alias("min"), F.max("value").alias("max"),
                 F.count(F.lit(1)).alias("users")))
