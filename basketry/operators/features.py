"""User, item and interaction features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.scores import (affinity, implicit_score, rating_to_unit, ratio_or_zero,
                                       recency_weight, whole_days)
from basketry.schemas import UNKNOWN_CATEGORY


def user_features(interactions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Activity count, mean rating, purchase share and favourite category.

    Counted per (user, category) first, so that the rows of a very active user
    shrink on the map side; users without activity keep default values.
    """
    with_category = interactions.join(products.select("item_id", "category"), "item_id", "left")
    per_category = with_category.groupBy("user_id", "category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.count_if(F.col("view_mode") == "purchase").alias("purchases"))
    favourite = F.min(F.when(F.col("category").isNotNull(),
                             F.struct((-F.col("n")).alias("n"), F.col("category"))))
    per_user = per_category.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.sum("rating_sum").alias("rating_sum"),
        F.sum("rating_n").alias("rating_n"), F.sum("purchases").alias("purchases"),
        favourite["category"].alias("favourite"))
    idle = F.col("n").isNull()
    mean_rating = F.col("rating_sum") / F.nullif(F.col("rating_n"), F.lit(0))
    return (users.join(per_user, "user_id", "left").select(
        "user_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("user_activity_count"),
        F.when(idle, F.lit(0.0)).otherwise(mean_rating).alias("avg_rating_given"),
        F.when(idle, F.lit(0.0)).otherwise(F.col("purchases") / F.col("n")).alias("purchase_ratio"),
        F.coalesce("favourite", F.lit(UNKNOWN_CATEGORY)).alias("preferred_category"),
        *[c for c in users.columns if c != "user_id"]))


def item_statistics(interactions: DataFrame) -> DataFrame:
    """Popularity, mean rating, purchases, views and conversion per item."""
    return (interactions.groupBy("item_id")
            .agg(F.count("user_id").alias("popularity_score"),
                 F.avg("rating").alias("avg_item_rating"),
                 F.count_if(F.col("view_mode") == "purchase").alias("purchase_count"),
                 F.count_if(F.col("view_mode") == "view").alias("view_count"))
            .withColumn("view_to_purchase_rate",
                        ratio_or_zero(F.col("purchase_count"), F.col("view_count"))))


def item_features(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Product columns with item statistics.

    Items without interactions get zeros, except that their purchase and view
    counts stay null.
    """
    return (products.join(item_statistics(interactions), "item_id", "left")
            .fillna(0, ["popularity_score", "avg_item_rating", "view_to_purchase_rate"]))


def interaction_features(interactions: DataFrame) -> DataFrame:
    """Recency weight against the newest timestamp and the affinity blend.

    Columns that are absent shorten the formula as they would for one row:
    no timestamp means weight 1, no rating means the implicit score alone.
    """
    df = interactions
    if "implicit_score" not in df.columns:
        df = df.withColumn("implicit_score", implicit_score(F.col("view_mode")))
    if "timestamp" in df.columns:
        newest = interactions.agg(F.max("timestamp")).scalar()
        df = (df.withColumn("days_since", whole_days(F.col("timestamp"), newest))
              .withColumn("recency_weight", recency_weight(F.col("days_since"))))
    else:
        df = df.withColumn("recency_weight", F.lit(1.0))
    if "rating" not in df.columns:
        return df.withColumn("user_item_affinity", F.col("implicit_score") / F.lit(3.0))
    return (df.withColumn("rating_normalized", rating_to_unit(F.col("rating")))
            .withColumn("user_item_affinity", affinity(
                F.col("implicit_score"), F.col("rating_normalized"), F.col("recency_weight"))))
