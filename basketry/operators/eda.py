"""Descriptive statistics of the prepared tables."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.quantiles import exact_percentiles


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, exact median, sample deviation, minimum and maximum per column."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns])))
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    medians = (exact_percentiles(long, "value", [0.5], ["column_name"])
               .select("column_name", F.col("q")[0].alias("median")))
    return stats.join(F.broadcast(medians), "column_name", "left")


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and share of every value of each column, null included."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])))
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("row_count") / total)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the value range, empty bins kept.

    Bins are right-open, the last one closed.  A constant column has one bin.
    """
    s = df.agg(F.struct(F.min(column).cast("double").alias("lo"),
                        F.max(column).cast("double").alias("hi"))).scalar()
    lo, hi = s["lo"], s["hi"]
    value = F.col(column).cast("double")
    at = F.floor((value - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins)
    counts = (df.where(value.isNotNull())
              .groupBy(F.when(hi > lo, F.least(F.lit(bins - 1), at)).otherwise(0).cast("int")
                       .alias("bin"))
              .agg(F.count(F.lit(1)).alias("row_count")))
    frame = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
             .where(lo.isNotNull() & ((F.col("bin") == 0) | (hi > lo))))
    width = (hi - lo) / bins
    return (frame.join(F.broadcast(counts), "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count")))


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns over rows with both values."""
    pairs = list(combinations_with_replacement(columns, 2))

    def both(a: str, b: str) -> Column:
        present = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(present, F.col(c).cast("double")) for c in (a, b))
        # ``corr`` divides by zero on a constant column; that pair is null here.
        return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))

    wide = df.agg(*[both(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(left).alias("column_a"), F.lit(right).alias("column_b"),
                                    F.col(f"_c{i}").alias("correlation")))
    return wide.select(F.inline(F.array(*entries)))


def matrix_sparsity(interactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Size, density and sparsity of the user-item matrix."""
    n_users = users.agg(F.count(F.lit(1))).scalar()
    n_items = items.agg(F.count(F.lit(1))).scalar()
    pairs = interactions.select("user_id", "item_id").distinct()
    cells = F.col("users") * F.col("items")
    return (pairs.agg(F.count(F.lit(1)).alias("filled_cells"))
            .select(n_users.alias("users"), n_items.alias("items"), "filled_cells")
            .withColumn("possible_cells", cells)
            .withColumn("density", F.col("filled_cells") / F.nullif(cells, F.lit(0)))
            .withColumn("sparsity", 1 - F.col("density")))


def activity(interactions: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Interactions per key: mean, exact median, maximum, share of keys with none."""
    per_key = interactions.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    all_keys = (dimension.select(key).join(per_key, key, "left")
                .select(F.coalesce("n", F.lit(0)).alias("n")))
    median = exact_percentiles(all_keys, "n", [0.5]).select(F.col("q")[0]).scalar()
    return all_keys.agg(
        F.lit(key).alias("entity"), F.avg("n").alias("mean"), median.alias("median"),
        F.max("n").alias("max"), F.avg((F.col("n") == 0).cast("double")).alias("zero_share"))


def daily_counts(interactions: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Interactions per calendar day."""
    return (interactions.groupBy(F.col(timestamp).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("interactions")))


def rating_counts(interactions: DataFrame) -> DataFrame:
    """Rows per rating value."""
    return interactions.groupBy("rating").agg(F.count(F.lit(1)).alias("row_count"))


def user_item_rows(interactions: DataFrame, value: Column) -> DataFrame:
    """Sparse matrix: one row per user with a map from item to value, for any catalogue."""
    cells = interactions.groupBy("user_id", "item_id").agg(F.sum(value).alias("value"))
    return cells.groupBy("user_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("item_id", "value"))))
        .alias("items"))


def user_item_matrix(interactions: DataFrame, value: Column, items: list[int]) -> DataFrame:
    """Wide matrix: one row per user, one column per listed item, zero where empty."""
    return (interactions.groupBy("user_id").pivot("item_id", items).agg(F.sum(value))
            .fillna(0, [str(i) for i in items]))
