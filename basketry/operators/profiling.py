"""Snapshot profiles, drift, completeness and content hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def snapshot_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, position, type, record count, null count."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}")
                      for i, c in enumerate(df.columns)])
    entries = [F.struct(F.lit(f.name).alias("column_name"), F.lit(i).alias("position"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"_n{i}").alias("null_count"))
               for i, f in enumerate(df.schema.fields)]
    return counts.select(F.col("_rows").alias("record_count"), F.inline(F.array(*entries)))


def snapshot_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two profiles side by side: added, removed and retyped columns, null share, rows."""
    def side(df: DataFrame, name: str) -> DataFrame:
        share = F.col("null_count") / F.nullif(F.col("record_count"), F.lit(0))
        return df.select("column_name", F.col("data_type").alias(f"{name}_type"),
                         F.col("record_count").alias(f"{name}_rows"),
                         share.alias(f"{name}_null_share"))

    change = (F.when(F.col("old_type").isNull(), "added")
              .when(F.col("new_type").isNull(), "removed")
              .when(F.col("old_type") != F.col("new_type"), "retyped").otherwise("kept"))
    return (side(old, "old").join(side(new, "new"), "column_name", "full")
            .withColumn("change", change)
            .withColumn("null_share_change", F.col("new_null_share") - F.col("old_null_share")))


def completeness(df: DataFrame, dataset: str) -> DataFrame:
    """Filled cells in whole percent, cut off, and the health flag at 95."""
    filled = [F.count(F.col(f"`{c}`")) for c in df.columns]
    cells = F.count(F.lit(1)) * len(df.columns)
    rate = sum(filled[1:], filled[0]) / F.nullif(cells, F.lit(0))
    return (df.agg(F.count(F.lit(1)).alias("record_count"),
                   F.floor(F.round(rate * 100, 9)).cast("int").alias("score"))
            .select(F.lit(dataset).alias("dataset"), "record_count",
                    F.lit(len(df.columns)).alias("attributes"), "score",
                    F.coalesce(F.col("score") >= 95, F.lit(False)).alias("healthy")))


def sample_values(df: DataFrame, columns: int = 4, values: int = 3) -> DataFrame:
    """The smallest distinct values, as text, of the first few columns."""
    names = df.columns[:columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"`{c}`").cast("string").alias("value")) for c in names])
    distinct = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
                .groupBy("column_name", "value").agg(F.lit(1).alias("_one")))
    w = Window.partitionBy("column_name").orderBy("value")
    return (distinct.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= values)
            .groupBy("column_name")
            .agg(F.concat_ws(", ", F.transform(
                F.array_sort(F.collect_list(F.struct("_rn", "value"))),
                lambda x: x["value"])).alias("samples")))


def content_sum(names: list[str], method: str = "xxhash64") -> Column:
    """Aggregate: sum of row hashes as text, the same for any order of rows.

    ``xxhash64`` is the fast default.  ``md5`` hashes the row as text, fields
    joined by ``|`` with a mark for null, and adds up its first 60 bits.
    """
    if method == "xxhash64":
        row = F.xxhash64(*[F.col(f"`{c}`") for c in names]).cast("decimal(38,0)")
    elif method == "md5":
        text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N"))
                                  for c in names])
        row = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    else:
        raise ValueError(f"unknown hash method {method}")
    return F.sum(row).cast("string")


def content_hash(df: DataFrame, columns: list[str] | None = None,
                 method: str = "xxhash64") -> DataFrame:
    """Row count and content sum of a table."""
    return df.agg(F.count(F.lit(1)).alias("record_count"),
                  content_sum(columns or df.columns, method).alias("content_hash"))
