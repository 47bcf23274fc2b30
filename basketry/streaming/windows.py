"""Windowed counts kept up to date while events arrive, late events in a table of their own.

The state of the windows is the feature table itself: one row per key and window, in one folder
per day.  A micro-batch is summed per key and window, joined with the rows of the days it touches,
and these days alone are replaced.  Every row remembers the batch that wrote it last and what it
held before, so a batch that is repeated after a failure, even a half-written one, gives the same
table.  The folders grow with days, not with batches.

An event is late once its window ended ``delay`` or more before the latest stamp of the batches
before; Spark's own watermark would drop it without a trace.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.session import drop_paths, materialise, scratch_scope
from basketry.sources.lake import child_folders

SUMS = ("events", "purchases", "rating_sum", "rating_n")
_EDGE = "batch bigint, latest timestamp_ntz"


def _schema(key: str) -> str:
    sums = ", ".join(f"{s} bigint, before_{s} bigint" for s in SUMS)
    return f"{key} bigint, window_start timestamp_ntz, {sums}, batch bigint, day date"


def _read(spark: SparkSession, path: str, schema: str, days: list) -> DataFrame:
    """Rows of the given days; a table that is not there yet has none."""
    if not days or not child_folders(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("day").isin(days))


def _replace_days(rows: DataFrame, path: str) -> None:
    """Replace the folders of the days that ``rows`` hold, and no others."""
    with scratch_scope() as own:
        ready = materialise(rows, "days")  # the days are read from where they are written
    (ready.hint("rebalance", "day").write.mode("overwrite").partitionBy("day")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    drop_paths(rows.sparkSession, own)


def latest_before(spark: SparkSession, path: str, batch_id: int) -> datetime | None:
    """The latest stamp of the batches before this one; two folders are written in turn."""
    if not child_folders(spark, f"{path}/edge"):
        return None
    rows = spark.read.schema(_EDGE).parquet(f"{path}/edge/*").where(F.col("batch") < batch_id)
    return rows.agg(F.max_by("latest", "batch")).first()[0]


def _days(rows: DataFrame) -> list:
    """Days that a micro-batch touches."""
    return [r[0] for r in rows.select("day").distinct().collect()]


def merge_batch(batch: DataFrame, batch_id: int, key: str, path: str, width: str,
                delay: str) -> None:
    """Add one micro-batch to the tables below ``path``."""
    spark = batch.sparkSession
    edge = latest_before(spark, path, batch_id)
    limit = F.lit(edge).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
    window = F.window("timestamp", width)
    rows = (batch.where(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
            .select("*", window.alias("w"))
            .withColumn("late", F.coalesce(F.col("w.end") <= limit, F.lit(False))))
    with scratch_scope() as own:
        rows = materialise(rows.select(
            key, "view_mode", F.col("rating").cast("bigint").alias("rating"), "timestamp", "late",
            F.col("w.start").alias("window_start"), F.to_date("w.start").alias("day")), "micro-batch")

    fresh = (rows.where("not late").groupBy(key, "window_start", "day")
             .agg(F.count(F.lit(1)).alias("events"),
                  F.count_if(F.col("view_mode") == "purchase").alias("purchases"),
                  F.coalesce(F.sum("rating"), F.lit(0)).alias("rating_sum"),
                  F.count("rating").alias("rating_n")))
    days = _days(fresh)
    if days:
        old = _read(spark, f"{path}/windows", _schema(key), days)
        again = F.col("batch") == batch_id  # written by an earlier attempt of this batch
        base = old.select(key, "window_start", "day", "batch", *(
            F.when(again, F.col(f"before_{s}")).otherwise(F.col(s)).alias(f"base_{s}") for s in SUMS))
        zero = F.lit(0).cast("bigint")
        both = base.join(fresh, [key, "window_start", "day"], "full")
        merged = both.select(
            key, "window_start",
            *(c for s in SUMS for c in (
                (F.coalesce(f"base_{s}", zero) + F.coalesce(s, zero)).alias(s),
                F.coalesce(f"base_{s}", zero).alias(f"before_{s}"))),
            F.when(F.col("events").isNotNull(), F.lit(batch_id)).otherwise(F.col("batch"))
            .cast("bigint").alias("batch"), "day").where("events > 0")
        _replace_days(merged, f"{path}/windows")

    late_schema = f"{key} bigint, view_mode string, rating bigint, timestamp timestamp_ntz, batch bigint, day date"
    late = rows.where("late").select(key, "view_mode", "rating", "timestamp",
                                     F.lit(batch_id).cast("bigint").alias("batch"), "day")
    days = _days(late)
    if days:
        kept = _read(spark, f"{path}/late", late_schema, days).where(F.col("batch") != batch_id)
        _replace_days(kept.unionByName(late), f"{path}/late")

    newest = rows.agg(F.max("timestamp").alias("t"))
    (newest.select(F.lit(batch_id).cast("bigint").alias("batch"),
                   F.greatest("t", F.lit(edge).cast("timestamp_ntz")).alias("latest"))
     .write.mode("overwrite").parquet(f"{path}/edge/{batch_id % 2}"))
    drop_paths(spark, own)


def refresh_windows(events: DataFrame, key: str, path: str, checkpoint: str,
                    width: str = "1 day", delay: str = "7 DAYS",
                    available_now: bool = True) -> StreamingQuery:
    """Keep counts per key (user or item) and event-time window below ``path``.

    ``events`` are accepted transactions.  ``path`` gets the tables ``windows`` and ``late``.
    """
    writer = (events.writeStream.foreachBatch(
        lambda batch, n: merge_batch(batch, n, key, path, width, delay))
        .outputMode("append").option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def window_counts(spark: SparkSession, key: str, path: str) -> DataFrame:
    """The current counts: key, window_start, events, purchases, rating_sum, rating_n."""
    return spark.read.schema(_schema(key)).parquet(f"{path}/windows").select(
        key, "window_start", *SUMS)


def late_events(spark: SparkSession, key: str, path: str) -> DataFrame:
    """Events that came after their window had closed."""
    schema = f"{key} bigint, view_mode string, rating bigint, timestamp timestamp_ntz"
    if not child_folders(spark, f"{path}/late"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/late")
