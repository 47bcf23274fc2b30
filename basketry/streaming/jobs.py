"""Structured Streaming jobs: sources, sinks, staging and incremental features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from basketry.functions.scores import ratio_or_zero
from basketry.streaming.contract import accepted


# Sources -----------------------------------------------------------------------

def kafka_events(spark: SparkSession, servers: str, topics: list[str],
                 starting: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """payload, topic and arrival from Kafka; needs the Kafka connector package.

    Offsets live in the checkpoint of the query, which replaces the consumer
    group of a plain client.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("payload"), "topic",
                                F.col("timestamp").cast("timestamp_ntz").alias("arrival"))


def file_events(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None,
                spread: str | None = None) -> DataFrame:
    """Rows of files as they appear; each file is read once per checkpoint.

    A micro-batch of few files has few tasks.  ``spread`` names a column by which its raw rows are
    dealt to as many tasks as a shuffle has, so that parsing them is not the work of one.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path)
    return rows.repartition(spread) if spread else rows


def unrepeated(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One event per id, however late a repeat comes; rows without an id are different events.

    A watermark would drop late events, so there is none: the ids are kept in the state store,
    where a micro-batch looks up its own ids only.  No batch reads what earlier ones wrote; with
    RocksDB the ids lie on the executors' disks, and a batch adds its changes to the checkpoint.
    The number of state partitions is that of the shuffle when the checkpoint was begun.
    """
    named = events.where(F.col(key).isNotNull()).dropDuplicates([key])
    return named.unionByName(events.where(F.col(key).isNull()))


def append_unrepeated(events: DataFrame, path: str, checkpoint: str, key: str = "event_id",
                      available_now: bool = True) -> StreamingQuery:
    """Append one event per id to a Parquet table, exactly once per checkpoint."""
    return append_files(unrepeated(events, key), path, checkpoint, available_now)


# Sinks -------------------------------------------------------------------------

def append_files(df: DataFrame, path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append to a Parquet table, exactly once per checkpoint."""
    writer = (df.writeStream.format("parquet").outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def kafka_sink(encoded: DataFrame, servers: str, checkpoint: str, acks: str = "all",
               retries: int = 3) -> StreamingQuery:
    """Write key, value and topic rows; acknowledged by all replicas, with retries.

    Option names are fixed by the connector.
    """
    return (encoded.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", acks).option("kafka.retries", str(retries))
            .option("checkpointLocation", checkpoint).start())


def stage_events(decoded: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the accepted events to a staging table."""
    return append_files(accepted(decoded), path, checkpoint)


def with_staged(raw: DataFrame, spark: SparkSession, staged: str, schema: StructType) -> DataFrame:
    """Raw rows and staged events in one table, united by column name."""
    return raw.unionByName(spark.read.schema(schema).parquet(staged), allowMissingColumns=True)


# Incremental features ------------------------------------------------------------

def fold_counts(events: DataFrame, key: str, path: str, checkpoint: str,
                available_now: bool = True) -> StreamingQuery:
    """Keep per-batch partial counts per key (user or item), interaction type and day.

    Every micro-batch writes its own folder, so a repeated batch replaces its
    earlier attempt; sums over the folders are the current counts.  Rows per
    batch are bounded by keys, types and days, not by events.
    """
    def fold(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(key, "view_mode", F.col("timestamp").cast("date").alias("day"))
         .agg(F.count(F.lit(1)).alias("events"), F.sum("rating").alias("rating_sum"),
              F.count("rating").alias("rating_n"))
         .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))

    writer = (events.writeStream.foreachBatch(fold).outputMode("append")
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def folded_counts(spark: SparkSession, key: str, path: str) -> DataFrame:
    """Current counts per key, interaction type and day."""
    return (spark.read.parquet(path).groupBy(key, "view_mode", "day")
            .agg(F.sum("events").alias("events"), F.sum("rating_sum").alias("rating_sum"),
                 F.sum("rating_n").alias("rating_n")))


def compact_counts(spark: SparkSession, key: str, path: str, target: str) -> DataFrame:
    """Rewrite the partial counts of all finished batches as one table.

    Run while no stream writes to ``path``; the target starts the next folder.
    """
    folded_counts(spark, key, path).write.mode("errorifexists").parquet(f"{target}/batch=-1")
    return folded_counts(spark, key, target)


def _of_mode(mode: str):
    return F.coalesce(F.sum(F.when(F.col("view_mode") == mode, F.col("events"))), F.lit(0))


def fresh_user_features(counts: DataFrame) -> DataFrame:
    """User statistics from the folded counts."""
    return (counts.groupBy("user_id")
            .agg(F.sum("events").alias("user_activity_count"),
                 (F.sum("rating_sum") / F.nullif(F.sum("rating_n"), F.lit(0)))
                 .alias("avg_rating_given"),
                 _of_mode("purchase").alias("purchase_count"))
            .withColumn("purchase_ratio",
                        ratio_or_zero(F.col("purchase_count"), F.col("user_activity_count"))))


def fresh_item_features(counts: DataFrame) -> DataFrame:
    """Item statistics from the folded counts."""
    return (counts.groupBy("item_id")
            .agg(F.sum("events").alias("popularity_score"),
                 (F.sum("rating_sum") / F.nullif(F.sum("rating_n"), F.lit(0)))
                 .alias("avg_item_rating"),
                 _of_mode("purchase").alias("purchase_count"),
                 _of_mode("view").alias("view_count"))
            .withColumn("view_to_purchase_rate",
                        ratio_or_zero(F.col("purchase_count"), F.col("view_count"))))
