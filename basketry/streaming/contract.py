"""The event contract: typed fields and domain checks on JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from basketry.functions.cleaning import parse_timestamp
from basketry.functions.scores import implicit_score
from basketry.schemas import (CORRUPT, DEVICES, EVENT_GENDERS, TRANSACTION_EVENT, USER_EVENT,
                              VIEW_MODES)

USER_TOPIC, TRANSACTION_TOPIC = "users", "transactions"
# How far a sender's clock may be ahead of the arrival.
MAX_AHEAD = "1 DAY"


def route(events: DataFrame, topic: str) -> DataFrame:
    """Events of one topic."""
    return events.where(F.col("topic") == topic)


def whole_number(text: Column) -> Column:
    """Integer, or null for fractions and other text; ``5.0`` counts as 5."""
    as_double = text.try_cast("double")
    return F.coalesce(text.try_cast("bigint"),
                      F.when(as_double == F.floor(as_double), as_double.try_cast("bigint")))


def _parsed(events: DataFrame, schema: StructType) -> DataFrame:
    """payload, arrival and the fields of the payload as text columns.

    The generator keeps later filters above the parse, which would otherwise
    be copied into them field by field.
    """
    document = F.from_json("payload", schema, {"columnNameOfCorruptRecord": CORRUPT})
    return events.select("payload", "arrival", F.inline(F.array(document)))


def _reasons(checks: dict[str, Column]) -> Column:
    """Names of the failed checks, or ``json`` alone; a null outcome is a failure."""
    broken = F.col("payload").isNull() | F.col(CORRUPT).isNotNull()
    failed = F.concat_ws(",", *[
        F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()])
    return F.when(broken, "json").otherwise(failed)


def decode_users(events: DataFrame) -> DataFrame:
    """Typed user events with ``reasons``; payload and arrival are kept."""
    typed = _parsed(events, USER_EVENT).select(
        "payload", "arrival", CORRUPT, whole_number(F.col("user_id")).alias("user_id"),
        whole_number(F.col("age")).alias("age"), "gender", "device")
    return typed.withColumn("reasons", _reasons({
        "user_id": F.col("user_id").isNotNull(), "age": F.col("age") > 0,
        "gender": F.col("gender").isin(*EVENT_GENDERS),
        "device": F.col("device").isin(*DEVICES)})).drop(CORRUPT)


def decode_transactions(events: DataFrame) -> DataFrame:
    """Typed transaction events with ``reasons`` and the implicit score.

    Rating and timestamp may be absent, but not malformed; an absent timestamp
    becomes the arrival time.
    """
    typed = _parsed(events, TRANSACTION_EVENT).select(
        "payload", "arrival", CORRUPT, whole_number(F.col("user_id")).alias("user_id"),
        whole_number(F.col("item_id")).alias("item_id"), "view_mode",
        whole_number(F.col("rating")).alias("rating"),
        parse_timestamp(F.col("timestamp")).alias("stamp"), "event_id",
        (F.col("rating").isNull()).alias("no_rating"),
        (F.col("timestamp").isNull()).alias("no_stamp"))
    reasons = _reasons({
        "user_id": F.col("user_id").isNotNull(), "item_id": F.col("item_id").isNotNull(),
        "view_mode": F.col("view_mode").isin(*VIEW_MODES),
        "rating": F.col("no_rating") | F.col("rating").between(1, 5),
        "timestamp": F.col("no_stamp") | F.col("stamp").isNotNull(),
        "future": F.coalesce(F.col("stamp") <= F.col("arrival") + F.expr(f"INTERVAL {MAX_AHEAD}"),
                             F.lit(True))})
    return typed.select(
        "payload", "arrival", "user_id", "item_id", "view_mode",
        F.col("rating").try_cast("int").alias("rating"),
        F.coalesce("stamp", "arrival").alias("timestamp"), "event_id",
        implicit_score(F.col("view_mode")).alias("implicit_score"), reasons.alias("reasons"))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reasons") == "").drop("payload", "arrival", "reasons")


def identified(decoded: DataFrame) -> DataFrame:
    """Accepted transactions, each with an event_id.

    An event that came without one gets an id from its user, item, stamp and payload, so a
    repeat of it is known and different events stay apart.
    """
    parts = F.concat_ws("_", "user_id", "item_id", F.col("timestamp").cast("string"),
                        F.md5("payload"))
    named = decoded.withColumn("event_id", F.coalesce("event_id", F.concat(F.lit("~"), parts)))
    return accepted(named)


def rejected(decoded: DataFrame) -> DataFrame:
    """Payload, arrival and the names of the failed checks."""
    return decoded.where(F.col("reasons") != "").select("payload", "arrival", "reasons")


def event_id(user_id: Column, item_id: Column, at: Column) -> Column:
    """``user_item_millis``, the id a producer puts on the wire.

    ``at`` has no zone and is read as UTC, whatever the session zone is.
    """
    gap = at - F.lit("1970-01-01").cast("timestamp_ntz")

    def part(name: str) -> Column:
        return F.extract(F.lit(name), gap)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    millis = minutes * 60_000 + F.floor(part("SECOND") * 1000).cast("bigint")
    return F.concat_ws("_", user_id.cast("string"), item_id.cast("string"), millis.cast("string"))


def encode_events(df: DataFrame, topic: str, columns: list[str], key: str) -> DataFrame:
    """Rows as ``key``, ``value`` (JSON) and ``topic``: the shape of a Kafka sink."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*columns)).alias("value"), F.lit(topic).alias("topic"))
