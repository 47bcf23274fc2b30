"""The warehouse tables read as users, products and interactions.

The tables are clean, so part of the rows gets the faults the cleaning is made
for, by arithmetic on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.cleaning import parse_timestamp
from basketry.operators.prepare import clean_raw_users


SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with its known schema: no look into the files to plan a query."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _every(column: str, n: int):
    return F.col(column) % n == 0


def users_text(spark: SparkSession, folder: str) -> DataFrame:
    """Users as two text files would bring them; the second lacks a column."""
    customer = table(spark, folder, "customer")
    key = F.col("c_custkey")
    age = (18 + key % 48).cast("string")
    first = customer.select(
        key.cast("string").alias("user_id"),
        F.when(_every("c_custkey", 53), None).when(_every("c_custkey", 59), "unknown")
        .when(_every("c_custkey", 97), "999")
        .when(_every("c_custkey", 71), F.concat(F.lit(" "), age, F.lit(" ")))
        .otherwise(age).alias("age"),
        F.when(_every("c_custkey", 61), None).when(_every("c_custkey", 67), " M ")
        .when(_every("c_custkey", 73), "nan")
        .when(_every("c_nationkey", 2), "M").otherwise("F").alias("gender"),
        F.when(_every("c_custkey", 43), "Phone").when(_every("c_custkey", 47), "None")
        .when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), "Mobile")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "Tablet").otherwise("Desktop")
        .alias("device"),
        F.lit("users_1").alias("source_file"), key.alias("row_seq"))
    second = customer.where(_every("c_custkey", 100) | _every("c_custkey", 149)).select(
        F.when(_every("c_custkey", 100), F.concat(F.lit(" "), key.cast("string")))
        .otherwise(F.concat(F.lit("u"), key.cast("string"))).alias("user_id"),
        F.lit("77").alias("age"), F.lit("F").alias("gender"),
        F.lit("users_2").alias("source_file"), key.alias("row_seq"))
    return first.unionByName(second, allowMissingColumns=True)


def users_raw(spark: SparkSession, folder: str) -> DataFrame:
    return clean_raw_users(users_text(spark, folder))


def products_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Products with missing prices, ratings and categories, and repeated ids."""
    part = table(spark, folder, "part")
    first = part.select(
        F.col("p_partkey").alias("item_id"),
        F.when(~_every("p_partkey", 37), F.col("p_retailprice")).alias("price"),
        F.col("p_brand").alias("brand"),
        F.when(~_every("p_partkey", 101), F.col("p_type")).alias("category"),
        F.when(~_every("p_partkey", 41), 1 + (F.col("p_size") % 41).cast("double") / 10)
        .alias("rating"),
        (F.col("p_size") % 5 != 0).alias("in_stock"),
        F.lit("products_1").alias("source_file"))
    again = (first.where(_every("item_id", 250))
             .withColumn("price", F.col("price") + 1).withColumn("brand", F.lit("Other"))
             .withColumn("source_file", F.lit("products_2")))
    return first.unionByName(again)


def interactions_text(spark: SparkSession, folder: str) -> DataFrame:
    """Events as interactions: two timestamp formats, orphans, unknown types."""
    events = table(spark, folder, "events")
    stamp = F.col("ts").cast("string")
    return events.select(
        "event_id",
        (F.col("user_id") + F.when(_every("event_id", 50), 10_000_000).otherwise(0))
        .alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type"))
        .alias("view_mode"),
        F.when(_every("event_id", 31), None).when(_every("event_id", 67), 9)
        .otherwise(1 + F.floor("value").cast("int") % 5).alias("rating"),
        F.when(_every("event_id", 83), "bad").when(_every("event_id", 89), None)
        .when(_every("event_id", 2), F.substring(stamp, 1, 19))
        .otherwise(F.translate(stamp, " ", "T")).alias("timestamp"))


def interactions_raw(spark: SparkSession, folder: str) -> DataFrame:
    return (interactions_text(spark, folder)
            .withColumn("timestamp", parse_timestamp(F.col("timestamp"))))


def order_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as interactions: the large fact table."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
        F.when(F.col("l_returnflag") == "N", "view")
        .when(F.col("l_returnflag") == "A", "add_to_cart").otherwise("purchase")
        .alias("view_mode"),
        (1 + F.col("l_quantity").cast("int") % 5).alias("rating"),
        F.col("l_shipdate").alias("timestamp"))
