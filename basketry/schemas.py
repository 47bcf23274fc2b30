"""Schemas, value domains and other fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

USERS_RAW = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("device", T.StringType()),
])

PRODUCTS_RAW = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("brand", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("in_stock", T.BooleanType()),
])

INTERACTIONS_RAW = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("view_mode", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

FEATURE_REGISTRY = T.StructType([
    T.StructField("feature_name", T.StringType()),
    T.StructField("feature_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("computation_logic", T.StringType()),
])

# Events arrive as JSON text.  Fields are read as text first, so that a value
# of the wrong type is a contract violation and not a silent null; a text that
# is no JSON lands in the last field.
CORRUPT = "_corrupt_record"
USER_EVENT = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("user_id", "age", "gender", "device", "timestamp", CORRUPT)
])
TRANSACTION_EVENT = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("user_id", "item_id", "view_mode", "rating", "timestamp", "event_id", CORRUPT)
])

# Domains and weights of the data model.
VIEW_MODES = ("view", "add_to_cart", "purchase")
IMPLICIT_SCORES = {"view": 1, "add_to_cart": 2, "purchase": 3}
GENDERS = ("M", "F", "Male", "Female")
EVENT_GENDERS = ("M", "F")
DEVICES = ("Mobile", "Desktop", "Tablet")
DEFAULT_GENDER = "M"
DEFAULT_DEVICE = "Mobile"
UNKNOWN_CATEGORY = "Unknown"
NULL_LABEL = "None"
PRICE_TIERS = ("low", "medium", "high")

# The texts that the pandas CSV reader takes as missing.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

USER_COLUMNS = ("user_id", "age", "gender", "device")
PRODUCT_COLUMNS = ("item_id", "price", "brand", "category", "rating", "in_stock")
INTERACTION_COLUMNS = ("user_id", "item_id", "view_mode", "rating", "timestamp")
