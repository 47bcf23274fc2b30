from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketry.operators import quality

USERS = "user_id long, age double, gender string, device string"
PRODUCTS = "item_id long, price double, brand string, category string, rating double"
ROWS = "user_id long, item_id long, view_mode string, rating int, timestamp timestamp_ntz"


def by_check(df):
    return {r.check: r for r in df.collect()}


def test_user_rules(spark):
    rows = [(i, 30.0, "M", "Mobile") for i in range(19)] + [(18, 70.0, "Male", "Phone")]
    got = by_check(quality.check_users(spark.createDataFrame(rows, USERS)))
    assert got["user_id_unique"].value == 1 and not got["user_id_unique"].passed
    # Exactly at the threshold passes.
    assert got["age_in_range_18_65"].value == 0.95 and got["age_in_range_18_65"].passed
    assert got["age_in_range_18_65"].details == "95.0% within range"
    assert got["gender_valid"].passed and got["device_valid"].passed
    assert got["no_null_user_ids"].passed and got["no_null_user_ids"].record_count == 20


def test_null_keys_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k long")
    assert df.agg(quality.duplicate_count("k")).first()[0] == 2


def test_empty_table_fails_rates(spark):
    got = by_check(quality.check_users(spark.createDataFrame([], USERS)))
    assert not got["age_in_range_18_65"].passed and got["age_in_range_18_65"].value is None
    assert got["user_id_unique"].passed


def test_missing_column_leaves_the_rule_out(spark):
    df = spark.createDataFrame([(1, "M")], "user_id long, gender string")
    assert set(by_check(quality.check_users(df))) == \
        {"user_id_unique", "gender_valid", "no_null_user_ids"}


def test_product_rules(spark):
    rows = [(1, 5.0, "b", "c", 4.0), (2, None, "b", None, 6.0), (2, -1.0, "b", "c", None)]
    got = by_check(quality.check_products(spark.createDataFrame(rows, PRODUCTS)))
    assert got["item_id_unique"].value == 1
    assert got["price_positive"].value == pytest.approx(1 / 3)
    assert got["rating_in_range_1_5"].value == pytest.approx(1 / 3)
    assert (got["item_id_not_null"].value, got["price_not_null"].value,
            got["category_not_null"].value) == (0, 1, 1)


def test_interaction_rules_and_scores(spark):
    t = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, 1, "view", 5, t), (1, 2, "buy", 0, None),
                                  (None, 1, "view", None, t), (7, 1, None, 3, t)], ROWS)
    users = spark.createDataFrame([(1, 30.0, "M", "Mobile"), (1, 30.0, "M", "Mobile")], USERS)
    items = spark.createDataFrame([(1, 5.0, "b", "c", 4.0)], PRODUCTS)
    got = by_check(quality.check_interactions(rows, users, items))
    assert got["user_id_foreign_key"].value == 0.5
    assert got["item_id_foreign_key"].value == 0.75
    assert got["view_mode_valid"].value == 0.5
    assert got["rating_in_range_1_5"].value == 0.5
    assert got["timestamp_valid"].value == 0.75
    scores = quality.quality_scores(quality.validation_report(users, items, rows))
    found = {r.dataset: (r.passed_checks, r.total_checks) for r in scores.collect()}
    assert found == {"users": (4, 5), "products": (6, 6), "transactions": (0, 5),
                     "overall": (10, 16)}
    gate = quality.quality_gate(scores, 0.5).first()
    assert gate.passed and gate.quality_score == 0.625
    assert quality.enforce_gate(scores, 0.5) == 0.625
    with pytest.raises(ValueError):
        quality.enforce_gate(scores, 0.9)


def test_key_match_against_an_empty_dimension(spark):
    rows = spark.createDataFrame([(1, 1)], "user_id long, item_id long")
    rate = quality.key_match_rate(rows, rows.limit(0), "user_id")
    assert spark.range(1).select(rate).first()[0] == 0.0


def test_warnings(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 2.0, "b"), (None, 1.0, "b")],
                               "item_id long, price double, brand string")
    got = by_check(quality.ingest_warnings(df, "products"))
    assert (got["null_item_id"].value, got["null_price"].value, got["duplicate_item_id"].value,
            got["missing_columns"].value) == (1, 1, 1, 3)
    assert "null_category" not in got and "rating" in got["missing_columns"].details


def test_unknown_values_and_orphans(spark):
    df = spark.createDataFrame([(1, "view"), (1, "x"), (2, None), (None, "x")],
                               "user_id long, view_mode string")
    got = quality.unknown_values(df, "view_mode", ["view"]).collect()
    assert {r.view_mode: r.row_count for r in got} == {"x": 2, None: 1}
    users = spark.createDataFrame([(1,)], "user_id long")
    assert {r.user_id: r.row_count for r in quality.orphan_keys(df, users, "user_id").collect()} \
        == {2: 1, None: 1}


def test_pipeline_metrics_and_freshness(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None)], "k long, v double").withColumn(
        "updated_at", F.lit("2024-01-30 10:00:00").cast("timestamp_ntz"))
    got = {r.metric: r for r in quality.pipeline_metrics(df, ["k", "v"], "k", F.col("v") > 1)
           .collect()}
    assert got["completeness"].value == 0.75 and not got["completeness"].passed
    assert got["schema_validity"].value == 0.5
    assert got["duplicate_rate"].value == 0.0 and got["duplicate_rate"].passed
    assert quality.feature_freshness(df, "updated_at", "2024-01-30").first().passed
    assert not quality.feature_freshness(df, "updated_at", "2024-01-31").first().passed
