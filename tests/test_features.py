import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketry.functions import scores as S
from basketry.operators import features

ROWS = "user_id long, item_id long, view_mode string, rating int, timestamp timestamp_ntz"


def interactions(spark):
    t = datetime(2024, 1, 31, 12)
    return spark.createDataFrame([
        (1, 1, "view", 4, datetime(2024, 1, 1, 13)), (1, 2, "purchase", 5, t),
        (1, 3, "view", None, t), (1, 1, "add_to_cart", 3, t), (2, 3, "purchase", None, t),
        (3, 9, "other", 1, t)], ROWS)


def test_user_features(spark):
    users = spark.createDataFrame([(1, "M"), (2, "F"), (3, "F"), (4, "M")],
                                  "user_id long, gender string")
    products = spark.createDataFrame([(1, "B"), (2, "A"), (3, "A")],
                                     "item_id long, category string")
    got = {r.user_id: r for r in
           features.user_features(interactions(spark), users, products).collect()}
    # Two rows in A and two in B: the smaller name wins.
    assert (got[1].user_activity_count, got[1].avg_rating_given, got[1].purchase_ratio,
            got[1].preferred_category, got[1].gender) == (4, 4.0, 0.25, "A", "M")
    # Active, but without any rating: no mean.
    assert (got[2].avg_rating_given, got[2].purchase_ratio) == (None, 1.0)
    assert got[3].preferred_category == "Unknown" and got[3].user_activity_count == 1
    assert (got[4].user_activity_count, got[4].avg_rating_given, got[4].purchase_ratio,
            got[4].preferred_category) == (0, 0.0, 0.0, "Unknown")


def test_item_features(spark):
    products = spark.createDataFrame([(1,), (2,), (3,), (4,)], "item_id long")
    got = {r.item_id: r for r in features.item_features(interactions(spark), products).collect()}
    assert (got[1].popularity_score, got[1].avg_item_rating, got[1].purchase_count,
            got[1].view_count, got[1].view_to_purchase_rate) == (2, 3.5, 0, 1, 0.0)
    # Bought without a view: zero rate.
    assert got[2].view_to_purchase_rate == 0.0 and got[2].purchase_count == 1
    assert got[3].view_to_purchase_rate == 1.0 and got[3].avg_item_rating == 0.0
    assert (got[4].popularity_score, got[4].avg_item_rating, got[4].view_to_purchase_rate,
            got[4].purchase_count, got[4].view_count) == (0, 0.0, 0.0, None, None)


def test_interaction_features(spark):
    got = features.interaction_features(interactions(spark)).where(
        "user_id = 1 AND view_mode = 'view' AND rating = 4").first()
    # 29 days and 23 hours are 29 whole days.
    assert got.days_since == 29
    assert got.recency_weight == pytest.approx(math.exp(-29 / 30))
    assert got.rating_normalized == 0.75
    assert got.user_item_affinity == pytest.approx(0.1 + 0.375 + 0.2 * math.exp(-29 / 30))


def test_interaction_features_without_columns(spark):
    df = interactions(spark)
    no_rating = features.interaction_features(df.drop("rating")).where("item_id = 2").first()
    assert no_rating.user_item_affinity == 1.0
    no_time = features.interaction_features(df.drop("timestamp")).where("item_id = 2").first()
    assert no_time.recency_weight == 1.0 and no_time.user_item_affinity == pytest.approx(1.0)


def test_formula_examples(spark):
    row = spark.range(1).select(
        S.recency_weight(F.lit(5)).alias("w5"), S.recency_weight(F.lit(60)).alias("w60"),
        S.affinity(F.lit(1), S.rating_to_unit(F.lit(4)), F.lit(0.9)).alias("a"),
        S.ratio_or_zero(F.lit(3), F.lit(0)).alias("none"),
        S.clamp_rating(F.lit(7.0)).alias("top"), S.unit_to_rating(F.lit(0.5)).alias("mid")).first()
    assert round(row.w5, 3) == 0.846 and round(row.w60, 3) == 0.135
    assert row.a == pytest.approx(0.655)
    assert (row.none, row.top, row.mid) == (0.0, 5.0, 3.0)


def test_whole_days_rounds_down(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2), datetime(2024, 1, 3, 23)),
                                (datetime(2024, 1, 3, 1), datetime(2024, 1, 2))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(S.whole_days(F.col("a"), F.col("b"))).collect()]
    assert got == [1, -2]
