import pytest
from pyspark.sql import functions as F

from basketry.operators import prepare
from basketry.operators.upsert import upsert

USERS = "user_id long, age double, gender string, device string, source_file string, row_seq long"
PRODUCTS = ("item_id long, price double, brand string, category string, rating double, "
            "in_stock boolean, source_file string")


def test_keep_first_in_file_order(spark):
    df = spark.createDataFrame([(1, "b", 2, "later"), (1, "a", 9, "first"), (1, "a", 10, "second"),
                                (None, "a", 1, "null"), (None, "a", 2, "null again")],
                               "k long, f string, s long, v string").repartition(4)
    got = prepare.keep_first(df, ["k"], ["f", "s"]).collect()
    assert sorted((str(r.k), r.v) for r in got) == [("1", "first"), ("None", "null")]


def test_keep_first_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    plan = prepare.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert prepare.distinct_rows(df).count() == 2


def test_clean_users(spark):
    rows = [(1, 20.0, "M", "Mobile", "f", 1), (2, 40.0, "F", "Tablet", "f", 2),
            (3, None, None, None, "f", 3), (1, 99.0, "F", "Phone", "g", 1),
            (4, 30.0, "F", "Mobile", "f", 4)]
    got = {r.user_id: r for r in prepare.clean_users(
        spark.createDataFrame(rows, USERS), ["source_file", "row_seq"]).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert (got[3].age, got[3].gender, got[3].device) == (30.0, "F", "Mobile")
    assert [got[i].gender_encoded for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [got[i].device_encoded for i in (1, 2)] == [0, 1]
    assert [got[i].age_normalized for i in (1, 2, 4)] == [0.0, 1.0, 0.5]


def test_clean_users_without_any_value(spark):
    rows = [(1, None, None, None, "f", 1), (2, None, None, None, "f", 2)]
    got = prepare.clean_users(spark.createDataFrame(rows, USERS), ["row_seq"]).collect()
    assert {(r.age, r.gender, r.device, r.age_normalized) for r in got} == \
        {(None, "M", "Mobile", None)}


def test_mode_takes_the_smaller_value_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    got = prepare.fill_mode(df, "v", "z").where("v = 'a'").count()
    assert got == 3


def test_clean_products(spark):
    rows = [(1, 10.0, "x", "A", 4.0, True, "f"), (2, 20.0, "y", "A", None, True, "f"),
            (3, None, "x", "A", 2.0, False, "f"), (4, None, "x", None, 3.0, True, "f"),
            (5, None, "z", "B", 3.0, True, "f"), (6, 40.0, None, "C", 3.0, True, "f"),
            (1, 77.0, "x", "A", 1.0, True, "g")]
    got = {r.item_id: r for r in prepare.clean_products(
        spark.createDataFrame(rows, PRODUCTS), ["source_file"]).collect()}
    assert got[1].price == 10.0 and got[3].price == 15.0
    # A null category and a category without any price stay as they are.
    assert got[4].price is None and got[5].price is None
    assert got[4].price_tier is None and got[4].price_normalized is None
    assert got[2].rating == pytest.approx(3.0)
    # Sorted labels; null is the class "None".
    assert [got[i].category_encoded for i in (1, 5, 6, 4)] == [0, 1, 2, 3]
    assert [got[i].brand_encoded for i in (6, 1, 2, 5)] == [0, 1, 2, 3]
    assert [got[i].price_tier for i in (1, 3, 2, 6)] == ["low", "medium", "high", "high"] or \
        [got[i].price_tier for i in (1, 3, 2, 6)] == ["low", "low", "medium", "high"]


def test_label_codes_follow_the_sorted_labels(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), (None, 2), ("B", 3), ("é", 4)],
                               "v string, w int")
    rows = prepare.encode_labels(df, ["v", "w"]).collect()
    want = {"B": 0, "None": 1, "a": 2, "b": 3, "é": 4}
    assert len(rows) == 5 and all(r.v_encoded == want[str(r.v)] for r in rows)
    assert all(r.w_encoded == r.w - 1 for r in rows)


def test_default_label_only_where_there_is_none(spark):
    df = spark.createDataFrame([(None, "x"), (None, None)], "v string, w string")
    fitted = prepare.fit_labels(df, ["v", "w"], {"v": "Other", "w": "Else"})
    assert [tuple(r) for r in fitted["v"].dictionary.collect()] == [("Other", 0)]
    assert [tuple(r) for r in fitted["w"].dictionary.collect()] == [("x", 0)]


def test_label_not_seen_at_fit_time_is_null(spark):
    codes = prepare.fit_labels(spark.createDataFrame([("a",), ("b",)], "v string"), ["v"])["v"]
    got = codes.encode(spark.createDataFrame([("b",), ("c",)], "v string")).orderBy("v").collect()
    assert [r.v_encoded for r in got] == [1, None]
    assert sorted(map(tuple, codes.dictionary.collect())) == [("a", 0), ("b", 1)]


def test_scaling_edge_cases(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0), (None, None)], "c double, x double")
    got = prepare.standard_scale(prepare.min_max_scale(df, "c", "c1"), "x", "x1").collect()
    assert [r.c1 for r in got] == [0.0, 0.0, None]
    assert [r.x1 for r in got] == [-1.0, 1.0, None]


def test_tiers_on_tied_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 5 + [(2.0,), (None,)], "p double")
    got = prepare.quantile_tiers(df, "p", "t").groupBy("t").count().collect()
    assert {r.t: r["count"] for r in got} == {"low": 5, "high": 1, None: 1}


def test_tier_shares_on_distinct_prices(spark):
    df = spark.range(100).select((F.col("id") * 1.5).alias("p"))
    got = {r.t: r["count"] for r in prepare.quantile_tiers(df, "p", "t").groupBy("t").count()
           .collect()}
    assert all(abs(n - 100 / 3) <= 1 for n in got.values()) and sum(got.values()) == 100


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, v string")
    got = prepare.one_hot(df, {"v": ["a", "b"]}, ["i"])
    assert got.columns == ["i", "v_a", "v_b"]
    assert [tuple(r) for r in got.orderBy("i").collect()] == \
        [(1, 1.0, 0.0), (2, 0.0, 1.0), (3, 0.0, 0.0)]
    sparse = prepare.one_hot_sparse(df, ["v"]).orderBy("i").collect()
    assert [r.one_hot for r in sparse] == [{"v_a": 1.0}, {"v_b": 1.0}, {}]


def test_clean_interactions(spark):
    rows = spark.createDataFrame(
        [(1, 1, "view", "2024-01-01"), (9, 1, "view", "2024-01-01"), (1, 9, "view", "2024-01-01"),
         (1, 2, "purchase", None), (2, 2, "error", "2024-01-02"), (None, 1, "view", "2024-01-01"),
         (2, 1, "add_to_cart", "2024-01-03")],
        "user_id long, item_id long, view_mode string, t string").withColumn(
        "timestamp", F.col("t").cast("timestamp_ntz")).drop("t")
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    items = spark.createDataFrame([(1,), (2,)], "item_id long")
    got = prepare.clean_interactions(rows, users, items).orderBy("user_id", "item_id").collect()
    assert [(r.user_id, r.item_id, r.view_mode_encoded, r.implicit_score) for r in got] == \
        [(1, 1, 2, 1), (2, 1, 0, 2), (2, 2, 1, None)]
    nobody = prepare.clean_interactions(rows, users.limit(0), items)
    assert nobody.count() == 0


def test_one_hot_and_standard_options(spark):
    rows = [(1, 20.0, "M", "Mobile", "f", 1), (2, 40.0, "F", "Tablet", "f", 2)]
    got = prepare.clean_users(spark.createDataFrame(rows, USERS), ["row_seq"], "one_hot",
                              "standard").orderBy("user_id").collect()
    assert [r.one_hot for r in got] == [{"gender_M": 1.0, "device_Mobile": 1.0},
                                        {"gender_F": 1.0, "device_Tablet": 1.0}]
    assert [r.age_normalized for r in got] == [-1.0, 1.0]
    with pytest.raises(ValueError):
        prepare.encode_columns(spark.createDataFrame(rows, USERS), ["gender"], "hash")


def test_upsert_keeps_created_at(spark):
    old = spark.createDataFrame([("a", 1, "t0", "t0"), ("b", 2, "t0", "t0")],
                                "k string, v int, created_at string, updated_at string")
    new = spark.createDataFrame([("b", None, "t1", "t1"), ("c", 3, "t1", "t1")], old.schema)
    got = sorted(map(tuple, upsert(old, new, ["k"]).collect()))
    assert got == [("a", 1, "t0", "t0"), ("b", None, "t0", "t1"), ("c", 3, "t1", "t1")]
