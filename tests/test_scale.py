"""Plans and results when nothing may be broadcast and one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from basketry.operators import features, prepare, quality, ranking

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}
N = 200_000


@pytest.fixture
def large(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def rows(large):
    """User 0 and item 0 hold a third of the rows each."""
    i = F.col("id")
    return large.range(0, N, 1, 16).select(
        F.when(i % 3 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(5_000))).cast("bigint")
        .alias("user_id"),
        F.when(i % 3 == 1, 0).otherwise(F.pmod(F.hash(i + 7), F.lit(700))).cast("bigint")
        .alias("item_id"),
        F.when(i % 5 == 0, "purchase").otherwise("view").alias("view_mode"),
        (i % 5 + 1).cast("int").alias("rating"),
        F.expr("timestampadd(HOUR, CAST(id % 900 AS INT), TIMESTAMP_NTZ'2024-01-01')")
        .alias("timestamp"))


def dimension(spark, key, n):
    return spark.range(n).select(F.col("id").alias(key), F.concat(
        F.lit("c"), (F.col("id") % 6).cast("string")).alias("category"))


def run(df):
    """Rows and the final adaptive plan."""
    got = df.collect()
    return got, df._jdf.queryExecution().executedPlan().toString()


def test_key_filter_splits_the_hot_key(large, rows):
    users = dimension(large, "user_id", 4_000)
    got, plan = run(prepare.keep_known(rows, users, "user_id").groupBy("view_mode").count())
    assert "skew=true" in plan
    assert sum(r["count"] for r in got) == rows.where("user_id < 4000").count()


def test_user_features_split_the_hot_item(large, rows):
    users, products = dimension(large, "user_id", 5_000), dimension(large, "item_id", 700)
    got, plan = run(features.user_features(rows, users.drop("category"), products))
    assert "skew=true" in plan and len(got) == 5_000
    hot = next(r for r in got if r.user_id == 0)
    assert hot.user_activity_count == rows.where("user_id = 0").count() > N / 3


def test_item_features_need_one_shuffle_of_the_facts(large, rows):
    """The aggregate and the join share the partitioning by item."""
    plan = features.item_features(rows, dimension(large, "item_id", 700)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(item_id") == 2
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(item_id")


def test_match_rate_counts_keys_before_the_join(large, rows):
    rate = quality.key_match_rate(rows, dimension(large, "user_id", 4_000), "user_id")
    got = large.range(1).select(rate).first()[0]
    assert got == pytest.approx(rows.where("user_id < 4000").count() / N)


def test_unseen_lists_of_a_hot_user(large, rows):
    scores = rows.groupBy("item_id").agg(F.count("*").cast("double").alias("score"))
    users = rows.select("user_id").distinct()
    got = ranking.unseen_topk(scores, rows, users, 10)
    assert got.join(rows, ["user_id", "item_id"], "left_semi").count() == 0
    order = {r.item_id: n for n, r in enumerate(
        scores.orderBy(F.desc("score"), "item_id").collect())}
    seen = {r.item_id for r in rows.where("user_id = 0").select("item_id").distinct().collect()}
    want = sorted(set(order) - seen, key=order.get)[:10]
    assert [r.item_id for r in got.where("user_id = 0").orderBy("rank").collect()] == want


def test_hot_key_dedupe(large, rows):
    got, plan = run(prepare.keep_first(rows, ["user_id"], ["timestamp", "item_id"]))
    assert len(got) == rows.select("user_id").distinct().count()
    assert plan.count("WindowGroupLimit") >= 2


def test_no_query_plan_has_a_cross_join(large, rows):
    users, products = dimension(large, "user_id", 500), dimension(large, "item_id", 700)
    for df in (features.user_features(rows, users, products.withColumn("x", F.lit(1))
                                      .drop("x")),
               features.interaction_features(rows),
               quality.validation_report(
                   users.withColumn("age", F.lit(3.0)),
                   products.withColumn("price", F.lit(2.0)), rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
