"""The registered queries: every operator over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from basketry.functions.cleaning import plausible_age
from basketry.functions.scores import RATING_HIGH, RATING_LOW
from basketry.operators import (content, eda, factor_model, features, metrics, prepare, profiling,
                                quality, ranking, sgd)
from basketry.plans import pipeline
from basketry.schemas import INTERACTION_COLUMNS, PRODUCT_COLUMNS, USER_COLUMNS, VIEW_MODES
from basketry.session import materialise, scratch_path, scratch_paths, shuffles_dropped
from basketry.sources import bindings, files
from basketry.sources.feature_store import FeatureStore, feature_definitions
from basketry.sources.keyed_table import KeyedTable
from basketry.sources.lake import Lake
from basketry.streaming import buffer, contract, jobs, windows

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

USER_ORDER = ["source_file", "row_seq"]
PRODUCT_ORDER = ["source_file"]
# The values that the wide one-hot table is asked for.
PRODUCT_VALUES = {"brand": [f"Brand#{i}" for i in range(1, 26)],
                  "category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: BIGINT, DOUBLE with 6 decimals, text timestamps."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.substring(c.cast("string"), 1, 19)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = lambda spark, folder: tidy(fn(spark, folder))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Prepared tables shared by several queries --------------------------------------

def users_prepared(spark, folder):
    return prepare.clean_users(bindings.users_raw(spark, folder), USER_ORDER)


def products_prepared(spark, folder):
    return prepare.clean_products(bindings.products_raw(spark, folder), PRODUCT_ORDER)


def users_known(spark, folder):
    return bindings.users_raw(spark, folder).select("user_id").distinct()


def products_known(spark, folder):
    return bindings.products_raw(spark, folder).select("item_id").distinct()


def interactions_prepared(spark, folder):
    return prepare.clean_interactions(
        bindings.interactions_raw(spark, folder), bindings.users_raw(spark, folder),
        bindings.products_raw(spark, folder))


def interactions_scored(spark, folder):
    """Read several times by the queries below, so it is written once, as in the lake."""
    return features.interaction_features(
        materialise(interactions_prepared(spark, folder), "interactions"))


def triples(spark, folder):
    return materialise(factor_model.rating_triples(interactions_scored(spark, folder)), "triples")


def order_pairs(spark, folder):
    """user_id and item_id of the order lines, joined once."""
    return materialise(bindings.order_interactions(spark, folder).select("user_id", "item_id"),
                       "pairs")


def order_triples(spark, folder):
    """user_id, item_id and score from the order lines, the large fact table."""
    facts = bindings.order_interactions(spark, folder)
    with shuffles_dropped(spark):
        return materialise(facts.groupBy("user_id", "item_id")
                           .agg(F.max("rating").cast("double").alias("score")), "order-triples")


def products_first(spark, folder):
    return prepare.keep_first(bindings.products_raw(spark, folder), ["item_id"], PRODUCT_ORDER)


# Cleaning -----------------------------------------------------------------------

@query
def users_ingest_clean(spark, folder):
    return bindings.users_raw(spark, folder)


@query
def users_dedup_first(spark, folder):
    return prepare.keep_first(bindings.users_raw(spark, folder), ["user_id"], USER_ORDER)


@query
def users_distinct_plausible(spark, folder):
    rows = prepare.distinct_rows(bindings.users_raw(spark, folder).select(*USER_COLUMNS))
    return rows.withColumn("age", plausible_age(F.col("age")))


@query
def users_clean(spark, folder):
    return users_prepared(spark, folder)


@query
def products_clean(spark, folder):
    return products_prepared(spark, folder)


@query
def products_one_hot(spark, folder):
    return prepare.one_hot(products_first(spark, folder), PRODUCT_VALUES,
                           ["item_id", "price", "rating"])


@query
def products_one_hot_sparse(spark, folder):
    rows = prepare.one_hot_sparse(products_first(spark, folder), ["brand", "category"])
    return rows.select("item_id", F.explode("one_hot").alias("entry", "value"))


@query
def products_standard_scaled(spark, folder):
    scaled = prepare.standard_scale(products_first(spark, folder), "price", "price_scaled")
    return prepare.standard_scale(scaled, "rating", "rating_scaled").select(
        "item_id", "price_scaled", "rating_scaled")


@query
def interactions_clean(spark, folder):
    return interactions_prepared(spark, folder)


# Quality ------------------------------------------------------------------------

def _report(spark, folder):
    return quality.validation_report(
        bindings.users_raw(spark, folder), bindings.products_raw(spark, folder),
        bindings.interactions_raw(spark, folder))


@query
def quality_users(spark, folder):
    return quality.check_users(bindings.users_raw(spark, folder))


@query
def quality_products(spark, folder):
    return quality.check_products(bindings.products_raw(spark, folder))


@query
def quality_interactions(spark, folder):
    return quality.check_interactions(
        bindings.interactions_raw(spark, folder), users_known(spark, folder),
        products_known(spark, folder))


@query
def quality_overall(spark, folder):
    return quality.quality_scores(_report(spark, folder))


@query
def quality_report_saved(spark, folder):
    """The report as JSON records, read back."""
    path, report = scratch_path(spark, "report"), _report(spark, folder)
    report.write.json(path)
    return spark.read.schema(report.schema).json(path)


@query
def quality_gate(spark, folder):
    return quality.quality_gate(quality.quality_scores(_report(spark, folder)), 0.90)


@query
def ingest_warnings(spark, folder):
    users = quality.ingest_warnings(bindings.users_raw(spark, folder), "users")
    products = quality.ingest_warnings(
        bindings.products_raw(spark, folder).drop("in_stock"), "products")
    rows = quality.ingest_warnings(bindings.interactions_raw(spark, folder), "transactions")
    return users.unionByName(products).unionByName(rows).drop("details")


@query
def fk_orphans(spark, folder):
    return quality.orphan_keys(bindings.interactions_raw(spark, folder),
                               users_known(spark, folder), "user_id")


@query
def invalid_modes(spark, folder):
    return quality.unknown_values(bindings.interactions_raw(spark, folder), "view_mode",
                                  VIEW_MODES)


@query
def quality_metrics(spark, folder):
    tables = {
        "users": (bindings.users_raw(spark, folder), USER_COLUMNS, "user_id",
                  F.col("age").between(18, 65)),
        "products": (bindings.products_raw(spark, folder), PRODUCT_COLUMNS, "item_id",
                     F.col("price") > 0),
        "transactions": (bindings.interactions_raw(spark, folder),
                         ("user_id", "item_id", "view_mode", "rating", "timestamp"), "event_id",
                         F.col("view_mode").isin(*VIEW_MODES))}
    every = None
    for name, (rows, columns, key, valid) in tables.items():
        one = (quality.pipeline_metrics(rows, list(columns), key, valid)
               .withColumn("dataset", F.lit(name)))
        every = one if every is None else every.unionByName(one)
    return every


@query
def feature_freshness(spark, folder):
    facts = bindings.order_interactions(spark, folder)
    published = facts.groupBy("item_id").agg(F.max("timestamp").alias("updated_at"))
    return quality.feature_freshness(published, "updated_at", "2001-12-01")


# Lake and profiles ----------------------------------------------------------------

@query
def snapshot_profile(spark, folder):
    return profiling.snapshot_profile(bindings.users_raw(spark, folder).select(*USER_COLUMNS))


@query
def snapshot_drift(spark, folder):
    raw = bindings.products_raw(spark, folder)
    old = raw.where("source_file = 'products_1'").drop("source_file")
    new = (raw.drop("in_stock", "source_file")
           .withColumn("rating", F.col("rating").cast("string"))
           .withColumn("discount", F.col("price") * 0.1))
    return profiling.snapshot_drift(profiling.snapshot_profile(old),
                                    profiling.snapshot_profile(new))


@query
def content_md5(spark, folder):
    return profiling.content_hash(bindings.users_raw(spark, folder), method="md5")


def _dated_lake(spark, folder):
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.save_by_date(bindings.table(spark, folder, "events"), "raw", "events", "ts")
    return lake


@query
def latest_partition(spark, folder):
    return _dated_lake(spark, folder).latest("raw", "events")


@query
def snapshot_as_of(spark, folder):
    return _dated_lake(spark, folder).as_of("raw", "events", "2024-01-15")


@query
def all_partitions(spark, folder):
    return _dated_lake(spark, folder).all_dates("raw", "events")


def _deliver_csv(df: DataFrame, inbox: str, name: str) -> None:
    """Write a table as CSV files with names as a sender gives them."""
    spark, part = df.sparkSession, scratch_path(df.sparkSession, "csv")
    files.write_csv(df, part)
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    source = jvm.Path(f"{part}/*.csv")
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.Path(inbox))
    for i, status in enumerate(fs.globStatus(source)):
        fs.rename(status.getPath(), jvm.Path(f"{inbox}/{name}_{i}.csv"))


@query
def users_csv_scan(spark, folder):
    inbox = scratch_path(spark, "inbox")
    text = bindings.users_text(spark, folder)
    _deliver_csv(text.where("source_file = 'users_1'").select(*USER_COLUMNS), inbox, "Users_old")
    _deliver_csv(text.where("source_file = 'users_2'").select("user_id", "gender", "age", "device"),
                 inbox, "new-USER-file")
    # Files without the required columns, or with other names, must not get in.
    _deliver_csv(text.select("user_id", "row_seq"), inbox, "user_matrix")
    _deliver_csv(text.select(*USER_COLUMNS), inbox, "people")
    rows, _ = files.read_users(spark, inbox)
    return prepare.clean_raw_users(rows).select(*USER_COLUMNS)


@query
def transactions_csv_scan(spark, folder):
    inbox = scratch_path(spark, "inbox")
    text = bindings.interactions_text(spark, folder).select(*INTERACTION_COLUMNS)
    _deliver_csv(text.where("view_mode = 'view'"), inbox, "transactions_views")
    _deliver_csv(text.where("view_mode <> 'view'"), inbox, "all TRANSACTIONS")
    rows, _ = files.read_interactions(spark, inbox)
    return pipeline.typed_interactions(rows).select(*INTERACTION_COLUMNS)


@query
def quarantined_files(spark, folder):
    """Files that the reader refuses, with the columns they lack."""
    inbox = scratch_path(spark, "inbox")
    text = bindings.users_text(spark, folder)
    _deliver_csv(text.select(*USER_COLUMNS).coalesce(1), inbox, "users")
    _deliver_csv(text.select("user_id", "row_seq").coalesce(1), inbox, "user_matrix")
    _, refused = files.read_users(spark, inbox)
    return refused.select(F.substring_index("path", "/", -1).alias("file"), "missing_columns")


@query
def products_json_scan(spark, folder):
    path = scratch_path(spark, "json")
    raw = bindings.products_raw(spark, folder).select(*PRODUCT_COLUMNS)
    raw.write.json(path)
    return files.read_products(spark, path, lines=True).select(*PRODUCT_COLUMNS)


# Features -------------------------------------------------------------------------

@query
def user_features(spark, folder):
    return features.user_features(bindings.order_interactions(spark, folder),
                                  users_prepared(spark, folder), products_prepared(spark, folder))


@query
def item_features(spark, folder):
    return features.item_features(bindings.order_interactions(spark, folder),
                                  products_prepared(spark, folder))


@query
def interaction_features(spark, folder):
    return interactions_scored(spark, folder)


@query
def feature_lookup(spark, folder):
    store = FeatureStore(spark, scratch_path(spark, "store"))
    stats = features.item_statistics(bindings.order_interactions(spark, folder))
    store.publish("item_features", stats, "item_id", "2024-02-01 00:00:00")
    wanted = bindings.table(spark, folder, "events").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"))
    return store.lookup("item_features", "item_id", wanted)


@query
def feature_upsert(spark, folder):
    facts = bindings.order_interactions(spark, folder)

    def version(rows, stamp):
        stats = features.item_statistics(rows).select("item_id", "popularity_score")
        return (stats.withColumn("created_at", F.lit(stamp).cast("timestamp_ntz"))
                .withColumn("updated_at", F.lit(stamp).cast("timestamp_ntz")))

    early = F.col("timestamp") < "1998-06-01"
    old = version(facts.where(early), "2024-01-01 00:00:00")
    new = version(facts.where(~early), "2024-02-01 00:00:00")
    table = KeyedTable(spark, scratch_path(spark, "keyed"), "item_id", old.schema)
    table.begin(old)
    table.upsert(new)
    return table.read()


@query
def feature_registry(spark, folder):
    """Definitions registered twice, with the types and rows of the tables that hold the features."""
    store = FeatureStore(spark, scratch_path(spark, "registry"))
    definitions = feature_definitions(spark)
    store.register(definitions, "2024-01-01 00:00:00")
    store.register(definitions.where("feature_type = 'item'"), "2024-02-01 00:00:00")
    facts = materialise(bindings.order_interactions(spark, folder), "facts")
    bought = F.count_if(F.col("view_mode") == "purchase") / F.count(F.lit(1))
    users = facts.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("user_activity_count"), F.avg("rating").alias("avg_rating_given"),
        bought.alias("purchase_ratio"))
    store.publish("user_features", users, "user_id", "2024-02-01 00:00:00")
    store.publish("item_features", features.item_statistics(facts), "item_id", "2024-02-01 00:00:00")
    held = store.describe("user_features", "user_id").unionByName(
        store.describe("item_features", "item_id"))
    return (store.registry().drop("data_type").join(F.broadcast(held), "feature_name")
            .withColumnRenamed("rows", "covered_ids").drop("published_at"))


# Recommendation ---------------------------------------------------------------------

@query
def rating_triples(spark, folder):
    return triples(spark, folder)


@query
def train_test_split(spark, folder):
    train, test = factor_model.train_test_split(triples(spark, folder))
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


@query
def popularity_topk(spark, folder):
    return ranking.popular_items(bindings.order_interactions(spark, folder), 20)


def _popularity_lists(facts, k):
    scores = (facts.groupBy("item_id").agg(F.count(F.lit(1)).cast("double").alias("score")))
    return ranking.unseen_topk(scores, facts, facts.select("user_id").distinct(), k)


@query
def unseen_topk(spark, folder):
    return _popularity_lists(order_pairs(spark, folder), 10)


@query
def baseline_predict(spark, folder):
    train, test = factor_model.train_test_split(triples(spark, folder))
    return factor_model.predict_baseline(train, test)


@query
def recommendation_sample(spark, folder):
    """Lists saved by date, and the small sample that is saved beside them."""
    path, lists = scratch_path(spark, "lists"), _baseline_lists(spark, folder)
    ranking.write_recommendations(lists, path, "2024-02-01")
    sample = spark.read.schema("user_id bigint, item_id bigint, predicted_score double, rank int, "
                               "inference_date string").json(f"{path}/sample")
    saved = spark.read.parquet(f"{path}/recommendations").agg(
        F.count(F.lit(1)).alias("n")).scalar()
    return sample.withColumn("saved_rows", saved)


@query
def model_saved_and_served(spark, folder):
    """A model that is saved, loaded again and asked for the list of one user."""
    loaded, rows = _model(spark, folder)
    path = scratch_path(spark, "saved-model")
    loaded.save(path)
    again = factor_model.FactorModel.load(spark, path)
    user = rows.agg(F.min("user_id")).first()[0]
    seen = ranking.seen_pairs(rows)
    one = _written(factor_model.recommend_for_user(
        again, user, rows.select("item_id").distinct(), seen.where(F.col("user_id") == user), 10))
    return ranking.list_facts(one, seen, RATING_LOW, RATING_HIGH)


def _facts(spark, values: dict) -> DataFrame:
    return spark.createDataFrame(list(values.items()), "fact string, value bigint")


@query
def sgd_quality(spark, folder):
    """Facts about a fit by gradient descent: who ordered what, with a taste laid into the scores.

    Customers with an odd key like parts with an odd key, those with an even key the others; what
    the ratings themselves say is left as noise.
    """
    likes = F.when((F.col("user_id") + F.col("item_id")) % 2 == 0, 1.2).otherwise(-1.2)
    rows = materialise(order_triples(spark, folder).withColumn(
        "score", 3 + likes + (F.col("score") - 3) / 10), "taste")
    train, test = factor_model.train_test_split(rows)
    fit = sgd.fit_sgd(train)
    told = fit.epoch_errors

    def error(predicted):
        return predicted.select(F.sqrt(F.avg((F.col("score") - F.col("prediction")) ** 2))).first()[0]

    held_out = error(fit.model.predict(test))
    return _facts(spark, {
        "train_rows": train.count(), "test_rows": test.count(), "epochs": len(told),
        "users": fit.model.user_factors.count(), "items": fit.model.item_factors.count(),
        "rising_epochs": sum(b >= a for a, b in zip(told, told[1:])),
        "no_better_than_biases": int(held_out >= error(factor_model.predict_baseline(train, test)))})


@query
def baseline_topk(spark, folder):
    return _baseline_lists(spark, folder)


@query
def baseline_topk_work(spark, folder):
    """How many of all user-item products the search of the same lists took."""
    work = ranking.SearchWork()
    lists = _baseline_lists(spark, folder, work=work, first_items=32)
    return _facts(spark, {"pairs": work.pairs, "list_rows": lists.count(),
                          "all_products": int(work.products >= work.pairs)})


def _baseline_lists(spark, folder, **search):
    """Mean and biases as two-entry vectors: the product search without factors."""
    rows = order_triples(spark, folder)
    mean, item_bias, user_bias = factor_model.bias_tables(rows)
    users = user_bias.select("user_id", F.array(mean + F.col("user_bias"), F.lit(1.0))
                             .alias("vector"))
    items = item_bias.select("item_id", F.array(F.lit(1.0), F.col("item_bias")).alias("vector"))
    # Equal scores must stay equal through the sum: a grid of 2**-20.
    def grid(v):
        return F.transform(v, lambda x: F.round(x * 2**20) / 2**20)
    return ranking.vector_topk(materialise(users.withColumn("vector", grid("vector")), "users"),
                               materialise(items.withColumn("vector", grid("vector")), "items"),
                               ranking.seen_pairs(rows), 10, RATING_LOW, RATING_HIGH, **search)


_SAVED: dict[tuple[str, str], str] = {}


def _model(spark, folder):
    """The model of a folder's orders, fitted and saved once per application, and the orders."""
    rows = order_triples(spark, folder)
    key = (spark.sparkContext.applicationId, folder)
    if _SAVED.get(key) not in scratch_paths(spark):
        path = scratch_path(spark, "model")
        train, _ = factor_model.train_test_split(rows)
        factor_model.fit_factor_model(train, path=path, blocks=factor_model.choose_blocks(train))
        _SAVED[key] = path
    return factor_model.FactorModel.load(spark, _SAVED[key]), rows


def _written(lists):
    with shuffles_dropped(lists.sparkSession):
        return materialise(lists, "lists")


@query
def als_topk(spark, folder):
    """Facts about the lists of a fitted model."""
    model, rows = _model(spark, folder)
    lists = _written(factor_model.recommend(model, rows, 10))
    return ranking.list_facts(lists, ranking.seen_pairs(rows), RATING_LOW, RATING_HIGH)


@query
def content_similar(spark, folder):
    return content.similar_items(products_first(spark, folder), 10)


@query
def hybrid_topk(spark, folder):
    """Facts about the blended lists of all users, those without orders too."""
    model, rows = _model(spark, folder)
    lists = _written(content.hybrid_topk(
        model, rows, products_first(spark, folder), 10, users=users_known(spark, folder)))
    # The blend of two parts within 0..1; the estimate may pass its scale a little.
    return ranking.list_facts(lists, ranking.seen_pairs(rows), -0.5, 1.5)


# Evaluation -------------------------------------------------------------------------

def _evaluation(spark, folder):
    pairs = materialise(ranking.seen_pairs(bindings.order_interactions(spark, folder)), "pairs")
    train, test = factor_model.train_test_split(pairs)
    return _popularity_lists(train, 20), test


@query
def rank_metrics(spark, folder):
    return metrics.ranking_metrics(*_evaluation(spark, folder))


@query
def rank_metrics_summary(spark, folder):
    return metrics.summarise_metrics(metrics.ranking_metrics(*_evaluation(spark, folder)))


# Exploration --------------------------------------------------------------------------

@query
def eda_describe(spark, folder):
    return eda.describe(bindings.products_raw(spark, folder), ["price", "rating"])


@query
def eda_distribution(spark, folder):
    return eda.distribution(bindings.users_raw(spark, folder), ["gender", "device"])


@query
def eda_histogram(spark, folder):
    return eda.histogram(bindings.products_raw(spark, folder), "price", 30)


@query
def eda_correlation(spark, folder):
    return eda.correlation(interactions_scored(spark, folder), [
        "rating", "implicit_score", "view_mode_encoded", "days_since", "user_item_affinity"])


@query
def eda_sparsity(spark, folder):
    return eda.matrix_sparsity(bindings.order_interactions(spark, folder),
                               users_known(spark, folder), products_known(spark, folder))


@query
def eda_activity(spark, folder):
    facts = order_pairs(spark, folder)
    return (eda.activity(facts, users_known(spark, folder), "user_id")
            .unionByName(eda.activity(facts, products_known(spark, folder), "item_id")))


@query
def eda_daily(spark, folder):
    return eda.daily_counts(bindings.order_interactions(spark, folder))


@query
def eda_rating_counts(spark, folder):
    return eda.rating_counts(interactions_prepared(spark, folder))


@query
def user_item_matrix(spark, folder):
    return eda.user_item_matrix(interactions_prepared(spark, folder), F.col("implicit_score"),
                                list(range(100)))


@query
def user_item_rows(spark, folder):
    rows = eda.user_item_rows(interactions_prepared(spark, folder), F.col("implicit_score"))
    return rows.select("user_id", F.explode("items").alias("item_id", "value"))


@query
def completeness(spark, folder):
    return (profiling.completeness(bindings.users_raw(spark, folder).select(*USER_COLUMNS), "users")
            .unionByName(profiling.completeness(
                bindings.products_raw(spark, folder).select(*PRODUCT_COLUMNS), "products")))


@query
def sample_values(spark, folder):
    return profiling.sample_values(bindings.users_raw(spark, folder).select(*USER_COLUMNS))


# Streams --------------------------------------------------------------------------------

def wire_events(events: DataFrame) -> DataFrame:
    """Events as messages: topic, JSON payload, arrival; some broken, some sent twice."""
    def every(n):
        return F.col("event_id") % n == 0

    stamp = F.col("ts").cast("string")
    user = F.to_json(F.struct(
        "user_id", (F.col("event_id") % 90 - 2).alias("age"),
        F.when(every(17), "X").when(every(2), "M").otherwise("F").alias("gender"),
        F.when(every(19), "Phone").when(every(3), "Mobile").otherwise("Tablet").alias("device")))
    rating = (F.when(every(31), None).when(every(67), "9").when(every(71), "good")
              .otherwise((1 + F.floor("value") % 5).cast("string")))
    transaction = F.to_json(F.struct(
        "user_id", F.get_json_object("props", "$.k").alias("item_id"),
        F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type"))
        .alias("view_mode"),
        rating.alias("rating"),
        F.when(every(13), None).when(every(89), "soon").otherwise(F.translate(stamp, " ", "T"))
        .alias("timestamp"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id")))
    is_user = F.col("event_type") == "signup"
    payload = F.when(is_user, user).otherwise(transaction)
    copies = F.when(every(10), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return events.select(
        F.when(is_user, contract.USER_TOPIC).otherwise(contract.TRANSACTION_TOPIC).alias("topic"),
        F.when(every(97), F.substring(payload, 1, 20)).otherwise(payload).alias("payload"),
        F.col("ts").alias("arrival"), F.explode(copies).alias("copy")).drop("copy")


def _event_stream(spark, folder):
    schema = bindings.table(spark, folder, "events").schema
    # As a pattern the path may be one file or a folder of files.
    return jobs.file_events(spark, f"{folder}/events.parque[t]", schema)


def _stream(spark, folder):
    return wire_events(_event_stream(spark, folder))


def _collect(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    jobs.append_files(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query
def stream_valid_events(spark, folder):
    events = contract.route(_stream(spark, folder), contract.TRANSACTION_TOPIC)
    return _collect(contract.accepted(contract.decode_transactions(events)), "valid")


@query
def stream_valid_users(spark, folder):
    events = contract.route(_stream(spark, folder), contract.USER_TOPIC)
    return _collect(contract.accepted(contract.decode_users(events)), "users")


@query
def stream_rejects(spark, folder):
    stream = _stream(spark, folder)
    users = contract.rejected(contract.decode_users(contract.route(stream, contract.USER_TOPIC)))
    rows = contract.rejected(contract.decode_transactions(
        contract.route(stream, contract.TRANSACTION_TOPIC)))
    return (_collect(users.union(rows), "rejects").groupBy("reasons")
            .agg(F.count(F.lit(1)).alias("events")))


@query
def stream_dedup(spark, folder):
    """Repeats over many files that arrive out of order, one file per micro-batch."""
    base = scratch_path(spark, "dedup")
    raw = bindings.table(spark, folder, "events")
    # Each file holds a slice of the keys, so stamps jump back with every file.
    (raw.withColumn("slice", F.col("event_id") % 20).repartitionByRange(20, "slice").drop("slice")
     .write.parquet(f"{base}/in"))
    stream = wire_events(jobs.file_events(spark, f"{base}/in", raw.schema, max_files=1,
                                          spread="event_id"))
    valid = contract.identified(contract.decode_transactions(
        contract.route(stream, contract.TRANSACTION_TOPIC)))
    jobs.append_unrepeated(valid, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(valid.schema).parquet(f"{base}/out").select(*valid.columns)


@query
def stream_window_counts(spark, folder):
    """Three deliveries, one micro-batch each: counts per item and day, and what came too late."""
    base = scratch_path(spark, "windows")
    raw = bindings.table(spark, folder, "events")
    for part in range(3):
        raw.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{base}/in")
        stream = wire_events(jobs.file_events(spark, f"{base}/in", raw.schema))
        valid = contract.accepted(contract.decode_transactions(
            contract.route(stream, contract.TRANSACTION_TOPIC)))
        windows.refresh_windows(valid, "item_id", base, f"{base}/checkpoint").awaitTermination()
    counted = windows.window_counts(spark, "item_id", base).select(
        F.lit("window").alias("kind"), "item_id", F.col("window_start").cast("string").alias("window_start"),
        "events", "purchases", "rating_sum")
    late = windows.late_events(spark, "item_id", base).groupBy(
        "item_id", F.date_trunc("day", "timestamp").cast("timestamp_ntz").cast("string")
        .alias("window_start")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("view_mode") == "purchase").alias("purchases"),
        F.coalesce(F.sum("rating"), F.lit(0)).alias("rating_sum"))
    return counted.unionByName(late.withColumn("kind", F.lit("late")))


@query
def stream_buffered(spark, folder):
    """Events in groups of 100, and the rest of each lane once it has waited."""
    base = scratch_path(spark, "buffer")
    events = _event_stream(spark, folder).select(
        "user_id", F.to_json(F.struct("event_id", "event_type")).alias("payload"))
    groups = buffer.in_groups(events, F.col("user_id") % 4, seconds=2)
    buffer.drain(buffer.append_groups(groups, f"{base}/out", f"{base}/checkpoint"), 2)
    sent = spark.read.schema(buffer.FLUSHED).parquet(f"{base}/out")
    return sent.groupBy("lane").agg(
        F.sum(F.size("payloads")).alias("events"), F.count(F.lit(1)).alias("groups"),
        F.count_if("full").alias("full_groups"), F.max("n").alias("largest"))


@query
def stream_item_counts(spark, folder):
    events = contract.route(_stream(spark, folder), contract.TRANSACTION_TOPIC)
    valid = contract.accepted(contract.decode_transactions(events))
    base = scratch_path(spark, "counts")
    jobs.fold_counts(valid, "item_id", f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return jobs.fresh_item_features(jobs.folded_counts(spark, "item_id", f"{base}/counts"))


@query
def stream_user_counts(spark, folder):
    events = contract.route(_stream(spark, folder), contract.TRANSACTION_TOPIC)
    valid = contract.accepted(contract.decode_transactions(events))
    base = scratch_path(spark, "counts")
    jobs.fold_counts(valid, "user_id", f"{base}/counts", f"{base}/checkpoint").awaitTermination()
    return jobs.fresh_user_features(jobs.folded_counts(spark, "user_id", f"{base}/counts"))


@query
def stream_new_files(spark, folder):
    """Two deliveries, two runs: the second run takes the new files only."""
    base = scratch_path(spark, "landing")
    events = bindings.table(spark, folder, "events")
    schema = events.schema
    runs = []
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{base}/in")
        stream = jobs.file_events(spark, f"{base}/in", schema)
        jobs.append_files(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        done = spark.read.schema(schema).parquet(f"{base}/out")
        runs.append(done.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
                    .withColumn("run", F.lit(half + 1)))
    return runs[0].unionByName(runs[1])


@query
def stream_staged_union(spark, folder):
    """Staged events join the next batch: union with the raw files."""
    events = contract.route(_stream(spark, folder), contract.TRANSACTION_TOPIC)
    decoded = contract.decode_transactions(events)
    base = scratch_path(spark, "staged")
    jobs.stage_events(decoded, f"{base}/staged", f"{base}/checkpoint").awaitTermination()
    raw = bindings.interactions_raw(spark, folder).select(
        "user_id", "item_id", "view_mode", "rating", "timestamp")
    both = jobs.with_staged(raw, spark, f"{base}/staged", contract.accepted(decoded).schema)
    return both.groupBy("view_mode").agg(F.count(F.lit(1)).alias("row_count"),
                                         F.sum("rating").alias("rating_sum"))


@query
def stream_wire_format(spark, folder):
    """Rows as key and JSON value, the shape of the Kafka sink, written as a stream."""
    rows = _event_stream(spark, folder).select(
        "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("event_type").alias("view_mode"), "ts")
    named = rows.withColumn("event_id", contract.event_id(
        F.col("user_id"), F.col("item_id"), F.col("ts")))
    return _collect(contract.encode_events(
        named, contract.TRANSACTION_TOPIC, ["user_id", "item_id", "view_mode", "event_id"],
        "user_id"), "wire")
