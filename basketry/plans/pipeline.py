"""The batch job: files to lake, quality gate, features, model, lists, metrics.

Plain functions; each stage reads what the one before wrote to the lake, so a
stage can be repeated alone.  When and where stages run is left to whatever
starts them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.cleaning import null_tokens, parse_timestamp, to_key
from basketry.operators import factor_model, features, metrics, prepare, quality, ranking
from basketry.session import drop_scratch, scratch_paths
from basketry.sources import files
from basketry.sources.feature_store import FeatureStore, feature_definitions
from basketry.sources.lake import Lake


@dataclass(frozen=True)
class Params:
    """Folders, run date and settings of one run."""

    data: str
    base: str
    run_date: str
    products_file: str = "products.json"
    products_as_lines: bool = False
    quality_threshold: float = 0.95
    encoding: str = "label"
    scaling: str = "minmax"
    test_size: float = 0.2
    seed: int = 42
    rank: int = 50
    iterations: int = 20
    reg: float = 0.02
    top_k: int = 10
    k_values: tuple[int, ...] = (5, 10, 20)

    @property
    def run_ts(self) -> str:
        return f"{self.run_date} 00:00:00"


def lake(spark: SparkSession, p: Params) -> Lake:
    return Lake(spark, f"{p.base}/lake")


def store(spark: SparkSession, p: Params) -> FeatureStore:
    return FeatureStore(spark, f"{p.base}/store")


def together(*steps):
    """Run independent steps at the same time; Spark shares the cluster among their jobs."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def typed_interactions(text: DataFrame) -> DataFrame:
    """Interactions from text columns; both timestamp formats are read."""
    return (text.withColumn("user_id", to_key(null_tokens(F.col("user_id"))))
            .withColumn("item_id", to_key(null_tokens(F.col("item_id"))))
            .withColumn("view_mode", null_tokens(F.col("view_mode")))
            .withColumn("rating", to_key(null_tokens(F.col("rating"))).try_cast("int"))
            .withColumn("timestamp", parse_timestamp(F.col("timestamp"))))


def ingest(spark: SparkSession, p: Params) -> DataFrame:
    """Source files to the raw layer; gives the warnings of all three tables."""
    out = lake(spark, p)
    files.require_sources(spark, p.data, [p.products_file])

    def land(name: str, df: DataFrame) -> DataFrame:
        saved = out.save(df, "raw", name, p.run_date)
        out.save_profile(saved, "raw", name, p.run_date)
        return quality.ingest_warnings(saved, name)

    def users():
        text, refused = files.read_users(spark, p.data)
        return land("users", prepare.clean_raw_users(text)), refused

    def products():
        path = f"{p.data}/{p.products_file}"
        return land("products", files.read_products(spark, path, p.products_as_lines)), None

    def transactions():
        text, refused = files.read_interactions(spark, p.data)
        return land("transactions", typed_interactions(text)), refused

    (users_warn, bad_users), (products_warn, _), (rows_warn, bad_rows) = together(
        users, products, transactions)
    (bad_users.unionByName(bad_rows).coalesce(1).write.mode("overwrite")
     .json(f"{p.base}/quarantine/dt={p.run_date}"))
    warnings = users_warn.unionByName(products_warn).unionByName(rows_warn)
    path = f"{p.base}/warnings/dt={p.run_date}"
    warnings.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(warnings.schema).json(path)


def raw_tables(spark: SparkSession, p: Params) -> list[DataFrame]:
    return [lake(spark, p).as_of("raw", n, p.run_date)
            for n in ("users", "products", "transactions")]


def validate(spark: SparkSession, p: Params) -> float:
    """Run the rules, save the report as JSON, stop the run below the threshold."""
    users, products, rows = raw_tables(spark, p)
    path = f"{p.base}/quality/dt={p.run_date}"
    report = quality.validation_report(users, products, rows)
    report.coalesce(1).write.mode("overwrite").json(path)
    saved = spark.read.schema(report.schema).json(path)
    return quality.enforce_gate(quality.quality_scores(saved), p.quality_threshold)


def prepare_tables(spark: SparkSession, p: Params) -> None:
    out = lake(spark, p)
    users, products, rows = raw_tables(spark, p)
    clean_users, clean_products = together(
        lambda: out.save(prepare.clean_users(users, files.FILE_ORDER, p.encoding, p.scaling),
                         "prepared", "users", p.run_date),
        lambda: out.save(prepare.clean_products(products, files.FILE_ORDER, p.encoding,
                                                p.scaling),
                         "prepared", "products", p.run_date))
    clean_rows = out.save(prepare.clean_interactions(rows, clean_users, clean_products),
                          "prepared", "transactions", p.run_date)
    for name, df in (("users", clean_users), ("products", clean_products),
                     ("transactions", clean_rows)):
        encoded = [c for c in df.columns if f"{c}_encoded" in df.columns]
        if encoded:
            out.save(prepare.label_dictionary(df, encoded), "encoders", name, p.run_date)


def build_features(spark: SparkSession, p: Params) -> None:
    out = lake(spark, p)
    users, products, rows = [out.as_of("prepared", n, p.run_date)
                             for n in ("users", "products", "transactions")]
    made = {"user_features": features.user_features(rows, users, products),
            "item_features": features.item_features(rows, products),
            "interaction_features": features.interaction_features(rows)}
    together(*[lambda n=n, df=df: out.save(df, "features", n, p.run_date)
               for n, df in made.items()])


def publish(spark: SparkSession, p: Params) -> None:
    """Newest features to the feature store, definitions to its registry."""
    out, target = lake(spark, p), store(spark, p)
    for name, key in (("user_features", "user_id"), ("item_features", "item_id")):
        target.publish(name, out.as_of("features", name, p.run_date), key, p.run_ts)
    target.register(feature_definitions(spark), p.run_ts)


def train(spark: SparkSession, p: Params) -> factor_model.FactorModel:
    """Fit on the training part of the snapshots up to the run date and save the model."""
    rows = lake(spark, p).all_dates("features", "interaction_features", p.run_date)
    part, _ = factor_model.train_test_split(factor_model.rating_triples(rows), p.test_size, p.seed)
    return factor_model.fit_factor_model(part, p.rank, p.iterations, p.reg, p.seed,
                                         path=f"{p.base}/models/dt={p.run_date}")


def infer(spark: SparkSession, p: Params) -> DataFrame:
    """Top-k unseen items for every active user, saved by inference date."""
    model = factor_model.FactorModel.load(spark, f"{p.base}/models/dt={p.run_date}")
    rows = lake(spark, p).as_of("features", "interaction_features", p.run_date)
    path = f"{p.base}/processed"
    ranking.write_recommendations(factor_model.recommend(model, rows, p.top_k), path, p.run_date)
    return spark.read.parquet(f"{path}/recommendations/inference_date={p.run_date}")


def evaluate(spark: SparkSession, p: Params) -> DataFrame:
    """Ranking metrics of the model on the held-out pairs."""
    model = factor_model.FactorModel.load(spark, f"{p.base}/models/dt={p.run_date}")
    rows = lake(spark, p).all_dates("features", "interaction_features", p.run_date)
    known, held_out = factor_model.train_test_split(factor_model.rating_triples(rows),
                                                    p.test_size, p.seed)
    lists = factor_model.recommend(model, known, max(p.k_values))
    summary = metrics.summarise_metrics(metrics.ranking_metrics(lists, held_out, p.k_values))
    path = f"{p.base}/evaluation/dt={p.run_date}"
    summary.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(summary.schema).json(path)


def run(spark: SparkSession, p: Params) -> DataFrame:
    """All stages in order; gives the evaluation summary and drops the run's scratch tables."""
    before = scratch_paths(spark)
    ingest(spark, p)
    validate(spark, p)
    prepare_tables(spark, p)
    build_features(spark, p)
    publish(spark, p)
    train(spark, p)
    infer(spark, p)
    summary = evaluate(spark, p)
    drop_scratch(spark, before)
    return summary
