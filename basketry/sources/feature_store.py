"""Published feature tables, one Parquet folder per version, and their registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.operators.upsert import upsert
from basketry.schemas import FEATURE_REGISTRY
from basketry.sources.lake import child_folders, is_finished

# The definitions the registry starts with
# (name, type, description, data type, source, logic).
FEATURE_DEFINITIONS = [
    ("user_activity_count", "user", "Total number of user interactions", "INTEGER",
     "transactions", "COUNT(transactions WHERE user_id = X)"),
    ("avg_rating_given", "user", "Average rating given by user", "REAL",
     "transactions", "AVG(rating WHERE user_id = X)"),
    ("purchase_ratio", "user", "Proportion of interactions that are purchases", "REAL",
     "transactions", "COUNT(purchases) / COUNT(total_interactions)"),
    ("popularity_score", "item", "Number of interactions the item received", "INTEGER",
     "transactions", "COUNT(interactions WHERE item_id = Y)"),
    ("avg_item_rating", "item", "Average rating received by item", "REAL",
     "transactions", "AVG(rating WHERE item_id = Y)"),
    ("view_to_purchase_rate", "item", "Conversion rate from views to purchases", "REAL",
     "transactions", "COUNT(purchases) / COUNT(views)"),
]


def feature_definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FEATURE_DEFINITIONS, FEATURE_REGISTRY)


def select_by_ids(table: DataFrame, key: str, ids=None) -> DataFrame:
    """Rows of the given ids; all without ids.

    A list becomes a filter that reaches the scan, a single-column DataFrame a semi-join.
    """
    if ids is None:
        return table
    if not isinstance(ids, DataFrame):
        return table.where(F.col(key).isin(list(ids)))
    wanted = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    return table.join(wanted, key, "left_semi")


@dataclass(frozen=True)
class FeatureStore:
    """Versions are written beside each other; readers take the newest."""

    spark: SparkSession
    base: str

    def _root(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def _started(self, name: str) -> list[int]:
        folders = child_folders(self.spark, self._root(name))
        return sorted(int(f[8:]) for f in folders if f.startswith("version="))

    def versions(self, name: str) -> list[int]:
        """Versions whose publication came to its end."""
        return [v for v in self._started(name)
                if is_finished(self.spark, f"{self._root(name)}/version={v}")]

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        """The next version; of two publishers at once the second fails on the folder."""
        version = (self._started(name) or [0])[-1] + 1
        path = f"{self._root(name)}/version={version}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.parquet(path)

    def read(self, name: str) -> DataFrame:
        versions = self.versions(name)
        if not versions:
            raise FileNotFoundError(f"feature table {name} was never published")
        return self.spark.read.parquet(f"{self._root(name)}/version={versions[-1]}")

    def publish(self, name: str, df: DataFrame, key: str, run_ts: str) -> DataFrame:
        """Full replace; a null or repeated key stops the publication."""
        bad = (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
               .where((F.col("n") > 1) | F.col(key).isNull()).limit(1).collect())
        if bad:
            raise ValueError(f"{name}: {key} {bad[0][key]} is null or repeated")
        return self._write(name, df.withColumn("updated_at",
                                               F.lit(run_ts).cast("timestamp_ntz")))

    def lookup(self, name: str, key: str, ids=None) -> DataFrame:
        return select_by_ids(self.read(name), key, ids)

    def register(self, definitions: DataFrame, run_ts: str) -> DataFrame:
        """Insert or replace definitions by feature name."""
        stamp = F.lit(run_ts).cast("timestamp_ntz")
        new = (definitions.dropDuplicates(["feature_name"])
               .withColumn("created_at", stamp).withColumn("updated_at", stamp))
        if self.versions("feature_metadata"):
            new = upsert(self.registry(), new, ["feature_name"])
        return self._write("feature_metadata", new)

    def registry(self) -> DataFrame:
        return self.read("feature_metadata")

    def describe(self, name: str, key: str) -> DataFrame:
        """What a published table holds: ``feature_name, data_type, rows, published_at``."""
        table = self.read(name)
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL",
                 "float": "REAL"}
        columns = [F.struct(F.lit(f.name).alias("feature_name"),
                            F.lit(kinds.get(f.dataType.simpleString(), "TEXT")).alias("data_type"))
                   for f in table.schema.fields if f.name not in (key, "updated_at")]
        return (table.agg(F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("published_at"))
                .select(F.inline(F.array(*columns)), "rows", "published_at"))

    def export_registry(self, path: str) -> None:
        """One JSON record per feature."""
        self.registry().write.mode("overwrite").json(path)
