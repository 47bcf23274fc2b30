"""Data-quality rules: one aggregation per table, unpivoted to one row per rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.cleaning import in_domain, in_range, positive
from basketry.schemas import (DEVICES, GENDERS, INTERACTION_COLUMNS, PRODUCT_COLUMNS,
                              USER_COLUMNS, VIEW_MODES)


@dataclass(frozen=True)
class Rule:
    """A check on one table.

    ``kind`` is ``rate`` (share of rows, passes at or above the threshold) or
    ``count`` (offending rows, passes at or below it).  ``needs`` lists the
    columns without which the rule does not apply.
    """

    check: str
    kind: str
    measure: Column
    threshold: float
    wording: str
    needs: tuple[str, ...] = ()
    severity: str = "error"


def share(test: Column) -> Column:
    """Share of rows passing a test; null on an empty table."""
    return F.avg(test.cast("double"))


def duplicate_count(key: str) -> Column:
    """Rows beyond the first per key; null keys are equal to each other."""
    has_null = F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return F.count(F.lit(1)) - F.count_distinct(F.col(key)) - has_null


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def run_rules(df: DataFrame, dataset: str, rules: list[Rule]) -> DataFrame:
    """One row per rule: dataset, check, severity, kind, value, threshold, passed, details."""
    rules = [r for r in rules if set(r.needs) <= set(df.columns)]
    values = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[r.measure.cast("double").alias(f"_m{i}") for i, r in enumerate(rules)])
    return _as_report(values, dataset, rules)


def _as_report(values: DataFrame, dataset: str, rules: list[Rule]) -> DataFrame:
    def entry(i: int, r: Rule) -> Column:
        value = F.col(f"_m{i}")
        if r.kind == "rate":
            passed, shown = value >= r.threshold, F.format_string("%.1f%%", value * 100)
        else:
            passed, shown = value <= r.threshold, value.cast("bigint").cast("string")
        return F.struct(
            F.lit(r.check).alias("check"), F.lit(r.severity).alias("severity"),
            F.lit(r.kind).alias("kind"), value.alias("value"),
            F.lit(float(r.threshold)).alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            F.concat(F.when(value.isNotNull(), shown).otherwise("no rows:"),
                     F.lit(" " + r.wording)).alias("details"))

    entries = F.array(*[entry(i, r) for i, r in enumerate(rules)])
    return values.select(F.lit(dataset).alias("dataset"), F.col("_rows").alias("record_count"),
                         F.inline(entries))


def key_match_rate(df: DataFrame, dimension: DataFrame, key: str) -> Column:
    """Share of rows whose key occurs in the dimension, as a scalar subquery.

    Rows are counted per key before the join: a hot key is one row in it.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = dimension.select(key).distinct().withColumn("_known", F.lit(True))
    matched = F.sum(F.when(F.col("_known"), F.col("_n")).otherwise(F.lit(0)))
    return (per_key.join(known, key, "left")
            .agg((matched / F.sum("_n")).cast("double")).scalar())


# Names, wordings and thresholds of the rules are part of the reports.

def user_rules(age_low: int = 18, age_high: int = 65) -> list[Rule]:
    return [
        Rule("user_id_unique", "count", duplicate_count("user_id"), 0, "duplicates found",
             ("user_id",)),
        Rule(f"age_in_range_{age_low}_{age_high}", "rate",
             share(in_range(F.col("age"), age_low, age_high)), 0.95, "within range", ("age",)),
        Rule("gender_valid", "rate", share(in_domain(F.col("gender"), GENDERS)), 0.95,
             "valid values", ("gender",)),
        Rule("device_valid", "rate", share(in_domain(F.col("device"), DEVICES)), 0.95,
             "valid values", ("device",)),
        Rule("no_null_user_ids", "count", null_count("user_id"), 0, "nulls in user_id",
             ("user_id",)),
    ]


def product_rules() -> list[Rule]:
    return [
        Rule("item_id_unique", "count", duplicate_count("item_id"), 0, "duplicates found",
             ("item_id",)),
        Rule("price_positive", "rate", share(positive(F.col("price"))), 0.99, "positive prices",
             ("price",)),
        Rule("rating_in_range_1_5", "rate", share(in_range(F.col("rating"), 1.0, 5.0)), 0.95,
             "within range", ("rating",)),
        *[Rule(f"{c}_not_null", "count", null_count(c), 0, f"nulls in {c}", (c,))
          for c in ("item_id", "price", "category")],
    ]


def interaction_rules(user_match: Column | None, item_match: Column | None) -> list[Rule]:
    """``*_match`` are key match rates; None leaves the rule out."""
    rules = []
    if user_match is not None:
        rules.append(Rule("user_id_foreign_key", "rate", user_match, 0.90,
                          "valid user references", ("user_id",)))
    if item_match is not None:
        rules.append(Rule("item_id_foreign_key", "rate", item_match, 0.90,
                          "valid item references", ("item_id",)))
    return rules + [
        Rule("view_mode_valid", "rate", share(in_domain(F.col("view_mode"), VIEW_MODES)), 0.99,
             "valid interaction types", ("view_mode",)),
        Rule("rating_in_range_1_5", "rate", share(in_range(F.col("rating"), 1, 5)), 0.95,
             "within range", ("rating",)),
        Rule("timestamp_valid", "rate", share(F.col("timestamp").isNotNull()), 0.99,
             "valid timestamps", ("timestamp",)),
    ]


def check_users(users: DataFrame) -> DataFrame:
    return run_rules(users, "users", user_rules())


def check_products(products: DataFrame) -> DataFrame:
    return run_rules(products, "products", product_rules())


def check_interactions(interactions: DataFrame, users: DataFrame,
                       products: DataFrame) -> DataFrame:
    return run_rules(interactions, "transactions", interaction_rules(
        key_match_rate(interactions, users, "user_id"),
        key_match_rate(interactions, products, "item_id")))


def validation_report(users: DataFrame, products: DataFrame,
                      interactions: DataFrame) -> DataFrame:
    """All rules of the three tables."""
    return (check_users(users).unionByName(check_products(products))
            .unionByName(check_interactions(interactions, users, products)))


def quality_scores(report: DataFrame) -> DataFrame:
    """Passed over total checks per dataset, and ``overall``."""
    ones = report.where(F.col("severity") == "error").select(
        F.explode(F.array(F.col("dataset"), F.lit("overall"))).alias("dataset"), "passed")
    return (ones.groupBy("dataset")
            .agg(F.count(F.lit(1)).alias("total_checks"),
                 F.count_if("passed").alias("passed_checks"))
            .withColumn("quality_score", F.col("passed_checks") / F.col("total_checks")))


def quality_gate(scores: DataFrame, threshold: float = 0.95) -> DataFrame:
    """The overall score against the threshold, one row."""
    return (scores.where(F.col("dataset") == "overall")
            .select("quality_score", F.lit(float(threshold)).alias("threshold"),
                    (F.col("quality_score") >= threshold).alias("passed")))


def enforce_gate(scores: DataFrame, threshold: float = 0.95) -> float:
    """Raise when the overall score is below the threshold; return it otherwise."""
    row = quality_gate(scores, threshold).first()
    if row is None or not row["passed"]:
        score = None if row is None else row["quality_score"]
        raise ValueError(f"data quality {score} is below {threshold}")
    return row["quality_score"]


# Structural checks at ingest: they warn and never stop a run ----------------

def missing_columns(df: DataFrame, expected) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def ingest_warnings(df: DataFrame, dataset: str) -> DataFrame:
    """Null critical columns, duplicate ids and unknown types as warnings."""
    unknown_mode = ~F.coalesce(F.col("view_mode").isin(*VIEW_MODES), F.lit(False))
    rules = {
        "users": [Rule("duplicate_user_id", "count", duplicate_count("user_id"), 0,
                       "duplicate ids", ("user_id",), "warn")],
        "products": [
            *[Rule(f"null_{c}", "count", null_count(c), 0, f"nulls in {c}", (c,), "warn")
              for c in ("item_id", "price", "category")],
            Rule("duplicate_item_id", "count", duplicate_count("item_id"), 0, "duplicate ids",
                 ("item_id",), "warn")],
        "transactions": [Rule("invalid_view_mode", "count", F.count_if(unknown_mode), 0,
                              "rows of unknown type", ("view_mode",), "warn")],
    }[dataset]
    expected = {"users": USER_COLUMNS, "products": PRODUCT_COLUMNS,
                "transactions": INTERACTION_COLUMNS}[dataset]
    absent = missing_columns(df, expected)
    rules.append(Rule("missing_columns", "count", F.max(F.lit(len(absent))), 0,
                      "expected columns missing" + "".join(f" {c}" for c in absent),
                      (), "warn"))
    return run_rules(df, dataset, rules)


def unknown_values(df: DataFrame, column: str, domain) -> DataFrame:
    """Distinct values outside the domain with their row counts; null is one of them."""
    return (df.where(~F.coalesce(F.col(column).isin(*domain), F.lit(False)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("row_count")))


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys without a match in the dimension, with their row counts."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.join(dimension.select(key), key, "left_anti")


def pipeline_metrics(df: DataFrame, required: list[str], key: str, valid: Column) -> DataFrame:
    """Completeness, schema validity and duplicate rate against their targets."""
    cells = F.count(F.lit(1)) * len(required)
    filled = sum((F.count(c) for c in required[1:]), F.count(required[0]))
    rows = df.agg(
        (filled / F.nullif(cells, F.lit(0))).alias("completeness"),
        share(F.coalesce(valid, F.lit(False))).alias("schema_validity"),
        (duplicate_count(key) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("duplicate_rate"))

    def entry(name: str, target: float, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), F.col(name).alias("value"),
                        F.lit(target).alias("target"),
                        F.coalesce(passed, F.lit(False)).alias("passed"))

    return rows.select(F.inline(F.array(
        entry("completeness", 0.98, F.col("completeness") >= 0.98),
        entry("schema_validity", 1.0, F.col("schema_validity") >= 1.0),
        entry("duplicate_rate", 0.01, F.col("duplicate_rate") < 0.01))))


def feature_freshness(df: DataFrame, updated_at: str, run_date: str,
                      max_days: int = 1) -> DataFrame:
    """Days between the newest feature update and the run date."""
    days = F.datediff(F.lit(run_date).cast("date"), F.max(updated_at).cast("date"))
    return (df.agg(days.alias("age_days"))
            .withColumn("passed", F.coalesce(F.col("age_days") < max_days, F.lit(False))))
