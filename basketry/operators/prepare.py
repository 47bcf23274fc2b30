"""Cleaning: keep-first, imputation, encoding, scaling, binning, key filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.cleaning import clean_text, null_tokens, to_key, to_number
from basketry.functions.positions import global_position
from basketry.functions.quantiles import exact_percentiles
from basketry.functions.scores import implicit_score
from basketry.schemas import DEFAULT_DEVICE, DEFAULT_GENDER, NULL_LABEL, PRICE_TIERS
from basketry.session import materialise

# Rows ----------------------------------------------------------------------

def clean_raw_users(df: DataFrame) -> DataFrame:
    """Type the text columns of ingested users; rows without a usable id go."""
    return df.withColumns({
        "user_id": to_key(null_tokens(F.col("user_id"))),
        "age": to_number(null_tokens(F.col("age"))),
        "gender": clean_text(null_tokens(F.col("gender"))),
        "device": clean_text(null_tokens(F.col("device"))),
    }).where(F.col("user_id").isNotNull())


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """First row per key in the given order.

    Catalyst turns the ``== 1`` filter into a per-task limit ahead of the
    shuffle, so a hot key sends one row per input partition.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedupe."""
    return df.distinct()


def keep_known(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in the dimension."""
    return df.join(dimension.select(key), key, "left_semi")


# Imputation ----------------------------------------------------------------

def median_of(df: DataFrame, column: str) -> Column:
    """Global median as a scalar subquery."""
    return exact_percentiles(df, column, [0.5]).select(F.col("q")[0]).scalar()


def mode_of(df: DataFrame, column: str) -> Column:
    """Most frequent value, smallest on a tie, as a scalar subquery."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), F.asc(column)).limit(1).select(column).scalar())


def fill_median(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), median_of(df, column)))


def fill_mode(df: DataFrame, column: str, default: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), mode_of(df, column), F.lit(default)))


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def fill_group_median(df: DataFrame, column: str, by: str) -> DataFrame:
    """Median of the row's group; a null group or an all-null group stays null."""
    medians = materialise(exact_percentiles(df.where(F.col(by).isNotNull()), column, [0.5], [by])
                          .select(by, F.col("q")[0].alias("_median")), "medians")
    return (df.join(medians, by, "left")
            .withColumn(column, F.coalesce(F.col(column), F.col("_median")))
            .select(*df.columns))


# Encoding ------------------------------------------------------------------

def as_label(column: Column) -> Column:
    """Encoder input: null is a class of its own, named ``None``."""
    return F.coalesce(column.cast("string"), F.lit(NULL_LABEL))


@dataclass(frozen=True)
class LabelCodes:
    """Sorted distinct labels of a column and their codes 0..n-1, as a written table."""

    column: str
    dictionary: DataFrame  # label, code

    def encode(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """Add the code column; a label not seen at fit time gives null."""
        output = output or f"{self.column}_encoded"
        codes = self.dictionary.select(F.col("label").alias("_label"),
                                       F.col("code").cast("int").alias(output))
        return (df.join(codes, as_label(F.col(self.column)) == F.col("_label"), "left")
                .drop("_label"))


def fit_labels(df: DataFrame, columns: list[str],
               filled_with: dict[str, str] | None = None) -> dict[str, LabelCodes]:
    """Fit the encodings of several columns in one pass and one sort.

    ``filled_with`` fits mode-filled columns on the rows before the fill: nulls
    take the mode, which is among the labels, or the given default when there
    is no label at all.
    """
    defaults = filled_with or {}
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(c).cast("string") if c in defaults
                                            else as_label(F.col(c))).alias("label"))
        for c in columns]))).where(F.col("label").isNotNull()).distinct()
    if defaults:
        pairs = materialise(pairs, "labels")
        spare = df.sparkSession.createDataFrame(list(defaults.items()), pairs.schema)
        pairs = pairs.unionByName(spare.join(pairs, "column", "left_anti"))
    ranked = global_position(pairs, [F.asc("column"), F.asc("label")], "at")
    first = ranked.groupBy("column").agg(F.min("at").alias("first"))  # a row per column
    codes = materialise(ranked.join(F.broadcast(first), "column").select(
        "column", "label", (F.col("at") - F.col("first")).cast("int").alias("code")), "codes")
    return {c: LabelCodes(c, codes.where(F.col("column") == c).select("label", "code"))
            for c in columns}


def label_dictionary(encoded: DataFrame, columns: list[str]) -> DataFrame:
    """(column, label, code) as used in an encoded table, to be kept beside it."""
    return encoded.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), as_label(F.col(c)).alias("label"),
                 F.col(f"{c}_encoded").alias("code")) for c in columns]))).distinct()


def encode_labels(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None,
                  filled_with: dict[str, str] | None = None) -> DataFrame:
    """Fit and encode each column as ``<column>_encoded``."""
    fitted = fit_labels(df if fit_on is None else fit_on, columns, filled_with)
    for codes in fitted.values():
        df = codes.encode(df)
    return df


def one_hot(df: DataFrame, values: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """``keep`` plus one 0/1 double per listed value, named ``<column>_<value>``.

    A wide table needs its columns when the plan is made, so the values are given.
    ``one_hot_sparse`` takes columns of any number of values.
    """
    return df.select(*keep, *[
        F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)).alias(f"{column}_{v}")
        for column, listed in values.items() for v in listed])


def one_hot_sparse(df: DataFrame, columns: list[str], output: str = "one_hot") -> DataFrame:
    """Add the entries of the one-hot vector that are not zero: ``<column>_<value>`` -> 1.0."""
    entries = [F.struct(F.concat(F.lit(f"{c}_"), F.col(c).cast("string")).alias("k"),
                        F.lit(1.0).alias("v")) for c in columns]
    held = F.filter(F.array(*entries), lambda e: e["k"].isNotNull())
    return df.withColumn(output, F.map_from_entries(held))


# Scaling and binning -------------------------------------------------------

def min_max_scale(df: DataFrame, column: str, output: str,
                  fit_on: DataFrame | None = None) -> DataFrame:
    """Onto [0, 1]; a constant column gives 0, null stays null.

    ``fit_on`` may name a cheaper table with the same extremes, such as the
    rows before imputation: a median or mean lies between them.
    """
    s = (df if fit_on is None else fit_on).agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    scaled = (F.col(column) - s["lo"]) / F.nullif(s["hi"] - s["lo"], F.lit(0.0))
    return df.withColumn(output, F.when(F.col(column).isNotNull(), F.coalesce(scaled, F.lit(0.0))))


def standard_scale(df: DataFrame, column: str, output: str,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column gives 0, null stays null.

    Imputed rows change both statistics, so ``fit_on`` is not used.
    """
    s = df.agg(F.struct(F.avg(column).alias("mu"), F.stddev_pop(column).alias("sd"))).scalar()
    scaled = (F.col(column) - s["mu"]) / F.nullif(s["sd"], F.lit(0.0))
    return df.withColumn(output, F.when(F.col(column).isNotNull(), F.coalesce(scaled, F.lit(0.0))))


def quantile_tiers(df: DataFrame, column: str, output: str, labels=PRICE_TIERS) -> DataFrame:
    """Equal-share bins, right-closed, edges interpolated linearly.

    Tied edges leave a bin empty instead of failing.
    """
    n = len(labels)
    q = (exact_percentiles(df, column, [i / n for i in range(1, n)]).select("q").scalar())
    value = F.round(F.col(column).cast("double"), 9)
    tier = F.when(F.col(column).isNull(), F.lit(None))
    for i, label in enumerate(labels[:-1]):
        tier = tier.when(value <= F.round(q[i], 9), label)
    return df.withColumn(output, tier.otherwise(labels[-1]))


# Tables --------------------------------------------------------------------

SCALERS = {"minmax": min_max_scale, "standard": standard_scale}


def encode_columns(df: DataFrame, columns: list[str], method: str,
                   fit_on: DataFrame | None = None,
                   filled_with: dict[str, str] | None = None) -> DataFrame:
    """Label codes, or a sparse one-hot vector beside the given columns."""
    if method == "label":
        return encode_labels(df, columns, fit_on, filled_with)
    if method == "one_hot":
        return one_hot_sparse(df, columns)
    raise ValueError(f"unknown encoding {method}")


def clean_users(raw: DataFrame, order: list, encoding: str = "label",
                scaling: str = "minmax") -> DataFrame:
    """Prepared users: first row per id, filled, encoded, scaled."""
    first = materialise(keep_first(raw, ["user_id"], order)
                        .select("user_id", "age", "gender", "device"), "users-first")
    filled = fill_mode(fill_mode(fill_median(first, "age"), "gender", DEFAULT_GENDER),
                       "device", DEFAULT_DEVICE)
    coded = encode_columns(filled, ["gender", "device"], encoding, first,
                           {"gender": DEFAULT_GENDER, "device": DEFAULT_DEVICE})
    return SCALERS[scaling](coded, "age", "age_normalized", first)


def clean_products(raw: DataFrame, order: list, encoding: str = "label",
                   scaling: str = "minmax") -> DataFrame:
    """Prepared products: first row per id, filled, encoded, scaled, tiered."""
    first = materialise(
        keep_first(raw, ["item_id"], order)
        .select("item_id", "price", "brand", "category", "rating", "in_stock"), "products-first")
    filled = fill_mean(fill_group_median(first, "price", "category"), "rating")
    coded = encode_columns(filled, ["category", "brand"], encoding, first)
    return quantile_tiers(SCALERS[scaling](coded, "price", "price_normalized", first),
                          "price", "price_tier")


def clean_interactions(raw: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Prepared interactions: known keys, valid timestamps, encoded, weighted.

    ``raw`` carries a parsed ``timestamp``.
    """
    known = keep_known(keep_known(raw, users, "user_id"), products, "item_id")
    # Fitting the labels and encoding both read the kept rows: they are written once.
    valid = materialise(known.where(F.col("timestamp").isNotNull()), "known-interactions")
    return (encode_labels(valid, ["view_mode"])
            .withColumn("implicit_score", implicit_score(F.col("view_mode"))))
