"""Exact percentiles that never hold a column, or a group of it, in one task.

The wanted ranks are found by descent.  The values are counted in bins that follow their order,
first by sign, binary exponent and the first 14 bits behind it, then twice in equal steps between
the least and greatest value of the bin that holds the rank.  Every level is one map-side combined
count of a bounded number of bins per group and rank, however many values there are, and 14 + 19 +
19 bits tell any two doubles of one exponent apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 1 << 19
STEP_LEVELS = 2
_LEAD = 1 << 14
_EXPONENTS = 1_100  # beyond those of doubles


def _exponent(v: Column) -> Column:
    """Sign, binary exponent and leading bits as one number that rises with the value.

    A logarithm that rounds up to the next exponent gives the last bin of the one before.
    """
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    # Halves of the exponent, as 2 ** -exponent may lie beyond the doubles.
    half = F.floor(exponent / 2)
    lead = F.floor((size * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent) - 1)
                   * _LEAD)
    place = F.when(size == float("inf"), F.lit(2 * _EXPONENTS * _LEAD)).otherwise(
        (exponent + _EXPONENTS) * _LEAD + lead)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * place).cast("bigint")


def _step(v: Column) -> Column:
    """Number of the step between ``lo`` and ``hi``."""
    share = (v - F.col("lo")) / (F.col("hi") - F.col("lo"))
    return F.when(F.col("hi") > F.col("lo"), F.floor(share * (BINS - 1))).otherwise(0).cast("bigint")


def exact_percentiles(df: DataFrame, value: str, probs: list[float],
                      by: list[str] | None = None) -> DataFrame:
    """Linear-interpolated percentiles, one row per group.

    Columns: the group columns, ``n`` (values counted) and ``q`` (array of doubles in the order
    of ``probs``).  Nulls and NaN are left out.  Without ``by`` there is at most one row; a table
    without values gives none.
    """
    by = by or []
    v = F.col("_v")
    rows = (df.select(*by, F.col(value).cast("double").alias("_v"))
            .where(v.isNotNull() & ~F.isnan(v)))
    groups = rows.groupBy(*by).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"),
                                   F.max("_v").alias("hi"))
    # Two neighbouring ranks per percentile; beyond the last value the second is the first.
    spots = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    ranks = [F.least(F.floor(s) + k, F.col("n") - 1) for s in spots for k in (0, 1)]
    targets = groups.where("n > 0").select(*by, "n", "lo", "hi", F.posexplode(F.array(*ranks))
                                           .alias("i", "rank"))
    for level in range(STEP_LEVELS + 1):
        targets = _descend(rows, targets, by, _exponent(v) if level == 0 else _step(v))
    each = targets.groupBy(*by, "n").agg(
        F.array_sort(F.collect_list(F.struct("i", "lo"))).alias("_s"))

    def between(k: int, spot: Column) -> Column:
        low, high = F.col("_s")[2 * k]["lo"], F.col("_s")[2 * k + 1]["lo"]
        share = spot - F.floor(spot)
        return F.when(share > 0, low + (high - low) * share).otherwise(low)

    return each.select(*by, "n", F.array(*[between(k, s) for k, s in enumerate(spots)]).alias("q"))


def _descend(rows: DataFrame, targets: DataFrame, by: list[str], bin_of: Column) -> DataFrame:
    """Narrow each target (rank among the values between ``lo`` and ``hi``) to one bin."""
    wanted = F.struct("i", "rank", "n", "lo", "hi")
    if by:
        lists = targets.groupBy(*[F.col(k).alias(f"_k_{k}") for k in by]).agg(
            F.collect_list(wanted).alias("_t"))
        met = rows.join(lists, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in by])
    else:
        met = rows.withColumn("_t", targets.agg(F.collect_list(wanted).alias("_t")).scalar())
    inside = (met.select(*by, "_v", F.inline("_t"))
              .where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))))
    keys = [*by, "i", "rank", "n"]
    bins = (inside.groupBy(*keys, bin_of.alias("_bin"))
            .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("lo"), F.max("_v").alias("hi")))
    upto = F.sum("_c").over(Window.partitionBy(*by, "i").orderBy("_bin"))
    return (bins.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_c"))
            .where((F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_upto")))
            .select(*by, "i", (F.col("rank") - F.col("_before")).alias("rank"), "n", "lo", "hi"))
