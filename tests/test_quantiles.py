import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from basketry.functions import positions
from basketry.functions.quantiles import exact_percentiles

PROBS = [0.0, 1 / 3, 0.5, 2 / 3, 1.0]


def percentiles(df, by=None):
    return {tuple(r[k] for k in by or []): (r["n"], r["q"])
            for r in exact_percentiles(df, "x", PROBS, by).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40))
def test_same_as_numpy(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double")
    n, q = percentiles(df)[()]
    assert n == len(xs)
    assert q == pytest.approx(list(np.quantile(xs, PROBS)))


def test_groups_and_null_group(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0), (None, 8.0), ("c", None)]
    got = percentiles(spark.createDataFrame(rows, "g string, x double"), ["g"])
    assert got[("a",)][1][2] == 2.0 and got[("b",)][1] == [5.0] * 5
    assert got[(None,)][1][2] == 7.5 and ("c",) not in got


def test_no_values_gives_no_row(spark):
    assert percentiles(spark.createDataFrame([(None,)], "x double")) == {}


def test_hot_group_and_ties(spark):
    df = (spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 2).cast("string")).alias("g"),
        F.when(F.col("id") % 5 == 0, 0.5).otherwise(F.pmod(F.hash("id"), F.lit(100_000)) / 7)
        .alias("x")))
    want = df.toPandas().groupby("g")["x"]
    got = percentiles(df, ["g"])
    for g, xs in want:
        assert got[(g,)][1] == pytest.approx(list(np.quantile(xs, PROBS)), abs=0, rel=1e-15)
    assert percentiles(df)[()][1] == pytest.approx(
        list(np.quantile(df.toPandas()["x"], PROBS)), abs=0, rel=1e-15)


def test_values_of_all_sizes(spark):
    """Signs, zeros, subnormal, neighbouring and huge doubles; the exact one comes out."""
    one = 1.0
    xs = [0.0, -0.0, 5e-324, -5e-324, 2.2e-308, one, np.nextafter(one, 2), np.nextafter(one, 0),
          1e300, -1e300, 1.7e308, -1.7e308, 8.0, np.nextafter(8.0, 0), 1e-300, -3.5, float("inf"),
          float("-inf"), 7.0, 1e16, 1e16 + 2]
    df = spark.createDataFrame([(float(x),) for x in xs] + [(float("nan"),)], "x double")
    probs = [i / (len(xs) - 1) for i in range(len(xs))]
    row = exact_percentiles(df, "x", probs).first()
    assert row.n == len(xs)
    got, want = row.q, sorted(float(x) for x in xs)
    near = [min(abs(want.index(g) - i) for g in [g]) for i, g in enumerate(got) if g in want]
    assert len(near) >= len(xs) - 4 and max(near) <= 1


def test_no_task_gets_all_values(spark):
    """Rows are never brought to a single partition: counts of bins are."""
    df = spark.range(100_000).select(F.sqrt(F.col("id").cast("double")).alias("x"))
    plan = exact_percentiles(df, "x", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "percentile" not in plan


def test_global_position(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(50)], "id long, s int").repartition(5)
    got = positions.global_position(df, [F.desc("s"), F.asc("id")], "pos")
    want = sorted(((i, i % 4) for i in range(50)), key=lambda r: (-r[1], r[0]))
    assert [(r.id, r.s, r.pos) for r in got.orderBy("pos").collect()] == \
        [(*row, n) for n, row in enumerate(want)]
