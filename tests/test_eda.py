import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import eda


def test_describe(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, None), (4.0, 7)], "a double, b int")
    got = {r.column_name: r for r in eda.describe(df, ["a", "b"]).collect()}
    assert got["a"].median == 2.0 and got["a"].std == pytest.approx(np.std([1, 2, 4], ddof=1))
    assert (got["b"].n, got["b"].mean, got["b"].median) == (2, 6.0, 6.0)


def test_distribution(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    got = {r.value: (r.row_count, r.share) for r in eda.distribution(df, ["v"]).collect()}
    assert got == {"a": (2, 0.5), "b": (1, 0.25), None: (1, 0.25)}


def test_histogram(spark):
    xs = [0.0, 0.1, 0.5, 3.9, 4.0, 4.0]
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
    got = eda.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r.row_count for r in got] == list(np.histogram(xs, bins=4)[0])
    assert [r.bin_start for r in got] == [0.0, 1.0, 2.0, 3.0] and got[-1].bin_end == 4.0
    flat = eda.histogram(spark.createDataFrame([(2.0,)] * 3, "x double"), "x", 4).collect()
    assert [(r.bin, r.row_count) for r in flat] == [(0, 3)]
    assert eda.histogram(df.where("x > 9"), "x", 4).count() == 0


def test_correlation(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.0, 5.0), (4.0, None, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.correlation
           for r in eda.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("a", "a")] == pytest.approx(1.0)
    assert got[("a", "b")] == got[("b", "a")] == \
        pytest.approx(np.corrcoef([1, 2, 3], [2, 4.5, 5])[0, 1])
    # A constant column has no correlation.
    assert got[("c", "c")] is None and got[("a", "c")] is None and len(got) == 9


def test_matrix_and_activity(spark):
    rows = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 10)], "user_id long, item_id long")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    items = spark.createDataFrame([(10,), (11,)], "item_id long")
    row = eda.matrix_sparsity(rows, users, items).first()
    assert (row.users, row.items, row.filled_cells, row.possible_cells) == (3, 2, 3, 6)
    assert row.density == 0.5 and row.sparsity == 0.5
    got = eda.activity(rows, users, "user_id").first()
    assert (got["mean"], got["median"], got["max"]) == (pytest.approx(4 / 3), 1.0, 3)
    assert got["zero_share"] == pytest.approx(1 / 3)
    wide = eda.user_item_matrix(rows, F.lit(1), [10, 11])
    assert wide.columns == ["user_id", "10", "11"]
    assert sorted(map(tuple, wide.collect())) == [(1, 2, 1), (2, 1, 0)]
    sparse = {r.user_id: r["items"] for r in eda.user_item_rows(rows, F.lit(1)).collect()}
    assert sparse == {1: {10: 2, 11: 1}, 2: {10: 1}}


def test_counts(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:59", 5), ("2024-01-02 00:00:00", 5),
                                ("2024-01-02 01:00:00", None)], "t string, rating int").withColumn(
        "timestamp", F.col("t").cast("timestamp_ntz"))
    assert {str(r.day): r.interactions for r in eda.daily_counts(df).collect()} == \
        {"2024-01-01": 1, "2024-01-02": 2}
    assert {r.rating: r.row_count for r in eda.rating_counts(df).collect()} == {5: 2, None: 1}
