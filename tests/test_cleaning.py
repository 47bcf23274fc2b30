from datetime import datetime

from pyspark.sql import functions as F

from basketry.functions import cleaning as C
from basketry.operators.prepare import clean_raw_users


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_to_number(spark):
    got = values(spark, ["12", " 12 ", "1e3", "twenty", "", None, "12d", "7F", "NaN", "-5"],
                 C.to_number)
    assert got == [12.0, 12.0, 1000.0, None, None, None, None, None, None, -5.0]


def test_to_key_keeps_every_digit(spark):
    got = values(spark, ["9007199254740993", "5.0", "5.7", "x", None, "1e400", "inf"], C.to_key)
    assert got == [9007199254740993, 5, 5, None, None, None, None]


def test_null_tokens_compare_before_trimming(spark):
    assert values(spark, ["NA", "None", "nan", " None ", "M", None], C.null_tokens) == \
        [None, None, None, " None ", "M", None]


def test_clean_text(spark):
    assert values(spark, [" M ", "NaN", " nan", "", None, "Femlae"], C.clean_text) == \
        ["M", None, None, "", None, "Femlae"]


def test_parse_timestamp_reads_both_formats(spark):
    got = values(spark, ["2026-01-06 00:51:47", "2026-01-27T10:30:00.123456", "10:30", "bad",
                         "", None, "2026-13-01 00:00:00", "2026-01-06"], C.parse_timestamp)
    assert got == [datetime(2026, 1, 6, 0, 51, 47), datetime(2026, 1, 27, 10, 30, 0, 123456),
                   None, None, None, None, None, datetime(2026, 1, 6)]


def test_predicates_count_null_as_false(spark):
    df = spark.createDataFrame([(None,), (0.0,), (18.0,), (65.0,), (66.0,)], "x double")
    x = F.col("x")
    assert [r[0] for r in df.select(C.in_range(x, 18, 65)).collect()] == \
        [False, False, True, True, False]
    assert [r[0] for r in df.select(C.positive(x)).collect()] == [False, False, True, True, True]
    assert [r[0] for r in df.select(C.in_domain(x, [0.0])).collect()] == \
        [False, True, False, False, False]


def test_plausible_age(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (110.0,), (999.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.plausible_age(F.col("x"))).collect()] == \
        [None, 0.0, 110.0, None, None]


def test_clean_raw_users(spark):
    df = spark.createDataFrame(
        [("1", "30", " M ", "Mobile"), (" 2 ", "twenty", "nan", "None"), ("x", "1", "F", "Phone"),
         (None, "1", "F", "Tablet")],
        "user_id string, age string, gender string, device string")
    assert [tuple(r) for r in clean_raw_users(df).orderBy("user_id").collect()] == \
        [(1, 30.0, "M", "Mobile"), (2, None, None, None)]
