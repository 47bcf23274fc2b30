import pytest
from pyspark.sql import functions as F

from basketry.sources.keyed_table import KeyedTable

SCHEMA = "item_id bigint, score bigint, created_at timestamp_ntz, updated_at timestamp_ntz"


def rows(spark, ids, score, stamp):
    return ids.select(F.col("id").alias("item_id"), (F.col("id") * 0 + score).alias("score"),
                      F.lit(stamp).cast("timestamp_ntz").alias("created_at"),
                      F.lit(stamp).cast("timestamp_ntz").alias("updated_at"))


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    keyed = KeyedTable(spark, str(tmp_path / "t"), "item_id", schema, 16, 8_192)
    keyed.begin(rows(spark, spark.range(60_000), 1, "2024-01-01"))
    return keyed


def files(tmp_path):
    return {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}


def content(keyed):
    return sorted(map(tuple, keyed.read().collect()))


def test_only_touched_buckets_are_rewritten(spark, table, tmp_path):
    before = files(tmp_path)
    new = rows(spark, spark.createDataFrame([(5,), (70_000,)], "id long"), 9, "2024-02-01")
    touched = table.upsert(new)
    assert 1 <= touched <= 2
    after = files(tmp_path)
    same = [p for p in before if after.get(p) == before[p]]
    assert len({p.parts[1] for p in same}) == 16 - touched
    got = {r.item_id: r for r in table.read().where("item_id in (5, 6, 70000)").collect()}
    assert (got[5].score, got[5].created_at.month, got[5].updated_at.month) == (9, 1, 2)
    assert (got[6].score, got[70_000].score, table.read().count()) == (1, 9, 60_001)
    once = content(table)
    table.upsert(new)
    assert content(table) == once
    assert table.upsert(new.limit(0)) == 0 and content(table) == once


def scanned(df):
    """Rows that left the scan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while "Scan" not in plan.nodeName():
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().head()
    return plan.metrics().get("numOutputRows").get().value()


def test_a_lookup_reads_few_row_groups(spark, table):
    got = table.lookup([3, 30_000, 59_999, 99_999_999])
    assert sorted(r.item_id for r in got.collect()) == [3, 30_000, 59_999]
    assert scanned(got) < 6_000
    assert table.lookup([]).collect() == []


def test_a_lookup_by_table(spark, table):
    wanted = spark.createDataFrame([(7,), (7,), (8,), (None,), (-1,)], "id long")
    assert sorted(r.item_id for r in table.lookup(wanted).collect()) == [7, 8]
