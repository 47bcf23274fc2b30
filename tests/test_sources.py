import json

import pytest
from pyspark.sql import functions as F

from basketry.operators import profiling
from basketry.sources import files
from basketry.sources.feature_store import FeatureStore, feature_definitions
from basketry.sources.lake import Lake

HEADER = "user_id,age,gender,device\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "Users_a.csv").write_text(HEADER + "1,30,M,Mobile\n2,,F,Tablet\n1,31,F,Phone\n")
    (tmp_path / "b_USER.csv").write_text("device,user_id,gender,age,city\nDesktop,3, M ,twenty,X\n")
    (tmp_path / "user_matrix.csv").write_text("user_id,100,101\n1,0.5,0.1\n")
    (tmp_path / "user_empty.csv").write_text("")
    (tmp_path / "other.csv").write_text("a\n1\n")
    return tmp_path


def test_csv_layouts_and_quarantine(spark, folder):
    rows, refused = files.read_users(spark, str(folder))
    got = {(r.user_id, r.age, r.gender, r.device, r.city) for r in rows.collect()}
    assert got == {("1", "30", "M", "Mobile", None), ("2", None, "F", "Tablet", None),
                   ("1", "31", "F", "Phone", None), ("3", "twenty", " M ", "Desktop", "X")}
    assert sorted((r.path.rsplit("/", 1)[1], r.missing_columns) for r in refused.collect()) == \
        [("user_empty.csv", "user_id,age,gender,device"), ("user_matrix.csv", "age,gender,device")]
    ordered = rows.where("user_id = '1'").orderBy(*files.FILE_ORDER).collect()
    assert [r.age for r in ordered] == ["30", "31"]


def test_no_matching_files(spark, folder, tmp_path):
    rows, refused = files.read_interactions(spark, str(folder))
    assert rows.count() == 0 and refused.count() == 0 and "timestamp" in rows.columns
    assert files.read_users(spark, str(tmp_path / "absent"))[0].count() == 0


def test_missing_sources(spark, folder):
    got = files.missing_sources(spark, str(folder), ["Users_a.csv", "user_empty.csv", "nope.csv"])
    assert sorted(r.name for r in got.collect()) == ["nope.csv", "user_empty.csv"]
    files.require_sources(spark, str(folder), ["other.csv"])
    with pytest.raises(FileNotFoundError):
        files.require_sources(spark, str(folder), ["nope.csv"])


def test_many_files_in_few_layouts(spark, tmp_path, monkeypatch):
    """Headers of 500 files in one job, and a scan per layout."""
    heads = [HEADER, "device,user_id,gender,age\r\n", '\ufeff"user_id",age,"a, b",gender,device\n', "user_id,age\n"]
    cells = ["{0},30,M,Mobile\n", "Mobile,{0},M,30\r\n", '{0},30,"x, y",M,Mobile\n', "{0},1\n"]
    for i in range(500):
        (tmp_path / f"user {i} 10%+é.csv").write_text(heads[i % 4] + cells[i % 4].format(i), newline="")
    layouts = files.header_layouts(spark, str(tmp_path), files.USER_FILES).collect()
    assert sorted(len(r.paths) for r in layouts) == [125] * 4
    assert ["user_id", "age", "a, b", "gender", "device"] in [r.header for r in layouts]
    scans = []
    reader = type(spark.read)
    monkeypatch.setattr(reader, "csv", lambda self, paths, f=reader.csv: (scans.append(paths), f(self, paths))[1])
    rows, refused = files.read_users(spark, str(tmp_path))
    assert len(scans) == 3 and refused.count() == 125
    got = sorted((int(r.user_id), r.age, r.gender, r.device, r["a, b"]) for r in rows.collect())
    assert got == [(i, "30", "M", "Mobile", "x, y" if i % 4 == 2 else None) for i in range(500) if i % 4 < 3]


def test_products_json(spark, tmp_path):
    rows = [{"item_id": 1, "price": 2.5, "brand": "é", "category": "c", "rating": 4.0,
             "in_stock": True}, {"item_id": 2, "price": None, "brand": "b"}]
    (tmp_path / "p.json").write_text(json.dumps(rows, indent=2, ensure_ascii=False), "utf-8")
    got = files.read_products(spark, str(tmp_path / "p.json")).orderBy("item_id").collect()
    assert got[0].brand == "é" and got[0].in_stock and got[1].price is None
    (tmp_path / "bad.json").write_text('[{"item_id": 1,')
    with pytest.raises(Exception):
        files.read_products(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in rows))
    assert files.read_products(spark, str(tmp_path / "lines.json"), lines=True).count() == 2


def test_lake_dates(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        lake.latest("raw", "users")
    for dt, n in (("2024-01-01", 3), ("2024-01-05", 7)):
        lake.save(spark.range(n), "raw", "users", dt)
    lake.save(spark.range(4).withColumn("x", F.lit("a")), "raw", "users", "2024-01-03")
    assert lake.dates("raw", "users") == ["2024-01-01", "2024-01-03", "2024-01-05"]
    assert lake.latest("raw", "users").count() == 7
    assert lake.as_of("raw", "users", "2024-01-04").count() == 4
    assert lake.snapshot("raw", "users", "2024-01-01").count() == 3
    every = lake.all_dates("raw", "users")
    assert every.count() == 14 and every.where("x IS NULL").count() == 10
    assert {r.dt for r in every.select("dt").distinct().collect()} == set(lake.dates("raw", "users"))
    # A repeated run replaces its date and leaves the others.
    lake.save(spark.range(1), "raw", "users", "2024-01-05")
    assert lake.latest("raw", "users").count() == 1
    with pytest.raises(FileNotFoundError):
        lake.as_of("raw", "users", "2023-12-31")


def test_lake_formats(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "i long, s string")
    for fmt in ("parquet", "csv", "json"):
        got = lake.save(df, "raw", fmt, "2024-01-01", fmt)
        assert sorted(map(tuple, got.collect())) == [(1, "a,b"), (2, None)]
        assert lake.latest("raw", fmt, fmt, df.schema).count() == 2
    with pytest.raises(ValueError):
        lake.save(df, "raw", "x", "2024-01-01", "xml")


def test_save_by_date_touches_only_its_dates(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "day string")
    lake.save_by_date(days("2024-01-01", "2024-01-01", "2024-01-02"), "raw", "e", "day")
    lake.save_by_date(days("2024-01-02", "2024-01-03"), "raw", "e", "day")
    got = lake.all_dates("raw", "e").groupBy("dt").count().collect()
    assert {r.dt: r["count"] for r in got} == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 1}


def test_profile_metadata(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    df = spark.createDataFrame([(1, None), (2, "x")], "i long, s string")
    meta = lake.save_profile(lake.save(df, "raw", "t", "2024-01-01"), "raw", "t",
                             "2024-01-01").first()
    assert meta.record_count == 2 and meta.size_bytes > 0
    assert [(c.column_name, c.data_type, c.null_count) for c in meta.columns] == \
        [("i", "bigint", 0), ("s", "string", 1)]
    # Profiles lie beside the layers and are no data.
    assert lake.latest("raw", "t").count() == 2


def test_content_hash(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, s string")
    value = lambda d, m="xxhash64": tuple(profiling.content_hash(d, method=m).first())
    for method in ("xxhash64", "md5"):
        assert value(df, method) == value(df.repartition(3), method)
        assert value(df, method) != value(df.dropDuplicates(), method)
        assert value(df, method) != value(df.withColumn("i", F.col("i") + 1), method)
    with pytest.raises(ValueError):
        profiling.content_hash(df, method="crc")


def test_drift(spark):
    old = profiling.snapshot_profile(spark.createDataFrame([(1, None)], "a int, b string"))
    new = profiling.snapshot_profile(spark.createDataFrame([(1, 2)], "a long, c int"))
    got = {r.column_name: r.change for r in profiling.snapshot_drift(old, new).collect()}
    assert got == {"a": "retyped", "b": "removed", "c": "added"}


def test_completeness_is_cut_off(spark):
    df = spark.createDataFrame([(1, None)] * 1 + [(1, 1)] * 10, "a int, b int")
    row = profiling.completeness(df, "d").first()
    assert (row.score, row.healthy, row.attributes) == (95, True, 2)
    samples = {r.column_name: r.samples for r in profiling.sample_values(df).collect()}
    assert samples == {"a": "1", "b": "1"}


def test_days_are_united_by_noted_schemas(spark, tmp_path):
    """One more column on a later day, without a look at the files; a changed type is refused."""
    lake = Lake(spark, str(tmp_path))
    one = spark.createDataFrame([(1, "a")], "id long, name string")
    two = spark.createDataFrame([(2, "b", 0.5)], "id long, name string, price double")
    for dt, df in (("2024-01-01", one), ("2024-01-02", one), ("2024-01-03", two), ("2024-01-04", two)):
        lake.save(df, "raw", "p", dt)
    assert len(list((tmp_path / "_schemas" / "raw" / "p").iterdir())) == 2
    got = lake.all_dates("raw", "p")
    assert got.columns == ["id", "name", "price", "dt"]
    assert sorted(map(tuple, got.collect())) == [
        (1, "a", None, "2024-01-01"), (1, "a", None, "2024-01-02"), (2, "b", 0.5, "2024-01-03"),
        (2, "b", 0.5, "2024-01-04")]
    assert lake.all_dates("raw", "p", "2024-01-02").columns == ["id", "name", "dt"]
    assert "mergeSchema" not in got._jdf.queryExecution().toString()
    lake.save(spark.createDataFrame([("x", "a")], "id string, name string"), "raw", "p", "2024-01-05")
    with pytest.raises(ValueError, match="id is"):
        lake.all_dates("raw", "p")
    assert lake.all_dates("raw", "p", "2024-01-04").count() == 4


def test_days_without_a_note(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for dt, n in (("2024-01-01", 1), ("2024-01-02", 2)):
        spark.range(n).write.parquet(lake.path("raw", "old", dt))
    assert lake.recorded_schema("raw", "old") is None
    assert lake.all_dates("raw", "old").count() == 3


def test_published_tables_describe_themselves(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, 2, 0.5, "a"), (2, 3, 0.1, "b")], "user_id long, n long, share double, c string")
    store.publish("u", rows, "user_id", "2024-01-05 00:00:00")
    got = {r.feature_name: (r.data_type, r.rows, str(r.published_at)) for r in store.describe("u", "user_id").collect()}
    stamp = (2, "2024-01-05 00:00:00")
    assert got == {"n": ("INTEGER", *stamp), "share": ("REAL", *stamp), "c": ("TEXT", *stamp)}


def test_feature_store(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    df = spark.createDataFrame([(i, i * 1.0) for i in range(5)], "user_id long, x double")
    store.publish("f", df, "user_id", "2024-01-01 00:00:00")
    store.publish("f", df.withColumn("x", F.col("x") + 1), "user_id", "2024-01-02 00:00:00")
    assert store.versions("f") == [1, 2]
    assert store.lookup("f", "user_id").agg(F.sum("x")).first()[0] == 15
    assert [r.x for r in store.lookup("f", "user_id", [3]).collect()] == [4.0]
    ids = spark.createDataFrame([(1,), (1,), (77,)], "some_id long")
    assert [r.user_id for r in store.lookup("f", "user_id", ids).collect()] == [1]
    assert store.lookup("f", "user_id", list(range(2, 3_000))).count() == 3
    for bad in (df.union(df), df.union(spark.createDataFrame([(None, 1.0)], df.schema))):
        with pytest.raises(ValueError):
            store.publish("f", bad, "user_id", "2024-01-03 00:00:00")
    assert store.versions("f") == [1, 2]
    with pytest.raises(FileNotFoundError):
        store.read("absent")


def test_lookup_ids_reach_the_scan(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    store.publish("f", spark.range(9).withColumnRenamed("id", "user_id"), "user_id",
                  "2024-01-01 00:00:00")
    plan = store.lookup("f", "user_id", [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(user_id" in plan


def test_registry(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path))
    store.register(feature_definitions(spark), "2024-01-01 00:00:00")
    changed = feature_definitions(spark).where("feature_name = 'purchase_ratio'").withColumn(
        "description", F.lit("changed"))
    store.register(changed, "2024-02-01 00:00:00")
    got = {r.feature_name: r for r in store.registry().collect()}
    assert len(got) == 6 and got["purchase_ratio"].description == "changed"
    assert str(got["purchase_ratio"].created_at) == "2024-01-01 00:00:00"
    assert str(got["purchase_ratio"].updated_at) == "2024-02-01 00:00:00"
    store.export_registry(str(tmp_path / "export"))
    assert spark.read.json(str(tmp_path / "export")).count() == 6
