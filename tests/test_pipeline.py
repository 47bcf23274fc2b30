import json
import random

import pytest

from basketry.plans import pipeline
from basketry.session import scratch_paths
from basketry.sources.lake import Lake


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    rnd, folder = random.Random(5), tmp_path_factory.mktemp("data")
    users = ["user_id,age,gender,device"]
    users += [f"{u},{rnd.randint(18, 65)},{rnd.choice('MF')},{rnd.choice(['Mobile', 'Tablet'])}"
              for u in range(1, 61)]
    (folder / "users1.csv").write_text("\n".join(users))
    (folder / "users2.csv").write_text("user_id,age,gender,device\nx,1,M,Mobile\n61,,,\n")
    (folder / "user_matrix.csv").write_text("user_id,1,2\n1,0,1\n")
    products = [{"item_id": i, "price": round(rnd.uniform(5, 90), 2), "brand": f"b{i % 4}",
                 "category": f"c{i % 3}", "rating": 4.0, "in_stock": True} for i in range(40)]
    products.append({**products[3], "brand": "late copy", "price": 1.0})
    (folder / "products.json").write_text(json.dumps(products))
    (folder / "users3.csv").write_text("")
    rows = ["user_id,item_id,view_mode,rating,timestamp"]
    for n in range(900):
        sep = "T" if n % 2 else " "
        rows.append(f"{rnd.randint(1, 60)},{rnd.randrange(40)},"
                    f"{rnd.choices(['view', 'add_to_cart', 'purchase'], [7, 2, 1])[0]},"
                    f"{rnd.randint(1, 5)},2026-01-{rnd.randint(1, 28):02d}{sep}10:00:00")
    (folder / "transactions.csv").write_text("\n".join(rows))
    return str(folder)


def test_whole_run(spark, data, tmp_path):
    p = pipeline.Params(data, str(tmp_path), "2026-02-01", quality_threshold=0.9, rank=3,
                        iterations=3, k_values=(5, 10))
    before = scratch_paths(spark)
    summary = {(r.metric, r.k): r for r in pipeline.run(spark, p).collect()}
    assert set(summary) == {(m, k) for m in ("precision", "recall", "ndcg", "hit_rate")
                            for k in (5, 10)} | {("mrr", None)}
    assert all(0 <= r.min <= r.mean <= r.max <= 1 for r in summary.values())
    assert scratch_paths(spark) == before  # the run cleared its own
    lake = Lake(spark, f"{tmp_path}/lake")
    assert lake.latest("raw", "users").count() == 61
    # Both timestamp formats survive the cleaning.
    assert lake.latest("prepared", "transactions").count() == 900
    lists = spark.read.parquet(f"{tmp_path}/processed/recommendations")
    seen = lake.latest("features", "interaction_features")
    assert lists.join(seen, ["user_id", "item_id"], "left_semi").count() == 0
    assert lists.groupBy("user_id").count().where("count > 10").count() == 0
    refused = spark.read.json(f"{tmp_path}/quarantine").collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in refused) == ["user_matrix.csv", "users3.csv"]
    # Of a repeated product the first row of the file stays.
    assert lake.latest("prepared", "products").where("item_id = 3").first().brand == "b3"
    warned = spark.read.json(f"{tmp_path}/warnings").where("not passed").collect()
    assert {"duplicate_item_id"} <= {r.check for r in warned}
    codes = lake.latest("encoders", "products").where("column = 'category'").collect()
    assert sorted((r.label, r.code) for r in codes) == [("c0", 0), ("c1", 1), ("c2", 2)]
    store = pipeline.store(spark, p)
    assert store.lookup("user_features", "user_id", [61]).first().user_activity_count == 0
    assert store.registry().count() == 6


def test_runs_do_not_see_the_future(spark, data, tmp_path):
    """Snapshots after the run date and unfinished ones take no part in training."""
    p = pipeline.Params(data, str(tmp_path), "2026-02-01", rank=2, iterations=1)
    pipeline.ingest(spark, p)
    pipeline.prepare_tables(spark, p)
    pipeline.build_features(spark, p)
    lake = pipeline.lake(spark, p)
    rows = lake.latest("features", "interaction_features")
    lake.save(rows.withColumn("item_id", rows.item_id + 1000), "features",
              "interaction_features", "2026-03-01")
    broken = lake.save(rows.withColumn("item_id", rows.item_id + 5000), "features",
                       "interaction_features", "2026-01-01")
    (tmp_path / "lake/features/interaction_features/dt=2026-01-01/_SUCCESS").unlink()
    assert broken.count() and lake.dates("features", "interaction_features") == [
        "2026-02-01", "2026-03-01"]
    model = pipeline.train(spark, p)
    assert model.item_factors.where("item_id >= 1000").count() == 0
    pipeline.publish(spark, p)
    store = pipeline.store(spark, p)
    (tmp_path / "store/user_features/version=2").mkdir()
    assert store.versions("user_features") == [1] and store.read("user_features").count() == 61
    store.publish("user_features", store.read("user_features"), "user_id", p.run_ts)
    assert store.versions("user_features") == [1, 3]


def test_gate_stops_the_run(spark, data, tmp_path):
    p = pipeline.Params(data, str(tmp_path), "2026-02-01", quality_threshold=1.01)
    pipeline.ingest(spark, p)
    with pytest.raises(ValueError, match="data quality"):
        pipeline.validate(spark, p)
    assert spark.read.json(f"{tmp_path}/quality").count() == 16


def test_missing_product_file(spark, data, tmp_path):
    p = pipeline.Params(data, str(tmp_path), "2026-02-01", products_file="absent.json")
    with pytest.raises(FileNotFoundError):
        pipeline.ingest(spark, p)
