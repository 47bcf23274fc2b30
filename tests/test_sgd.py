import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.operators import factor_model as fm, sgd
from basketry.session import scratch_paths

TRIPLE = "user_id long, item_id long, score double"


def table(seed=0, users=40, items=30, hot=True):
    rng = np.random.default_rng(seed)
    taste, kind = rng.normal(size=(users, 2)), rng.normal(size=(items, 2))
    bu, bi = rng.normal(scale=0.4, size=users), rng.normal(scale=0.4, size=items)
    return [(u, i * 7 - 3, float(np.clip(3 + bu[u] + bi[i] + taste[u] @ kind[i] * 0.6, 1, 5)))
            for u in range(users) for i in range(items) if rng.random() < 0.5 or (hot and i == 0)]


def one_by_one(spark, rows, rank, epochs, rate, reg, seed, blocks):
    """Plain loops: strata in turn, the cells of each, and their ratings in the order of the hash."""
    df = spark.createDataFrame(rows, TRIPLE).select(
        "*", sgd.block_of("user_id", blocks, 1).alias("ub"),
        sgd.block_of("item_id", blocks, 2).alias("ib"), sgd.place_of(seed).alias("place"))
    rated = sorted(df.collect(), key=lambda r: (r.place, r.user_id, r.item_id))
    mean = sum(r.score for r in rated) / len(rated)
    p, q, bu, bi = {}, {}, {}, {}
    for r in rated:
        p[r.user_id] = sgd.start_factors(np.array([r.user_id]), rank, 2 * seed)[0]
        q[r.item_id] = sgd.start_factors(np.array([r.item_id]), rank, 2 * seed + 1)[0]
        bu[r.user_id] = bi[r.item_id] = 0.0
    errors = []
    for _ in range(epochs):
        met = 0.0
        for s in range(blocks):
            for r in rated:
                if (r.ib - r.ub) % blocks != s:
                    continue
                u, i = r.user_id, r.item_id
                e = r.score - (mean + bu[u] + bi[i] + p[u] @ q[i])
                bu[u], bi[i] = bu[u] + rate * (e - reg * bu[u]), bi[i] + rate * (e - reg * bi[i])
                p[u], q[i] = p[u] + rate * (e * q[i] - reg * p[u]), q[i] + rate * (e * p[u] - reg * q[i])
                met += e * e
        errors.append((met / len(rated)) ** 0.5)
    return mean, p, q, bu, bi, errors


@pytest.mark.parametrize("blocks", [1, 3])
def test_equals_plain_loops(spark, blocks):
    rows = table()
    args = dict(rank=4, epochs=3, rate=0.02, reg=0.05, seed=5, blocks=blocks)
    fit = sgd.fit_sgd(spark.createDataFrame(rows, TRIPLE).repartition(7), **args)
    mean, p, q, bu, bi, errors = one_by_one(spark, rows, **args)
    assert fit.model.mean == pytest.approx(mean)
    assert fit.epoch_errors == pytest.approx(errors, rel=1e-9)
    for side, bias, factors in (("user", bu, p), ("item", bi, q)):
        got = {r[0]: r[1] for r in getattr(fit.model, f"{side}_bias").collect()}
        assert got == pytest.approx(bias, abs=1e-9)
        got = {r[0]: r[1] for r in getattr(fit.model, f"{side}_factors").collect()}
        assert got.keys() == factors.keys()
        assert all(np.allclose(got[k], factors[k], atol=1e-9) for k in got)


def test_waves_share_nothing_and_keep_order():
    rng = np.random.default_rng(1)
    u, i = rng.integers(0, 9, 200), rng.integers(0, 5, 200)
    w = sgd.waves(u, i)
    for k in range(w.max() + 1):
        at = np.flatnonzero(w == k)
        assert len(set(u[at])) == len(at) == len(set(i[at]))
    for x in (u, i):
        for v in set(x.tolist()):
            assert (np.diff(w[x == v]) > 0).all()


def test_quality(spark):
    """The error falls with every epoch, and held-out ratings are told better than by biases."""
    train, test = fm.train_test_split(spark.createDataFrame(table(3, 80, 60), TRIPLE))
    fit = sgd.fit_sgd(train, rank=6, epochs=25, rate=0.03, reg=0.05)
    assert all(a > b for a, b in zip(fit.epoch_errors, fit.epoch_errors[1:]))
    error = lambda d: d.select(F.sqrt(F.avg((F.col("score") - F.col("prediction")) ** 2))).first()[0]
    assert error(fit.model.predict(test)) < error(fm.predict_baseline(train, test))


def test_blocks_follow_the_ratings(spark, monkeypatch):
    rows = spark.createDataFrame(table(), TRIPLE)
    assert sgd.choose_blocks(rows) == sgd.LEAST_BLOCKS
    monkeypatch.setattr(sgd, "CELL_RATINGS", 5)
    assert sgd.choose_blocks(rows) >= int((rows.count() / 5) ** 0.5)
    monkeypatch.setattr(sgd, "CELL_RATINGS", 40)  # item -3 has all 40 users
    assert sgd.choose_blocks(rows) >= 1


def test_no_ratings(spark):
    with pytest.raises(ValueError, match="no ratings"):
        sgd.fit_sgd(spark.createDataFrame([], TRIPLE))


def test_blocks_fit_a_task(spark, monkeypatch):
    rows = spark.createDataFrame(table(), TRIPLE)
    assert sgd.choose_blocks(rows) == sgd.LEAST_BLOCKS
    monkeypatch.setattr(sgd, "PAIR_BYTES", 8 * 52 * 10)  # ten ids of 50 factors, of 70
    assert sgd.choose_blocks(rows) == 7
    assert sgd.choose_blocks(rows, rank=258) == 35


def test_plans_of_one_stratum_equal_plain_loops(spark, monkeypatch, tmp_path):
    """Each stratum written by itself; what is written on the way goes."""
    monkeypatch.setattr(sgd, "PLAN_BYTES", 1)
    rows, before = table(4), set(scratch_paths(spark))
    args = dict(rank=3, epochs=2, rate=0.02, reg=0.05, seed=5, blocks=3)
    fit = sgd.fit_sgd(spark.createDataFrame(rows, TRIPLE), path=str(tmp_path / "m"), **args)
    _, p, _, _, bi, errors = one_by_one(spark, rows, **args)
    assert fit.epoch_errors == pytest.approx(errors, rel=1e-9)
    assert all(np.allclose(r[1], p[r[0]], atol=1e-9) for r in fit.model.user_factors.collect())
    assert {r[0]: r[1] for r in fit.model.item_bias.collect()} == pytest.approx(bi, abs=1e-9)
    assert set(scratch_paths(spark)) == before


def test_no_row_grows_with_its_block(monkeypatch):
    """Blocks and cells in many pieces, in any order, give what they give as a whole."""
    monkeypatch.setattr(sgd, "PIECE", 4)
    monkeypatch.setattr(sgd, "CELL_PIECE", 7)
    monkeypatch.setattr(sgd, "WAVE_PART", 3)
    rng = np.random.default_rng(2)
    pairs = sorted({(int(a) * 5, int(b) * 3) for a, b in zip(rng.integers(0, 15, 90), rng.integers(0, 11, 90))})
    users, items = (np.array(x) for x in zip(*pairs))
    cell = sgd._cell(pa.table({
        "user_id": users, "item_id": items, "score": rng.random(len(users)), "place": rng.integers(0, 99, len(users)),
        "ub": pa.array([0] * len(users), pa.int32()), "ib": pa.array([0] * len(users), pa.int32())}))
    states = [sgd._start(2, 1)(pa.table({"id": np.unique(x), "side": [s] * len(np.unique(x)),
                                         "block": pa.array([0] * len(np.unique(x)), pa.int32())}))
              for s, x in (("user", users), ("item", items))]
    assert cell.num_rows > 5 and all(s.num_rows > 2 for s in states)
    assert max(len(v) for s in states for v in s["factors"].to_pylist()) == 4 * 2 * 8
    rows = [r for t in (*states, cell) for r in t.to_pylist()]
    names = dict.fromkeys([*sgd.STATE_ROW.names, "users", "items", "scores", "waves"])
    rows = [names | {"side": "cell"} | r for r in rows]
    rng.shuffle(rows)
    schema = pa.schema([*sgd.STATE_ROW, *(pa.field(n, pa.binary()) for n in list(names)[-4:])])
    batches = pa.Table.from_pylist(rows, schema).to_batches(max_chunksize=3)
    out = pa.Table.from_batches(list(sgd._step(0.5, 0.1, 0.02)(iter(batches)))).sort_by("start").to_pylist()

    def whole(rows, side, name, kind=np.float64):
        return np.frombuffer(b"".join(r[name] for r in rows if r["side"] == side), kind)

    start = [r for s in states for r in s.to_pylist()]
    p, q, bu, bi = (whole(start, s, n).copy() for s, n in (
        ("user", "factors"), ("item", "factors"), ("user", "bias"), ("item", "bias")))
    p, q = p.reshape(-1, 2), q.reshape(-1, 2)
    u, i, score, wave = (np.frombuffer(b"".join(cell[n].to_pylist()), k) for n, k in (
        ("users", np.int64), ("items", np.int64), ("scores", np.float64), ("waves", np.int64)))
    u, i = np.searchsorted(np.unique(users), u), np.searchsorted(np.unique(items), i)
    met = 0.0
    for a, b, s in zip(u, i, score):
        met += sgd.descend(p, q, bu, bi, np.array([a]), np.array([b]), np.array([s]), np.array([1]), 0.5, 0.1, 0.02)
    for side, factors, bias in (("user", p, bu), ("item", q, bi)):
        assert np.allclose(whole(out, side, "factors"), factors.ravel())
        assert np.allclose(whole(out, side, "bias"), bias)
    assert sum(r["errors"] for r in out) == pytest.approx(met)
    assert sum(r["ratings"] for r in out) == len(pairs) and (np.diff(wave) >= 0).all()
