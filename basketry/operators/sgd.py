"""Biased matrix factorisation by stochastic gradient descent over disjoint blocks.

Biases and factors are learned together, one rating after the other:

    e = score - (mean + bu + bi + p.q)
    bu += rate (e - reg bu)    p += rate (e q - reg p)
    bi += rate (e - reg bi)    q += rate (e p - reg q)

Users and items are dealt into as many blocks each, ratings into cells of a user and an item
block.  An epoch goes through strata: in stratum s user block b meets item block b + s, so the
cells of a stratum share neither a user nor an item and are worked on side by side, each by one
task that holds its two blocks.  So many blocks are made that two of them take some 192 MB, and they
travel in pieces of 512 ids, which a task lays into its arrays one by one: no row, batch or task
grows with the tables.  The strata of an epoch are one plan, or several if the state is large, since
each stratum shuffles the state; the result of a plan is written to the shared folder, so a lost
executor costs an epoch at most.

Inside a cell ratings keep a fixed order (by a hash), but go in waves: a rating's wave comes after
those of the earlier ratings of its user and of its item, so no wave has a user or an item twice,
and a wave computed at once gives what its ratings give one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from basketry.operators.factor_model import TABLES, FactorModel, _write_scalars
from basketry.session import (drop_paths, materialise, scratch_path, scratch_scope, settings,
                              shared_folder, ship_package, shuffles_dropped)

CELL_RATINGS = 2_000_000
LEAST_BLOCKS = 4
# A user and an item block together, and the state that the strata of one plan shuffle.
PAIR_BYTES, PLAN_BYTES = 192 << 20, 1 << 30
# Ids of a state row and ratings of a cell row, ratings taken at once; rows of a batch on their way.
PIECE, CELL_PIECE, WAVE_PART = 512, 16_384, 16_384
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "64",
           "spark.sql.parquet.columnarReaderBatchSize": "64"}
START_SPREAD = 0.1
# ``size`` rows of a cell or block in all, those of a piece from ``start`` on.
CELLS = ("ub int, ib int, size int, start int, users binary, items binary, scores binary, "
         "waves binary")
STATE = ("side string, block int, size int, start int, ids binary, bias binary, factors binary, "
         "errors double, ratings bigint")
STATE_ROW = pa.schema([("side", pa.string()), ("block", pa.int32()), ("size", pa.int32()),
                       ("start", pa.int32()), ("ids", pa.binary()), ("bias", pa.binary()),
                       ("factors", pa.binary()), ("errors", pa.float64()), ("ratings", pa.int64())])


def start_factors(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Normal numbers with a spread of 0.1 that depend on id, column and seed alone."""
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
             + np.arange(1, 2 * rank + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
             + np.uint64(seed) * np.uint64(0x94D049BB133111EB))
        for _ in range(2):
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    even = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return START_SPREAD * np.sqrt(-2 * np.log(even[:, :rank])) * np.cos(2 * np.pi * even[:, rank:])


def waves(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The wave of each rating: one more than that of its user's and item's last one."""
    (n_users, users), (n_items, items) = ((len(x), y) for x, y in (
        np.unique(ids, return_inverse=True) for ids in (users, items)))
    user_next, item_next = [0] * n_users, [0] * n_items
    out = np.empty(len(users), dtype=np.int64)
    for start in range(0, len(users), CELL_PIECE):
        part = slice(start, start + CELL_PIECE)
        for k, (u, i) in enumerate(zip(users[part].tolist(), items[part].tolist(), strict=True), start):
            w = max(user_next[u], item_next[i])
            out[k] = w
            user_next[u] = item_next[i] = w + 1
    return out


def _pieces(values: np.ndarray, starts: range) -> pa.Array:
    return pa.array([values[a:a + starts.step].tobytes() for a in starts], pa.binary())


def _cell(table: pa.Table) -> pa.Table:
    """Ratings of a cell in waves."""
    table = table.sort_by([("place", "ascending"), ("user_id", "ascending"), ("item_id", "ascending")])
    users, items, scores = (table.column(c).to_numpy() for c in ("user_id", "item_id", "score"))
    wave = waves(users, items)
    order = np.argsort(wave, kind="stable")
    starts = range(0, len(order), CELL_PIECE)
    same = {"ub": table.column("ub")[0], "ib": table.column("ib")[0], "size": len(order)}
    return pa.table({**{n: pa.array([pa.scalar(v).as_py()] * len(starts), pa.int32())
                        for n, v in same.items()}, "start": pa.array(starts, pa.int32()),
                     **{n: _pieces(x[order], starts) for n, x in
                        (("users", users), ("items", items), ("scores", scores), ("waves", wave))}})


def descend(p, q, bu, bi, u, i, scores, ends, mean, rate, reg) -> float:
    """One pass over a cell, wave by wave, in place; the sum of squared errors it met."""
    errors, start = 0.0, 0
    for end in ends.tolist():
        # Parts of a wave share nothing either, and keep what is worked on small.
        for first in range(start, end, WAVE_PART):
            part = slice(first, min(first + WAVE_PART, end))
            a, b = u[part], i[part]
            x, y = p[a], q[b]
            e = scores[part] - (mean + bu[a] + bi[b] + (x * y).sum(axis=1))
            bu[a] += rate * (e - reg * bu[a])
            bi[b] += rate * (e - reg * bi[b])
            p[a] = x + rate * (e[:, None] * y - reg * x)
            q[b] = y + rate * (e[:, None] * x - reg * y)
            errors += float(e @ e)
        start = end
    return errors


def _numbers(value, kind=np.float64) -> np.ndarray:
    return np.frombuffer(value.as_py(), dtype=kind)


def _laid(arrays: dict, row, size: int, start: int, kinds: dict) -> int:
    """Lay a piece into the arrays of its whole, made with its first piece; gives its length."""
    count = 0
    for name, kind in kinds.items():
        values = _numbers(row(name), kind)
        count = count or len(values)
        values = values.reshape(count, -1)
        if name not in arrays:
            arrays[name] = np.empty((size, values.shape[1]), kind)
        arrays[name][start:start + count] = values
    return count


def _step(mean: float, rate: float, reg: float):
    block = {"ids": np.int64, "bias": np.float64, "factors": np.float64}
    rated = {"users": np.int64, "items": np.int64, "scores": np.float64, "waves": np.int64}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A user and an item block after the ratings of their cell."""
        sides: dict[str, dict] = {"user": {}, "item": {}, "cell": {}}
        heads = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = lambda n: batch.column(n)[k]  # noqa: E731, B023
                side, number, size, start, errors, ratings = (row(n).as_py() for n in (
                    "side", "block", "size", "start", "errors", "ratings"))
                count = _laid(sides[side], row, size, start, rated if side == "cell" else block)
                if side != "cell":
                    heads.append([side, number, size, start, count, errors, ratings])
        users, items, cell = sides.values()
        if cell:
            u, i = (np.searchsorted(s["ids"][:, 0], cell[n][:, 0])
                    for s, n in ((users, "users"), (items, "items")))
            ends = np.cumsum(np.bincount(cell["waves"][:, 0]))
            met = descend(users["factors"], items["factors"], users["bias"][:, 0], items["bias"][:, 0],
                          u, i, cell["scores"][:, 0], ends, mean, rate, reg)
            first = next(h for h in heads if h[0] == "user")
            first[-2] += met
            first[-1] += len(u)
        for side, number, size, start, count, errors, ratings in heads:
            values = [side, number, size, start,
                      *(sides[side][n][start:start + count].tobytes() for n in block), errors, ratings]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(values, STATE_ROW, strict=True)], schema=STATE_ROW)
    return step


def _start(rank: int, seed: int):
    def start(table: pa.Table) -> pa.Table:
        ids = np.sort(table.column("id").to_numpy())
        side, number = (table.column(c)[0].as_py() for c in ("side", "block"))
        starts = range(0, len(ids), PIECE)
        parts = [ids[a:a + PIECE] for a in starts]
        n = len(parts)
        return pa.table([
            pa.array([side] * n), pa.array([number] * n, pa.int32()), pa.array([len(ids)] * n, pa.int32()),
            pa.array(starts, pa.int32()), _pieces(ids, starts), _pieces(np.zeros(len(ids)), starts),
            pa.array([start_factors(x, rank, 2 * seed + (side == "item")).tobytes() for x in parts],
                     pa.binary()), pa.array([0.0] * n), pa.array([0] * n, pa.int64())], schema=STATE_ROW)
    return start


def _unpacked(side: str):
    def step(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids = _numbers(batch.column("ids")[k], np.int64)
                bias, flat = (_numbers(batch.column(c)[k]) for c in ("bias", "factors"))
                offsets = np.arange(len(ids) + 1) * (len(flat) // max(1, len(ids)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(bias),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                    names=[f"{side}_id", f"{side}_bias", f"{side}_factor"])
    return step


def block_of(column: str, blocks: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column), F.lit(salt)), F.lit(blocks)).cast("int")


def place_of(seed: int) -> Column:
    """The order of ratings inside a cell."""
    return F.xxhash64("user_id", "item_id", F.lit(seed))


def state_bytes(triples: DataFrame, rank: int) -> int:
    """What all ids, biases and factors take."""
    ids = sum(triples.select(c).distinct().count() for c in ("user_id", "item_id"))
    return 8 * (rank + 2) * ids


def choose_blocks(triples: DataFrame, rank: int = 50) -> int:
    """So many blocks that a cell has some million ratings, also that of a hot user or item, and
    that a task can hold the user and the item block that meet in it."""
    n = triples.count()
    hottest = max([triples.groupBy(c).count().agg(F.max("count")).first()[0] or 0
                   for c in ("user_id", "item_id")])
    return max(LEAST_BLOCKS, -(-hottest // CELL_RATINGS), int(np.ceil((n / CELL_RATINGS) ** 0.5)),
               -(-state_bytes(triples, rank) // PAIR_BYTES))


@dataclass(frozen=True)
class SgdFit:
    """The model, and the root mean squared error that each epoch met as it went."""

    model: FactorModel
    epoch_errors: list[float]


def fit_sgd(triples: DataFrame, rank: int = 50, epochs: int = 20, rate: float = 0.005,
            reg: float = 0.02, seed: int = 42, blocks: int | None = None,
            path: str | None = None) -> SgdFit:
    """Fit mean, biases and factors; the tables are written to ``path`` or a scratch folder.

    ``blocks`` is also the number of tasks that work at a time; it is chosen by the ratings if not
    given, and the result depends on it, on the seed and on the ratings alone.
    """
    spark = triples.sparkSession
    shared_folder(spark)
    ship_package(spark)
    path = path or scratch_path(spark, "sgd-model")
    with scratch_scope() as own, shuffles_dropped(spark):
        fit = _fit(triples, rank, epochs, rate, reg, seed, blocks, path)
    drop_paths(spark, own)
    return fit


def _fit(triples: DataFrame, rank: int, epochs: int, rate: float, reg: float, seed: int,
         blocks: int | None, path: str) -> SgdFit:
    spark = triples.sparkSession
    triples = materialise(triples.select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("item_id").cast("bigint").alias("item_id"),
        F.col("score").cast("double").alias("score")), "ratings")
    mean = triples.agg(F.avg("score")).first()[0]
    if mean is None:
        raise ValueError("there are no ratings to fit")
    blocks = blocks or choose_blocks(triples, rank)
    together = max(1, PLAN_BYTES // state_bytes(triples, rank))
    dealt = triples.select("*", block_of("user_id", blocks, 1).alias("ub"),
                           block_of("item_id", blocks, 2).alias("ib"), place_of(seed).alias("place"))
    cells = materialise(dealt.groupBy("ub", "ib").applyInArrow(_cell, CELLS), "cells")
    cells = cells.withColumn("side", F.lit("cell")).withColumn("meets", F.col("ub"))
    sides = [dealt.select(F.lit(s).alias("side"), F.col(f"{s[0]}b").alias("block"),
                          F.col(f"{s}_id").alias("id")).distinct() for s in ("user", "item")]
    start = sides[0].unionAll(sides[1]).groupBy("side", "block").applyInArrow(_start(rank, seed), STATE)
    with scratch_scope() as written:
        state = materialise(start, "sgd-state")
    errors = []
    for _ in range(epochs):
        now = state.withColumn("errors", F.lit(0.0)).withColumn("ratings", F.lit(0).cast("bigint"))
        for stratum in range(blocks):
            meets = F.when(F.col("side") == "user", F.col("block")).otherwise(
                F.pmod(F.col("block") - stratum, F.lit(blocks))).cast("int")
            here = cells.where(F.pmod(F.col("ib") - F.col("ub"), F.lit(blocks)) == stratum).drop("ub", "ib")
            now = (now.withColumn("meets", meets).unionByName(here, allowMissingColumns=True)
                   .groupBy("meets").applyInArrow(_step(mean, rate, reg), STATE))
            if (stratum + 1) % together and stratum + 1 < blocks:
                continue
            done = list(written)
            with scratch_scope() as written, settings(spark, BATCHES):
                now = state = materialise(now, "sgd-state")
            drop_paths(spark, done)
        met = state.agg(F.sum("errors"), F.sum("ratings")).first()
        errors.append(float((met[0] / met[1]) ** 0.5))

    def keep(table: DataFrame, name: str) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(TABLES[name]).parquet(f"{path}/{name}")

    tables = {}
    for side in ("user", "item"):
        schema = f"{side}_id bigint, {side}_bias double, {side}_factor array<double>"
        flat = state.where(F.col("side") == side).select("ids", "bias", "factors").mapInArrow(
            _unpacked(side), schema)
        tables[f"{side}_bias"] = keep(flat.select(f"{side}_id", f"{side}_bias"), f"{side}_bias")
        with settings(spark, BATCHES):
            tables[f"{side}_factors"] = keep(flat.select(f"{side}_id", f"{side}_factor"),
                                             f"{side}_factors")
    _write_scalars(spark, path, mean, rank)
    return SgdFit(FactorModel(mean, tables["user_bias"], tables["item_bias"], tables["user_factors"],
                              tables["item_factors"], rank), errors)
