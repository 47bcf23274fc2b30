"""One row of each group of near copies: 5-word shingles with a Jaccard similarity of 0.8 and more.

SimHash with BK-trees (``simhash``), then a check of the pairs found.  Texts with the same set of
shingles are one from the start.  Each distinct set has the 64-bit fingerprint of its shingles, and
two sets are compared if a tree search finds their fingerprints within ``RADIUS`` bits.  Two sets of
similarity 0.8 differ in a bit with a probability of about 0.15 (0.19 at worst, for four shingles
against five), so more than 28 of 64 bits differ in some 1e-8 of such pairs (1e-6 at worst), of more
similar ones in fewer.

At this radius bands of the fingerprint's own bits cannot cut the shards (29 bands of two or three
bits would be needed), and one tree would be walked nearly whole.  So a shard holds the sets that agree
on a band: of each set, 32 bands of six least hash values are taken; two sets of similarity 0.8
agree on a band with a probability of 1 - (1 - 0.8 ** 6) ** 32 = 0.99994, more similar ones sooner.

A pair within the radius is judged by its 192 least values first, a byte of each: the share that
agrees tells the similarity with a standard error of 0.03.  A pair five errors below 0.8 is no link,
and one five errors above it is one (a false verdict has a probability of some 3e-7 either way);
only the pairs between are compared by their whole sets, exactly.  So texts travel for these alone.

In a shard of up to ``small`` sets a tree search for each set finds all pairs within the radius.  In
a larger one the root of the tree, the leader, is compared with all sets on its edges up to the
radius, which links a group of near copies with one pair a set.  The links of all shards make
components.  Of a large shard that then holds several components, every set outside the largest
is searched among the sets of the other components, in blocks of up to 2,048 sets a side that are
each a task with a tree of its own; a block gives one link for two components, not pairs, and a
pair in doubt is compared in the first shard that its sets share.  So every two sets of a shard
within the radius are compared or known to be connected, and no link between them is lost.  Sets
that share a band, fill one shard and are not alike cost up to the square of its size in visited
nodes, but no rows.

Rows are written once in files by their number, so texts move once.

Defined results: null counts as empty; a text of fewer than five words is one shingle; texts
without words are alike; a text of any length is compared whole; of a group the smallest id stays,
of equal ids the first in the input, null after all others; the rows that stay are as they came,
columns with any names included; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketry.llm import simhash
from basketry.llm.common import bodies, bucketed, python_rows, restored, shuffle_width
from basketry.llm.components import components
from basketry.session import drop_paths, materialise, scratch_scope

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 28
BANDS, ROWS = 32, 6
SMALL = 8
BLOCK_SETS = 2048
SEARCH_SETS = 256
ERRORS = 5.0
CHUNK_BYTES = 4 << 20
SEED = 42
_CHUNK = 1 << 14
_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
_MIX[0] |= np.uint64(1)


def shingles(body: bytes) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    return np.unique(simhash.shingle_hashes(body, SHINGLE_WORDS))


def least_values(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _CHUNK):
        mixed = found[at:at + _CHUNK, None] * _MIX[0] + _MIX[1]
        least = np.minimum(least, (mixed ^ mixed >> np.uint64(32)).min(axis=0))
    return least


def bands(least: np.ndarray) -> list[int]:
    """A key per band."""
    return [xxhash.xxh64_intdigest(row.tobytes(), i) >> 1
            for i, row in enumerate(least.reshape(BANDS, ROWS))]


def signature(least: np.ndarray) -> bytes:
    """A byte of each least value."""
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def sure(agreeing: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """1 for pairs of signatures that are surely alike, -1 for surely not, 0 for the others."""
    n = BANDS * ROWS
    share = (agreeing / n - 1 / 256) / (1 - 1 / 256)  # bytes agree by chance, too
    error = ERRORS * np.sqrt(least * (1 - least) / n)
    return np.where(share >= least + error, 1, np.where(share < least - error, -1, 0))


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def _parts(batch: pa.RecordBatch):
    """Slices of a batch of some megabytes of text."""
    held = np.cumsum(pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        limit = (held[start - 1] if start else 0) + CHUNK_BYTES
        end = max(start + 1, int(np.searchsorted(held, limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _set_step(batches):
    for batch in batches:
        for part in _parts(batch):
            keys, fps, prints, found = [], [], [], []
            for body in part.column("body"):
                s = shingles(body.as_py())
                least = least_values(s)
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                fps.append(simhash.signed(simhash.majority(s)))
                prints.append(signature(least))
                found.append(bands(least) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n"), pa.array(keys, pa.binary()),
                 pa.array(fps, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(found, pa.list_(pa.int64()))],
                names=["doc_id", "n", "key", "fp", "print", "bands"])


def _tree_step(batches, radius: int):
    """Pairs within the radius; rows come ordered by shard, and only the current one is held."""
    at, held = None, []

    def pairs():
        values = [fp & (1 << 64) - 1 for _, fp in held]
        return [(held[j][0], held[i][0]) for i, j in simhash.near_pairs(values, radius)]

    for batch in batches:
        found = []
        for bucket, n, fp in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if at != bucket:
                found += pairs()
                at, held = bucket, []
            held.append((n, fp))
        if found:
            yield _pair_batch(found)
    if found := pairs():
        yield _pair_batch(found)


def _pair_batch(pairs):
    return pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in pairs], pa.int64()) for i in range(2)], names=["a", "b"])


def _judge_step(batches):
    """Pairs with both signatures: the verdict of each that is not surely unlike."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8)
                .reshape(-1, BANDS * ROWS) for n in ("print_a", "print_b"))
        verdict = sure((x == y).sum(axis=1))
        at = pa.array(np.flatnonzero(verdict >= 0))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a").take(at), batch.column("b").take(at),
             pa.array(verdict[verdict >= 0] > 0)], names=["a", "b", "linked"])


def _check_step(batches):
    """Pairs with both texts: those that are similar enough."""
    for batch in batches:
        linked = []
        last, held = None, None  # pairs of one leader mostly follow each other
        for x, y in zip(batch.column("body_a"), batch.column("body_b"), strict=True):
            x, y = x.as_py(), y.as_py()
            if x != last:
                last, held = x, shingles(x)
            linked.append(similar(held, shingles(y)))
        at = pa.array(np.flatnonzero(linked))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("a", "b")],
                                         names=["a", "b"])


def _beside(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    for x in ("a", "b"):
        pairs = pairs.join(rows.select(F.col("n").alias(x), F.col(column).alias(f"{column}_{x}")), x)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def _linked(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose sets are similar enough."""
    judged = materialise(python_rows(_beside(pairs.distinct(), sets, "print"), _judge_step,
                                     "a bigint, b bigint, linked boolean"), "copy-pairs")
    exact = python_rows(_beside(judged.where("not linked").select("a", "b"), texts, "body"),
                        _check_step, "a bigint, b bigint")
    return materialise(judged.where("linked").select("a", "b").unionAll(exact), "copy-links")


class _Sets:
    """Shingle sets of the rows of a block, made when first asked for."""

    def __init__(self, table: pa.Table):
        self.bodies, self.found = table.column("body"), {}
        self.buckets = table.column("mixed").to_pylist()

    def __getitem__(self, i: int) -> np.ndarray:
        if i not in self.found:
            self.found[i] = shingles(self.bodies[i].as_py())
        return self.found[i]


_RIGHT = ["n", "root", "outside", "fp", "print", "body", "mixed"]


def _searched(left: np.ndarray, right: np.ndarray, radius: int):
    """For each fingerprint on the left the numbers of those on the right within the radius."""
    distinct, of = np.unique(right, return_inverse=True)
    tree = simhash.BKTree(radius)
    for value in distinct.tolist():
        tree.add(value)
    for start in range(0, len(left), SEARCH_SETS):
        part = left[start:start + SEARCH_SETS]
        asked, nodes = tree.near_all(part)
        near = np.zeros((len(part), len(distinct)), bool)
        near[asked, nodes] = True
        for row in near:
            yield np.flatnonzero(row[of])


def _compare_blocks(left: pa.Table, right: pa.Table, radius: int) -> pa.Table:
    """The roots of components that any sets of both sides link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    right = right.select([f"{c}_y" for c in _RIGHT]).rename_columns(_RIGHT)
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    x, y = (np.frombuffer(b"".join(t.column("print").to_pylist()), np.uint8)
            .reshape(-1, BANDS * ROWS) for t in (left, right))
    n_x, n_y, root_x, root_y = (t.column(c).to_numpy() for c in ("n", "root") for t in (left, right))
    outside = right.column("outside").to_numpy(zero_copy_only=False)
    bucket = left.column("bucket")[0].as_py()
    sets_x, sets_y = _Sets(left), _Sets(right)
    linked = {}
    fp_x, fp_y = (t.column("fp").to_numpy().view(np.uint64) for t in (left, right))
    for i, near in enumerate(_searched(fp_x, fp_y, radius)):
        # Two sets outside the main component meet twice; the smaller number counts.
        done = linked.setdefault(root_x[i], {root_x[i]})
        near = near[~np.isin(root_y[near], list(done)) & (~outside[near] | (n_x[i] < n_y[near]))]
        agreeing = (y[near] == x[i]).sum(axis=1)
        verdict = sure(agreeing)
        for k in sorted(np.flatnonzero(verdict >= 0).tolist(), key=lambda k: -agreeing[k]):
            j = near[k]
            if root_y[j] in done:
                continue
            if verdict[k] == 0 and (
                    min(set(sets_x.buckets[i]).intersection(sets_y.buckets[j])) != bucket
                    or not similar(sets_x[i], sets_y[j])):
                continue
            done.add(root_y[j])
    found = [(one, two) for one, done in linked.items() for two in done if one != two]
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)


def _across(large: DataFrame, roots: DataFrame, sets: DataFrame, texts: DataFrame,
            radius: int) -> DataFrame:
    """Links between the components ``(n, root)`` of large buckets (``bucket, n``), by their roots."""
    placed = materialise(large.join(roots, "n", "left").select(
        "bucket", "n", F.coalesce("root", "n").alias("root")), "placed")
    main = (placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("bucket").agg(F.max_by("root", F.struct("size", "root")).alias("main"),
                                   F.count(F.lit(1)).alias("kinds"), F.sum("size").alias("sets"))
            .where("kinds > 1"))
    mixed = materialise(placed.join(main, "bucket").select(
        "bucket", "n", "root", (F.col("root") != F.col("main")).alias("outside"),
        F.ceil(F.col("sets") / BLOCK_SETS).cast("int").alias("blocks")), "mixed")
    each = (mixed.groupBy("n").agg(F.collect_list("bucket").alias("mixed"))  # one per band at most
            .join(sets.select("n", "fp", "print"), "n").join(texts.select("n", "body"), "n"))
    rows = mixed.join(each, "n").withColumn("own", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.where("outside").select("bucket", F.col("own").alias("x"), every.alias("y"),
                                        "n", "root", "fp", "print", "body", "mixed")
    # Other names than on the left, whose columns these are.
    right = rows.select(F.col("bucket").alias("at"), every.alias("p"), F.col("own").alias("q"),
                        *(F.col(c).alias(f"{c}_y") for c in _RIGHT))

    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        return _compare_blocks(one, two, radius)

    return materialise(left.groupBy("bucket", "x", "y").cogroup(right.groupBy("at", "p", "q"))
                       .applyInArrow(compare, "a bigint, b bigint"), "copy-links")


def connected(sets: DataFrame, texts: DataFrame, firsts: DataFrame, small: int = SMALL,
              radius: int = RADIUS) -> DataFrame:
    """``firsts`` with the ``root`` of the near copies that each belongs to.

    ``sets`` has ``n, fp, print, bands`` of all rows, ``texts`` their ``n, body``; ``firsts`` has the
    ``n`` of one row of each set.
    """
    every = sets.join(firsts, "n", "left_semi").select(
        "n", "fp", F.explode("bands").alias("bucket"))
    size = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"),
                                       F.min(F.struct("n", "fp")).alias("leader"))
    rows = materialise(every.join(size.where("size > 1"), "bucket"), "buckets")
    shards = (rows.where(F.col("size") <= small).select("bucket", "n", "fp")
              .repartition(shuffle_width(rows.sparkSession), "bucket")
              .sortWithinPartitions("bucket", "n"))
    pairs = python_rows(shards, partial(_tree_step, radius=radius), "a bigint, b bigint")
    edge = F.bit_count(F.col("fp").bitwiseXOR(F.col("leader.fp")))
    star = rows.where((F.col("size") > small) & (F.col("n") != F.col("leader.n"))
                      & (edge <= radius)).select(F.col("leader.n").alias("a"), F.col("n").alias("b"))
    roots = components(_linked(pairs.unionAll(star), sets, texts)).select(
        F.col("node").alias("n"), "root")
    large = rows.where(F.col("size") > small).select("bucket", "n")
    tops = components(_across(large, roots, sets, texts, radius)).select(
        F.col("node").alias("root"), F.col("root").alias("top"))
    return (firsts.join(roots, "n", "left").withColumn("root", F.coalesce("root", "n"))
            .join(tops, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
             small: int = SMALL, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near copies."""
    whole = bucketed(bodies(docs, id_col, text_col, whole=True)
                     .withColumn("n", F.monotonically_increasing_id()), "n", "near_rows")
    with scratch_scope() as own:
        sets = materialise(python_rows(
            whole.select("doc_id", "n", "body"), _set_step,
            "doc_id bigint, n bigint, key binary, fp bigint, print binary, bands array<bigint>"),
            "shingle-sets")
        best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")
        firsts = materialise(sets.groupBy("key").agg(F.min(best).alias("first"))
                             .select("first", F.col("first.n").alias("n")), "set-firsts")
        kept = materialise(
            connected(sets, whole.select("n", "body"), firsts, small, radius)
            .groupBy("root").agg(F.min("first").alias("first"))
            .select(F.col("first.n").alias("n")), "kept")
    drop_paths(docs.sparkSession, own[:-1])
    return restored(whole.join(kept, "n", "left_semi"), docs, text_col)
