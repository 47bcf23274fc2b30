"""SimHash near-dedup with BK-trees.

A text's fingerprint has 64 bits; a bit is set when it is set in over half of the hashes of the
text's 3-word shingles.  Texts whose fingerprints differ in at most two bits are linked, and
linked texts form a component.

Links are found among distinct fingerprints with Burkhard-Keller trees: children are keyed by
their integer Hamming distance to the parent, and a search from a node at distance d follows
only the edges d - radius .. d + radius.  One tree over the corpus would be walked nearly whole,
as most fingerprints lie some 32 bits apart, and broadcasting its shards would send every
fingerprint to every executor.  So a shard holds the fingerprints that agree on one of three
bands of bits: two fingerprints that differ in two bits at most agree on at least one band, so a
fingerprint needs to meet only the trees of its own three band values, and each meets them in the
task that holds the shard.  A shard above ``shard_rows`` is cut again by three bands of the bits
left over, and once more; after three cuts at most 20 bits are left, so no shard can exceed
2 ** 20 fingerprints whatever the corpus holds.  A shard reports a spanning forest of its links,
never all pairs.

The words of a shingle and the radius of a tree are parameters; ``nearcopies`` searches with wider
ones, over shards of its own.

Defined results: null counts as empty; a text without words has the fingerprint zero and links
like any other; a null id takes the smallest id its component has, and is never that id itself
unless all are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from basketry.llm.common import bodies, python_rows, restored, shuffle_width
from basketry.llm.components import components
from basketry.session import materialise

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
SHARD_ROWS = 4096
LEVELS = 3

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def shingle_hashes(body: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of a text's shingles in order, repeats included."""
    words = body.lower().split()  # bytes.lower() changes A-Z alone
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in
                     zip(starts[:n], ends[-n:], strict=True)], dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """Unsigned 64-bit fingerprint of hashes: the bits set in over half of them."""
    if not len(hashes):
        return 0
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BYTE_BITS
                             for k in range(8)])
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(body: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    return majority(shingle_hashes(body, shingle_words))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprint_step(batches):
    for batch in batches:
        prints = [signed(fingerprint(b)) for b in batch.column("body").to_pylist()]
        kept = [n for n in batch.schema.names if n != "body" or "_row" in batch.schema.names]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(prints, pa.int64())],
            names=[*kept, "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 whole: bool = False) -> DataFrame:
    taken = bodies(docs, id_col, text_col, whole)
    schema = T.StructType([f for f in taken.schema.fields if f.name != "body" or whole]
                          + [T.StructField("fp", T.LongType())])
    return python_rows(taken, _fingerprint_step, schema)


def _bands(free: list[int]) -> list[int]:
    """Masks of three near-equal runs of the given bit numbers."""
    return [sum(1 << int(b) for b in part) for part in np.array_split(free, RADIUS + 1)]


def _cuts(level: int) -> dict[int, list[tuple[int, int]]]:
    """Path of a shard at ``level - 1`` -> paths and masks (all bits agreed on) one level on."""
    paths = {0: 0}
    for _ in range(level):
        found = {path: [(path * 4 + j + 1, mask | band) for j, band in
                        enumerate(_bands([b for b in range(64) if not mask >> b & 1]))]
                 for path, mask in paths.items()}
        paths = {p: m for cut in found.values() for p, m in cut}
    return found


class BKTree:
    """Children by integer Hamming distance to their parent."""

    def __init__(self, radius: int = RADIUS):
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int) -> list[int]:
        """Numbers of the nodes within the radius."""
        if not self.values:
            return []
        found, todo, r = [], [0], self.radius
        values, children = self.values, self.children
        while todo:
            node = todo.pop()
            d = (values[node] ^ value).bit_count()
            if d <= r:
                found.append(node)
            edges = children[node]
            if len(edges) > 2 * r + 1:
                todo += [edges[k] for k in range(d - r, d + r + 1) if k in edges]
            else:
                todo += [child for k, child in edges.items() if d - r <= k <= d + r]
        return found

    def add(self, value: int) -> int:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while node != new:
            node = self.children[node].setdefault((self.values[node] ^ value).bit_count(), new)
        return new

    def near_all(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``near`` for many values in one walk, level by level: numbers of values and of nodes."""
        nodes = np.array(self.values, np.uint64)
        size = np.array([len(c) for c in self.children], np.int64)
        starts = np.cumsum(size) - size
        edge = np.array([k for c in self.children for k in c], np.int64)
        child = np.array([n for c in self.children for n in c.values()], np.int64)
        asked = np.arange(len(values) if len(nodes) else 0)
        at = np.zeros(len(asked), np.int64)
        found = [(asked[:0], at[:0])]
        while len(asked):
            d = np.bitwise_count(nodes[at] ^ values[asked]).astype(np.int64)
            found.append((asked[d <= self.radius], at[d <= self.radius]))
            n = size[at]
            below = np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            follow = np.abs(np.repeat(d, n) - edge[below]) <= self.radius
            asked, at = np.repeat(asked, n)[follow], child[below[follow]]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def near_pairs(values: list[int], radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Numbers ``(i, j)``, i > j, of the values within the radius, by a tree that grows with i."""
    tree = BKTree(radius)
    for i, value in enumerate(values):
        for j in tree.near(value):
            yield i, j
        tree.add(value)


def shard_links(values: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links within a shard of distinct fingerprints."""
    if len(values) == 2:
        return [(values[0], values[1])] if (values[0] ^ values[1]).bit_count() <= RADIUS else []
    parent, links = list(range(len(values))), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in near_pairs(values):
        if (a := root(i)) != (b := root(j)):
            parent[a] = b
            links.append((values[i], values[j]))
    return links


def _shard_step(batches):
    """Rows come ordered by shard; only the current shard is held."""
    at, held = None, []
    for batch in batches:
        links = []
        for path, agreed, fp in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if at != (path, agreed):
                links += shard_links(held) if len(held) > 1 else []
                at, held = (path, agreed), []
            held.append(fp & (1 << 64) - 1)
        if links:
            yield _link_batch(links)
    if len(held) > 1 and (links := shard_links(held)):
        yield _link_batch(links)


def _link_batch(links):
    return pa.RecordBatch.from_arrays(
        [pa.array([signed(x[i]) for x in links], pa.int64()) for i in range(2)], names=["a", "b"])


def near_links(prints: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(a, b)``: links that connect all fingerprints (column ``fp``, distinct) within the radius."""
    spark = prints.sparkSession
    width = shuffle_width(spark)
    ready = None
    rows = prints.select(F.lit(0).alias("path"), F.lit(0).cast("bigint").alias("agreed"), "fp")
    for level in range(1, LEVELS + 1):
        options = None
        for path, cuts in _cuts(level).items():
            shards = F.array(*(F.struct(F.lit(p).alias("path"), F.col("fp").bitwiseAND(
                F.lit(signed(m))).alias("agreed")) for p, m in cuts))
            options = F.when(F.col("path") == path, shards) if options is None else \
                options.when(F.col("path") == path, shards)
        rows = rows.select("fp", F.explode(options).alias("s")).select("s.path", "s.agreed", "fp")
        sizes = rows.groupBy("path", "agreed").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = materialise(rows.join(sizes, ["path", "agreed"]), "shards")
        fit = rows
        if level < LEVELS:
            fit = rows.where(F.col("n") <= shard_rows)
            rows = rows.where(F.col("n") > shard_rows)
        fit = fit.select("path", "agreed", "fp")
        ready = fit if ready is None else ready.unionAll(fit)
    dealt = (ready.repartition(width, "path", "agreed")
             .sortWithinPartitions("path", "agreed", "fp"))
    return python_rows(dealt, _shard_step, "a bigint, b bigint")


def _components(prints: DataFrame, shard_rows: int) -> DataFrame:
    """``(fp, root)`` of the fingerprints that have a link."""
    links = near_links(prints.select("fp").distinct(), shard_rows)
    return components(links).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row."""
    prints = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    roots = _components(prints, shard_rows)
    firsts = (prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(roots, "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    firsts = materialise(firsts, "fingerprint-groups")
    ids = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    owners = firsts.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return prints.join(owners, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of each component: the smallest id, of equal ids the first in the input."""
    whole = materialise(fingerprints(docs, id_col, text_col, True)
                        .withColumn("_n", F.monotonically_increasing_id()), "fingerprints")
    prints = whole.select("doc_id", "_n", "fp")
    best = F.struct(F.col("doc_id").isNull(), "doc_id", "_n")
    firsts = (prints.groupBy("fp").agg(F.min(best).alias("first"))
              .join(_components(prints, shard_rows), "fp", "left")
              .groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first"))
              .select(F.col("first._n").alias("_n")))
    return restored(whole.join(firsts, "_n", "left_semi"), docs, text_col)
