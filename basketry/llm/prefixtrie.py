"""Prefix trie of rebuilt conversations, its subtrees summed along an Euler tour.

Every conversation c is rebuilt: the first h turns of conversation ``c - c % family`` and then its
own turns after its first h, where h is ``crc32(c) % most``.  Each distinct sequence of the first
d rebuilt turns is a node.

1. Turns travel as digests of role and text.  Rebuilt turns are range sorted; a scan in blocks
   gives every prefix a 127-bit polynomial hash (each sorted partition sums up its last
   conversation, the summaries are chained, and every partition starts from what came before).
2. Nodes are partial aggregates by prefix hash.  Sorted by parent and smallest member they get
   numbers in which siblings follow each other.
3. A node has an enter arc and an exit arc.  Enter leads to the first child's enter, or to the own
   exit; exit to the next sibling's enter, or to the parent's exit.  The arcs are one list, the
   tour.
4. The list is ranked: arcs that follow each other in a bucket (of some turns of one smallest
   member) are joined to runs first; runs then learn their distance to the end by pointer jumping,
   each round a join of the runs still on their way, written to the shared folder.
5. Sorted by position, leaves and savings are summed in blocks; what lies between a node's enter
   and exit is its subtree.

No step gathers the children, members or turns of a node or a conversation; members that end at a
node are joined in blocks, and only the hash of the joined list, serial by nature, streams them
through one task.

Defined results: a null role or text is empty; turns are ordered with null first, equal turn
numbers by the digest of role and text, and repeated rows are turns of their own; rows without a
conv_id belong to no conversation; a conversation whose turns all fall away is a member of the
root alone; an empty table has no node, not even a root; texts of any length are hashed where they
lie; columns other than the four are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.positions import global_position
from basketry.llm.common import python_rows, shuffle_width
from basketry.session import drop_paths, materialise, scratch_scope, shared_folder, ship_package

FAMILY, MOST = 5, 9
BUCKET_TURNS = 1024
BUCKET_NODES = 100_000
BLOCK_ARCS = 1 << 16
END_IDS = 4096
_PRIME = (1 << 127) - 1
_BASE = 0x5A3C9F17D2E84B6190C7F3A5B1D86E4F % _PRIME
ROOT = (1).to_bytes(16, "big")

SUMMARY_SCHEMA = ("part int, first bigint, last bigint, heads bigint, head_state binary, "
                  "own bigint, firsts array<binary>, rest binary")
PREFIX_SCHEMA = "conv bigint, depth bigint, key binary, parent binary, size bigint"
RUN_SCHEMA = "arc bigint, head bigint, offset bigint, next bigint, length bigint"
BLOCK_SCHEMA = "key binary, first bigint, ids string"
ENDS_SCHEMA = "key binary, ends_sha256 string"


def borrowed(conv: Column, most: int = MOST) -> Column:
    """The number of turns that a conversation takes from the first of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % most


def _taken(conv: int, most: int) -> int:
    return zlib.crc32(str(conv).encode()) % most


# Rebuilt conversations and their prefixes -----------------------------------------------------

def turn_digests(conversations: DataFrame) -> DataFrame:
    """``(conv, at, x, size)``: each turn with 16 bytes of hash and the bytes of its text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.select(
        F.col("`conv_id`").cast("bigint").alias("conv"), F.col("`turn`").cast("bigint").alias("at"),
        F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, 16).alias("x"),
        F.octet_length(text).cast("bigint").alias("size")).where("conv is not null"))


def rebuilt(turns: DataFrame, family: int = FAMILY, most: int = MOST) -> DataFrame:
    """``(conv, own, at, x, size)``: taken turns (own = 0) and all own ones (own = 1).

    The scan leaves out the first own turns.  The first ``most`` turns of a conversation are found
    by a limit inside each task before the shuffle.
    """
    first = Window.partitionBy("conv").orderBy(F.asc_nulls_first("at"), "x")
    heads = (turns.withColumn("d", F.row_number().over(first)).where(F.col("d") < most)
             .select(F.col("conv").alias("family"), F.col("d").cast("bigint").alias("d"), "x", "size"))
    members = turns.select("conv").distinct().select(
        "conv", (F.col("conv") - F.col("conv") % family).alias("family"))
    taken = (members.join(heads, "family").where(F.col("d") <= borrowed(F.col("conv"), most))
             .select("conv", F.lit(0).alias("own"), F.col("d").alias("at"), "x", "size"))
    return taken.unionAll(turns.select("conv", F.lit(1).alias("own"), "at", "x", "size"))


class _Chain:
    """The state of a conversation: turns so far, own turns met, prefix hash."""

    def __init__(self, conv, most, depth=0, own=0, state=1):
        self.conv, self.depth, self.own, self.state = conv, depth, own, state
        self.skip = _taken(conv, most)

    def step(self, x: bytes) -> None:
        self.state = (self.state * _BASE + int.from_bytes(x, "big")) % _PRIME
        self.depth += 1

    def jump(self, n: int, state: int) -> None:
        """As ``n`` steps that led from 0 to ``state``."""
        self.state = (self.state * pow(_BASE, n, _PRIME) + state) % _PRIME
        self.depth += n


def _bytes(state: int) -> bytes:
    return state.to_bytes(16, "big")


def _summary_step(most: int):
    """One row per partition about its last conversation."""
    def step(batches):
        part = first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, owns, xs = (batch.column(n).to_pylist() for n in ("conv", "own", "x"))
            if part is None:
                part, first = batch.column("part")[0].as_py(), convs[0]
            for conv, own, x in zip(convs, owns, xs, strict=True):
                if conv != last:
                    last, heads, head, n, firsts, rest = conv, 0, 0, 0, [], 0
                value = int.from_bytes(x, "big")
                if not own:
                    heads, head = heads + 1, (head * _BASE + value) % _PRIME
                elif n < most:
                    n += 1
                    firsts.append(x)
                else:
                    n, rest = n + 1, (rest * _BASE + value) % _PRIME
        if part is not None:
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "first": first, "last": last, "heads": heads,
                  "head_state": _bytes(head), "own": n, "firsts": firsts, "rest": _bytes(rest)}],
                schema=pa.schema([("part", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
                                  ("heads", pa.int64()), ("head_state", pa.binary()),
                                  ("own", pa.int64()), ("firsts", pa.list_(pa.binary())),
                                  ("rest", pa.binary())]))
    return step


def _carries(summaries: list, most: int) -> dict[int, tuple]:
    """What each partition starts from: ``part -> (conv, depth, own, state)``."""
    found, chain = {}, None
    for row in sorted(summaries, key=lambda r: r["part"]):
        if chain is not None and chain.conv == row["first"]:
            found[row["part"]] = (chain.conv, chain.depth, chain.own, chain.state)
        if chain is None or chain.conv != row["last"]:
            chain = _Chain(row["last"], most)
        chain.jump(row["heads"], int.from_bytes(row["head_state"], "big"))
        for x in row["firsts"]:
            chain.own += 1
            if chain.own > chain.skip:
                chain.step(x)
        more = row["own"] - len(row["firsts"])
        chain.own += more
        if more:  # behind ``most`` own turns none is left out
            chain.jump(more, int.from_bytes(row["rest"], "big"))
    return found


def _prefix_step(shared, most: int):
    def step(batches):
        chain = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n).to_pylist() for n in ("conv", "own", "x", "size")]
            if chain is None:
                start = shared.value.get(batch.column("part")[0].as_py())
                chain = _Chain(start[0], most, *start[1:]) if start else None
            out = []
            for conv, own, x, size in zip(*columns, strict=True):
                if chain is None or chain.conv != conv:
                    chain = _Chain(conv, most)
                if own:
                    chain.own += 1
                    if chain.own <= chain.skip:
                        continue
                before = chain.state
                chain.step(x)
                out.append((conv, chain.depth, _bytes(chain.state), _bytes(before), size))
            if out:
                conv, depth, key, parent, size = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(conv, pa.int64()), pa.array(depth, pa.int64()),
                     pa.array(key, pa.binary()), pa.array(parent, pa.binary()),
                     pa.array(size, pa.int64())], names=["conv", "depth", "key", "parent", "size"])
    return step


def prefixes(rows: DataFrame, most: int = MOST) -> DataFrame:
    """``(conv, depth, key, parent, size)``: every prefix of every rebuilt conversation."""
    spark = rows.sparkSession
    shared_folder(spark)
    placed = (rows.orderBy("conv", "own", F.asc_nulls_first("at"), "x")
              .withColumn("part", F.spark_partition_id()).checkpoint())
    # One row per sorted partition.
    summaries = python_rows(placed, _summary_step(most), SUMMARY_SCHEMA).collect()
    carry = spark.sparkContext.broadcast(_carries(summaries, most))
    return materialise(python_rows(placed, _prefix_step(carry, most), PREFIX_SCHEMA), "prefixes")


# The tour -------------------------------------------------------------------------------------

def tree(found: DataFrame, members: DataFrame) -> DataFrame:
    """Numbered nodes with their first child, parent, and whether a sibling follows.

    ``id, key, conv, depth, n_convs, size, n_children, first_child, parent_id, parent_conv, last``.
    """
    nodes = found.groupBy("key").agg(
        F.min("conv").alias("conv"), F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.first("parent").alias("parent"), F.first("size").alias("size"))
    root = (members.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"))
            .where("conv is not null")
            .select(F.lit(bytearray(ROOT)).alias("key"), "conv", F.lit(0).cast("bigint").alias("depth"),
                    "n_convs", F.lit(None).cast("binary").alias("parent"),
                    F.lit(0).cast("bigint").alias("size")))
    nodes = global_position(nodes.unionByName(root), [F.asc_nulls_first("parent"), F.asc("conv")], "id")
    children = materialise(nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("id").alias("first_child"),
        F.max("id").alias("last_child")), "children")
    parents = children.join(nodes.select("key", F.col("id").alias("parent_id"),
                                         F.col("conv").alias("parent_conv")), "key")
    parents = parents.select(F.col("key").alias("parent"), "parent_id", "parent_conv", "last_child")
    whole = (nodes.join(children.drop("last_child"), "key", "left").join(parents, "parent", "left")
             .select("id", "key", "conv", "depth", "n_convs", "size",
                     F.coalesce("n_children", F.lit(0)).alias("n_children"), "first_child",
                     "parent_id", "parent_conv", (F.col("id") == F.col("last_child")).alias("last")))
    return materialise(whole, "tree")


def tour(nodes: DataFrame) -> DataFrame:
    """``(arc, next)`` per node as two arcs: 2 id enters, 2 id + 1 leaves; the last has next -1."""
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    back = (F.when(F.col("parent_id").isNull(), F.lit(-1))
            .when(F.col("last"), F.col("parent_id") * 2 + 1).otherwise(enter + 2))
    return nodes.select("conv", "depth", enter.alias("enter"),
                        F.coalesce(F.col("first_child") * 2, leave).alias("enter_next"),
                        leave.alias("leave"), back.cast("bigint").alias("leave_next"))


def _runs(table: pa.Table) -> pa.Table:
    """Arcs of a bucket that follow each other, as runs."""
    arc, after = (np.concatenate([table.column(f"{side}{end}").to_numpy() for side in
                                  ("enter", "leave")]) for end in ("", "_next"))
    order = np.argsort(arc)
    arc, after = arc[order], after[order]
    at = np.minimum(np.searchsorted(arc, after), len(arc) - 1)
    inside = arc[at] == after
    headed = np.ones(len(arc), dtype=bool)
    headed[at[inside]] = False
    step = np.where(inside, at, -1).tolist()
    head, offset = [0] * len(arc), [0] * len(arc)
    out_next, out_length = [None] * len(arc), [None] * len(arc)
    for h in np.flatnonzero(headed).tolist():
        i, n = h, 0
        while True:
            head[i], offset[i] = h, n
            n += 1
            if step[i] < 0:
                break
            i = step[i]
        out_next[h], out_length[h] = int(after[i]), n
    return pa.table([pa.array(arc), pa.array(arc[head]), pa.array(offset, pa.int64()),
                     pa.array(out_next, pa.int64()), pa.array(out_length, pa.int64())],
                    names=["arc", "head", "offset", "next", "length"])


def ranked(arcs: DataFrame, n_nodes: int) -> DataFrame:
    """``(arc, position)`` of every arc of a tour of ``2 n_nodes`` arcs."""
    spark = arcs.sparkSession
    ship_package(spark)
    buckets = max(shuffle_width(spark), -(-n_nodes // BUCKET_NODES))
    bucket = F.pmod(F.xxhash64("conv", F.floor(F.col("depth") / BUCKET_TURNS)), F.lit(buckets))
    runs = materialise(arcs.groupBy(bucket.alias("bucket")).applyInArrow(_runs, RUN_SCHEMA), "runs")
    with scratch_scope() as written:
        way = materialise(runs.where("length is not null")
                          .select("head", "next", F.col("length").alias("rest")), "way")
    while not way.where("next >= 0").isEmpty():
        ahead = way.select(F.col("head").alias("next"), F.col("next").alias("after"),
                           F.col("rest").alias("more"))
        jumped = way.where("next >= 0").join(ahead, "next").select(
            "head", F.col("after").alias("next"), (F.col("rest") + F.col("more")).alias("rest"))
        done = list(written)
        with scratch_scope() as written:
            way = materialise(jumped.unionAll(way.where("next < 0")), "way")
        drop_paths(spark, done)
    return (runs.select("arc", "head", "offset").join(way.select("head", "rest"), "head")
            .select("arc", (F.lit(2 * n_nodes) - F.col("rest") + F.col("offset")).alias("position")))


def subtree_sums(nodes: DataFrame, positions: DataFrame, weights: dict[str, Column],
                 block_arcs: int = BLOCK_ARCS) -> DataFrame:
    """``id`` and, for each weight of a node, its sum over the node's subtree."""
    enter = F.col("arc") % 2 == 0
    weighed = nodes.select("id", *(w.cast("bigint").alias(n) for n, w in weights.items()))
    placed = positions.select(F.shiftright("arc", 1).alias("id"), enter.alias("enter"), "position",
                              F.floor(F.col("position") / block_arcs).alias("block"))
    rows = materialise(placed.join(weighed, "id").select(
        "id", "enter", "position", "block",
        *(F.when(F.col("enter"), F.col(n)).otherwise(0).alias(n) for n in weights)), "arcs")
    # One row per block of 65,536 arcs.
    so_far = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (rows.groupBy("block").agg(*(F.sum(n).alias(n) for n in weights))
              .select("block", *(F.coalesce(F.sum(n).over(so_far), F.lit(0)).alias(f"{n}_before")
                                 for n in weights)))
    inside = Window.partitionBy("block").orderBy("position").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = rows.select("id", "enter", "block", *weights,
                         *(F.sum(n).over(inside).alias(f"{n}_upto") for n in weights))
    summed = summed.join(blocks, "block")
    part = lambda n: F.col(f"{n}_before") + F.col(f"{n}_upto")
    return summed.groupBy("id").agg(*(
        F.sum(F.when(F.col("enter"), F.col(n) - part(n)).otherwise(part(n))).alias(n)
        for n in weights))


# Members that end at a node -------------------------------------------------------------------

def _block_step(batches):
    """Sorted ``(key, conv)`` rows as joined ids, some thousand at a time."""
    key, held = None, []

    def row():
        return {"key": key, "first": held[0], "ids": ",".join(map(str, held))}

    schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        out = []
        for k, conv in zip(*(batch.column(n).to_pylist() for n in ("key", "conv")), strict=True):
            if held and (k != key or len(held) >= END_IDS):
                out.append(row())
                held = []
            key = k
            held.append(conv)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if held:
        yield pa.RecordBatch.from_pylist([row()], schema=schema)


def _digest_step(batches):
    """Blocks of a key in order, streamed through its hash."""
    key, state = None, None
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for k, ids in zip(*(batch.column(n).to_pylist() for n in ("key", "ids")), strict=True):
            if k != key:
                if state is not None:
                    out.append({"key": key, "ends_sha256": state.hexdigest()})
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": state.hexdigest()}],
                                         schema=schema)


def ends(found: DataFrame, members: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of the nodes at which some conversation ends."""
    last = found.groupBy("conv").agg(F.max_by("key", "depth").alias("key"))
    at = members.join(last, "conv", "left").select(
        F.coalesce("key", F.lit(bytearray(ROOT))).alias("key"), "conv")
    sorted_ids = at.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    blocks = python_rows(sorted_ids, _block_step, BLOCK_SCHEMA)
    by_key = blocks.repartition("key").sortWithinPartitions("key", "first")
    return python_rows(by_key, _digest_step, ENDS_SCHEMA)


def prefix_trie(conversations: DataFrame, *, family: int = FAMILY, most: int = MOST) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    turns = materialise(turn_digests(conversations), "turns")
    members = turns.select("conv").distinct()
    found = prefixes(rebuilt(turns, family, most), most)
    nodes = tree(found, members)
    sums = subtree_sums(nodes, ranked(tour(nodes), nodes.count()), {
        "n_leaves": (F.col("n_children") == 0).cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("size")})
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(sums, "id").join(ends(found, members), "key", "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))
