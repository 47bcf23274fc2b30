"""Exact dedup with an extendible-hash index on shared files.

Texts are equal when they are identical without white space.  The 64-bit hash of that text is
the key.  A directory over the leading bits of the key names the bucket of a key; an overfull
bucket is split on its next bit, and the directory doubles when the bucket already used all of
its bits.  Buckets follow the order of the keys, so a run of buckets is a key range, and each
owner task gets one such range.  The owner reads its entries in key order, chains texts that
share a key but differ in their bytes, and writes one index record per distinct text: bucket,
key, place in the chain, digest, group size and the row that stays.

Copies of one text inside an Arrow batch are folded into one entry before the shuffle, so a
text that a third of all rows share reaches its owner as one entry per batch.  The rows then
find their group by key and digest in a join that the runtime may split.

Defined results: null counts as empty; of equal texts the row with the most code points stays,
then the smallest id, a null id before all others; rows that tie in both are all marked kept;
an empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import SPACE, bodies, python_rows, shuffle_width
from basketry.session import materialise, scratch_path

MAX_DEPTH = 16  # the directory has 2 ** MAX_DEPTH slots at most
BUCKET_KEYS = 4096

KEY_SCHEMA = "doc_id bigint, n_chars bigint, key bigint, text_sha256 string"
ENTRY_SCHEMA = ("owner int, bucket int, key bigint, norm binary, n bigint, "
                "n_chars bigint, doc_id bigint")
INDEX_SCHEMA = ("bucket int, key bigint, slot int, text_sha256 string, group_size bigint, "
                "keep_id bigint, keep_chars bigint")
_SIGN = 1 << 63


def normalised(body: bytes) -> bytes:
    return body.translate(None, SPACE)


def text_key(norm: bytes) -> int:
    """Unsigned 64-bit hash with the sign bit turned, so signed order is key order."""
    return xxhash.xxh3_64_intdigest(norm) - _SIGN


def code_points(body: bytes) -> int:
    return len(body.decode("utf-8", "replace"))


class Directory:
    """Slots over the leading ``depth`` bits; ``buckets[slot]`` counts up in key order."""

    def __init__(self, depth: int, buckets: np.ndarray):
        self.depth, self.buckets = depth, buckets

    @property
    def n_buckets(self) -> int:
        return int(self.buckets[-1]) + 1

    def bucket(self, key: int) -> int:
        return int(self.buckets[(key + _SIGN) >> (64 - self.depth)]) if self.depth else 0

    @classmethod
    def grown(cls, histogram: np.ndarray, max_depth: int, capacity: int) -> Directory:
        """Split overfull buckets until all fit or the depth is used up.

        ``histogram[prefix]`` counts the distinct keys by their first ``max_depth`` bits.
        """
        below = np.concatenate([[0], np.cumsum(histogram)])
        depth, local, starts, done = 0, [0], [0], 0
        # A bucket is a start slot at full resolution and the number of bits it uses.
        while done < len(local):
            width = 1 << (max_depth - local[done])
            keys = below[starts[done] + width] - below[starts[done]]
            if keys <= capacity or local[done] == max_depth:
                done += 1
                continue
            if local[done] == depth:
                depth += 1  # the directory doubles
            local[done] += 1
            starts.append(starts[done] + width // 2)
            local.append(local[done])
        starts = np.sort(np.array(starts)) >> (max_depth - depth)
        buckets = np.searchsorted(starts, np.arange(1 << depth), side="right") - 1
        return cls(depth, buckets.astype(np.int32))


def _key_step(batches):
    for batch in batches:
        norms = [(b, normalised(b)) for b in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"),
             pa.array([code_points(b) for b, _ in norms], pa.int64()),
             pa.array([text_key(n) for _, n in norms], pa.int64()),
             pa.array([hashlib.sha256(n).hexdigest() for _, n in norms], pa.string())],
            names=["doc_id", "n_chars", "key", "text_sha256"])


def _rank(n_chars: int, doc_id: int | None):
    """The row that stays ranks lowest."""
    return (-n_chars, doc_id is not None, doc_id or 0)


def _entry_step(directory: Directory, owners: int):
    def step(batches):
        for batch in batches:
            folded: dict[bytes, list] = {}
            for doc_id, body in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("body").to_pylist(), strict=True):
                norm, n_chars = normalised(body), code_points(body)
                entry = folded.setdefault(norm, [0, n_chars, doc_id])
                entry[0] += 1
                if _rank(n_chars, doc_id) < _rank(entry[1], entry[2]):
                    entry[1:] = n_chars, doc_id
            keys = [text_key(n) for n in folded]
            buckets = [directory.bucket(k) for k in keys]
            ranges = [b * owners // directory.n_buckets for b in buckets]
            values = list(folded.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), pa.array(buckets, pa.int32()),
                 pa.array(keys, pa.int64()), pa.array(list(folded), pa.binary()),
                 *(pa.array([v[i] for v in values], pa.int64()) for i in range(3))],
                names=["owner", "bucket", "key", "norm", "n", "n_chars", "doc_id"])
    return step


def _owner_step(batches):
    """Entries come in key order; only the chain of the current key is held."""
    names = ["bucket", "key", "slot", "text_sha256", "group_size", "keep_id", "keep_chars"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    at, chain = None, []

    def records():
        for slot, (norm, n, n_chars, doc_id) in enumerate(chain):
            yield (*at, slot, hashlib.sha256(norm).hexdigest(), n, doc_id, n_chars)

    def batch_of(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        out = []
        for _, bucket, key, norm, n, n_chars, doc_id in zip(
                *(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if at != (bucket, key):
                out += records()
                at, chain = (bucket, key), []
            for entry in chain:
                if entry[0] == norm:  # the bytes decide, not the hash
                    entry[1] += n
                    if _rank(n_chars, doc_id) < _rank(entry[2], entry[3]):
                        entry[2:] = n_chars, doc_id
                    break
            else:
                chain.append([norm, n, n_chars, doc_id])
        if out:
            yield batch_of(out)
    if chain:
        yield batch_of(list(records()))


def build_index(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                *, bucket_keys: int = BUCKET_KEYS, path: str | None = None) -> DataFrame:
    """Write the index of ``docs`` and read it back; ``keys`` holds the hash of each row."""
    spark = docs.sparkSession
    prefix = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(-_SIGN)), 64 - MAX_DEPTH)
    counts = (keys.select("key").distinct().groupBy(prefix.alias("prefix"))
              .agg(F.count(F.lit(1)).alias("n")).collect())  # 2 ** MAX_DEPTH rows at most
    histogram = np.zeros(1 << MAX_DEPTH, dtype=np.int64)
    for row in counts:
        histogram[row["prefix"]] = row["n"]
    directory = Directory.grown(histogram, MAX_DEPTH, bucket_keys)
    owners = min(shuffle_width(spark), directory.n_buckets)
    entries = python_rows(bodies(docs, id_col, text_col), _entry_step(directory, owners),
                          ENTRY_SCHEMA)
    dealt = entries.repartitionById(owners, F.col("owner")).sortWithinPartitions("bucket", "key")
    path = path or scratch_path(spark, "hash-index")
    python_rows(dealt, _owner_step, INDEX_SCHEMA).write.parquet(path)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row."""
    keys = materialise(python_rows(bodies(docs, id_col, text_col), _key_step, KEY_SCHEMA), "keys")
    index = build_index(docs, keys, id_col, text_col, **options)
    groups = index.select("key", "text_sha256", "group_size", "keep_id", "keep_chars")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return keys.join(groups, ["key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", same.alias("kept"), "text_sha256")
