"""Line dedup with levelled sorted runs of line hashes.

The index is a set of runs.  A run is a table of ``(line_hash, owner)``, hash-bucketed and sorted
by the hash, each hash once.  Documents arrive in batches of rising id.  A batch reduces its
lines to one smallest document per hash, merge-anti-joins them with every run (both sides are
bucketed and sorted alike, so the runs are read in place: no shuffle, no sort), and what is new
becomes a run of level 0.  When a level holds ``fanout`` runs they are merged into one run of the
next level, so a batch meets at most ``fanout - 1`` runs per level.

A line stays in the document that owns its hash, and is dropped from every other.  As the owner
is part of the run, the decision is an anti-join on ``(line_hash, owner)``: a line that a third
of all documents share is a hot hash but not a hot pair, and nothing gathers its documents.

Hashes have 128 bits (XXH3), so equal hashes are taken as equal keys.

Defined results: a null or empty text is one empty line; keys shorter than ``min_chars`` code
points are never dropped; a line repeated inside its owner stays each time; rows with the same
id are one holder, and a null id sorts before all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from basketry.llm.common import SPACE, bodies, python_rows, restored, shuffle_width
from basketry.session import materialise, scratch_path

MIN_CHARS = 10
LINE_SCHEMA = "doc_id bigint, digest bigint, line int, line_hash binary"
RUN_COLUMNS = ("line_hash", "owner")


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of the stripped, ASCII-lower-cased line; none for a key that is too short."""
    key = line.strip(SPACE)
    if len(key) < min_chars or (len(key) < 4 * min_chars
                                and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key.lower())


def text_digest(body: bytes) -> int:
    """64-bit digest that tells rows with the same id apart."""
    return xxhash.xxh3_64_intdigest(body) - (1 << 63)


def _line_step(min_chars: int):
    def step(batches):
        for batch in batches:
            ids, digests, numbers, hashes = [], [], [], []
            for doc_id, body in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("body").to_pylist(), strict=True):
                digest = text_digest(body)
                for number, line in enumerate(body.split(b"\n")):
                    if (h := line_hash(line, min_chars)) is not None:
                        ids.append(doc_id)
                        digests.append(digest)
                        numbers.append(number)
                        hashes.append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()),
                 pa.array(numbers, pa.int32()), pa.array(hashes, pa.binary())],
                names=["doc_id", "digest", "line", "line_hash"])
    return step


class SortedRuns:
    """Levelled runs of line hashes below one folder."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = 4,
                 folder: str | None = None):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.folder = folder or scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.made: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        """A run: bucketed and sorted by hash.  ``rows`` are already dealt by the hash."""
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.format("parquet").option("path", f"{self.folder}/{name}")
         .bucketBy(self.buckets, "line_hash").sortBy("line_hash").saveAsTable(name))
        self.made.append(name)
        return name

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> str:
        """Anti-join ``(line_hash, owner)`` with the runs; the rest becomes a run, named here."""
        fresh = keys
        for name in self.tables():
            # A hint, as statistics of a bucketed table may invite a broadcast of the run.
            fresh = fresh.join(self.spark.table(name).select("line_hash").hint("merge"),
                               "line_hash", "left_anti")
        name = self._write(fresh.select(*RUN_COLUMNS))
        self._place(name, 0)
        return name

    def _place(self, name: str, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            merged = self.spark.table(self.levels[level][0])
            for other in self.levels[level][1:]:
                merged = merged.unionByName(self.spark.table(other))
            name = self._write(merged.repartition(self.buckets, "line_hash"))
            # The files of merged runs stay until the shared folder is cleared: readers of
            # earlier batches may still hold them.
            self.levels[level] = []
            self._place(name, level + 1)

    def close(self) -> None:
        """Take the runs out of the session's catalogue; files stay in the folder."""
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  batches: int = 4, fanout: int = 3, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc_id, digest, lines)``: numbers of the lines each document loses."""
    spark = docs.sparkSession
    lines = python_rows(bodies(docs, id_col, text_col), _line_step(min_chars), LINE_SCHEMA)
    # Batches are ranges of the id.  Their borders decide how much each step does, never what
    # comes out, so they may come from a sketch of the ids.
    borders = docs.select(F.percentile_approx(
        F.col(f"`{id_col}`").cast("bigint"),
        [(i + 1) / batches for i in range(batches - 1)], 1000).alias("b")).first()["b"] or []
    batch = F.lit(0)
    for border in sorted(set(borders)):
        batch = batch + F.when(F.col("doc_id") > border, 1).otherwise(0)
    path = scratch_path(spark, "lines")
    lines.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    stored = spark.read.schema(LINE_SCHEMA + ", batch int").parquet(path)
    buckets = shuffle_width(spark)
    runs, losses = SortedRuns(spark, buckets, fanout), []
    for number in range(len(set(borders)) + 1):
        part = stored.where(F.col("batch") == number)
        # Nulls first: as the smallest of a struct that says whether the id is there.
        keys = part.groupBy("line_hash").agg(
            F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first"))
        keys = keys.select("line_hash", F.col("first.doc_id").alias("owner"))
        run = spark.read.schema("line_hash binary, owner bigint").parquet(
            f"{runs.folder}/{runs.add(keys.repartition(buckets, 'line_hash'))}")
        lost = part.join(run, (part.line_hash == run.line_hash)
                         & part.doc_id.eqNullSafe(run.owner), "left_anti")
        losses.append(lost.select("doc_id", "digest", "line"))
    runs.close()
    every = losses[0]
    for other in losses[1:]:
        every = every.unionByName(other)
    # Bounded by the lines of one document; repeated rows give each number more than once.
    return every.groupBy("doc_id", "digest").agg(F.collect_set("line").alias("lines"))


def _rebuild_step(report: bool):
    def step(batches):
        for batch in batches:
            texts, n_lines, n_dropped, digests = [], [], [], []
            for body, gone in zip(batch.column("body").to_pylist(),
                                  batch.column("lines").to_pylist(), strict=True):
                split = body.split(b"\n")
                if gone:
                    lost = set(gone)
                    kept = b"\n".join([x for i, x in enumerate(split) if i not in lost])
                else:
                    kept = body
                n_lines.append(len(split))
                n_dropped.append(len(gone or ()))
                if report:
                    digests.append(hashlib.sha256(kept).hexdigest())
                else:
                    texts.append(kept.decode("utf-8", "replace"))
            made = (digests, pa.string()) if report else (texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64()), pa.array(*made)],
                names=[batch.schema.names[0], "n_lines", "n_dropped",
                       "kept_sha256" if report else "kept_text"])
    return step


def _rebuilt(docs: DataFrame, id_col: str, text_col: str, report: bool, carried: bool,
             **options) -> DataFrame:
    losses = dropped_lines(docs, id_col, text_col, **options)
    whole = bodies(docs, id_col, text_col, carried)
    whole = python_rows(whole, _digest_step, T.StructType(
        [*whole.schema.fields, T.StructField("digest", T.LongType())]))
    joined = whole.join(losses.withColumnRenamed("doc_id", "_lost_id")
                        .withColumnRenamed("digest", "_lost_digest"),
                        F.col("doc_id").eqNullSafe(F.col("_lost_id"))
                        & (F.col("digest") == F.col("_lost_digest")), "left")
    first = "_row" if carried else "doc_id"
    schema = T.StructType([whole.schema[first], T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()),
                           T.StructField("kept_sha256" if report else "kept_text",
                                         T.StringType())])
    return python_rows(joined.select(first, "body", "lines"), _rebuild_step(report), schema)


def _digest_step(batches):
    for batch in batches:
        digests = [text_digest(b) for b in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.int64())],
                                         names=[*batch.schema.names, "digest"])


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` per document."""
    return _rebuilt(docs, id_col, text_col, True, False, **options)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        **options) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; all columns and rows stay."""
    rebuilt = _rebuilt(docs, id_col, text_col, False, True, **options)
    return restored(rebuilt, docs, text_col, F.col("kept_text"))
