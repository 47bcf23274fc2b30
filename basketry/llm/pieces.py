"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two of n's binary form,
the longest first, with as many pieces of the maximal length as fit.  Pieces of equal length
form a bucket, and a training batch draws from one bucket: every sequence is one piece of one
document, none crosses documents and none is padded.

Defined results: null counts as empty, and an empty text is the end id alone; repeated rows are
cut each for itself; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import bodies, python_rows
from basketry.llm.tokens import END_ID, default_tokenizer, worker_tokenizer

MAX_LENGTH = 4096
PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"
_FLUSH_BYTES = 32 << 20


def lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two that add up to n, falling, none above ``longest``."""
    rest = n % longest
    return ([longest] * (n // longest)
            + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1])


def _piece_step(tokenizer: str, longest: int):
    def step(batches):
        encoder = worker_tokenizer(tokenizer)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows, held = [], 0
            for doc_id, body in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("body").to_pylist(), strict=True):
                ids = encoder.encode(body) + end
                n, start = len(ids) // 4, 0
                for length in lengths(n, longest):
                    rows.append((doc_id, start, length, n, ids[4 * start:4 * (start + length)]))
                    start += length
                held += len(ids)
                if held > _FLUSH_BYTES:
                    yield _piece_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _piece_batch(rows)
    return step


def _piece_batch(rows):
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary())],
        names=["doc_id", "start", "length", "doc_tokens", "ids"])


def power_of_two_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                        tokenizer: str | None = None, longest: int = MAX_LENGTH) -> DataFrame:
    """One row per piece: ids (little-endian 32-bit), its place in the document, its sequence.

    ``length`` is the bucket.  ``sequence_id`` is unique and follows the input partitions.
    ``longest`` must be a power of two.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")
    step = _piece_step(tokenizer or default_tokenizer(), longest)
    return (python_rows(bodies(docs, id_col, text_col), step, PIECE_SCHEMA)
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("bigint")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences by length, one folder per bucket, for training batches of equal length."""
    pieces.write.partitionBy("length").parquet(path)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
