"""Best-fit-decreasing packing into rows of a token-id matrix.

A document longer than a row is cut into full rows and a rest; nothing is dropped.  The pieces
of a packing group are placed by falling length into the open row with the least room that
still fits; a segment tree over the room finds that row in log2(row length) steps.  A group is
what one task gathers up to ``group_tokens``, so packing needs no shuffle and its memory does
not grow with the corpus; with thousands of pieces per group the padding stays small.

Each output row is one matrix row: padded ids, cumulative segment lengths (for attention that
must not cross documents), and positions that start again at 0 in every segment.

Defined results: null counts as empty, and an empty text is the end id alone; repeated rows are
packed each for itself; an empty table gives no rows; columns other than the id and the text
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import bodies, python_rows
from basketry.llm.tokens import END_ID, default_tokenizer, worker_tokenizer

ROW_TOKENS = 2048
GROUP_TOKENS = 4 << 20
PAD_ID = 0

PACKED_SCHEMA = ("n_tokens bigint, n_segments bigint, doc_ids array<bigint>, "
                 "starts array<bigint>, cu_seqlens array<int>, input_ids binary, "
                 "position_ids binary")


class RoomTree:
    """Open rows by the room they have left; a segment tree over 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)  # open rows below each node
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node:
            self.open[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and give ``(room, row)`` of the least room that is at least ``need``."""
        node = self.leaves + need
        if not self.open[node]:
            # Up until a right-hand neighbour holds something, then down to its least leaf.
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.open[node]:
                    node += 1
        room = node - self.leaves
        while node:
            self.open[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: list[int], row_tokens: int) -> list[list[int]]:
    """Rows as lists of piece numbers."""
    tree, rows = RoomTree(row_tokens), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        if (found := tree.take(size)) is None:
            room, row = row_tokens, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(piece)
        if room > size:
            tree.add(room - size, row)
    return rows


def _packed(pieces: list[tuple], row_tokens: int, kind: str) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(7)]
    order = np.arange(row_tokens, dtype=kind)
    for row in best_fit_decreasing([len(p[2]) for p in pieces], row_tokens):
        parts = [pieces[i] for i in row]
        ids = np.full(row_tokens, PAD_ID, dtype=kind)
        positions = np.zeros(row_tokens, dtype=kind)
        ends = [0]
        for _, _, part in parts:
            at = ends[-1]
            ids[at:at + len(part)] = part
            positions[at:at + len(part)] = order[:len(part)]
            ends.append(at + len(part))
        for column, value in zip(columns, (
                ends[-1], len(parts), [p[0] for p in parts], [p[1] for p in parts], ends,
                ids.tobytes(), positions.tobytes()), strict=True):
            column.append(value)
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        names=["n_tokens", "n_segments", "doc_ids", "starts", "cu_seqlens", "input_ids",
               "position_ids"])


def _pack_step(tokenizer: str, row_tokens: int, group_tokens: int):
    def step(batches):
        encoder = worker_tokenizer(tokenizer)
        kind = "<u2" if max(encoder.vocabulary, row_tokens) <= 1 << 16 else "<u4"
        end = np.array([END_ID], dtype=kind)
        pieces, held = [], 0
        for batch in batches:
            for doc_id, body in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("body").to_pylist(), strict=True):
                ids = np.frombuffer(encoder.encode(body), dtype="<u4").astype(kind)
                ids = np.concatenate([ids, end])
                # Copies, so that no piece holds on to the whole document.
                pieces += [(doc_id, at, ids[at:at + row_tokens].copy())
                           for at in range(0, len(ids), row_tokens)]
                held += len(ids)
                if held >= group_tokens:
                    yield _packed(pieces, row_tokens, kind)
                    pieces, held = [], 0
        if pieces:
            yield _packed(pieces, row_tokens, kind)
    return step


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
         tokenizer: str | None = None, row_tokens: int = ROW_TOKENS,
         group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per matrix row.

    ``input_ids`` and ``position_ids`` are ``row_tokens`` little-endian numbers of 16 bits (32
    where the vocabulary needs them), padded after ``n_tokens``.  Segment i holds the tokens of
    ``doc_ids[i]`` from ``starts[i]`` on and lies between ``cu_seqlens[i]`` and the next.
    """
    step = _pack_step(tokenizer or default_tokenizer(), row_tokens, group_tokens)
    return (python_rows(bodies(docs, id_col, text_col), step, PACKED_SCHEMA)
            .withColumn("sequence_id", F.monotonically_increasing_id()))


def write_packed(packed: DataFrame, path: str) -> None:
    """The matrix as files: the id and position rows have equal width, so a reader may map them."""
    packed.write.parquet(path)
