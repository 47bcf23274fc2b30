"""SentencePiece encoding and decoding by suffix-array matching.

Instead of trying every pair of neighbours against the vocabulary, the text of a batch is indexed
once and the vocabulary is looked up in it: a suffix array of the concatenated text, a binary
search of every piece for the range of suffixes that begin with it, and the occurrences sorted
by position as the edges of a lattice.  Relaxation then works on edges alone: the pieces of a
unit start as single characters, and in every round the best edge over two neighbouring pieces
(highest score, then leftmost) joins them, for all units at once, until no edge is left.  That
is the order of a SentencePiece BPE model, so the ids are the library's.

No piece holds a space mark after another character, so the words of a text (with the marks
before them) are independent units; each worker indexes the distinct units it has not met yet
and keeps the ids of the others in two generations of bounded size.  Units of hundreds of
characters relax with a heap on the same edges.  Characters without a piece become byte pieces.

Defined results: null counts as empty, and an empty text has no ids; repeated rows are encoded
each for itself; an empty table gives an empty result; columns other than the id and the text
are ignored.  Decoding gives back the text, but for space marks (U+2581) in it, which become
spaces; ids outside the vocabulary raise.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.common import bodies, python_rows

MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHE_UNITS = 200_000
BATCH_CHARS = 200_000
TEXT_CHUNK = 1 << 20
LONG_UNIT = 400
ENCODED_SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, round_trip boolean"
DECODED_SCHEMA = "doc_id bigint, text string"
_NO_EDGE = 1 << 30


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fixed_width(codes: np.ndarray, width: int) -> np.ndarray:
    """Rows of code points, one up so that none is zero, as comparable strings."""
    return np.ascontiguousarray(codes, dtype=np.uint32).view(f"U{width}").ravel()


class PieceModel:
    """The pieces of a BPE model and the edges they make in a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        sp, n = self.library, len(self.library)
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n)
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain):
            raise ValueError("a piece spans a word border")
        self.char_id = {names[i]: i for i in plain if len(names[i]) == 1}
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        long = np.array([i for i in plain if len(names[i]) > 1])
        self.width = max(len(names[i]) for i in long)
        codes = np.zeros((len(long), self.width), dtype=np.uint32)
        for row, i in enumerate(long):
            codes[row, :len(names[i])] = [ord(c) + 1 for c in names[i]]
        self.piece_length = np.array([len(names[i]) for i in long])
        self.piece_id = long
        scores = np.array([sp.get_score(int(i)) for i in long])
        self.piece_rank = np.unique(-scores, return_inverse=True)[1]  # 0 is the best
        self.first = _fixed_width(codes.copy(), self.width)
        codes[np.arange(len(long)), self.piece_length - 1] += 1
        self.after = _fixed_width(codes, self.width)
        known = sorted(self.char_id)
        self.known_codes = np.array([ord(c) for c in known])
        self.known_ids = np.array([self.char_id[c] for c in known])
        self.spelled = [b"" if sp.is_control(i) else bytes([int(names[i][3:5], 16)])
                        if sp.is_byte(i) else names[i].replace(MARK, " ").encode()
                        for i in range(n)]

    def edges(self, codes: np.ndarray):
        """Occurrences of all pieces, by position: ``(position * 2 width + length, rank, id)``.

        ``codes``: code points plus one, zero after each unit.
        """
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.width, np.uint32)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.width)[:n]
        # What stands after a unit's end must not match: all after the first zero is zero.
        windows = windows * np.minimum.accumulate(windows > 0, axis=1)
        suffixes = _fixed_width(windows, self.width)
        order = np.argsort(suffixes, kind="stable")
        ordered = suffixes[order]
        low = np.searchsorted(ordered, self.first)
        count = np.searchsorted(ordered, self.after) - low
        piece = np.repeat(np.arange(len(count)), count)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        position = order[low[piece] + within]
        key = position * (2 * self.width) + self.piece_length[piece]
        by = np.argsort(key)
        return key[by], self.piece_rank[piece][by], self.piece_id[piece][by]


def _look_up(keys, values, wanted, missing):
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def relax(start: np.ndarray, unit: np.ndarray, ends: np.ndarray, keys, ranks, width: int):
    """Join neighbours round by round; gives the first positions of the pieces that remain.

    ``start``: positions of the characters; ``unit``: the unit of each; ``ends``: end of a unit.
    """
    done = []
    while len(start):
        stop = np.append(start[1:], 0)
        last = np.append(unit[1:] != unit[:-1], True)
        stop = np.where(last, ends[unit], stop)
        after = np.append(stop[1:], 0)  # end of the neighbour
        length = after - start
        rank = np.full(len(start), _NO_EDGE)
        pair = np.flatnonzero(~last & (length <= width))
        rank[pair] = _look_up(keys, ranks, start[pair] * (2 * width) + length[pair], _NO_EDGE)
        borders = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
        best = np.minimum.reduceat(rank * (1 << 32) + np.arange(len(start)), borders)
        open_ = best >> 32 < _NO_EDGE
        going = np.repeat(open_, np.diff(np.append(borders, len(start))))
        done.append(start[~going])
        going[(best[open_] & 0xFFFFFFFF) + 1] = False  # the right one of each joined pair
        start, unit = start[going], unit[going]
    return np.sort(np.concatenate(done)) if done else start


def relax_long(n: int, rank_of: dict[tuple[int, int], int]) -> list[int]:
    """The same for one long unit: first positions, from edges ``(position, length) -> rank``."""
    after = list(range(1, n + 1))  # where the piece that starts here ends
    before = list(range(-1, n - 1))  # where the piece before it starts
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if 0 <= i and after[i] < n:
            length = after[after[i]] - i
            if (rank := rank_of.get((i, length))) is not None:
                heapq.heappush(heap, (rank, i, length))

    for i in range(n):
        offer(i)
    while heap:
        _, i, length = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] - i != length:
            continue
        right = after[i]
        alive[right] = False
        after[i] = after[right]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [i for i in range(n) if alive[i]]


class Encoder:
    """Ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, cache_units: int = CACHE_UNITS, long_unit: int = LONG_UNIT):
        self.model = PieceModel(path)
        self.cache_units, self.long_unit = cache_units, long_unit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode_all(self, texts):
        """Ids of each text, in order."""
        normalise = self.model.library.normalize
        part, held = [], 0
        for text in texts:
            part.append(UNIT.findall(normalise(text)))
            held += len(text)
            if held >= TEXT_CHUNK:
                yield from self._encode_part(part)
                part, held = [], 0
        yield from self._encode_part(part)

    def _encode_part(self, texts: list[list[str]]) -> list[bytes]:
        young, old = self.young, self.old
        missing, held = [], 0
        for unit in {u for units in texts for u in units if u not in young}:
            if (ids := old.get(unit)) is not None:
                young[unit] = ids
                continue
            missing.append(unit)
            held += len(unit) + 1
            if held >= BATCH_CHARS:
                young.update(zip(missing, self._encode_units(missing), strict=True))
                missing, held = [], 0
        if missing:
            young.update(zip(missing, self._encode_units(missing), strict=True))
        out = [b"".join([young[u] for u in units]) for units in texts]
        if len(young) > self.cache_units:
            self.old, self.young = young, {}
        return out

    def _encode_units(self, units: list[str]) -> list[bytes]:
        model = self.model
        sizes = np.array([len(u) for u in units])
        text = "\0".join([*units, ""]).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(text, dtype=np.uint32) + 1
        ends = np.cumsum(sizes + 1) - 1
        codes[ends] = 0
        keys, ranks, ids = model.edges(codes)
        unit = np.repeat(np.arange(len(units)), sizes + 1)
        inside = np.ones(len(codes), dtype=bool)
        inside[ends] = False
        short = inside & (sizes <= self.long_unit)[unit]
        place = np.flatnonzero(short)
        starts = [relax(place, unit[place], ends, keys, ranks, model.width)]
        for u in np.flatnonzero(sizes > self.long_unit):
            first = int(ends[u] - sizes[u])
            a, b = np.searchsorted(keys, [first * 2 * model.width, ends[u] * 2 * model.width])
            position, length = np.divmod(keys[a:b], 2 * model.width)
            rank_of = dict(zip(zip((position - first).tolist(), length.tolist(), strict=True),
                               ranks[a:b].tolist(), strict=True))
            starts.append(first + np.array(relax_long(int(sizes[u]), rank_of)))
        start = np.sort(np.concatenate(starts))
        owner = unit[start]
        stop = np.append(start[1:], 0)
        last = np.append(owner[1:] != owner[:-1], True)
        stop = np.where(last, ends[owner], stop)
        found = np.where(
            stop - start > 1, _look_up(keys, ids, start * (2 * model.width) + stop - start, -1),
            _look_up(model.known_codes, model.known_ids, codes[start].astype(np.int64) - 1, -1))
        data = found.astype("<u4").tobytes()
        counts = np.cumsum(np.bincount(owner, minlength=len(units)))
        borders = np.concatenate([[0], counts]).tolist()
        out = [data[4 * a:4 * b] for a, b in zip(borders[:-1], borders[1:], strict=True)]
        for u in np.unique(owner[found < 0]).tolist():  # characters without a piece
            parts = []
            for k in range(borders[u], borders[u + 1]):
                if found[k] >= 0:
                    parts.append(int(found[k]))
                else:
                    parts += [model.byte_id[b] for b in
                              chr(int(codes[start[k]]) - 1).encode("utf-8", "replace")]
            out[u] = np.array(parts, dtype="<u4").tobytes()
        return out


def decode(model: PieceModel, ids: bytes) -> str:
    """Text of little-endian 32-bit ids."""
    spelled = model.spelled
    data = b"".join([spelled[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])
    return data.decode("utf-8", "replace").removeprefix(" ")  # the mark put before a text


_LOADED: dict[str, Encoder] = {}


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _encode_step(path: str):
    def step(batches):
        encoder = worker_encoder(path)
        for batch in batches:
            texts = [b.decode("utf-8", "replace") for b in batch.column("body").to_pylist()]
            ids = list(encoder.encode_all(texts))
            same = [decode(encoder.model, i) == t for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids", "round_trip"])
    return step


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
           model: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip``: ids as little-endian 32-bit numbers, and whether
    decoding them gives the text back."""
    return python_rows(bodies(docs, id_col, text_col), _encode_step(model or default_model()),
                       ENCODED_SCHEMA)


def _decode_step(path: str):
    def step(batches):
        model = worker_encoder(path).model
        for batch in batches:
            texts = [None if i is None else decode(model, i)
                     for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return step


def decode_rows(encoded: DataFrame, *, model: str | None = None) -> DataFrame:
    """``doc_id, text`` from rows of ``encode``; null ids stay null."""
    return python_rows(encoded.select("doc_id", "ids"), _decode_step(model or default_model()),
                       DECODED_SCHEMA)
