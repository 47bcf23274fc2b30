"""Alignment of two tokenizers' tokens of the same texts, by merge-path partitioning.

Both tokenizers encode a space and the text; the byte offsets where their tokens end are two
ascending lists.  Laid end to end they are merged in pieces of equal work: piece k of ``work``
steps begins where diagonal k of the merge grid crosses the merge path, found by binary search in
both lists at once, so every piece is merged by itself, however long one text is.  A piece emits
overlaps, the pairs of tokens that share a byte, and the offsets where both lists end a token;
where a piece border parts two equal ends the pieces beside it are stitched.  Overlaps between two
common ends make a group, and all pairs of a group are links.

Neither tokenizer's tokens reach across a segment's ends (a run of other characters with the one
space before it, a single other white space, or a longer run of white space with what follows;
white space that some token holds beside other characters parts nothing), so equal segments have
equal groups: what is laid end to end are the segments a worker has not met yet, and a text is the
list of its segments.  A tokenizer with a token that has a space behind another character is
refused.

Counts over the corpus go through Spark.  Texts are worked on in chunks of bounded size; a chunk's
row holds its texts as segment numbers, its segments as numbers of pairs, and its distinct pairs
with the number of its texts that hold them.  Pairs are summed over chunks, the greatest sum of
each A id is joined to them, and every distinct pair of a chunk is answered once.  No table is
broadcast, no key is hotter than the number of chunks, and a chunk's answers are no more than it
asked.

Defined results: null and empty texts, and texts whose tokens do not spell the space and the text
(the second tokenizer's own space character, say), have no tokens: zeros and an empty groups
column; a text of any length is one row; repeated rows and ids count each for itself, a null id
stays null; an empty table gives an empty result; columns other than the id and the text are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from basketry.llm.bytepairs import WHITE, _slices, default_pattern
from basketry.llm.common import pack, python_rows, unpack
from basketry.llm.tokens import BYTE_CHARACTERS
from basketry.session import materialise, ship_package

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
WORK = 4096
CHUNK_BYTES = 4 << 20
CACHE_SEGMENTS = 60_000
BLOCK_LINKS = 1 << 21
SHIFT = 32  # a pair is the A id, shifted, and the B id
CHUNK_SCHEMA = ("chunk bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, "
                "n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>, "
                "sizes array<bigint>, doc_segments binary, segments binary, segment_pairs binary, pair_at binary, "
                "pair_times binary, pairs array<bigint>, holders array<bigint>")
RESULT_SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                 "n_best bigint, count_sum bigint, groups_sha256 string")
_WHITE = re.compile(f"[{WHITE}]")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(FIRST), public_tokenizers.path(SECOND)


# The merge ------------------------------------------------------------------------------------

def path_points(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where every ``work``-th diagonal crosses the merge path of two ascending lists.

    Of equal values the one of ``a`` comes first.  The binary searches run side by side.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        m = np.where(open_, middle, 0)
        other = np.where(open_, diagonal - 1 - middle, 0)
        take = np.zeros(len(m), dtype=bool)
        take[open_] = a[m[open_]] <= b[other[open_]]
        low = np.where(open_ & take, middle + 1, low)
        high = np.where(open_ & ~take, middle, high)
    return low, diagonal - low


def merge_piece(a: np.ndarray, b: np.ndarray, i: int, j: int):
    """Overlaps and common ends of one piece, whose first tokens are numbers ``i`` and ``j``.

    ``(a of overlaps, b of overlaps, a of common ends)``, in the order of the ends.
    """
    at = np.searchsorted(b, a)  # the token of b that is open, or ends too, where a ends
    both = np.zeros(len(a), dtype=bool)
    inside = at < len(b)
    both[inside] = b[at[inside]] == a[inside]
    alone = np.ones(len(b), dtype=bool)
    alone[at[both]] = False
    alone = np.flatnonzero(alone)
    back = np.searchsorted(a, b[alone])
    return (np.concatenate([i + np.arange(len(a)), i + back]),
            np.concatenate([j + at, j + alone]), i + np.flatnonzero(both))


def align(a: np.ndarray, b: np.ndarray, work: int = WORK):
    """Overlapping tokens, and the tokens of ``a`` and of ``b`` at whose end both lists end one.

    ``a`` and ``b`` are ascending ends with one last value.
    """
    left, right = path_points(a, b, work)
    found = [merge_piece(a[i:i2], b[j:j2], i, j) for i, i2, j, j2 in
             zip(left[:-1], left[1:], right[:-1], right[1:], strict=True)]
    x, y, cuts = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64)
                  for k in range(3))
    # A border between two equal ends: the piece before it has met b's token from a's side, the
    # piece after it took the same token for an overlap with a's next one.
    i, j = left[1:-1], right[1:-1]
    split = np.flatnonzero((i > 0) & (j < len(b)))
    split = split[a[i[split] - 1] == b[j[split]]]
    if len(split):
        wrong = np.isin(y, j[split]) & np.isin(x, i[split])
        wrong[wrong] = a[x[wrong] - 1] == b[y[wrong]]
        x, y = x[~wrong], y[~wrong]
        cuts = np.sort(np.concatenate([cuts, i[split] - 1]))
    return x, y, cuts, np.searchsorted(b, a[cuts])


# Tokens of segments ---------------------------------------------------------------------------

def ranked(path: str, tokens: dict[int, bytes]):
    """A faster encoder of the same ids, where a merge's place and its token's id agree in order."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, before = whole["model"], whole["pre_tokenizer"]
    plain = (before == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                        "use_regex": True} and whole["normalizer"] is None and not model["dropout"])
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"]["".join(m)] for m in merges]
    singles = {i for i, t in tokens.items() if len(t) == 1}
    if not plain or made != sorted(set(made)) or singles.union(made) != set(tokens):
        return None
    return tiktoken.Encoding("own", pat_str=default_pattern(), special_tokens={},
                             mergeable_ranks={t: i for i, t in tokens.items()})


def segment_pattern(tokens: list[str]) -> re.Pattern:
    """What cuts texts into segments that none of the tokens reaches across."""
    glue = set()
    for t in tokens:
        found = _WHITE.findall(t)
        if found and len(found) < len(t):
            if " " in t.lstrip(" "):
                raise ValueError(f"token {t!r} has a space behind another character")
            glue.update(found)
    glue.discard(" ")
    if "\n" in glue:
        raise ValueError("a token holds a line end beside other characters")
    join = "".join(map(re.escape, sorted(glue)))
    part = "".join(re.escape(chr(c)) for c in range(0x3001)
                   if _WHITE.match(chr(c)) and chr(c) not in glue)
    other = part.replace(re.escape(" "), "")
    glued = f"(?:[{part}]*+[{join}][{WHITE}]*+[^{WHITE}]*+)*+" if glue else ""
    return re.compile(f"[{other}](?![{WHITE}])|(?:[{part}]{{2,}}+(?![{WHITE}])| (?![{WHITE}]))?"
                      f"[^{WHITE}]*+{glued}")


class Aligner:
    """Groups of segments under two tokenizers."""

    def __init__(self, first: str, second: str, cache: int = CACHE_SEGMENTS, work: int = WORK):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        raw = {c: b for b, c in BYTE_CHARACTERS.items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(raw[c] for c in t) for t, i in vocabulary.items()}
        self.ranked = ranked(first, self.a_bytes)
        self.b_bytes = {}
        texts = [t.decode("utf-8", "replace") for t in self.a_bytes.values()]
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i).replace("▁", " ")
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.b.is_byte(i) else None
            self.b_bytes[i] = bytes([int(byte[1], 16)]) if byte else piece.encode()
            if not (byte or self.b.is_control(i) or self.b.is_unknown(i)):
                texts.append(piece)
        self.split = segment_pattern(texts).findall
        self.a_size, self.b_size = (np.zeros(max(t) + 1, dtype=np.int64)
                                    for t in (self.a_bytes, self.b_bytes))
        for size, table in ((self.a_size, self.a_bytes), (self.b_size, self.b_bytes)):
            for i, body in table.items():
                size[i] = len(body)
        # Every id as text with what may follow it: another id, the other tokenizer, a group.
        self.texts = [f"{i}{c}" for i in range(len(self.a_size)) for c in ",|"] + [
            f"{i}{c}" for i in range(len(self.b_size)) for c in ",;"]
        self.cache, self.work = cache, work
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def segments(self, text: str | None) -> list[str]:
        return [s for s in self.split(" " + text) if s] if text else []

    def _ids(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        if self.ranked is not None:
            first = list(map(self.ranked.encode_ordinary, segments))
        else:
            first = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        # The second tokenizer puts a space before a text.  A line end is never part of another
        # token, so behind it a segment stands as it is.
        second = self.b.encode(["\n" + s for s in segments], num_threads=1)
        return first, [ids[2:] for ids in second]

    def meet(self, segments: Iterable[str]) -> dict[str, tuple]:
        """``((n_a, n_b, n_groups, n_links), groups as text, pairs, times)`` of each segment.

        None for a segment that one tokenizer does not spell.
        """
        if len(self.known) > self.cache:
            self.known, self.older = {}, self.known
        known, new = self.known, []
        for s in set(segments).difference(known):
            if s in self.older:
                known[s] = self.older[s]
            else:
                new.append(s)
        for at in range(0, len(new), 50_000):
            self._align(new[at:at + 50_000])
        return known

    def _spelled(self, segments: list[str], first: list, second: list) -> list[bool]:
        """Which segments both tokenizers spell."""
        a, b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        whole = "".join(segments).encode()
        if (all(first) and all(second) and b"".join(map(a, chain.from_iterable(first))) == whole
                and b"".join(map(b, chain.from_iterable(second))) == whole):
            size = np.fromiter((len(s.encode()) for s in segments), np.int64, len(segments))
            if all((_summed(table[_flat(ids)], _ends(ids)) == size).all()
                   for table, ids in ((self.a_size, first), (self.b_size, second))):
                return [True] * len(segments)
        return [bool(x and y) and b"".join(map(a, x)) == s.encode() == b"".join(map(b, y))
                for s, x, y in zip(segments, first, second, strict=True)]

    def _align(self, new: list[str]) -> None:
        first, second = self._ids(new)
        good = self._spelled(new, first, second)
        if not all(good):
            self.known.update((s, None) for s, g in zip(new, good, strict=True) if not g)
            new, first, second = ([x for x, g in zip(part, good, strict=True) if g]
                                  for part in (new, first, second))
            if not new:
                return
        a_ids, b_ids = _flat(first), _flat(second)
        x, y, cut_a, cut_b = align(np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids]),
                                   self.work)
        # The tokens of a group are those that its overlaps name, from the least to the greatest.
        group = np.searchsorted(cut_a, x)
        order = np.argsort(group, kind="stable")
        new_group = np.searchsorted(group[order], np.arange(len(cut_a)))
        a_from, b_from = (np.minimum.reduceat(t[order], new_group) for t in (x, y))
        a_n, b_n = cut_a + 1 - a_from, cut_b + 1 - b_from
        links = a_n * b_n
        a_ends = _ends(first)
        ends = np.searchsorted(cut_a, a_ends - 1) + 1  # groups up to each segment's end
        starts = np.append(0, ends[:-1])
        sums = np.append(0, np.cumsum(links))
        shown, shown_at = self._shown(a_ids, b_ids, a_from, a_n, b_from, b_n, ends)
        facts = zip(_sizes(first), _sizes(second), (ends - starts).tolist(),
                    (sums[ends] - sums[starts]).tolist(), strict=True)
        at = 0
        while at < len(new):  # as many segments at a time as make a bounded number of links
            limit = sums[starts[at]] + BLOCK_LINKS
            stop = max(at + 1, int(np.searchsorted(sums[ends], limit, side="right")))
            g = slice(starts[at], ends[stop - 1])
            owner = np.repeat(np.arange(at, stop), (ends - starts)[at:stop])
            seg, pair, times = _linked(a_ids, b_ids, a_from[g], a_n[g], b_from[g], b_n[g], owner)
            borders = np.searchsorted(seg, np.arange(at, stop + 1)).tolist()
            pair, times = pair.tobytes(), times.astype("<u4").tobytes()
            for k in range(at, stop):
                p, q = borders[k - at], borders[k - at + 1]
                text = "".join(shown[shown_at[k]:shown_at[k + 1]])
                self.known[new[k]] = (next(facts), text[:-1], pair[8 * p:8 * q], times[4 * p:4 * q])
            at = stop

    def _shown(self, a_ids, b_ids, a_from, a_n, b_from, b_n, ends):
        """Groups as text: ids with what follows them, and where each segment's begin."""
        groups = np.arange(len(a_n))
        g = np.repeat(groups, a_n)
        out = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        at = np.arange(len(a_ids))
        out[at + b_from[g]] = 2 * a_ids + (at == (a_from + a_n)[g] - 1)
        g = np.repeat(groups, b_n)
        at = np.arange(len(b_ids))
        out[at + (a_from + a_n)[g]] = (2 * b_ids + (at == (b_from + b_n)[g] - 1)
                                       + 2 * len(self.a_size))
        tokens = np.append(0, np.cumsum(a_n + b_n))
        return (list(map(self.texts.__getitem__, out.tolist())),
                tokens[np.append(0, ends)].tolist())


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64)


def _sizes(ids: list[list[int]]) -> list[int]:
    return list(map(len, ids))


def _ends(ids: list[list[int]]) -> np.ndarray:
    return np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))


def _linked(a_ids, b_ids, a_from, a_n, b_from, b_n, owner):
    """Distinct pairs of ids per owner, with the number of their links; sorted by both."""
    links = a_n * b_n
    out = []
    wide = links > BLOCK_LINKS
    for g in np.flatnonzero(wide):  # one long group: ids first, so that links are not listed
        x, x_n = np.unique(a_ids[a_from[g]:a_from[g] + a_n[g]], return_counts=True)
        y, y_n = np.unique(b_ids[b_from[g]:b_from[g] + b_n[g]], return_counts=True)
        out.append((np.full(len(x) * len(y), owner[g]),
                    ((x << SHIFT)[:, None] | y).ravel(), (x_n[:, None] * y_n).ravel()))
    few = np.flatnonzero(~wide)
    n = links[few]
    of = np.repeat(few, n)
    k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    pair = a_ids[a_from[of] + k // b_n[of]] << SHIFT | b_ids[b_from[of] + k % b_n[of]]
    out.append((owner[of], pair, np.ones(len(of), dtype=np.int64)))
    seg, pair, times = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.lexsort((pair, seg))
    seg, pair, times = seg[order], pair[order], times[order]
    new = np.flatnonzero(np.append(True, (seg[1:] != seg[:-1]) | (pair[1:] != pair[:-1]))
                         if len(seg) else np.empty(0, bool))
    return seg[new], pair[new], np.add.reduceat(times, new) if len(new) else times


_LOADED: dict[tuple[str, str], Aligner] = {}


def worker_aligner(first: str, second: str) -> Aligner:
    """One per worker process and pair of files."""
    if (first, second) not in _LOADED:
        _LOADED[first, second] = Aligner(first, second)
    return _LOADED[first, second]


# Chunks ---------------------------------------------------------------------------------------

def _summed(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs; an empty run gives 0."""
    sums = np.append(0, np.cumsum(values))
    return np.diff(sums[np.append(0, ends)])


class _Numbers(dict):
    """Segments numbered as they come."""

    def __missing__(self, segment):
        self[segment] = n = len(self)
        return n


def chunk_row(aligner: Aligner, chunk: int, ids: list, texts: list) -> pa.RecordBatch:
    """A chunk's texts, as the row that ``CHUNK_SCHEMA`` names."""
    number, parts = _Numbers(), []
    for text in texts:
        found = aligner.segments(text)
        parts.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
    known = aligner.meet(number.keys())
    of = [known[s] for s in number]
    # Texts that one tokenizer does not spell have no tokens; their segments count nowhere.
    refused = np.array([o is None for o in of], dtype=bool)
    if refused.any():
        parts = [p[:0] if refused[p].any() else p for p in parts]
        of = [o or ((0, 0, 0, 0), "", b"", b"") for o in of]
    counts = np.array([o[0] for o in of], dtype=np.int64).reshape(-1, 4)
    shown = [o[1] for o in of]
    pair = np.frombuffer(b"".join([o[2] for o in of]), dtype=np.int64)
    times = np.frombuffer(b"".join([o[3] for o in of]), dtype="<u4").astype(np.int64)
    n_pairs = np.array([len(o[2]) // 8 for o in of], dtype=np.int64)
    segment = np.concatenate(parts) if parts else np.empty(0, np.int64)
    doc_ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    pairs, at = np.unique(pair, return_inverse=True)
    holders = _holders(segment, doc_ends, n_pairs, at, len(pairs))
    facts = [_summed(counts[segment, k], doc_ends) for k in range(4)]
    digests = [hashlib.sha256(";".join([shown[i] for i in p.tolist()]).encode()).hexdigest()
               if len(p) else "" for p in parts]
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
         *(pa.array([f], pa.list_(pa.int64())) for f in facts),
         pa.array([digests], pa.list_(pa.string())),
         pa.array([[len(segment), len(of), len(at)]], pa.list_(pa.int64())),
         *(pa.array([pack(x)], pa.binary()) for x in (
             np.diff(np.append(0, doc_ends)), segment, n_pairs, at, times)),
         pa.array([pairs], pa.list_(pa.int64())), pa.array([holders], pa.list_(pa.int64()))],
        names=[c.split()[0] for c in CHUNK_SCHEMA.split(", ")])


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.append(True, values[1:] != values[:-1]))] if len(values) else values


def _holders(segment, doc_ends, n_pairs, at, pairs: int) -> np.ndarray:
    """The number of texts that hold each pair."""
    doc = np.repeat(np.arange(len(doc_ends)), np.diff(np.append(0, doc_ends)))
    met = _distinct(doc * max(1, len(n_pairs)) + segment)  # a text's segments once
    doc, segment = met // max(1, len(n_pairs)), met % max(1, len(n_pairs))
    n = n_pairs[segment]
    first = (np.cumsum(n_pairs) - n_pairs)[segment]
    place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.bincount(_distinct(np.repeat(doc, n) * max(1, pairs) + at[place]) % max(1, pairs),
                       minlength=pairs)


def _chunk_step(first: str, second: str):
    def step(batches):
        aligner = worker_aligner(first, second)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _slices(batch, "text", CHUNK_BYTES):
                yield chunk_row(aligner, chunk, part.column("doc_id").to_pylist(),
                                part.column("text").to_pylist())
                chunk += 1
    return step


def _answer(chunks: pa.Table, answers: pa.Table) -> pa.Table:
    """The rows of one chunk, whose distinct pairs have been counted."""
    row = {n: chunks.column(n)[0] for n in chunks.column_names}
    n_segments, n_distinct, n_pairs = row["sizes"].as_py()
    listed = lambda n: row[n].values
    order = np.argsort(answers.column("place").to_numpy())
    total, best = (answers.column(n).to_numpy()[order] for n in ("total", "best"))
    at, times = (unpack(row[n].as_py(), n_pairs) for n in ("pair_at", "pair_times"))
    segment = unpack(row["segments"].as_py(), n_segments)
    docs, ends = (np.cumsum(unpack(row[n].as_py(), size)) for n, size in
                  (("doc_segments", len(listed("doc_id"))), ("segment_pairs", n_distinct)))
    # A pair that only texts without tokens would hold has no answer that counts.
    counted = [_summed(_summed(times * x[at], ends)[segment], docs)
               for x in ((total == best).astype(np.int64), total)]
    return pa.table(
        [listed("doc_id"), *map(listed, ("n_a", "n_b", "n_groups", "n_links")),
         *(pa.array(c, pa.int64()) for c in counted), listed("groups_sha256")],
        names=[c.split()[0] for c in RESULT_SCHEMA.split(", ")])


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                first: str | None = None, second: str | None = None) -> DataFrame:
    """The aligned texts in chunks, written once."""
    paths = default_paths()
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return materialise(python_rows(texts, _chunk_step(first or paths[0], second or paths[1]),
                                   CHUNK_SCHEMA), "aligned")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(a_id, b_id, total, best)``: texts that hold a linked pair, and the most of the A id."""
    held = (chunks.select(F.arrays_zip("pairs", "holders").alias("z"))
            .select(F.inline("z")).groupBy("pairs").agg(F.sum("holders").alias("total")))
    held = materialise(held.select(
        F.shiftright("pairs", SHIFT).alias("a_id"),
        F.col("pairs").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("b_id"), "total"), "pairs")
    return held.join(held.groupBy("a_id").agg(F.max("total").alias("best")), "a_id")


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
            first: str | None = None, second: str | None = None) -> DataFrame:
    """One row per text with the counts of its tokens, groups and links (``RESULT_SCHEMA``)."""
    chunks = chunk_table(docs, id_col, text_col, first=first, second=second)
    counted = pair_counts(chunks).select(
        F.shiftleft("a_id", SHIFT).bitwiseOR(F.col("b_id")).alias("pair"), "total", "best")
    asked = chunks.select(F.col("chunk").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counted, "pair").select("asker", "place", "total", "best")
    ship_package(docs.sparkSession)
    return (chunks.groupBy("chunk").cogroup(answers.groupBy("asker"))
            .applyInArrow(_answer, RESULT_SCHEMA))
