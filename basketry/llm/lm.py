"""Language-model scores by deleted interpolation.

The probability of a word after its context is a mixture of maximum-likelihood estimates,

    P(w | v) = l2(b) * c(v, w) / c(v) + l1(b) * c(w) / N + l0(b) / (V + 1),

whose weights depend on b, the bucket (power of two) of the context's frequency.  Weights are
learned by expectation-maximisation on counts held out of the training documents: estimates from
one part, counts from the other.  The scores then use the counts of all training documents.
Every pair of the training documents counts, whatever its frequency, and every word is a context.

No table of words or pairs is broadcast, and no row is made for a token:

1. Texts are worked on in chunks of bounded size.  A chunk asks for its distinct words and pairs
   once: sorted 64-bit hashes, packed as differences, with the chunk's own counts, cut into shards
   by their first bits.  Its texts travel beside them as numbers of its words.
2. A shard sums the counts of equal hashes over all chunks and answers each chunk in the order in
   which it asked, so answers need no keys.  A shard holds a bounded part of what was asked: the
   number of shards follows the bytes of the texts, hashes fall evenly, and a frequent pair is
   asked once per chunk.
3. Answers meet their chunk again, which puts counts to its tokens and adds up its held-out tokens
   on a grid for the fit.
4. The chunks, read again, are scored text by text.

Held-out tokens are gathered in cells of 0.1 of the natural logarithms of both estimates; a cell
keeps the mean estimates of its tokens, which leaves an error of the order of 0.1 squared over 24
in a token's shares, some 0.05 %.  Words are told apart by 64 bits of their xxhash64, pairs by 64
bits of their words' hashes.

A document is its words and one end; the end is also the context of the first word.

Defined results: null counts as empty, which is the end alone; a null id counts as an empty id
text; repeated rows are counted and scored each for itself; a text of any length is scored whole
(one beyond a chunk's size is a chunk of its own); an empty table gives an empty result; without
training documents every token is unknown; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from basketry.llm.common import (bodies, pack, pack_sorted, python_rows, shuffle_width, unpack,
                                 unpack_sorted)
from basketry.session import materialise, ship_package

FOLDS, HELD_OUT, TUNING = 7, 2, 5
END = b""  # no word is empty
CHUNK_BYTES = 8 << 20
SHARD_BYTES = 12 << 20
BUCKETS = 64
HASH_SEED = 42
STEP = 0.1  # of the natural logarithms in the grid of held-out tokens
NONE = -1_000_000  # the cell of an estimate of zero

TEXTS, WORDS, PAIRS, TOTALS = range(4)
ASKED_SCHEMA = ("kind int, chunk bigint, shard int, n bigint, keys binary, fit binary, tune binary, "
                "doc_id array<bigint>, doc_end array<bigint>, fold array<int>")
COUNTED_SCHEMA = (
    "chunk bigint, n bigint, doc_id array<bigint>, doc_end array<bigint>, fold array<int>, "
    "words binary, n_words bigint, word_total binary, pair_total binary, "
    "cells array<struct<bucket: int, q2: int, q1: int, n: bigint, p2: double, p1: double>>")
SCORE_SCHEMA = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                "train_tokens bigint, base_score double, score double")


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def chunks(batches, size: int = CHUNK_BYTES):
    """Columns of the batches' rows, some megabytes of text at a time."""
    for batch in batches:
        start, held = 0, 0
        columns = [c.to_pylist() for c in batch.columns]
        texts = columns[batch.schema.names.index("body")]
        for i, body in enumerate(texts):
            held += len(body)
            if held >= size:
                yield [c[start:i + 1] for c in columns]
                start, held = i + 1, 0
        if start < len(texts):
            yield [c[start:] for c in columns]


def tokens(body: bytes) -> list[bytes]:
    return [*body.lower().split(), END]  # bytes.lower() changes A-Z alone


# Chunks ask -----------------------------------------------------------------------------------

class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64 bits for pairs of word hashes."""
    mixed = v * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) + w
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


def _contexts(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The word before each one; a text's last word, its end, is also before its first."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[:1] = words[-1:]
    return before


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where ascending keys pass from shard to shard."""
    limits = np.array([-(-(s << 64) // shards) for s in range(1, shards)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, limits), [len(keys)]])


def ask(ids: list, texts: list[bytes], folds: list[int], chunk: int, shards: int) -> pa.RecordBatch:
    """The rows of one chunk: its texts, and what it asks of each shard."""
    numbers = _Numbers()
    parts = []
    for body in texts:
        t = tokens(body)
        parts.append(np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)))
    digest = xxhash.xxh64_intdigest
    hashes, place = np.unique(np.array([digest(w, HASH_SEED) for w in numbers], dtype=np.uint64),
                              return_inverse=True)
    words = place[np.concatenate(parts)]
    ends = np.cumsum([len(p) for p in parts])
    of = np.repeat(np.array(folds), np.diff(np.append(0, ends)))
    tune = of == TUNING
    fit = ~tune & (of != HELD_OUT)
    keys = pair_keys(hashes[_contexts(words, ends)], hashes[words])
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    asked = [(WORDS, hashes, *(np.bincount(words[x], minlength=len(hashes)) for x in (fit, tune))),
             (PAIRS, keys[new], *(np.add.reduceat(x[order].astype(np.int64), new)
                                  for x in (fit, tune)))]
    rows = [{"kind": TEXTS, "chunk": chunk, "shard": chunk % shards, "n": len(words),
             "keys": pack_sorted(hashes), "fit": pack(words), "tune": None,
             "doc_id": ids, "doc_end": ends, "fold": folds}]
    for kind, found, n_fit, n_tune in asked:
        cuts = _cuts(found, shards).tolist()
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                rows.append({"kind": kind, "chunk": chunk, "shard": shard, "n": b - a,
                             "keys": pack_sorted(found[a:b]), "fit": pack(n_fit[a:b]),
                             "tune": pack(n_tune[a:b])})
    return pa.RecordBatch.from_pylist(rows, schema=_ASKED)


_ASKED = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("shard", pa.int32()),
                    ("n", pa.int64()), ("keys", pa.binary()), ("fit", pa.binary()),
                    ("tune", pa.binary()), ("doc_id", pa.list_(pa.int64())),
                    ("doc_end", pa.list_(pa.int64())), ("fold", pa.list_(pa.int32()))])


def _ask_step(shards: int, size: int):
    def step(batches):
        chunk = TaskContext.get().partitionId() << 32
        for ids, texts, folds in chunks(batches, size):
            yield ask(ids, texts, folds, chunk, shards)
            chunk += 1
    return step


# Shards answer --------------------------------------------------------------------------------

def answer(table: pa.Table) -> pa.Table:
    """A shard's rows with the counts of all chunks in place of each chunk's own."""
    rows = table.to_pylist()
    out = [r for r in rows if r["kind"] == TEXTS]
    for kind in (WORDS, PAIRS):
        asked = [r for r in rows if r["kind"] == kind]
        if not asked:
            continue
        keys, place = np.unique(np.concatenate([unpack_sorted(r["keys"], r["n"]) for r in asked]),
                                return_inverse=True)
        sums = [np.bincount(place, weights=np.concatenate([unpack(r[side], r["n"]) for r in asked]),
                            minlength=len(keys)).astype(np.int64) for side in ("fit", "tune")]
        at = 0
        for r in asked:
            own = place[at:at + r["n"]]
            at += r["n"]
            out.append(r | {"keys": None, "fit": pack(sums[0][own]), "tune": pack(sums[1][own])})
        if kind == WORDS:
            fit, tune = sums
            out.append({"kind": TOTALS, "chunk": None, "shard": asked[0]["shard"], "n": None,
                        "doc_end": [int(fit.sum()), int(tune.sum()),
                                    int(np.count_nonzero(fit + tune)), int(np.count_nonzero(fit))]})
    return pa.Table.from_pylist(out, schema=_ASKED)


# Chunks count ---------------------------------------------------------------------------------

def buckets(n: np.ndarray) -> np.ndarray:
    """The power of two above a frequency; 0 for what was never seen."""
    return np.minimum(np.frexp(n.astype(float))[1], BUCKETS - 1)


def _cells(n_v, n_w, n, total: int) -> list[dict]:
    """Held-out tokens by bucket and the logarithms of both estimates."""
    p2, p1 = n / np.maximum(n_v, 1), n_w / max(1, total)
    with np.errstate(divide="ignore"):
        q2, q1 = (np.where(p > 0, np.round(np.log(p) / STEP), NONE).astype(np.int64)
                  for p in (p2, p1))
    keys, at, each = np.unique(np.stack([buckets(n_v), q2, q1]), axis=1, return_inverse=True,
                               return_counts=True)
    sums = [np.bincount(at.ravel(), weights=p, minlength=len(each)) for p in (p2, p1)]
    return [{"bucket": b, "q2": x, "q1": y, "n": k, "p2": s2, "p1": s1} for b, x, y, k, s2, s1 in
            zip(*keys.tolist(), each.tolist(), *(s.tolist() for s in sums), strict=True)]


def _count_step(fit_total: int):
    def count(table: pa.Table) -> pa.Table:
        """The rows of one chunk, its texts and the answers, as one row with counts."""
        rows = table.to_pylist()
        texts, = (r for r in rows if r["kind"] == TEXTS)
        words = unpack(texts["fit"], texts["n"])
        counted = {}
        for kind in (WORDS, PAIRS):
            parts = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["shard"])
            counted[kind] = [np.concatenate([unpack(r[side], r["n"]) for r in parts])
                             for side in ("fit", "tune")]
        n_words = len(counted[WORDS][0])
        hashes = unpack_sorted(texts["keys"], n_words)
        ends = np.array(texts["doc_end"])
        before = _contexts(words, ends)
        keys, place = np.unique(pair_keys(hashes[before], hashes[words]), return_inverse=True)
        if len(keys) != len(counted[PAIRS][0]):
            raise ValueError("a chunk was answered for other texts than it holds")
        folds = np.array(texts["fold"])
        held = np.flatnonzero(np.repeat(folds == TUNING, np.diff(np.append(0, ends))))
        fit = counted[WORDS][0]
        cells = _cells(fit[before[held]], fit[words[held]], counted[PAIRS][0][place[held]],
                       fit_total) if len(held) else []
        row = {"chunk": texts["chunk"], "n": texts["n"], "doc_id": texts["doc_id"],
               "doc_end": texts["doc_end"], "fold": texts["fold"], "words": texts["fit"],
               "n_words": n_words, "word_total": pack(sum(counted[WORDS])),
               "pair_total": pack(sum(counted[PAIRS])[place]), "cells": cells}
        return pa.Table.from_pylist([row], schema=_COUNTED)
    return count


_CELL = pa.struct([("bucket", pa.int32()), ("q2", pa.int32()), ("q1", pa.int32()), ("n", pa.int64()),
                   ("p2", pa.float64()), ("p1", pa.float64())])
_COUNTED = pa.schema([("chunk", pa.int64()), ("n", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                      ("doc_end", pa.list_(pa.int64())), ("fold", pa.list_(pa.int32())),
                      ("words", pa.binary()), ("n_words", pa.int64()), ("word_total", pa.binary()),
                      ("pair_total", pa.binary()), ("cells", pa.list_(_CELL))])


# The fit and the scores -----------------------------------------------------------------------

def fit_weights(cells: list[tuple], uniform: float, iterations: int = 60) -> np.ndarray:
    """``[bucket, (l0, l1, l2)]`` by expectation-maximisation on held-out counts.

    ``cells`` are ``(bucket, tokens, P2, P1)``.  A bucket that saw little leans on all of them.
    """
    weights = np.tile(np.array([0.1, 0.6, 0.3]), (BUCKETS, 1))
    weights[0] = 0.1, 0.9, 0.0  # a context never seen has no P2
    if not cells:
        return weights
    table = np.array(sorted(cells), dtype=float)
    bucket, n = table[:, 0].astype(int), table[:, 1]
    p = np.stack([np.full(len(table), uniform), table[:, 3], table[:, 2]], axis=1)
    one = weights[1:2].copy()
    inside = bucket > 0
    for pooled in (True, False):
        for _ in range(iterations):
            w = np.repeat(one, len(table), axis=0) if pooled else weights[bucket]
            share = w * p
            share *= (n / np.maximum(share.sum(axis=1), 1e-300))[:, None]
            if pooled:
                got = share[inside].sum(axis=0) + 1.0
                one = (got / got.sum())[None]
            else:
                got = np.stack([np.bincount(bucket, weights=share[:, i], minlength=BUCKETS)
                                for i in range(3)], axis=1)
                prior = np.repeat(one, BUCKETS, axis=0)
                prior[0] = 0.1, 0.9, 0.0
                got += 10 * prior
                weights = got / got.sum(axis=1, keepdims=True)
    return weights


def probabilities(weights: np.ndarray, n_v, n_w, n, total: int, types: int) -> np.ndarray:
    """P(w | v) from the counts of contexts, words and pairs."""
    share = weights[buckets(n_v)]
    return (share[:, 0] / (types + 1) + share[:, 1] * n_w / max(1, total)
            + share[:, 2] * n / np.maximum(n_v, 1))


def _score_step(weights: np.ndarray, total: int, types: int):
    def step(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = unpack(row["words"], row["n"])
                count = unpack(row["word_total"], row["n_words"])
                ends = np.array(row["doc_end"])
                starts = np.append(0, ends[:-1])
                n_w = count[words]
                p = probabilities(weights, count[_contexts(words, ends)], n_w,
                                  unpack(row["pair_total"], row["n"]), total, types)
                base = np.log10((n_w + 1) / (total + types + 1))
                sums = [np.add.reduceat(x, starts) for x in
                        ((n_w > 0).astype(np.int64), base, np.log10(p))]
                m = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_id"], pa.int64()), pa.array(np.array(row["fold"]) == HELD_OUT),
                     pa.array(ends - starts), pa.array(sums[0]),
                     pa.array(np.full(m, total, dtype=np.int64)), pa.array(sums[1]),
                     pa.array(sums[2])], names=[c.split()[0] for c in SCORE_SCHEMA.split(", ")])
    return step


def _once(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` that leaves no shuffle files behind."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return materialise(df, name)
    finally:
        conf.set(key, before)


def counted_chunks(texts: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, list[int]]:
    """Chunks with the counts of their tokens, and the totals: tokens of the estimates' part and of
    the held-out part, distinct words of both and of the first."""
    spark = texts.sparkSession
    ship_package(spark)
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(shuffle_width(spark), -(-size // SHARD_BYTES))
    asked = python_rows(texts, _ask_step(shards, chunk_bytes), ASKED_SCHEMA)
    answers = _once(asked.groupBy("shard").applyInArrow(answer, ASKED_SCHEMA), "answers")
    of = lambda i: F.sum(F.col("doc_end")[i])
    totals = [int(x or 0) for x in
              answers.where(F.col("kind") == TOTALS).agg(*map(of, range(4))).first()]
    counted = answers.where(F.col("kind") != TOTALS).groupBy("chunk").applyInArrow(
        _count_step(totals[0]), COUNTED_SCHEMA)
    return _once(counted, "counted"), totals


def learn_weights(counted: DataFrame, totals: list[int]) -> np.ndarray:
    """Mixture weights from the cells of all chunks; their number is bounded by the grid."""
    cells = (counted.select(F.inline("cells")).groupBy("bucket", "q2", "q1")
             .agg(*(F.sum(c).alias(c) for c in ("n", "p2", "p1")))
             .select("bucket", "n", F.col("p2") / F.col("n"), F.col("p1") / F.col("n")))
    return fit_weights([tuple(r) for r in cells.collect()], 1 / (totals[3] + 1))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
          weights: np.ndarray | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Counts and log10 probabilities per row; ``weights``, if given, are not learned again.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    texts = bodies(docs, id_col, text_col)
    counted, totals = counted_chunks(texts.withColumn("fold", fold(F.col("doc_id")).cast("int")),
                                     chunk_bytes)
    if weights is None:
        weights = learn_weights(counted, totals)
    return python_rows(
        counted.select("n", "doc_id", "doc_end", "fold", "words", "n_words", "word_total", "pair_total"),
        _score_step(weights, totals[0] + totals[1], totals[2]), SCORE_SCHEMA)
