import math
import re
import zlib
from collections import Counter

import numpy as np

from basketry.llm import common, lm
from tests.llm.cases import frame, rows


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", text) + [None]


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7


def brute(table):
    c = Counter(t for i, x in table if fold(i) != 2 for t in tokens(x))
    n, v = sum(c.values()), len(c)
    out = []
    for i, x in table:
        ts = tokens(x)
        out.append((i, fold(i) == 2, len(ts), sum(c[t] > 0 for t in ts), n,
                    sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts)))
    return sorted(out, key=repr)


def check(df, table):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    want = brute(table)
    key = lambda r: (repr(r[:5]), r[5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9), (a, b)
        assert -1e6 < a[6] <= 0
    return got


def test_rows(spark):
    check(lm.score(frame(spark, rows())), rows())


def test_chunks_and_shards_change_nothing(spark, monkeypatch):
    """Small chunks and many shards give the same rows as one of each."""
    whole = sorted((repr(r.doc_id), r.n_tokens, round(r.score, 9))
                   for r in lm.score(frame(spark, rows())).collect())
    monkeypatch.setattr(lm, "SHARD_BYTES", 500)
    cut = sorted((repr(r.doc_id), r.n_tokens, round(r.score, 9)) for r in
                 lm.score(frame(spark, rows()).repartition(40), chunk_bytes=700).collect())
    assert cut == whole


def test_packed_numbers():
    r = np.random.default_rng(2)
    for top in (1, 200, 70_000, 1 << 40, (1 << 63) - 1):
        x = r.integers(0, top, 500)
        assert (common.unpack(common.pack(x), 500) == x).all()
    keys = np.unique(r.integers(0, 1 << 63, 999, dtype=np.uint64) * np.uint64(2))
    assert (common.unpack_sorted(common.pack_sorted(keys), len(keys)) == keys).all()
    cuts = lm._cuts(keys, 7)
    assert cuts[0] == 0 and cuts[-1] == len(keys) and (np.diff(cuts) > 0).all()
    assert all((keys[a:b].astype(object) * 7 >> 64 == s).all()
               for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])))


def test_empty(spark):
    assert lm.score(frame(spark, [])).count() == 0
    assert check(lm.score(frame(spark, [(None, None)])), [(None, None)])
    held = next(i for i in range(99) if fold(i) == 2)
    got = check(lm.score(frame(spark, [(held, "a b")])), [(held, "a b")])
    assert got[0][4] == 0 and got[0][3] == 0


def test_probabilities_sum_to_one(spark):
    """Over all known words and one unknown, in every context that has a weight."""
    table = rows()
    words, pairs = Counter(), Counter()
    for i, x in table:
        if fold(i) != 2:
            ts = tokens(x)
            words.update(ts)
            pairs.update(zip([None, *ts], ts))
    n, types = sum(words.values()), len(words)
    weights = lm.fit_weights([(b, 5 + b, 0.1 / b, 0.01) for b in range(1, 9)], 1e-3)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 2] == 0 and (weights[:, 0] > 0).all()
    known = list(words)
    for v in [None, *known[:20]]:
        p = lm.probabilities(weights, np.full(types, words[v]), np.array([words[w] for w in known]),
                             np.array([pairs[v, w] for w in known]), n, types)
        unknown = lm.probabilities(weights, np.array([words[v]]), np.zeros(1), np.zeros(1), n, types)
        assert abs(p.sum() + unknown[0] - 1) < 1e-9, v


def brute_weights(table):
    """Expectation-maximisation over single held-out tokens."""
    words, pairs, held = Counter(), Counter(), []
    for i, x in table:
        ts = tokens(x)
        if fold(i) == 5:
            held += zip([None, *ts], ts)
        elif fold(i) != 2:
            words.update(ts)
            pairs.update(zip([None, *ts], ts))
    n, types = max(1, sum(words.values())), len(words)
    return lm.fit_weights([(words[v].bit_length(), 1, pairs[v, w] / max(1, words[v]), words[w] / n)
                           for v, w in held], 1 / (types + 1))


def test_learned_weights(spark):
    """The grid of held-out tokens gives the weights of a fit to the tokens themselves."""
    table = rows(n=600)
    counted, totals = lm.counted_chunks(
        common.bodies(frame(spark, table)).withColumn("fold", lm.fold(lm.F.col("doc_id")).cast("int")))
    got, want = lm.learn_weights(counted, totals), brute_weights(table)
    assert np.abs(got - want).max() < 0.01, np.abs(got - want).max()


def test_weights_follow_the_data():
    """Held-out tokens that the pairs foretell move the weight to the pairs."""
    strong = lm.fit_weights([(5, 1000, 0.8, 0.05), (6, 1000, 0.05, 0.3)], 1e-5)
    assert strong[5, 2] > 0.9 and strong[6, 1] > 0.9


def test_held_out_beats_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lm.score(docs).where("held_out").selectExpr(
        "sum(score) / sum(n_tokens) m", "sum(base_score) / sum(n_tokens) b").first()
    assert got.m > got.b + 0.05, got


def test_every_pair_counts(spark):
    """Scores equal the mixture over the counts of all pairs, whatever their frequency."""
    table = rows()
    weights = lm.fit_weights([(b, 50 + b, 0.45, 0.41) for b in range(1, 9)], 1e-3)
    words, pairs = Counter(), Counter()
    for i, x in table:
        if fold(i) != 2:
            ts = tokens(x)
            words.update(ts)
            pairs.update(zip([None, *ts], ts))
    n, types = sum(words.values()), len(words)

    def brute_score(ts):
        out = 0.0
        for v, w in zip([None, *ts], ts):
            l0, l1, l2 = weights[words[v].bit_length()]
            out += math.log10(l0 / (types + 1) + l1 * words[w] / n
                              + l2 * pairs[v, w] / max(1, words[v]))
        return out

    want = sorted((repr(i), len(tokens(x)), brute_score(tokens(x))) for i, x in table)
    got = sorted((repr(r.doc_id), r.n_tokens, r.score)
                 for r in lm.score(frame(spark, table), weights=weights).collect())
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9), (a, b)
