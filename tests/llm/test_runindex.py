import random

import numpy as np

from basketry.llm.runindex import RunIndex, suffix_ranks


def texts(seed, n=25, letters=b"ab\x00\xff"):
    r = random.Random(seed)
    base = bytes(r.choice(letters) for _ in range(60))
    out = []
    for _ in range(n):
        a, b = sorted((r.randrange(60), r.randrange(60)))
        t = bytearray(base[a:b])
        for _ in range(r.randint(0, 2)):
            if t:
                t[r.randrange(len(t))] = r.choice(letters)
        out.append(bytes(t))
    return out


def test_suffix_order():
    symbols = np.array([2, 1, 2, 1, 0, 2, 1, 0, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 0], dtype=np.int16)
    order, _ = suffix_ranks(symbols)
    ends = np.flatnonzero(symbols == 0)

    def suffix(i):
        end = ends[ends >= i][0]
        return ([(int(s), 0) for s in symbols[i:end]] + [(0, int(end))])

    assert order.tolist() == sorted(range(len(symbols)), key=suffix)


def test_matching_statistics_against_brute_force():
    for seed in range(12):
        held, asked = texts(seed), texts(seed + 50, 15, b"ab\x00\xffq") + texts(seed, 5) + [b""]
        index = RunIndex(held, 8)
        lengths, rows = index.matching_statistics(asked)
        for i, q in enumerate(asked):
            for t in range(len(q)):
                want = max(k for k in range(len(q) - t + 1)
                           if k == 0 or any(q[t:t + k] in h for h in held))
                assert lengths[i, t] == want, (seed, q, t)


def test_classes_against_brute_force():
    for seed in range(12):
        held = texts(seed, 30)
        docs = np.random.default_rng(seed).integers(0, 9, len(held))
        for window in (8, 14, 15, 20):
            index = RunIndex(held, window)
            least = index.least(docs)
            lengths, rows = index.matching_statistics(held)
            for i, q in enumerate(held):
                for t in range(len(q) - window + 1):
                    assert lengths[i, t] >= window
                    want = min(d for d, h in zip(docs, held) if q[t:t + window] in h)
                    assert least[index.class_of_row[rows[i, t]]] == want
