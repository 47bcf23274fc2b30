import random
import re
from math import comb

import numpy as np
import xxhash

import corpus_pipeline
from basketry.llm import nearcopies
from tests.llm.cases import frame, rows


def brute_set(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(table):
    """Least id of each component of texts with a similarity of 0.8 and more."""
    sets = [brute_set(t) for _, t in table]
    parent = list(range(len(table)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(table):
        least[root(i)] = min(least.get(root(i), (True, 0)), (d is None, d or 0))
    return sorted(least.values())


def near_copies(groups=12, each=9, seed=3):
    """Texts of 120 words and copies with a few words changed."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(700)]
    out = []
    for g in range(groups):
        base = [r.choice(words) for _ in range(120)]
        for k in range(each):
            text = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 5, 9])):
                text[r.randrange(120)] = r.choice(words)
            out.append((10_000 + g * 100 + k, " ".join(text)))
    return out


def kept(df):
    return sorted((x.doc_id is None, x.doc_id or 0) for x in df.collect())


def test_against_brute_force(spark):
    """The stage finds near copies that lie more than two bits apart."""
    table = near_copies()
    want = brute_kept(table)
    assert 12 <= len(want) < len(table) // 2
    assert kept(corpus_pipeline.near_dedup(spark, frame(spark, table, wide=False), "")) == want


def test_awkward_rows_and_large_buckets(spark):
    table = rows(n=60)
    df = frame(spark, table)
    assert kept(nearcopies.keep_one(df)) == brute_kept(table)
    assert nearcopies.keep_one(df).columns == df.columns
    table = near_copies(2, 40, 5)
    got = kept(nearcopies.keep_one(frame(spark, table, wide=False), small=3))
    assert got == brute_kept(table)


def chained(n=60, seed=4):
    """A chain: each text is close to the next one, the ends are far apart; and unlike texts that
    share most shingles with a template."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(900)]
    text, out = [r.choice(words) for _ in range(150)], []
    for i in range(n):
        text = list(text)
        text[(7 * i) % 150] = r.choice(words)
        out.append((20_000 + i, " ".join(text)))
    base = [r.choice(words) for _ in range(150)]
    for i in range(n):
        text = list(base)
        for _ in range(5):
            text[r.randrange(150)] = r.choice(words)
        out.append((30_000 + i, " ".join(text)))
    return out


def test_no_link_is_lost_in_large_buckets(spark):
    """Leaders that are unlike each other do not hide the links between their followers."""
    table = chained()
    assert kept(nearcopies.keep_one(frame(spark, table, wide=False), small=2)) == brute_kept(table)


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "BLOCK_SETS", 9)
    table = chained(40, 6)
    assert kept(nearcopies.keep_one(frame(spark, table, wide=False), small=2)) == brute_kept(table)


def test_signatures_leave_doubt_around_the_threshold():
    n = nearcopies.BANDS * nearcopies.ROWS
    verdict = nearcopies.sure(np.array([n, round(0.96 * n), round(0.8 * n), round(0.72 * n), n // 2]))
    assert verdict.tolist() == [1, 1, 0, 0, -1]


def test_links_on_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table = [(d.doc_id, d.text) for d in docs.select("doc_id", "text").collect()]
    assert kept(nearcopies.keep_one(docs)) == brute_kept(table)


def test_columns_with_internal_names(spark):
    docs = spark.createDataFrame(
        [(1, None, "a", 2, "x"), (2, "b c", "d", 3, "y"), (3, "B  c", "e", 4, "z")],
        "doc_id bigint, text string, _row string, n int, `print.bands` string")
    got = sorted((tuple(r) for r in nearcopies.keep_one(docs).collect()))
    assert got == [(1, None, "a", 2, "x"), (2, "b c", "d", 3, "y")]


def test_empty(spark):
    assert nearcopies.keep_one(frame(spark, [])).count() == 0
    assert nearcopies.keep_one(frame(spark, [(None, None), (1, "")])).count() == 1


def brute_print(found):
    """64-bit fingerprint of a set of shingles."""
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_within(table, radius):
    """As ``brute_kept``, by links whose fingerprints differ in ``radius`` bits at most."""
    sets = [brute_set(t) for _, t in table]
    prints = [brute_print(s) for s in sets]
    root = list(range(len(table)))
    for i, a in enumerate(sets):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                one, two = root[i], root[j]
                root = [two if r == one else r for r in root]
    least = {}
    for (d, _), r in zip(table, root, strict=True):
        least[r] = min(least.get(r, d), d)
    return sorted((False, d) for d in least.values())


def test_links_come_from_the_trees(spark):
    """Narrow trees find fewer links, in small shards, by the leaders of large ones and in blocks."""
    table = near_copies(3, 14) + chained(12)
    every = brute_kept(table)
    for radius, small in ((0, 8), (3, 8), (3, 2)):
        want = brute_within(table, radius)
        assert len(every) < len(want) < len(table)
        df = frame(spark, table, wide=False)
        assert kept(nearcopies.keep_one(df, small=small, radius=radius)) == want
    assert brute_within(table, nearcopies.RADIUS) == every


def test_radius_is_wide_enough():
    """Of pairs of similarity 0.8 and more hardly any lies outside: sets of up to 60 shingles."""
    pmf = [np.array([comb(n, k) / 2 ** n for k in range(n + 1)]) for n in range(61)]
    worst = 0
    for n in range(2, 61):
        both = -(-4 * n // 5)
        for a in range((n - both) // 2 + 1):
            b = n - both - a
            k = np.arange(both + 1)
            one, two = ((pmf[m] * (2 * (k[:, None] + np.arange(m + 1)) > both + m)).sum(axis=1)
                        for m in (a, b))  # the bit is set, by the number of common ones that have it
            worst = max(worst, (pmf[both] * (one * (1 - two) + two * (1 - one))).sum())
    assert abs(worst - 0.1875) < 1e-9
    lost = sum(comb(64, k) * worst ** k * (1 - worst) ** (64 - k) for k in range(nearcopies.RADIUS + 1, 65))
    assert lost < 2e-6
