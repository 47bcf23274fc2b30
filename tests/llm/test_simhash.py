import random
import re
from collections import Counter

import numpy as np
import xxhash

from basketry.llm import simhash
from basketry.llm.components import components
from tests.llm.cases import collected, frame, rows


def brute_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [(xxhash.xxh64(s.encode(), seed=42).intdigest(), n) for s, n in Counter(shingles).items()]
    return sum(1 << b for b in range(64)
               if 2 * sum(n for h, n in hashes if h >> b & 1) > len(shingles))


def brute_groups(prints):
    """Least id reachable over prints that differ in two bits at most."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, p) in enumerate(prints):
        for j in range(i):
            if (prints[j][1] ^ p).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, f"{p:016x}", least.get(root(i))) for i, (d, p) in enumerate(prints)]


def test_rows(spark):
    table = rows()
    want = brute_groups([(i, brute_print(t)) for i, t in table])
    got = simhash.near_duplicates(frame(spark, table))
    assert collected(got) == sorted(want, key=repr)


def test_empty(spark):
    assert collected(simhash.near_duplicates(frame(spark, []))) == []
    assert collected(simhash.near_duplicates(frame(spark, [(None, None)]))) == [
        (None, "0" * 16, None)]


def planted(n=600, seed=2):
    r = random.Random(seed)
    out = set()
    while len(out) < n:
        p = r.getrandbits(64)
        out.add(p)
        for _ in range(r.randint(0, 4)):  # chains of 1 to 4 changed bits
            for _ in range(r.randint(1, 4)):
                p ^= 1 << r.randrange(64)
            out.add(p)
    base = r.getrandbits(64)
    out |= {base ^ (1 << a) ^ (1 << b) ^ (1 << c) for a in range(6) for b in range(20, 26)
            for c in range(50, 54)}  # a dense group
    return sorted(out)


def test_links_lose_nothing(spark):
    """Shards of two rows at most make every level of cuts do its part."""
    prints = planted()
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint")
    want = {}
    for d, p, c in brute_groups(list(enumerate(prints))):
        want[simhash.signed(int(p, 16))] = c
    for limit in (2, 4096):
        links = simhash.near_links(df, limit)
        assert links.count() < 12 * len(prints)
        roots = {r.node: r.root for r in components(links).collect()}
        groups = {}
        for p in want:
            groups.setdefault(roots.get(p, p), set()).add(p)
        brute = {}
        for p, c in want.items():
            brute.setdefault(c, set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_tree_follows_only_near_edges():
    prints = planted(300, 9)
    tree = simhash.BKTree()
    for p in prints:
        tree.add(p)
    for p in prints[::7]:
        want = [i for i, q in enumerate(tree.values) if (p ^ q).bit_count() <= 2]
        assert sorted(tree.near(p)) == want


def test_last_cut_is_bounded():
    masks = [m for cuts in simhash._cuts(simhash.LEVELS).values() for _, m in cuts]
    assert len(masks) == 27 and min(m.bit_count() for m in masks) >= 44


def test_keep_one(spark):
    df = frame(spark, [(3, "a b c d"), (1, "a b  c d"), (1, "a b c d"), (None, "a b c d"),
                       (2, "x y z"), (None, None), (None, "")])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)[:2] == [
        (1, "a b  c d"), (2, "x y z")]
    assert kept.count() == 3


def test_components(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1100)]
    links += [(r.randrange(2000, 2300), r.randrange(2000, 2300)) for _ in range(150)]
    r.shuffle(links)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a bigint, b bigint"))
           .collect()}
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_one_walk_for_many_values():
    prints = planted(300, 9)
    for radius in (0, 2, 28):
        tree = simhash.BKTree(radius)
        assert [x.tolist() for x in tree.near_all(np.array(prints[:3], np.uint64))] == [[], []]
        for p in prints[::2]:
            tree.add(p)
        asked = prints[::3]
        got = sorted(zip(*(x.tolist() for x in tree.near_all(np.array(asked, np.uint64))), strict=True))
        assert got == [(i, j) for i, p in enumerate(asked) for j, q in enumerate(tree.values)
                       if (p ^ q).bit_count() <= radius]
        for i, p in enumerate(asked[:20]):
            assert sorted(tree.near(p)) == [j for k, j in got if k == i]


def test_words_of_a_shingle():
    body = b"A b c d e f g"
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c d e", b"b c d e f", b"c d e f g")]
    assert simhash.fingerprint(body, 5) == sum(
        1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) >= 2) != simhash.fingerprint(body)
