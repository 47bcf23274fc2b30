"""The trie and its subtree sums against a plain tree in memory."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from basketry.llm import prefixtrie, queries
from tests.llm import cases

SCHEMA = ("conv_id bigint, turn bigint, role string, text string, key string, depth string, "
          "id string, conv string, part string")


def frame(spark, table):
    return spark.createDataFrame([(*r, "k", "d", "i", "c", "p") for r in table], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(table):
    turns = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, digest(role or "", text or ""),
                                role or "", text or ""))
    own = {c: [r[3:] for r in sorted(t)] for c, t in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for n in nodes:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in children[n]) if children[n] else 1
        size = len(n[-1][1].encode()) if n else 0
        saved[n] = (len(nodes[n]) - 1) * size + sum(saved[x] for x in children[n])
    return sorted(((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(children[n]),
                    leaves[n], saved[n], hashlib.sha256(",".join(
                        str(c) for c in sorted(m) if len(built[c]) == len(n)).encode()).hexdigest())
                   for n, m in nodes.items()), key=repr)


def table(seed=1, convs=60):
    r = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(r.randint(1, 12)):
            out.append((c, t, r.choice(["user", "assistant", None]), r.choice(["a", "bé", "", None])))
    out += [(200, None, "user", "null turn"), (200, None, "user", "null turn"), (200, 3, "x", "y"),
            (200, 3, "x", "a tie"), (205, 1, "user", "a"), (205, 1, "user", "a"),
            (None, 1, "user", "no conversation"), (-3, 1, "user", "a"), (-5, 0, "user", "a"),
            (999, 0, "user", "z" * 50_000), (-2**63, 0, None, None), (2**63 - 1, 5, "user", "a")]
    out += [(1000 + i, t, "user", f"same {t}") for i in range(40) for t in range(4)]
    out += [(2001, t, "user", f"long {t}") for t in range(3000)]
    out += [(2002, t, "user", f"long {t}") for t in range(2500)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rows(spark, seed):
    rows = table(seed)
    random.Random(seed).shuffle(rows)
    assert cases.collected(prefixtrie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_small_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "BUCKET_TURNS", 2)
    monkeypatch.setattr(prefixtrie, "BUCKET_NODES", 10)
    monkeypatch.setattr(prefixtrie, "END_IDS", 3)
    rows = [r for r in table(3, 40) if r[0] not in (2001, 2002)]
    assert cases.collected(prefixtrie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_one_conversation_over_all_partitions(spark):
    rows = [(4, t, "user", f"t{t}") for t in range(5000)] + [(3, 0, "user", "t0")]
    assert cases.collected(prefixtrie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_turnless_conversation_is_in_the_root(spark):
    lone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lone, 0, "user", "a"), (lone, 1, "user", "b")]
    got = cases.collected(prefixtrie.prefix_trie(frame(spark, rows)))
    assert got == brute(rows) and got[0][:5] == (lone, 0, None, 1, 0)


def test_empty_table(spark):
    assert prefixtrie.prefix_trie(frame(spark, [])).collect() == []


def test_query_on_whole_conversations(spark, sf_dir):
    got = queries.op11_prefix_trie(spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    assert cases.collected(got) == brute(
        [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows])
