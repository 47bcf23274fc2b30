import hashlib
import random

import numpy as np
import pytest

from basketry.llm import suffixdedup
from tests.llm.cases import by_id, collected, frame, rows

FIRST = -(1 << 63)


def brute(table, window):
    docs = [(FIRST if i is None else i, i, b) for i, b in by_id(table)]
    least = {}
    for at, _, b in docs:
        for s in range(len(b) - window + 1):
            w = b[s:s + window]
            least[w] = min(least.get(w, at), at)
    out = []
    for at, i, b in docs:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for s in range(len(b) - window + 1):
            if least[b[s:s + window]] < at:
                gone[s:s + window] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        n_spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(b), len(b) - len(kept), n_spans, kept))
    return sorted(out, key=repr)


def digested(found):
    return sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in found), key=repr)


def passages(seed=3, n=60):
    """Random texts that share random passages, some one byte short of the window."""
    r = random.Random(seed)
    letter = lambda: r.choice("abcdefgé ")
    shared = ["".join(letter() for _ in range(k)) for k in (49, 50, 51, 52, 60, 120, 300)]
    out = []
    for i in range(n):
        text = "".join(letter() for _ in range(r.randint(0, 200)))
        for _ in range(r.randint(0, 3)):
            p = r.choice(shared)
            a = r.randint(0, 20) if r.random() < 0.5 else 0
            at = r.randint(0, len(text))
            text = text[:at] + p[a:] + text[at:]
        out.append((i * 7 - 100, text))
    return out + [(9999, "aaaa" * 60), (10000, "aaaa" * 60), (10001, "a" * 49), (10002, "a" * 50)]


def test_rows(spark):
    for table in (passages(), rows()):
        want = digested(brute(table, 50))
        assert sum(r[2] > 0 for r in want) > 10
        assert collected(suffixdedup.passage_report(frame(spark, table))) == want


def test_hot_anchors_and_full_filter(spark):
    """Single windows of hot anchors, and a filter that passes nearly everything."""
    table = passages(5)
    want = digested(brute(table, 50))
    for options in ({"hot_documents": 3}, {"filter_bits": 4}):
        assert collected(suffixdedup.passage_report(frame(spark, table), **options)) == want


def test_other_window(spark):
    table = passages(8, 25)
    got = suffixdedup.passage_report(frame(spark, table), window=33)
    assert collected(got) == digested(brute(table, 33))


def test_empty(spark):
    assert collected(suffixdedup.passage_report(frame(spark, []))) == []
    table = [(None, None), (1, "é" * 24), (1, "b" * 80), (1, "b" * 80)]
    assert collected(suffixdedup.passage_report(frame(spark, table))) == digested(brute(table, 50))


def test_texts(spark):
    table = passages(9, 30)
    df = frame(spark, table)
    got = suffixdedup.drop_repeated_passages(df)
    assert got.columns == df.columns
    want = [(i, k.decode("utf-8", "ignore")) for i, _, _, _, k in brute(table, 50)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_every_window_has_one_segment():
    r = random.Random(1)
    parts = [bytes(r.choice(b"abc") for _ in range(k)) for k in (0, 49, 50, 200, 3, 0, 120)]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    owner, first, count, keys = suffixdedup.segments(b"".join(parts), starts)
    seen = [(o, s + i) for o, s, c in zip(owner, first, count) for i in range(c)]
    assert seen == [(o, s) for o, p in enumerate(parts) for s in range(len(p) - 49)]
    # The same window has the same key wherever it stands.
    again = suffixdedup.segments(parts[3][7:90], np.array([0]))
    key = {parts[3][s + i:s + i + 50]: k for o, s, c, k in zip(owner, first, count, keys)
           if o == 3 for i in range(c)}
    for s, c, k in zip(*again[1:]):
        assert all(key[parts[3][7:90][s + i:s + i + 50]] == k for i in range(c))


def test_ids_of_all_sizes():
    ids = np.array([FIRST, -5, 7, (1 << 63) - 1])
    far = suffixdedup._from_base(ids, FIRST)
    back = suffixdedup._to_ids(suffixdedup._wide(suffixdedup._narrow(far), 4), FIRST)
    assert back.tolist() == ids.tolist()


@pytest.mark.parametrize("width", [1, 2, 5, 35])
def test_windowed_min(width):
    x = np.random.default_rng(2).integers(0, 99, 200)
    got = suffixdedup.windowed_min(x, width)
    assert got.tolist() == [x[i:i + width].min() for i in range(201 - width)]
