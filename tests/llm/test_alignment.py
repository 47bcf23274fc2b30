"""Alignment by merge paths against whole texts, token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from basketry.llm import alignment, queries
from tests.llm import cases

pytest.importorskip("sentencepiece")
pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*alignment.default_paths())


def tokens(aligner, text):
    """Ids and bytes under both tokenizers; None if a text has no tokens."""
    if not text:
        return None
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    x, y = [aligner.a_bytes[i] for i in a], [aligner.b_bytes[i] for i in b]
    whole = (" " + text).encode()
    return (a, x, b, y) if b"".join(x) == whole == b"".join(y) else None


def ends(parts):
    return np.cumsum([len(p) for p in parts])


def groups(found):
    a, x, b, y = found
    common = sorted(set(ends(x).tolist()) & set(ends(y).tolist()))
    out, i, j = [], 0, 0
    for e in common:
        p, q = i, j
        while i < len(a) and ends_of(x, i) <= e:
            i += 1
        while j < len(b) and ends_of(y, j) <= e:
            j += 1
        out.append((a[p:i], b[q:j]))
    return out


_ENDS: dict = {}


def ends_of(parts, i):
    key = id(parts)
    if key not in _ENDS or _ENDS[key][0] is not parts:
        _ENDS[key] = (parts, ends(parts))
    return _ENDS[key][1][i]


def brute(aligner, table):
    held, grouped = Counter(), []
    for _, text in table:
        found = tokens(aligner, text)
        g = groups(found) if found else []
        grouped.append(g)
        held.update({(a, b) for x, y in g for a in x for b in y})
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    rows = []
    for (doc_id, _), g in zip(table, grouped, strict=True):
        links = [(a, b) for x, y in g for a in x for b in y]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        rows.append((doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g),
                     len(links), sum(held[p] == best[p[0]] for p in links),
                     sum(held[p] for p in links),
                     hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return sorted(rows, key=repr)


AWKWARD = ["a", " ", "  ", "   ", "a ", " a", "a  b", "\n", "\n\n", " \n a\n b \n", "\ta\t\tb",
           "▁", "a▁b c", "<s> </s> <unk> <0x41> <|endoftext|>", "　a　 b\xa0c \xa0 d",
           "naïve ☃☃ 漢字漢字 \x00\x01 \x85 x", "''''''''''''''''''''''''", "=" * 700, " " * 900,
           "aaaa" * 400, "supercalifragilisticexpialidocious", "1234567890" * 30, "\r\n\r\n a", "a;\r\nb;\r c;\r", "\r", "\r \r  x",
           "don't I'll we've", "é" * 99, "x\n y\n  z", "a\n\n\nb", "  \n  \n  "]


@pytest.mark.parametrize("work", [1, 2, 3, 7, 4096])
def test_pieces_of_any_size(work):
    r = np.random.default_rng(work)
    for _ in range(200):
        n = int(r.integers(1, 60))
        a, b = (np.unique(np.append(r.integers(1, n + 1, r.integers(0, n + 1)), n))
                for _ in range(2))
        x, y, cut_a, cut_b = alignment.align(a, b, work)
        start = lambda e, i: 0 if i == 0 else e[i - 1]
        want = {(i, j) for i in range(len(a)) for j in range(len(b))
                if max(start(a, i), start(b, j)) < min(a[i], b[j])}
        assert sorted(zip(x.tolist(), y.tolist(), strict=True)) == sorted(want)
        assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        i, j = alignment.path_points(a, b, work)
        sizes = np.diff(i + j)
        assert (sizes[:-1] == work).all() and 0 < sizes[-1] <= work


@pytest.mark.parametrize("work", [5, 4096])
def test_segments_have_the_tokens_of_whole_texts(aligner, work):
    aligner = alignment.Aligner(*alignment.default_paths(), cache=50, work=work)
    r = random.Random(2)
    letters = list("aabé '\n\t  sd;\r　\xa01.,<☃") + ["the", "ing", "  ", "\n\n", " and"]
    texts = AWKWARD + ["".join(r.choice(letters) for _ in range(r.randint(1, 30)))
                       for _ in range(1500)]
    for text in texts:
        found = tokens(aligner, text)
        known = aligner.meet(set(aligner.segments(text)))
        got = [known[s] for s in aligner.segments(text)]
        if found is None:
            assert None in got, repr(text)
            continue
        g = groups(found)
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        assert ";".join(k[1] for k in got) == shown, repr(text)
        assert sum(k[0][3] for k in got) == sum(len(x) * len(y) for x, y in g)


def test_long_group_counts_every_link(aligner, monkeypatch):
    text = "=" * 700 + " " + "漢字" * 200
    plain = alignment.Aligner(*alignment.default_paths())
    want = plain.meet(set(plain.segments(text)))
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 3)
    few = alignment.Aligner(*alignment.default_paths())
    got = few.meet(set(few.segments(text)))
    assert got == want


def test_both_encoders_of_the_first_tokenizer_agree(aligner):
    assert aligner.ranked is not None
    tokens = [b.decode("utf-8", "ignore") for b in aligner.a_bytes.values()]
    for text in tokens + AWKWARD:
        assert aligner.ranked.encode_ordinary(text) == \
            aligner.a.encode(text, add_special_tokens=False).ids, repr(text)


def test_segments_part_where_no_token_reaches_across():
    cut = lambda tokens, text: [s for s in alignment.segment_pattern(tokens).findall(text) if s]
    assert cut([" a", "\n\n"], " a\nb  c \n d ") == [" a", "\n", "b", "  c", " \n d", " "]
    assert cut([";\r"], " a;\r\nb c\rd e") == [" a;\r\nb", " c\rd", " e"]
    with pytest.raises(ValueError, match="behind another"):
        alignment.segment_pattern(["a b"])
    with pytest.raises(ValueError, match="line end"):
        alignment.segment_pattern(["a\n"])


def test_rows(spark, aligner):
    table = cases.rows() + list(enumerate(AWKWARD, 2000))
    got = alignment.aligned(cases.frame(spark, table))
    assert cases.collected(got) == brute(aligner, table)


def test_chunks_do_not_change_counts(spark, aligner, monkeypatch):
    table = cases.rows(n=40)
    row = lambda part, i: alignment.chunk_row(
        aligner, i, [d for d, _ in part], [t or "" for _, t in part])
    held = Counter()
    for i, at in enumerate(range(0, len(table), 7)):
        r = row(table[at:at + 7], i)
        held.update(dict(zip(r.column("pairs")[0].as_py(), r.column("holders")[0].as_py(),
                             strict=True)))
    whole = row(table, 0)
    assert held == dict(zip(whole.column("pairs")[0].as_py(), whole.column("holders")[0].as_py(),
                            strict=True))


def test_empty_table(spark):
    assert alignment.aligned(cases.frame(spark, [])).collect() == []


def test_query_on_whole_documents(spark, sf_dir, aligner):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op13_alignment(spark, sf_dir)
    assert cases.collected(got) == brute(aligner, [tuple(d) for d in docs])
