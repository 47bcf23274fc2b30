import zlib

import numpy as np
import pytest

from basketry.llm import packing, pieces
from basketry.llm.tokens import END_ID, WordTokenizer, default_tokenizer
from tests.llm.cases import frame, rows


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [END_ID]


ODD = ["don't stop, it's 3.14 <|endoftext|>x", " a b ́c", "é é ﬁ İ", "日本語 テキスト 🙂🙂",
       "a\x00b \x1c c\x85d", "ΣΑΣ ǅx \u0345a \u1e9e", "\ufeffa </w> <w/> '' 's'sa 's", "<|startoftext|> <|endoftext|>", "1234 ½ ²", "x" * 3000]


def test_words_equal_whole_texts(plain):
    encoder = WordTokenizer(default_tokenizer(), cache_words=20)
    texts = [*ODD, *(t or "" for _, t in rows())]
    for text in texts:
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() + [END_ID] == ids_of(plain, text), text[:40]


def test_lengths():
    assert pieces.lengths(4096 * 2 + 13, 4096) == [4096, 4096, 8, 4, 1]
    assert pieces.lengths(0) == []
    for n in range(1, 300):
        cut = pieces.lengths(n, 64)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= 64 for x in cut)


def test_pieces_round_trip(spark, plain):
    table = [*rows(), *((600 + i, t) for i, t in enumerate(ODD))]
    got = pieces.power_of_two_pieces(frame(spark, table), longest=256)
    full = got.collect()
    assert len({r.sequence_id for r in full}) == len(full)
    assert all(r.offset == 0 and len(r.ids) == 4 * r.length for r in full)
    joined: dict = {}
    for r in sorted(full, key=lambda r: r.sequence_id):  # pieces of a row follow each other
        if r.start == 0:
            joined.setdefault(r.doc_id, []).append(b"")
        assert len(joined[r.doc_id][-1]) == 4 * r.start
        joined[r.doc_id][-1] += r.ids
    want: dict = {}
    for i, t in table:
        want.setdefault(i, []).append(np.array(ids_of(plain, t), "<u4").tobytes())
    assert {k: sorted(v) for k, v in joined.items()} == {k: sorted(v) for k, v in want.items()}
    marks = {(r.sequence_id, r.ids_crc32) for r in pieces.digests(got).collect()}
    assert marks == {(r.sequence_id, zlib.crc32(r.ids)) for r in full}
    with pytest.raises(ValueError):
        pieces.power_of_two_pieces(frame(spark), longest=100)


def test_buckets_are_written(spark, tmp_path):
    pieces.write_buckets(pieces.power_of_two_pieces(frame(spark)), str(tmp_path / "b"))
    assert {p.name for p in (tmp_path / "b").iterdir() if p.is_dir()} >= {"length=1", "length=2"}


def test_best_fit_takes_the_least_room():
    sizes = [7, 5, 3, 3, 2, 2, 1, 9, 10]
    packed = packing.best_fit_decreasing(sizes, 10)
    assert sorted(i for row in packed for i in row) == list(range(len(sizes)))
    filled = sorted(sum(sizes[i] for i in row) for row in packed)
    assert filled == [2, 10, 10, 10, 10]


def test_best_fit_against_brute_force():
    r = np.random.default_rng(3)
    for _ in range(30):
        size = int(r.integers(5, 70))
        sizes = r.integers(1, size + 1, 60).tolist()
        rooms: list[int] = []
        for s in sorted(sizes, reverse=True):
            fits = [i for i, room in enumerate(rooms) if room >= s]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= s
            else:
                rooms.append(size - s)
        got = packing.best_fit_decreasing(sizes, size)
        assert sorted(size - sum(sizes[i] for i in row) for row in got) == sorted(rooms)


def test_packed_round_trip(spark, plain):
    table = rows()
    got = packing.pack(frame(spark, table), row_tokens=64, group_tokens=3000).collect()
    parts: dict = {}
    for r in got:
        ids, at = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(at) == 64 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert not ids[r.n_tokens:].any()
        for k, (doc, start) in enumerate(zip(r.doc_ids, r.starts, strict=True)):
            a, b = r.cu_seqlens[k:k + 2]
            assert at[a:b].tolist() == list(range(b - a))
            parts.setdefault((doc, start), []).append(ids[a:b].tolist())
    want: dict = {}
    for i, t in table:
        ids = ids_of(plain, t)
        for a in range(0, len(ids), 64):
            want.setdefault((i, a), []).append(ids[a:a + 64])
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    used = sum(r.n_tokens for r in got) / (64 * len(got))
    assert used > 0.9
    assert packing.pack(frame(spark, [])).count() == 0
