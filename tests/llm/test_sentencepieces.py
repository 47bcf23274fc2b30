import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from basketry.llm import sentencepieces as sp
from tests.llm.cases import collected, frame, rows

ODD = ["", " ", "   ", "Hello  World\n\ta ﬁ é é", "  lead trail ", "a\x00b\x01", "<s>hi</s><0x41>",
       "　全角 日本語のテキスト", "🙂🙂﻿ 𝔘𝔫𝔦", "x" * 900 + " " * 50 + "ab" * 700, "▁x",
       "the thethe thethethe" * 60, "Ωmega ß ŉ ǅ", "…—“”", "\n" * 30, " " * 400 + "a"]


@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder(sp.default_model(), cache_units=50)


def ids(encoder, texts):
    return [np.frombuffer(i, "<u4").tolist() for i in encoder.encode_all(texts)]


def test_ids_are_the_librarys(encoder):
    texts = [*ODD, *(t or "" for _, t in rows())]
    want = encoder.model.library.encode(texts)
    for text, a, b in zip(texts, ids(encoder, texts), want, strict=True):
        assert a == b, text[:60]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]),
                                  st.sampled_from(" ▁atheingon.")), max_size=60), max_size=6))
def test_any_text(texts):
    encoder = sp.worker_encoder(sp.default_model())
    assert ids(encoder, texts) == encoder.model.library.encode(texts)
    for text, found in zip(texts, encoder.encode_all(texts), strict=True):
        assert sp.decode(encoder.model, found) == text.replace(sp.MARK, " ")


def test_long_units_relax_alike():
    """The heap and the rounds give the same pieces."""
    r = random.Random(6)
    texts = ["".join(r.choice("theingationsrd") for _ in range(r.randint(1, 300)))
             for _ in range(60)]
    encoders = [sp.Encoder(sp.default_model(), long_unit=k) for k in (0, 1000)]
    one, two = ([*e.encode_all(texts)] for e in encoders)
    assert one == two
    assert ids(encoders[0], texts) == encoders[0].model.library.encode(texts)


def test_edges_are_all_occurrences(encoder):
    text = "the thing▁▁then"
    codes = np.array([ord(c) + 1 for c in text] + [0], dtype=np.uint32)
    keys, _, found = encoder.model.edges(codes)
    at, length = np.divmod(keys, 2 * encoder.model.width)
    got = set(zip(at.tolist(), length.tolist(), strict=True))
    model = encoder.model
    names = {model.library.id_to_piece(int(i)) for i in model.piece_id}
    want = {(a, k) for a in range(len(text)) for k in range(2, model.width + 1)
            if a + k <= len(text) and text[a:a + k] in names}
    assert got == want and (np.diff(keys) > 0).all()
    assert [model.library.id_to_piece(int(i)) for i in found] == [
        text[a:a + k] for a, k in zip(at, length)]


def test_rows(spark, encoder):
    table = [*rows(), *((600 + i, t) for i, t in enumerate(ODD))]
    got = sp.encode(frame(spark, table))
    want = sorted(((i, np.array(encoder.model.library.encode(t or ""), "<u4").tobytes())
                   for i, t in table), key=repr)
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got.collect()), key=repr) == want
    assert {r.doc_id for r in got.where("not round_trip").collect()} == {
        i for i, t in table if sp.MARK in (t or "")}
    back = sorted(((i, (t or "").replace(sp.MARK, " ")) for i, t in table), key=repr)
    assert collected(sp.decode_rows(got)) == back
    assert sp.encode(frame(spark, [])).count() == 0
