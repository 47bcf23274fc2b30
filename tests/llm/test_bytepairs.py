"""Two-tier byte pairs against the library of the rank file."""

import hashlib
import random

import numpy as np
import pytest

from basketry.llm import bytepairs, queries
from tests.llm import cases

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=bytepairs.default_pattern(), special_tokens={},
                             mergeable_ranks=bytepairs.read_ranks(bytepairs.default_ranks()))


@pytest.fixture(scope="module")
def pairs():
    return bytepairs.BytePairs(bytepairs.default_ranks())


def ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, dtype="<u4").tolist()


def expected(library, doc_id, text):
    want = library.encode_ordinary(text or "")
    packed = np.array(want, dtype="<u4").tobytes()
    return (doc_id, len(want), hashlib.sha256(packed).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_every_token_has_a_slot_of_its_own(pairs):
    tokens = list(pairs.rank_of)
    slots = pairs.hash.find(tokens)
    assert sorted(slots) == list(range(len(tokens)))
    assert [pairs.id_at[s] for s in slots] == list(pairs.rank_of.values())
    assert pairs.hash.find([b"no such token at all", b""]) == [-1, -1]


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
def test_hash_of_small_sets(n):
    keys = [b"k%d" % i for i in range(n)]
    found = bytepairs.PerfectHash(keys)
    assert sorted(found.find(keys)) == list(range(n)) and found.find([b"x"]) == [-1]


def test_random_texts(library, pairs):
    r = random.Random(3)
    letters = list("aab '\n\t  sdtéß　\xa0\x1c\x851.²,<|>▁☃") + ["the", "ing", "'ll", "<|endoftext|>"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    for text, packed in zip(texts, pairs.encode(texts), strict=True):
        assert ids(packed) == library.encode_ordinary(text), repr(text)
        assert pairs.decode(packed) == text.encode()


def test_every_low_character(library, pairs):
    texts = [f"a{c}b {c}{c} 1{c}\n{c}" for c in map(chr, range(0x3100))]
    assert list(map(ids, pairs.encode(texts))) == [library.encode_ordinary(t) for t in texts]


def test_long_pre_token(library, pairs):
    text = "ab" * 40_000 + "a" * 40_000
    assert ids(pairs.encode([text])[0]) == library.encode_ordinary(text)


def test_generations_keep_results(library):
    small = bytepairs.BytePairs(bytepairs.default_ranks(), cache=20)
    r = random.Random(5)
    for _ in range(30):
        text = " ".join(f"w{r.randint(0, 60)}" for _ in range(30))
        assert ids(small.encode([text])[0]) == library.encode_ordinary(text)


def test_rows(spark, library):
    table = cases.rows()
    got = bytepairs.digests(bytepairs.decode(bytepairs.encode(cases.frame(spark, table))))
    assert cases.collected(got) == sorted((expected(library, i, t) for i, t in table), key=repr)


def test_empty_table(spark):
    assert bytepairs.decode(bytepairs.encode(cases.frame(spark, []))).collect() == []


def test_query_on_whole_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_byte_bpe(spark, sf_dir)
    assert cases.collected(got) == sorted((expected(library, *d) for d in docs), key=repr)
