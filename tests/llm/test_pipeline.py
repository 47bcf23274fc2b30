import zlib

import numpy as np
import pytest

import corpus_pipeline
from basketry.llm import pieces, quality
from tests.llm import test_linededup, test_nearcopies, test_suffixdedup
from tests.llm.cases import frame, rows
from tests.llm.test_packing import ids_of


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    from basketry.llm.tokens import default_tokenizer

    return Tokenizer.from_file(default_tokenizer())


def table():
    """The awkward rows, and enough ordinary ones for the quality rules."""
    import random

    r = random.Random(1)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(900)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, line = text(30), text(8)
    out = []
    for i in range(70):
        body = f"{text(r.randint(30, 80))}\n{text(40)}"
        if i % 5 == 0:
            body += "\n" + line
        if i % 7 == 0:
            body = f"{text(20)} {shared} {body}"
        if i % 11 == 0 and out:
            body = out[-3][1] if len(out) > 3 else body
        if i % 13 == 0:
            body = body.replace(" ", " ### ")
        out.append((1000 + i, body))
    # Near copies: too far apart for two bits of a fingerprint, and on both sides of 0.8.
    return rows(n=40) + out + test_nearcopies.near_copies(4, 6)


def test_against_brute_force(spark, plain):
    docs = frame(spark, table(), wide=False)
    now = docs
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")  # chained as they are, nothing is written in between
        assert now.columns == docs.columns
        assert not now.where("n_chars <> length(text)").count() or stage.__name__ == "quality_rules"
        steps.append([(x.doc_id, x.text) for x in now.collect()])
    key = lambda x: sorted(x, key=repr)
    good, lines, one, passages = steps
    marked = quality.judge(docs).groupBy("doc_id").agg({"kept": "max", "*": "count"}).collect()
    sure = {x.doc_id: x["max(kept)"] for x in marked if x["count(1)"] == 1}
    assert {i for i, _ in good if i in sure} == {i for i, k in sure.items() if k}
    assert 0 < len(good) < len(table()) and set(good) <= set(table())
    assert key(lines) == key((i, t) for i, _, _, t in test_linededup.brute(good))
    left = test_nearcopies.brute_kept(lines)
    assert sorted((i is None, i or 0) for i, _ in one) == left
    assert len(left) < len(lines) and set(one) <= set(lines)
    cut = test_suffixdedup.brute(one, 50)
    assert key(passages) == key((i, k.decode("utf-8", "ignore")) for i, _, _, _, k in cut)
    assert sum(r[2] for r in cut) > 0
    want = []
    for i, t in passages:
        ids, start = np.array(ids_of(plain, t), "<u4"), 0
        for n in pieces.lengths(len(ids)):
            want.append((i, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids)))
            start += n
    packed = corpus_pipeline.STAGES[-1][1](spark, now, "")
    got = [(x.doc_id, x.start, x.length, x.ids_crc32, x.doc_tokens) for x in packed.collect()]
    assert key(got) == key(want)


def test_empty_table(spark):
    docs = frame(spark, [], wide=False)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, docs, "")
        assert now.columns == docs.columns and now.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_columns_go_along(spark):
    """Clashing names, nulls and equal rows through every stage."""
    docs = frame(spark, table())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, docs, "")
        assert now.columns == docs.columns
        assert now.where("_row <> 'r' or digest <> 'd' or h <> 'h'").count() == 0 < now.count()


def test_run(spark, sf_dir):
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    got = corpus_pipeline.run(spark, sf_dir)
    clean = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = quality.keep_good(docs).select("doc_id")
    long = docs.where("size(split(trim(text), '[ \\\\n]+')) >= 50").select("doc_id")
    lost = clean.join(long, "doc_id").join(kept, "doc_id", "left_anti").count()
    assert got.count() > 0 and lost <= 0.02 * clean.count()
