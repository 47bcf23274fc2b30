"""A training corpus from raw documents: five text operators, one after the other.

Each stage works on all rows that its predecessor kept, and all but the last return the columns
of the documents.  A stage is a plain function, so stages can be chained as they are; ``run`` writes
the rows of each to the shared folder, reads them again, and then drops what the stage itself had
written there.

Defined results, in every stage: a null text counts as empty, so the quality rules reject it, and
where it passes (a table that enters at a later stage) it stays one row; a null id is an id like
any other and the last of them in an order; equal rows and ties follow the operators (the smallest
id stays, of equal ids the first in the input); texts of any length are worked on whole; an empty
table gives an empty result with the same columns; further columns go along unchanged, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import linededup, nearcopies, pieces, quality, suffixdedup
from basketry.llm.common import read_documents
from basketry.session import drop_paths, materialise, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the votes of the quality rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first one only."""
    return _recounted(linededup.drop_repeated_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash of 5-word shingles, BK-trees, and
    a check of the pairs they find (similarity 0.8)."""
    return nearcopies.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that an earlier document has go."""
    return _recounted(suffixdedup.drop_repeated_passages(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two lengths, without padding."""
    return pieces.digests(pieces.power_of_two_pieces(docs))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("passage_dedup", passage_dedup), ("packing", packing)]

# The fit of the first stage has no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, done = read_documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        with scratch_scope() as own:
            rows = materialise(stage(spark, rows, sf_dir), name)
        drop_paths(spark, done + own[:-1])
        done = own[-1:]
    return STAGES[-1][1](spark, rows, sf_dir)
